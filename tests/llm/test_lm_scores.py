import collections
import math
import zlib

import brute
import numpy as np
import pytest

from earshot.llm import attention as att
from earshot.llm import lm_scores
from earshot.llm.subwords import Numbers, subwords


def _base(rows):
    """doc_id to (held out, tokens, known, training tokens, base score)."""
    out_of = {i: zlib.crc32(str(i).encode()) % 7 == 2 if i is not None else False for i, _ in rows}
    counts = collections.Counter()
    for i, text in rows:
        if not out_of[i]:
            counts.update([*brute.words(text), None])
    n, v = sum(counts.values()), len(counts)
    out = {}
    for i, text in rows:
        tokens = [*brute.words(text), None]
        score = sum(math.log10((counts[t] + 1) / (n + v + 1)) for t in tokens)
        out[i] = (out_of[i], len(tokens), sum(counts[t] > 0 for t in tokens), n, pytest.approx(score, rel=1e-9))
    return out


def _rows(df):
    return {r.doc_id: (r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in df.collect()}


@pytest.mark.parametrize("frequent", [40, 500_000])
def test_base_scores_and_held_out_gain(spark, sf, frequent):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    scored = lm_scores.score(docs, frequent=frequent).cache()
    assert _rows(scored) == _base(rows)
    # The attention model does better on texts it has not seen than their subwords' own frequencies.
    own = subwords(lm_scores.VOCABULARY)
    held = {i: [own._encoding.encode_ordinary(" " + w) for w in brute.words(t)] for i, t in rows}
    out_of = {r.doc_id: r.held_out for r in scored.collect()}
    counts = np.full(own.size, 0.5)
    for i, found in held.items():
        if not out_of[i]:
            for ids in found:
                np.add.at(counts, ids, 1)
            counts[own.end] += 1
    logs = np.log10(counts / counts.sum())
    plain = sum(logs[own.end] + sum(logs[j] for ids in found for j in ids) for i, found in held.items() if out_of[i])
    model = sum(r.score for r in scored.collect() if r.held_out)
    assert plain < model < 0
    assert all(r.score < 0 for r in scored.collect())
    scored.unpersist()


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \n"), (4, "One one ONE"), (5, "no " * 60_000), (None, "one"), (7, "é😀 ß"), (8, "x" * 30_000)]
    docs = spark.createDataFrame([(*r, 0.0) for r in rows], "doc_id long, text string, score double")
    got = lm_scores.score(docs)
    assert _rows(got) == _base(rows)
    assert all(math.isfinite(r.score) for r in got.collect())
    again = {r.doc_id: r.score for r in lm_scores.score(docs).collect()}
    assert again == pytest.approx({r.doc_id: r.score for r in got.collect()}, rel=1e-6)
    assert lm_scores.score(docs.limit(0)).count() == 0


def test_chances_of_all_ids_sum_to_one():
    counts = np.random.default_rng(0).integers(0, 9, 2_000) ** 3
    classes = att.make_classes(counts)
    mass = np.bincount(classes.classes, np.exp(classes.within), att.HEAD + att.BANDS)
    assert mass == pytest.approx(np.ones(att.HEAD + att.BANDS))
    p = att.new_parameters()
    places, exists, _ = att.windows(np.array([0]), np.array([50]))
    inputs = np.random.default_rng(1).integers(0, att.INPUTS, 50)[places]
    total = sum(np.exp(att.log_chances(att.Tables(p), inputs, exists, np.full((len(places), att.STRIDE), c))) for c in range(att.HEAD + att.BANDS))
    assert total == pytest.approx(np.ones_like(total), abs=1e-4)


def test_each_place_is_scored_once_and_sees_what_is_before_it():
    begin, length = np.array([0, 70, 70]), np.array([70, 0, 31])
    places, exists, owner = att.windows(begin, length)
    scored = slice(att.WINDOW - att.STRIDE, None)
    found = sorted(places[:, scored][exists[:, scored]].tolist())
    assert found == list(range(101))
    p = att.new_parameters()
    rng = np.random.default_rng(3)
    inputs = rng.integers(0, att.INPUTS, 101)
    targets = rng.integers(0, att.HEAD, 101)
    one = att.log_chances(att.Tables(p), inputs[places], exists, targets[places[:, scored]])
    changed = inputs.copy()
    changed[60] = (changed[60] + 1) % att.INPUTS
    two = att.log_chances(att.Tables(p), changed[places], exists, targets[places[:, scored]])
    differs = set(places[:, scored][exists[:, scored] & (one != two)].tolist())
    assert differs and min(differs) == 60 and max(differs) < 60 + att.WINDOW


@pytest.mark.parametrize("name", list(att.SHAPES))
def test_gradients_are_those_of_small_steps(name):
    rng = np.random.default_rng(4)
    p = {n: v.astype(np.float64) for n, v in att.new_parameters().items()}
    p["far"] += rng.standard_normal(att.WINDOW) * 0.1
    places, exists, _ = att.windows(np.array([0, 40]), np.array([40, 17]))
    inputs = rng.integers(0, 12, 57)[places]
    asked = places[:, att.WINDOW - att.STRIDE :]
    there = exists[:, att.WINDOW - att.STRIDE :]
    targets = rng.integers(0, att.HEAD, 57)[asked]

    def loss():
        return -np.where(there, att.log_chances(att.Tables(p), inputs, exists, targets), 0).sum() / there.sum()

    g = att.gradients(p, inputs, exists, targets, there)[name]
    for place in rng.permutation(p[name].size)[:6] if name != "embed" else range(0, 12 * att.WIDTH, 37):
        at = np.unravel_index(place, p[name].shape)
        kept = p[name][at]
        p[name][at] = kept + 1e-4
        up = loss()
        p[name][at] = kept - 1e-4
        down = loss()
        p[name][at] = kept
        assert g[at] == pytest.approx((up - down) / 2e-4, abs=2e-5)


def test_every_block_is_learnt_from_once():
    words = np.array([0, 1, 96, 97, 500, 2_300, 12_345])
    first = np.concatenate([[0], np.cumsum(words)])
    salts = np.arange(len(words)) % lm_scores.ROUNDS
    taken = [lm_scores._block_words(first, salts, turn, lm_scores.ROUNDS) for turn in range(lm_scores.ROUNDS)]
    begin, end, opens, closes = (np.concatenate(parts) for parts in zip(*taken))
    times = np.zeros(first[-1], int)
    for a, b in zip(begin, end):
        times[a:b] += 1
    assert (times == 1).all()
    assert opens.sum() == closes.sum() == len(words)


def test_all_tokens_give_gradients(spark):
    docs = spark.createDataFrame([(k, " ".join(f"w{k}x{j}" for j in range(37 * k % 400)), k) for k in range(60)], "doc_id long, text string, salt long")
    own = subwords(lm_scores.VOCABULARY)
    content = [own._encoding.encode_ordinary(" " + w) for r in docs.collect() for w in r.text.split()]
    asked = sum(map(len, content)) + docs.count()
    classes = att.make_classes(np.ones(own.size, np.int64))
    shared = spark.sparkContext.broadcast((att.flat(att.new_parameters(classes.mass)), classes))
    seen = 0.0
    for turn in range(lm_scores.ROUNDS):
        run = lm_scores._training(shared, lm_scores.VOCABULARY, turn, lm_scores.ROUNDS, 0.01)
        sums = docs.select("text", "salt").coalesce(1).mapInArrow(run, "place int, value double")
        seen += max(sums.collect(), key=lambda r: r.place).value
    assert seen == asked


def test_texts_are_read_once_and_ids_after_that(spark, monkeypatch):
    seen = {}

    def noting(name):
        own = getattr(lm_scores, name)

        def noted(rows, *more):
            seen[name] = rows.columns
            return own(rows, *more)

        monkeypatch.setattr(lm_scores, name, noted)

    noting("count_tokens")
    noting("train")
    docs = spark.createDataFrame([(k, f"one two {k}") for k in range(20)], "doc_id long, text string")
    assert lm_scores.score(docs).count() == 20
    assert seen == {"count_tokens": ["size", "ids"], "train": ["size", "ids", "salt"]}


def test_ids_and_keys_of_words():
    own = subwords(lm_scores.VOCABULARY)
    words = ["no", "NO", "x y", " ", " ", "é😀", "a\x1cb", "x" * 5_000, "0,5", "no", "\x00"]
    texts = ["", " ".join(words), "  ", "no " * 3_000 + "é😀", " "]
    raw = [t.encode() for t in texts] + [b"\xff\xfe a\xff", b"\xff\xfe"]
    content = np.frombuffer(b"".join(raw), np.uint8)
    ids, edge = own.encode(content, np.concatenate([[0], np.cumsum([len(t) for t in raw])]))
    for k, text in enumerate(texts):
        plain = [i for w in brute.words(text) for i in own._encoding.encode_ordinary(" " + w)]
        assert ids[edge[k] : edge[k + 1]].tolist() == [*plain, own.end]
    assert own._encoding.decode_bytes(ids[edge[5] : edge[6] - 1].tolist()) == b" \xff\xfe a\xff"
    keys, heads = own.word_keys(ids)
    counts = np.diff(np.searchsorted(heads, edge))
    assert counts.tolist() == [0, len(words), 0, 3_001, 1, 2, 1]
    found = [w.lower() for t in texts for w in brute.words(t)] + ["�1", "�2", "�1"]
    by_word = {}
    for word, key in zip(found, keys.tolist()):
        assert by_word.setdefault(word, key) == key
    assert len(set(by_word.values())) == len(by_word)


def test_numbers_of_keys():
    rng = np.random.default_rng(5)
    keys = rng.integers(0, 1 << 63, 90_000).astype(np.uint64) * np.uint64(2)
    keys[:300] = (keys[:300] >> np.uint64(40)) << np.uint64(1)  # all of these want the same few places
    keys = rng.permutation(np.concatenate([np.unique(keys), np.unique(keys)]))
    index, numbers = Numbers(), {}
    for part in np.array_split(keys, 7):
        found, new = index.learn(part)
        assert found[new].tolist() == list(range(len(numbers), index.count))
        for key, number in zip(part.tolist(), found.tolist()):
            assert numbers.setdefault(key, number) == number
    assert len(numbers) == index.count == len(set(numbers.values()))
    assert index.find(keys).tolist() == [numbers[k] for k in keys.tolist()]
    assert (index.find(keys | np.uint64(1)) == -1).all()


def test_gradients_of_many_windows_are_those_of_their_parts():
    rng = np.random.default_rng(6)
    p = {n: v.astype(np.float64) for n, v in att.new_parameters().items()}
    length = rng.integers(0, 120, 40)
    places, exists, _ = att.windows(np.cumsum(length) - length, length)
    inputs = rng.integers(0, 40, length.sum() + 1)[places]
    scored = slice(att.WINDOW - att.STRIDE, None)
    targets = rng.integers(0, att.HEAD + att.BANDS, exists[:, scored].shape)
    there = exists[:, scored] & (rng.random(targets.shape) < 0.8)
    assert len(places) > 70
    room, whole = att.Room(), att.gradients(p, inputs, exists, targets, there)
    sums = {n: np.zeros_like(v) for n, v in p.items()}
    for at in range(0, len(places), 7):
        part = slice(at, at + 7)
        for name, g in att.gradients(p, inputs[part], exists[part], targets[part], there[part], room).items():
            sums[name] += g * there[part].sum() / there.sum()
    for name, g in whole.items():
        assert g == pytest.approx(sums[name], abs=1e-7)
