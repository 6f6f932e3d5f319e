import random

import brute
import numpy as np
import pytest

from earshot.llm import near_dup, repeats
from earshot.session import materialize

SCHEMA = "doc_id long, text string"


def _documents(spark, path):
    return spark.read.parquet(f"{path}/documents.parquet")


def _near(df):
    return {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in df.collect()}


@pytest.mark.parametrize("size,percent", [(3, 85), (5, 80)])
def test_near_groups_are_those_of_all_pairs(spark, sf, size, percent):
    docs = _documents(spark, sf)
    want = brute.near_groups([(r.doc_id, r.text) for r in docs.collect()], size, percent)
    got = _near(near_dup.near_duplicates(docs, percent=percent, size=size))
    assert got == {i: (n, c, i == c) for i, (n, c) in want.items()}


def test_near_chain_and_rows_of_every_kind(spark):
    rng = random.Random(4)
    base = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    rows, text = [], list(base)
    for i in range(30):  # each a little further from the first: a chain of links
        rows.append((100 + i, " ".join(text)))
        for k in range(6):
            text[(i * 6 + k * 17) % 300] = f"x{i}-{k}"
    rows += [(1, None), (2, ""), (3, " \t\n"), (4, "one"), (5, "ONE"), (6, "one two"), (7, " ".join(base)), (7, " ".join(base)), (8, "word " * 50_000)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.doc_id, r.n_shingles, r.component_id, r.kept) for r in near_dup.near_duplicates(docs, percent=85, size=3).collect())
    want = brute.near_groups(list(dict(rows).items()), 3, 85)
    assert got == sorted((i, *want[i], i == want[i][1]) for i, _ in rows)


def test_near_without_rows_and_without_ids(spark):
    assert near_dup.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    docs = spark.createDataFrame([(None, "a b c d e f g", 1), (None, "a b c d e f g", 2), (3, None, 3)], "doc_id long, text string, key int")
    got = near_dup.near_duplicates(docs).collect()
    assert sorted((r.n_shingles, r.component_id, r.kept) for r in got if r.doc_id is None) == [(3, None, True)] * 2
    assert near_dup.drop_near_copies(docs).columns == docs.columns


def test_repeats_are_those_of_all_places(spark, sf):
    rows = _documents(spark, sf).select("doc_id", "text").collect()
    want = {r.doc_id: w for r, w in zip(rows, brute.repeats([r.text for r in rows], 200))}
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in repeats.cut_repeats(_documents(spark, sf)).collect()}
    assert got == want


@pytest.mark.parametrize("seed", range(3))
def test_repeats_in_texts_of_few_letters(spark, seed):
    rng = random.Random(seed)
    passages = ["".join(rng.choice("ab") for _ in range(rng.randrange(10, 90))) for _ in range(6)]
    rows = [(i, "".join(rng.choice([*passages, rng.choice("abé")]) for _ in range(rng.randrange(12)))) for i in range(60)]
    rows += [(60, None), (61, ""), (62, "a" * 5000), (63, rows[0][1]), (63, rows[0][1]), (None, rows[1][1])]
    docs = spark.createDataFrame(rows, SCHEMA)
    want = sorted(zip([str(i) for i, _ in rows], brute.repeats([t for _, t in rows], 40)))
    got = repeats.cut_repeats(docs, length=40, gram=8).collect()
    assert sorted((str(r.doc_id), (r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256)) for r in got) == want
    assert repeats.cut_repeats(docs.limit(0)).count() == 0


def test_parities_bound_what_two_sets_do_not_share(spark):
    """Differing bits are never more than the shingles that only one set has, and close to them where these are few."""
    rng = np.random.default_rng(5)
    sets, apart = [], []
    for n, changed in [(1, 0), (5, 2), (148, 10), (148, 34), (900, 80), (20000, 9000), (0, 0)]:
        first = np.unique(rng.integers(0, 1 << 63, n, dtype=np.uint64))
        second = np.unique(np.concatenate([first[changed:], rng.integers(0, 1 << 63, changed, dtype=np.uint64)]))
        sets += [first, second]
        apart.append(len(np.setxor1d(first, second)))
    rows = near_dup.parities(sets)
    pairs = [(rows[k].tolist(), rows[k + 1].tolist(), apart[k // 2]) for k in range(0, len(sets), 2)]
    df = spark.createDataFrame(pairs, "a array<long>, b array<long>, apart long")
    got = df.select("apart", near_dup.least_apart("a", "b").alias("least")).collect()
    assert all(r.least <= r.apart for r in got)
    assert all(r.least >= 0.8 * r.apart for r in got if r.apart <= 70)


def test_families_that_drift_take_a_row_of_each_band(spark, monkeypatch):
    """A class of a large family whose members are apart goes on with a row for each band, not for each two of them."""
    rng = np.random.default_rng(3)
    texts = []
    for _ in range(120):
        words = [f"w{k}" for k in range(150)]
        for place in rng.choice(150, size=4, replace=False):
            words[place] = f"x{rng.integers(0, 60)}"
        texts.append(" ".join(words))
    held = {}

    def counted(df, label="step"):
        held[label] = materialize(df, label)
        return held[label]

    monkeypatch.setattr(near_dup, "materialize", counted)
    docs = spark.createDataFrame(list(enumerate(texts)), SCHEMA)
    assert _near(near_dup.near_duplicates(docs, percent=85, size=3)) == {
        i: (n, c, i == c) for i, (n, c) in brute.near_groups(list(enumerate(texts)), 3, 85).items()
    }
    assert held["waiting"].count() > 10 * len(texts)
    assert max(step.count() for step in held.values()) <= near_dup.BANDS * len(texts)


def test_families_that_drift_are_linked_as_by_all_pairs(spark):
    """Members of one large family around the threshold, which no single hub links."""
    rng = np.random.default_rng(11)
    base = [f"w{k}" for k in range(120)]
    texts = []
    for k in range(160):
        words = list(base)
        for place in rng.choice(120, size=int(rng.integers(0, 9)), replace=False):
            words[place] = f"x{rng.integers(0, 400)}"
        texts.append(" ".join(words[: 120 - int(rng.integers(0, 12))]))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in near_dup.near_duplicates(docs, percent=85, size=3).collect()}

    def shingles(text):
        w = text.split()
        return {tuple(w[i : i + 3]) for i in range(len(w) - 2)}

    held = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for a in range(len(texts)):
        for b in range(a):
            if 100 * len(held[a] & held[b]) >= 85 * len(held[a] | held[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    want = {k: find(k) for k in range(len(texts))}
    assert len(set(want.values())) > 3
    assert got == want
