"""Fingerprints, ranked search and collocations beside plain versions, and what they do with odd rows."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict

import pytest
from brute import words
from pyspark.sql import functions as F

from earshot.llm import collocations, fingerprints, lexical, queries

COLUMNS = {
    "op11_fingerprints": {
        "doc_id": "bigint", "n_chars": "bigint", "edited_sha256": "string", "fingerprint": "string", "edited_fingerprint": "string",
        "near_edited": "double", "near_next": "double",
    },
    "op12_search": {"item_id": "bigint", "rank": "int", "doc_id": "bigint", "score": "bigint"},
    "op13_collocations": {
        "lang": "string", "rank": "bigint", "phrase": "string", "a": "bigint", "l": "bigint", "r": "bigint", "n": "bigint", "score": "bigint",
    },
}


def _shingles(text):
    own = words(text)
    if len(own) < 5:
        return {" ".join(own)} if own else set()
    return {" ".join(own[k : k + 5]) for k in range(len(own) - 4)}


def _sketch(text, k):
    return sorted({hashlib.md5(s.encode()).hexdigest()[:12] for s in _shingles(text)})[:k]


def _prose(rng, n):
    return " ".join(rng.choice(["alpha", "Beta", "gamma", "delta,", "épsilon", "ζeta", "eta.\n", "theta", "iota"]) for _ in range(n))


@pytest.fixture(scope="module")
def prose():
    rng = random.Random(5)
    rows = [(k * 3 - 40, _prose(rng, rng.choice([0, 1, 3, 5, 40, 300]))) for k in range(60)]
    return [*rows, (500, None), (501, ""), (502, "   "), (503, "x" * 40), (504, "漢字" * 30), (505, " one  two\tthree four\nfive ")]


@pytest.mark.parametrize(("part", "rows"), [(64, 7), (32_768, 500)])
def test_fingerprints_are_those_of_the_whole_text(spark, prose, part, rows):
    docs = spark.createDataFrame(prose, "doc_id long, text string").withColumn("fingerprint", F.lit(1)).repartition(5)
    got = {r["doc_id"]: r for r in fingerprints.fingerprints(docs, k=16, part=part, rows=rows).collect()}
    falling = sorted(prose, reverse=True)
    assert len(got) == len(prose)
    for at, (doc_id, text) in enumerate(falling):
        text, after = text or "", falling[(at + 1) % len(falling)][1] or ""
        cut = len(text) // 3
        edited = text[: len(text) - cut] + after[:cut]
        assert got[doc_id]["edited"] == edited and got[doc_id]["n_chars"] == len(text)
        assert got[doc_id]["fingerprint"] == _sketch(text, 16)
        assert got[doc_id]["edited_fingerprint"] == _sketch(edited, 16)
        assert got[doc_id]["next_fingerprint"] == _sketch(after, 16)


def test_estimates_come_near_and_merge(spark):
    rng = random.Random(9)
    a = [f"w{rng.randrange(5000)}" for _ in range(4000)]
    b = a[:2500] + [f"v{rng.randrange(5000)}" for _ in range(1500)]
    df = spark.createDataFrame([(" ".join(a), " ".join(b), " ".join(a[:2000]), " ".join(a[1996:]))], "a string, b string, head string, tail string")
    own, other, head, tail = (fingerprints.sketch(F.col(c)) for c in df.columns)
    row = df.select(own.alias("a"), other.alias("b"), fingerprints.merge(head, tail).alias("m")).select(
        "a", "m", fingerprints.resemblance(F.col("a"), F.col("b")).alias("r"), fingerprints.containment(F.col("a"), F.col("b")).alias("c"),
        fingerprints.distinct_shingles(F.col("a")).alias("n"),
    ).first()
    x, y = _shingles(" ".join(a)), _shingles(" ".join(b))
    assert row["a"] == row["m"]
    assert abs(row["r"] - len(x & y) / len(x | y)) < 0.15 and abs(row["c"] - len(x & y) / len(x)) < 0.15
    assert abs(row["n"] / len(x) - 1) < 0.3


def test_fingerprints_of_odd_rows(spark):
    one = fingerprints.fingerprints(spark.createDataFrame([(7, "abcdef")], "doc_id long, text string")).collect()
    assert [r["edited"] for r in one] == ["abcdab"]
    assert fingerprints.fingerprints(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    # Null ids come last, repeated rows stay, an id held by many is dealt out.
    rows = [(None, "n n n")] * 5 + [(3, "c")] * 700 + [(9, "first words")]
    got = fingerprints.fingerprints(spark.createDataFrame(rows, "doc_id long, text string"), rows=4).groupBy("doc_id").count().collect()
    assert {r["doc_id"]: r["count"] for r in got} == {None: 5, 3: 700, 9: 1}


def _search(docs, items, top=20):
    term = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
    lower = {c: c + 32 for c in range(65, 91)}
    found = [(i, Counter(term.findall((t or "").translate(lower)))) for i, t in docs]
    found = [(i, c) for i, c in found if c]
    n_docs, n_terms = len(found), sum(sum(c.values()) for _, c in found)
    df = Counter(t for _, c in found for t in c)
    out = []
    for item, text in items:
        scored = []
        for doc, c in found:
            m = 75 + 25 * sum(c.values()) * n_docs // n_terms
            s = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t in term.findall((text or "").translate(lower)) if t in c
            )
            if s > 0:
                scored.append((-s, doc is None, doc or 0, doc))
        out += [(item, k + 1, doc, -s) for k, (s, _, _, doc) in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


@pytest.mark.parametrize(("block", "seeds", "key_bits"), [(1024, 64, 10), (3, 2, 10), (1024, 3, 1)])
def test_search_gives_the_answers_of_all_pairs(spark, block, seeds, key_bits):
    # With one bit a key the signatures are full of false hits: more is scored, the answers are the same.
    rng = random.Random(3)
    vocabulary = [f"w{k}" for k in range(150)] + ["Éa", "éa", "ß", "naïve", "x1", "X1"]

    def text(n):
        return rng.choice([" ", "-", "\n", "_"]).join(rng.choice(vocabulary[: rng.choice([9, 40, 156])]) for _ in range(n))

    docs = [(k, text(rng.choice([1, 4, 30, 200]))) for k in range(150)] + [(900, None), (901, ""), (902, "-- --"), (None, "w1 w2 w140")]
    docs += [(k, "w3 w77 w140") for k in range(300, 330)] + [(5, "again w3"), (5, "again w3")]
    items = [("a", text(12)), ("b", "w3 w77 w77"), ("c", None), ("d", "unheard of"), ("e", text(60)), ("b", "w3 w77 w77"), (None, "W140 éa")]
    left = spark.createDataFrame(docs, "doc_id long, text string").withColumn("score", F.lit(1)).repartition(4)
    right = spark.createDataFrame(items, "item_id string, text string").coalesce(1)
    got = [tuple(r) for r in lexical.search(left, right, block=block, seeds=seeds, key_bits=key_bits, block_docs=16).select("item_id", "rank", "doc_id", "score").collect()]
    assert sorted(got, key=str) == _search(docs, items)


def test_search_of_empty_tables(spark):
    docs, items = spark.createDataFrame([(1, "a")], "doc_id long, text string"), spark.createDataFrame([("i", "a")], "item_id string, text string")
    assert lexical.search(docs.limit(0), items).count() == 0 and lexical.search(docs, items.limit(0)).count() == 0
    assert lexical.search(docs, items).columns == lexical.search(docs, items.limit(0)).columns


def _phrases(rows, top, least, longest, absorb):
    n, f = Counter(), defaultdict(Counter)
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate({c: c + 32 for c in range(65, 91)})):
            own = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(own)
            for size in range(1, longest + 1):
                f[lang].update(tuple(own[k : k + size]) for k in range(len(own) - size + 1))
    out = []
    for lang, counts in f.items():
        kept = []
        frequent = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        for p, a in frequent.items():
            inside = [b for q, b in frequent.items() if len(q) > len(p) and any(q[k : k + len(p)] == p for k in range(len(q) - len(p) + 1))]
            if any(100 * b >= absorb * a for b in inside):
                continue
            score, k = min((10**6 * a * a // (counts[p[:k]] * counts[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        out += [(lang, at + 1, p.decode(), -a, l, r, n[lang], -s) for at, (s, a, p, l, r) in enumerate(sorted(kept)[:top])]
    return sorted(out)


@pytest.mark.parametrize(("longest", "top", "bits"), [(3, 2000, 27), (4, 25, 27), (2, 2000, 27), (3, 2000, 15)])
def test_collocations_are_those_of_all_counts(spark, longest, top, bits):
    rng = random.Random(11)
    some = ["New York", "of the", "a", "b", "Ça va bien", "zero", "x y z", "É", "ﬁ", "tab\tbed", "q\x1fr", " "]
    texts = [rng.choice([" ", "  ", "\t"]).join(rng.choice(some) + rng.choice(["", "", "", ".", ",", "\r\n", "\x0b"]) for _ in range(30)) for _ in range(150)]
    rows = [(rng.choice(["en", "de", None, "x\ty", ""]), t) for t in texts] + [("en", None), ("fr", ""), ("fr", " . "), ("en", texts[0])] * 3
    docs = spark.createDataFrame(rows, "lang string, text string").withColumn("phrase", F.lit(1)).withColumn("n", F.lit(2)).repartition(4)
    found = collocations.collocations(docs, top=top, longest=longest, width=bits)
    got = sorted(tuple(r) for r in found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score").collect())
    assert got == _phrases(rows, top, 10, longest, 50)


def test_collocations_of_an_empty_table(spark):
    assert collocations.collocations(spark.createDataFrame([], "lang string, text string")).count() == 0


@pytest.mark.parametrize("name", list(COLUMNS))
def test_query_columns(name, spark, sf):
    assert dict(queries.QUERIES[name](spark, sf).dtypes[: len(COLUMNS[name])]) == COLUMNS[name]
