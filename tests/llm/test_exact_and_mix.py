import collections
import hashlib
import re

import pytest
from pyspark.sql import functions as F

from earshot.llm import exact_dedup, mixing

SCHEMA = "doc_id long, text string, source string"


def test_chunks_join_to_the_text(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    short = exact_dedup.normalised()
    found = docs.select(short.alias("s"), exact_dedup.chunks(short).alias("c"))
    assert found.filter(F.array_join("c", "") != F.col("s")).count() == 0
    assert found.select(F.max(F.size("c"))).first()[0] > 5


def test_an_edit_moves_few_cuts(spark, sf):
    short = exact_dedup.normalised()
    long = spark.read.parquet(f"{sf}/documents.parquet").select(short.alias("t")).orderBy(F.length("t").desc()).limit(4)
    edited = F.concat(F.substr("t", F.lit(1), F.lit(900)), F.lit("somethingelse"), F.substr("t", F.lit(901)))
    for one, two in long.select(exact_dedup.chunks(F.col("t")), exact_dedup.chunks(edited)).collect():
        assert len(set(one) - set(two)) <= 5 and len(one) > 8


@pytest.mark.parametrize("mask", [-1, 3])
def test_groups_also_where_fingerprints_clash(spark, sf, mask):
    rows = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    rows = [(r.doc_id, r.text) for r in rows]
    rows += [(9001, None), (9002, ""), (9003, " \n"), (9004, rows[0][1].replace(" ", "\t \n")), (3, rows[3][1]), (None, rows[5][1])]
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, recipe int")
    got = exact_dedup.exact_groups(docs, words=1 if mask != -1 else 2, mask=mask).collect()
    groups = collections.defaultdict(list)
    for i, t in rows:
        groups[re.sub(r"[\x20\x09-\x0D]", "", t or "")].append((-len(t or ""), i is None, i))
    want = collections.Counter()
    for short, members in groups.items():
        for member in members:
            want[member[2], min(members)[2], len(members), hashlib.sha256(short.encode()).hexdigest()] += 1
    assert collections.Counter((r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got) == want
    assert sum(r.kept for r in got) == len(groups)
    assert all(r.doc_id == r.keep_id for r in got if r.kept)


def test_clashes_are_seen(spark):
    docs = spark.createDataFrame([(k, f"text {k}") for k in range(40)], "doc_id long, text string")
    assert exact_dedup.verified_words(docs) == exact_dedup.WORDS
    assert exact_dedup.verified_words(docs, words=1, mask=3) > 1


def test_dropping_copies_keeps_columns(spark):
    rows = [(1, "a b", "x"), (1, "a b", "x"), (2, "ab", "y"), (3, None, "z"), (4, " ", None), (5, "c", "x")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("key", F.lit(0)).withColumn("kept", F.lit(False))
    kept = exact_dedup.drop_exact_copies(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 4, 5]
    assert exact_dedup.drop_exact_copies(docs.limit(0)).count() == 0


def _filled(sizes, weights, most):
    """Targets by pouring step by step."""
    total, full = sum(sizes.values()), {}
    while True:
        open_ = [s for s in sizes if s not in full]
        left, weight = total - sum(full.values()), sum(weights[s] for s in open_)
        over = [s for s in open_ if left * weights[s] / weight > most * sizes[s]]
        if not over:
            return {**full, **{s: left * weights[s] / weight for s in open_}}
        full.update({s: most * sizes[s] for s in over})


@pytest.mark.parametrize("sizes", [[5, 7, 9], [1, 100, 1000, 3], [1, 1, 1, 1, 500], [0, 4, 4], [10]])
def test_targets(spark, sizes):
    names = ["b", "a", None, "é", "Z"][: len(sizes)]
    order = sorted(names, key=lambda n: (n is None, n or ""))
    weights = {n: order.index(n) % 3 + 1 for n in names}
    want = _filled(dict(zip(names, sizes)), weights, 3)
    rows = [(n, size) for n, size in zip(names, sizes)]
    got = {r.source: r.target for r in mixing.targets(spark.createDataFrame(rows, "source string, size long")).collect()}
    assert got == pytest.approx(want)


def test_mix_meets_targets_and_reruns_agree(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    one, two = (sorted(map(tuple, mixing.mix(docs, block=16).drop("key").collect())) for _ in range(2))
    assert one == two
    by_source = collections.defaultdict(list)
    for _, size, source_size, target, taken, source, copies in one:
        assert taken == size * copies <= 3 * size
        assert copies in (int(target / source_size), int(target / source_size) + 1)
        by_source[source].append((size, taken, target))
    for rows in by_source.values():
        assert abs(sum(t for _, t, _ in rows) - rows[0][2]) <= max(s for s, _, _ in rows)


def test_chances_are_kept(spark):
    rows = [(k, f"{'w ' * (k % 7 + 1)}", "ab"[k % 2]) for k in range(60)]
    docs = spark.createDataFrame(rows, SCHEMA)
    taken = collections.Counter()
    rounds = 60
    for seed in range(rounds):
        for r in mixing.mix(docs, seed=seed, block=8).collect():
            taken[r.source, r.size] += r.copies * r.size
    sizes = {r.source: (r.source_size, r.target) for r in mixing.mix(docs).collect()}
    for (source, size), words in taken.items():
        own = sum(1 for _, t, s in rows if s == source and t.count("w") == size) * size * rounds
        assert words / own == pytest.approx(sizes[source][1] / sizes[source][0], abs=0.12)


def test_mix_of_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", None), (None, "x y", None), (3, "one", "a"), (3, "one", "a"), (4, "w " * 30_000, "b")]
    docs = spark.createDataFrame(rows, SCHEMA).withColumn("size", F.lit(1)).withColumn("p", F.lit(1))
    got = mixing.mix(docs).collect()
    assert sorted(r.size for r in got) == [0, 0, 1, 1, 2, 30_000]
    assert all(r.taken <= 3 * r.size for r in got)
    assert mixing.mix(docs.limit(0)).count() == 0
