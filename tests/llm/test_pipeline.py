import brute
from pyspark.sql import functions as F

import corpus_pipeline
from earshot.llm import decontaminate, mixing


def test_stages_take_effect(spark, sf):
    """Each stage against a plain version, on what the one before kept."""
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = docs.columns
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, docs, sf).cache()
        before = {r.doc_id: r.text for r in docs.collect()}
        after = {r.doc_id: r.text for r in found.collect()}
        assert all(before[i] == t for i, t in after.items())
        if name != "mixing":
            assert found.columns == names
        kept[name] = before, after
        docs = found
    before, after = kept["quality"]
    labels = {r.doc_id: (r.quality, r.toxic) for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    good = [i for i, rating in labels.items() if rating == (1, 0)]
    bad = [i for i, rating in labels.items() if rating != (1, 0)]
    # So few ratings teach little; test_held_out_ratings_are_met has more.
    assert sum(i in after for i in good) > 0.95 * len(good) and sum(i in after for i in bad) < len(bad)

    before, after = kept["exact_dedup"]
    short = lambda t: "".join(brute.WORD.findall(t or ""))
    best: dict = {}
    for i, t in before.items():
        rank = (-len(t or ""), i)
        best[short(t)] = min(best.get(short(t), rank), rank)
    assert set(after) == {i for _, i in best.values()}

    before, after = kept["near_dedup"]
    assert set(after) == {i for i, (_, least) in brute.near_groups(list(before.items()), 5, 80).items() if i == least}

    before, after = kept["decontamination"]
    rows = spark.createDataFrame(list(before.items()), "doc_id long, text string")
    leaks = {r.doc_id for r in decontaminate.find_leaks(rows, spark.read.parquet(f"{sf}/benchmark.parquet")).collect()}
    assert set(after) == set(before) - leaks

    before, after = kept["mixing"]
    want = mixing.mix(spark.createDataFrame([(i, t, s) for i, t, s in kept_rows(kept, spark, sf)], "doc_id long, text string, source string"))
    assert {r.doc_id: r.copies for r in docs.collect()} == {r.doc_id: r.copies for r in want.collect() if r.copies}


def kept_rows(kept, spark, sf):
    sources = {r.doc_id: r.source for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "source").collect()}
    return [(i, t, sources[i]) for i, t in kept["mixing"][0].items()]


def test_run_is_the_stages_in_a_row(spark, sf):
    rows = corpus_pipeline.run(spark, sf)
    assert {"doc_id", "text", "lang", "source", "n_chars", "copies", "size"} == set(rows.columns)
    assert rows.filter("copies < 1").count() == 0 and rows.count() > 50


def test_odd_rows_go_through(spark, tmp_path):
    rows = [(1, None, "en", "a", None), (None, "some words", None, None, 3), (2, "", "en", "a", 0), (3, "good text", "en", "a", 9), (3, "good text", "en", "a", 9)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    got = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert len({r.doc_id for r in got}) == len(got) <= 4
    docs.limit(0).write.mode("overwrite").parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).withColumn("x", F.lit(1)).count() == 0
