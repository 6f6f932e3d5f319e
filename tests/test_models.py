"""Stored models: order of dependence, versions, what a changed input rebuilds, and monitors over the stored tables."""

import pytest
from pyspark.sql import functions as F

from earshot.operators import monitors
from earshot.operators.models import Model, Models, Source, files_version, listening_models
from earshot.schemas import PLAY_EVENT


def _plays(spark, first, last):
    rows = [
        (f"e{k}", f"u{k % 3}", "play", f"t{k % 7}", f"T{k % 7}", f"A{k % 2}", "al", 1000 + k, f"2024-01-{1 + k % 20:02d}T10:{k % 60:02d}:00Z", "mobile")
        for k in range(first, last)
    ]
    return spark.createDataFrame(rows, PLAY_EVENT)


def _graph(spark, tmp_path, made=None):
    """c needs b and y, b needs a, a needs x."""
    made = made if made is not None else []

    def read(name):
        return Source(lambda: spark.read.parquet(f"{tmp_path}/{name}"), files_version(spark, f"{tmp_path}/{name}"))

    def a(x):
        made.append("a")
        return x.groupBy("k").agg(F.sum("v").alias("v"))

    def b(a):
        made.append("b")
        return a.withColumn("v", F.col("v") * 2)

    def c(b, y):
        made.append("c")
        return b.join(y.withColumnRenamed("v", "w"), "k")

    return Models(spark, f"{tmp_path}/store", [Model("c", c), Model("b", b), Model("a", a)], {"x": read("x"), "y": read("y")})


def _write(spark, tmp_path, name, rows, mode="append"):
    spark.createDataFrame(rows, "k int, v int").write.mode(mode).parquet(f"{tmp_path}/{name}")


def test_a_changed_input_rebuilds_what_depends_on_it(spark, tmp_path):
    _write(spark, tmp_path, "x", [(1, 2), (1, 3), (2, 5)])
    _write(spark, tmp_path, "y", [(1, 10)])
    made = []
    assert _graph(spark, tmp_path, made).build() == ["a", "b", "c"] == made
    assert _graph(spark, tmp_path, made).build() == [] and len(made) == 3
    _write(spark, tmp_path, "y", [(2, 20)])
    graph = _graph(spark, tmp_path, made)
    assert not graph.is_current("c") and graph.newest("c").count() == 1
    assert graph.build() == ["c"]
    assert sorted(tuple(r) for r in graph.table("c").collect()) == [(1, 10, 10), (2, 10, 20)]
    _write(spark, tmp_path, "x", [(2, 1)])
    graph = _graph(spark, tmp_path, made)
    assert graph.build("b") == ["a", "b"] and not graph.is_current("c")
    assert {tuple(r) for r in graph.table("b").collect()} == {(1, 10), (2, 12)}
    assert graph.build() == ["c"]
    assert len(graph.prune()) == 4 and graph.newest("a").count() == 2


def test_a_replaced_file_and_an_unfinished_write_are_noticed(spark, tmp_path):
    _write(spark, tmp_path, "x", [(1, 2)])
    _write(spark, tmp_path, "y", [(1, 10)])
    graph = _graph(spark, tmp_path)
    graph.build()
    (tmp_path / "store" / "b" / graph.versions["b"] / "_SUCCESS").unlink()
    assert graph.newest("b") is None and graph.build() == ["b"]
    _write(spark, tmp_path, "x", [(1, 7)], "overwrite")
    assert _graph(spark, tmp_path).table("b").collect()[0]["v"] == 14


def test_settings_are_part_of_the_version():
    def m(x):
        return x

    version = lambda settings: Models(None, "r", [Model("m", m, settings)], {"x": Source(None, "1")}).versions["m"]
    assert version({"gap": 30}) == version({"gap": 30}) != version({"gap": 60})


def test_wrong_graphs_are_refused():
    def p(q):
        return q

    def q(p):
        return p

    with pytest.raises(ValueError, match="need each other"):
        Models(None, "r", [Model("p", p), Model("q", q)], {})
    with pytest.raises(ValueError, match="nothing provides"):
        Models(None, "r", [Model("p", p)], {})
    with pytest.raises(ValueError, match="name of its own"):
        Models(None, "r", [Model("p", p)], {"p": Source(None, "1"), "q": Source(None, "1")})


def test_listening_models_and_their_monitors(spark, tmp_path):
    path = f"{tmp_path}/bronze"
    _plays(spark, 0, 60).write.parquet(path)

    def stored():
        source = Source(lambda: spark.read.schema(PLAY_EVENT).parquet(path), files_version(spark, path))
        return Models(spark, f"{tmp_path}/gold", listening_models("2024-01-31", 1440), {"bronze": source})

    gold = ("daily_user_stats", "top_tracks", "top_artists", "device_usage")

    def failed():
        graph = stored()
        checks = monitors.gold_completeness({n: graph.newest(n) for n in gold}, {n: graph.is_current(n) for n in gold})
        return {r["check_name"] for r in checks.filter("not passed").collect()}

    everything = {f"{n}_{c}" for n in gold for c in ("not_empty", "current")}
    assert failed() == everything
    assert stored().build()[0] == "silver_plays"
    assert failed() == set()
    # A table from before the last load is old, though it has rows.
    _plays(spark, 60, 80).write.mode("append").parquet(path)
    assert failed() == {f"{n}_current" for n in gold}
    graph = stored()
    graph.build()
    assert failed() == set()
    assert graph.table("device_usage").first()["total_plays"] == graph.table("silver_plays").count() == 80
    # An emptied table fails, though its version is right.
    graph.table("top_artists").limit(0).write.mode("overwrite").parquet(f"{graph.path('top_artists')}-other")
    emptied = spark.read.parquet(f"{graph.path('top_artists')}-other")
    emptied.write.mode("overwrite").parquet(graph.path("top_artists"))
    (tmp_path / "gold" / "top_artists" / f"{graph.versions['top_artists']}-other" / "_SUCCESS").unlink()
    assert failed() == {"top_artists_not_empty"}
    status = {r["model"]: (r["current"], r["row_count"]) for r in graph.status().collect()}
    assert status["top_artists"] == (True, 0) and status["silver_plays"] == (True, 80)
