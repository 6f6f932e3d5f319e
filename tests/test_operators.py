"""Operators on small frames: edge rules, and the scale paths against brute force."""

import itertools
import random
from collections import defaultdict

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from earshot.operators import gold, incremental, monitors, ordering, quality, recommend, reshape, sessions, snapshots
from earshot.operators import silver as silver_ops
from earshot.plans import bridge
from earshot.schemas import PLAY_EVENT


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def play(event_id, user="u", track="t", at="2024-01-01T10:00:00Z", ms=1000, name=None):
    return (event_id, user, "play", track, name or track.upper(), "A", "B", ms, at, "phone")


def bronze(spark, *plays):
    return spark.createDataFrame(list(plays), PLAY_EVENT)


def test_silver_rules(spark):
    df = bronze(
        spark,
        play("b"), play("a"),  # one play delivered twice: the smaller id stays
        play("c", at="2024-01-01T10:00:00+00:00"),  # other text, so another play
        play("d", at="not a time"),  # kept, time null
        play("e", track="x", ms=0), play("f", track="x", ms=600_000), play("g", track="x", ms=599_999),
        play(None, track="y"), play("h", user=None),
    )
    out = silver_ops.silver_plays(df, bridge.AS_OF)
    assert sorted(r.event_id for r in out.collect()) == ["a", "c", "d", "g"]
    assert out.filter("event_id = 'd'").first().played_at is None
    assert dict(out.dtypes)["played_at"] == "timestamp_ntz"


def test_session_gap_rule(spark):
    times = ["10:00:59", "11:00:00", "12:01:00", "13:01:59", "14:02:00"]
    df = silver_ops.silver_plays(
        bronze(spark, *[play(str(i), track=f"t{i}", at=f"2024-01-01T{t}Z") for i, t in enumerate(times)])
    )
    got = {r.event_id: r.session_id for r in sessions.sessionize(df).collect()}
    # 10:00->11:00 is 60 (stays), 11:00->12:01 is 61 (new), 12:01->13:01 is 60, 13:01->14:02 is 61
    assert got == {"0": 1, "1": 1, "2": 2, "3": 2, "4": 3}


def _sessions_by_window(df, gap):
    """The rule stated directly: lag, then a running sum whose ties share the value."""
    lag = Window.partitionBy("user_id").orderBy(F.col("played_at").asc_nulls_last(), "event_id")
    run = Window.partitionBy("user_id").orderBy(F.col("played_at").asc_nulls_last())
    from earshot.functions.dates import datediff_boundary

    prev = F.lag("played_at").over(lag)
    flag = F.when((datediff_boundary("minute", prev, F.col("played_at")) > gap) | prev.isNull(), 1).otherwise(0)
    return df.withColumn("_f", flag).select("event_id", F.sum("_f").over(run).alias("s"))


def test_sessions_with_ties_and_missing_times(spark):
    rng = random.Random(5)
    plays = []
    for i in range(400):
        user = f"u{rng.randrange(4)}"
        minute = rng.randrange(0, 3000)
        at = "bad" if rng.random() < 0.05 else f"2024-01-{1 + minute // 1440:02d}T{minute // 60 % 24:02d}:{minute % 60:02d}:{rng.choice(['00', '30'])}Z"
        plays.append(play(f"{i:04d}", user, f"t{rng.randrange(30)}", at))
    plays += [play("z1", "only", "t1", "bad"), play("z2", "only", "t2", "bad")]
    df = silver_ops.silver_plays(bronze(spark, *plays))
    want = rows(_sessions_by_window(df, 60))
    assert rows(sessions.sessionize(df).select("event_id", "session_id")) == want


def test_blocks_give_the_same_pairs(spark):
    rng = random.Random(11)
    baskets = defaultdict(set)
    for _ in range(600):
        baskets["hot"].add(rng.randrange(300))  # one basket with far more items than a block
    for b in range(30):
        for _ in range(rng.randrange(1, 8)):
            baskets[f"b{b}"].add(rng.randrange(300))
    data = [("u", b, i) for b, items in baskets.items() for i in items]
    lines = spark.createDataFrame(data, "u string, b string, i long")
    want = defaultdict(int)
    for items in baskets.values():
        for a, b in itertools.combinations(sorted(items), 2):
            want[(a, b)] += 1
    items = recommend.basket_items(lines, "u", "b", "i")
    for size in (7, 50, 1000):
        pairs = recommend.session_pairs(items, size).groupBy("track_a_id", "track_b_id").agg(F.count("*").alias("n"))
        assert {(r.track_a_id, r.track_b_id): r.n for r in pairs.collect()} == want


def test_blocks_follow_distinct_items(spark):
    """A track played very often in one long session is still one item."""
    plays = [play(f"{i:04d}", track=f"t{i % 5}", at=f"2024-01-01T{10 + i // 600}:{i // 10 % 60:02d}:{i % 10:02d}Z") for i in range(1200)]
    items = recommend.session_items(silver_ops.silver_plays(bronze(spark, *plays)))
    assert items.count() == 5
    assert recommend._with_blocks(items, 5).agg(F.max("blocks")).first()[0] == 1
    assert recommend._with_blocks(items, 2).agg(F.max("blocks")).first()[0] == 3


def test_cooccurrence_scores(spark):
    plays = [
        play("1", track="a", at="2024-01-01T10:00:00Z"), play("2", track="b", at="2024-01-01T10:10:00Z"),
        play("3", track="a", at="2024-01-02T10:00:00Z"), play("4", track="b", at="2024-01-02T10:10:00Z"),
        play("5", track="a", at="2024-01-03T10:00:00Z"), play("6", track="c", at="2024-01-02T10:20:00Z"),
    ]
    silver = silver_ops.silver_plays(bronze(spark, *plays))
    got = {(r.track_a_id, r.track_b_id): (r.sessions_together, r.track_a_total_sessions, r.cooccurrence_score)
           for r in recommend.track_cooccurrence(silver).collect()}
    assert got == {("a", "b"): (2, 3, 0.667), ("a", "c"): (1, 3, 0.333), ("b", "c"): (1, 2, 0.5)}
    both = recommend.track_cooccurrence(silver, symmetric=True)
    assert both.count() == 6
    assert both.filter("track_a_id = 'b' and track_b_id = 'a'").first().cooccurrence_score == 1.0
    assert recommend.track_cooccurrence(silver, min_sessions=2).count() == 1
    assert recommend.track_cooccurrence(silver, user_id="nobody").count() == 0


def test_affinity_is_null_when_all_tie(spark):
    silver = silver_ops.silver_plays(bronze(spark, play("1"), play("2", user="v")))
    assert {r.affinity_score for r in recommend.artist_affinity(silver, bridge.AS_OF).collect()} == {None}
    with pytest.raises(ValueError):
        recommend.artist_affinity(silver, normalize="x")


def test_recommendation_limits(spark):
    silver = silver_ops.silver_plays(bronze(spark, play("1", track="a"), play("2", track="b")))
    cooc, liked = recommend.track_cooccurrence(silver), recommend.artist_affinity(silver, bridge.AS_OF)
    assert recommend.recommend_for_track(cooc, liked, "a").count() == 1
    assert recommend.recommend_for_track(cooc, liked, "unknown").count() == 0
    with pytest.raises(ValueError):
        recommend.recommend_for_track(cooc, liked, "a", limit=51)
    # a played track is recommended all the same, unless asked otherwise
    assert recommend.track_recommendations(cooc, liked).count() == 1
    assert recommend.track_recommendations(cooc, liked, exclude_played=silver).count() == 0


def test_renamed_track_has_two_rows(spark):
    silver = silver_ops.silver_plays(
        bronze(spark, play("1"), play("2", at="2024-01-02T10:00:00Z", name="Other"))
    )
    assert gold.top_tracks(silver).count() == 2


@pytest.mark.parametrize("unique", [True, False])
def test_global_rank(spark, unique):
    values = [(i, i % 7) for i in range(5000)]
    df = spark.createDataFrame(values, "i long, k long").repartition(16)
    order = [F.col("k").desc(), F.col("i").asc()] if unique else [F.col("k").desc()]
    ranked = ordering.global_rank(df, order, "r", unique)
    got = sorted((r.r, r.k, r.i) for r in ranked.collect())
    assert [g[0] for g in got] == list(range(1, 5001))
    assert [g[1] for g in got] == sorted((k for _, k in values), reverse=True)
    if unique:
        assert [(g[1], g[2]) for g in got] == sorted(((k, i) for i, k in values), key=lambda p: (-p[0], p[1]))


@pytest.mark.parametrize("offset", [-1, 1])
@pytest.mark.parametrize("chunk", [1, 7, 100_000])
def test_neighbours_equal_a_window(spark, offset, chunk):
    rng = random.Random(3)
    # one group holds a third of the rows; some group keys and values are null
    data = [(rng.choice(["hot", "hot", "a", "b", "c", None]), i, rng.choice([None, i])) for i in range(600)]
    df = spark.createDataFrame(data, "g string, o long, v long")
    w = Window.partitionBy("g").orderBy("o")
    step = F.lag if offset == -1 else F.lead
    want = rows(df.withColumn("n", step("v").over(w)))
    assert rows(ordering.neighbours(df, [F.col("o").asc()], {"n": F.col("v")}, ["g"], offset, chunk_rows=chunk)) == want


@pytest.mark.parametrize("offset", [-1, 1])
def test_neighbours_in_buckets_equal_a_window(spark, offset):
    rng = random.Random(offset)
    data = [(rng.choice([None, "a", "b"]), rng.choice([None, *range(40)]), k) for k in range(400)]
    df = spark.createDataFrame(data, "g string, o long, v long")
    w = Window.partitionBy("g").orderBy(F.col("o").asc_nulls_last(), F.col("v").asc_nulls_last())
    want = rows(df.withColumn("n", (F.lag if offset == -1 else F.lead)("v").over(w)))
    got = ordering.neighbours_in_buckets(df, [F.col("o"), F.col("v")], F.shiftright("o", 2), {"n": F.col("v")}, ["g"], offset)
    assert rows(got) == want


def test_merge_refuses_repeated_source_keys(spark):
    target = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    source = spark.createDataFrame([(1, "x"), (1, "y"), (None, "n"), (None, "n")], "k long, v string")
    with pytest.raises(ValueError, match="more than once"):
        incremental.merge(target, source, ["k"])
    merged = incremental.merge(target, source, ["k"], order_by=[F.col("v").desc()])
    assert rows(merged) == [(1, "y"), (2, "b"), (None, "n"), (None, "n")]


def test_results_of_the_newest_run_are_all_judged(spark):
    log = [(f"t{k:02d}", "fail" if k == 11 else "pass", "2024-01-02") for k in range(12)] + [("old", "fail", "2024-01-01")]
    results = spark.createDataFrame(log, "test_name string, status string, executed_at string")
    assert monitors.test_results(results).first().passed is False
    assert monitors.test_results(results.filter("test_name <> 't11'")).first().passed is True
    assert monitors.test_results(results, last=5).first().passed is True


def test_every_order_is_on_one_side(spark, sf):
    from earshot.plans import changes

    before, after = changes._before_after(spark, sf)
    orders = bridge.table(spark, sf, "orders").count()
    assert before.agg(F.sum("orders")).first()[0] + after.agg(F.sum("orders")).first()[0] == orders


def test_pivot_names_and_quotes(spark):
    df = spark.createDataFrame([("S", "red"), ("S", "blue"), ("S", "blue's"), ("M", "red")], "size string, color string")
    columns = reshape.pivot_columns("color", ["red", "blue", "blue's"])
    assert rows(df.groupBy("size").agg(*columns)) == [("M", 1, 0, 0), ("S", 1, 1, 1)]
    named = reshape.pivot_columns("color", ["blue's"], prefix="n ", quote_identifiers=False)
    assert df.groupBy("size").agg(*named).columns == ["size", "n_blues"]


def test_unpivot_keeps_nulls(spark):
    df = spark.createDataFrame([(1, None, True), (2, "x", False)], "id int, a string, b boolean")
    assert rows(reshape.unpivot(df, exclude=["ID"])) == [
        (1, "a", None), (1, "b", "true"), (2, "a", "x"), (2, "b", "false")
    ]


def test_union_relations(spark):
    a = spark.createDataFrame([(1, "drew", "pi")], "id int, name string, favorite_number string")
    b = spark.createDataFrame([(1, "green", "7")], "id int, favorite_color string, favorite_number string")
    out = reshape.union_relations({"a": a, "b": b}, source_column_name=None)
    assert out.columns == ["id", "name", "favorite_number", "favorite_color"]
    assert rows(out) == [(1, "drew", "pi", None), (1, None, "7", "green")]
    assert reshape.union_relations({"a": a, "b": b}, include=["ID"]).columns == ["source_relation", "id"]
    with pytest.raises(ValueError):
        reshape.union_relations({"a": a}, include=["id"], exclude=["name"])


def test_deduplicate(spark):
    df = spark.createDataFrame([(1, "play", 1), (1, "play", 2), (2, "pause", 1)], "u int, e string, v int")
    assert rows(reshape.deduplicate(df, ["u"], [F.col("v").desc()])) == [(1, "play", 2), (2, "pause", 1)]


def test_rules_pass_on_null(spark):
    df = spark.createDataFrame([(1,), (None,), (9,)], "x int")
    assert rows(quality.accepted_range(df, "x", 1, 5)) == [(9,)]
    assert quality.accepted_range(df, "x", 1, 9, inclusive=False).count() == 2
    assert rows(quality.expression_is_true(df, "< 5", "x")) == [(9,)]
    assert rows(quality.accepted_values(df, "x", [1])) == [(9, 1)]
    assert quality.at_least_one(df, "x").count() == 0
    assert quality.at_least_one(df.filter("x is null"), "x").count() == 1
    assert quality.not_null_proportion(df, "x", 0.5).count() == 0
    assert quality.not_null_proportion(df, "x", 0.9).count() == 1


def test_ranges(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, date'2019-01-01', date'2019-02-01'), (1, date'2019-03-03', date'2019-04-01'),"
        " (2, date'2019-05-06', date'2019-07-02'), (2, date'2019-07-03', date'9999-01-01') t(id, lo, hi)"
    )
    failing = {g: quality.mutually_exclusive_ranges(df, "lo", "hi", "id", g).count() for g in ("allowed", "required", "not_allowed")}
    assert failing == {"allowed": 0, "required": 0, "not_allowed": 2}
    seamless = spark.createDataFrame([(0, 1), (1, 2), (2, 4)], "lo int, hi int")
    failing = {g: quality.mutually_exclusive_ranges(seamless, "lo", "hi", gaps=g).count() for g in ("allowed", "required", "not_allowed")}
    assert failing == {"allowed": 0, "required": 2, "not_allowed": 0}
    empty = spark.createDataFrame([(1, 1)], "lo int, hi int")
    assert quality.mutually_exclusive_ranges(empty, "lo", "hi").count() == 1
    assert quality.mutually_exclusive_ranges(empty, "lo", "hi", zero_length_range_allowed=True).count() == 0


def test_sequences(spark):
    even = spark.createDataFrame([(2,), (4,), (6,)], "x int")
    assert quality.sequential_values(even, "x", 2).count() == 0
    assert quality.sequential_values(even, "x").count() == 2
    hourly = spark.sql("SELECT explode(sequence(timestamp_ntz'2024-01-01', timestamp_ntz'2024-01-02', interval 1 hour)) AS t")
    assert quality.sequential_values(hourly, "t", 1, "hour").count() == 0


def test_runner_thresholds(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "x int")
    out = quality.run_tests([
        quality.DataTest("unique", quality.unique(df, "x")),
        quality.DataTest("nulls", quality.not_null(df, "x"), warn_if="> 0", error_if="> 1"),
        quality.DataTest("inverted", quality.not_null(df, "x"), warn_if="< 1", error_if="< 1"),
        quality.DataTest("limited", df, limit=2),
    ])
    assert {r.test_name: (r.failures, r.status) for r in out.collect()} == {
        "unique": (1, "fail"), "nulls": (1, "warn"), "inverted": (1, "pass"), "limited": (2, "fail")
    }


def test_merge_rules(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20), (None, "n", 0)], "k int, s string, v int")
    source = spark.createDataFrame([(2, "B", 21), (3, "C", 30), (None, "N", 1)], "k int, s string, v int")
    assert rows(incremental.merge(target, source, ["k"])) == sorted(
        [(1, "a", 10), (2, "B", 21), (3, "C", 30), (None, "n", 0), (None, "N", 1)], key=str
    )
    assert (2, "b", 21) in rows(incremental.merge(target, source, ["k"], update_columns=["v"]))
    assert (2, "b", 21) in rows(incremental.merge(target, source, ["k"], exclude_columns=["S"]))
    assert incremental.merge(target, source, []).count() == 6
    guarded = rows(incremental.merge(target, source, ["k"], predicate=F.col("v") < 15))
    assert (2, "b", 20) in guarded and (2, "B", 21) in guarded  # outside the predicate: not matched, so added
    with pytest.raises(ValueError):
        incremental.merge(target, source, ["k"], update_columns=["v"], exclude_columns=["s"])


def test_schema_policies(spark):
    target = spark.createDataFrame([(1, "a")], "k int, gone string")
    source = spark.createDataFrame([(2, 5)], "k int, more int")
    assert incremental.schema_diff(source, target) == {"added": {"more": "int"}, "removed": {"gone": "string"}, "retyped": {}}
    columns = {
        m: incremental.append(*incremental.apply_schema_change(target, source, m)).columns
        for m in ("ignore", "append_new_columns", "sync_all_columns")
    }
    assert columns == {"ignore": ["k", "gone"], "append_new_columns": ["k", "gone", "more"], "sync_all_columns": ["k", "more"]}
    with pytest.raises(ValueError):
        incremental.apply_schema_change(target, source, "fail")


def _state(spark, *data):
    return spark.createDataFrame(list(data), "id int, v string, at string").withColumn("at", F.col("at").cast("timestamp_ntz"))


def _versions(df):
    cells = df.select("id", "v", F.date_format("valid_from", "d"), F.date_format("valid_to", "d"))
    return rows(cells)


def test_snapshot_history(spark):
    rule = snapshots.SnapshotRule(["id"], "timestamp", "at", hard_deletes="invalidate")
    s = snapshots.snapshot_start(_state(spark, (1, "a", "2024-01-01"), (2, "b", "2024-01-01")), rule)
    s = snapshots.snapshot_apply(s, _state(spark, (1, "a2", "2024-01-02"), (2, "b", "2024-01-01"), (3, "c", "2024-01-02")), rule)
    s = snapshots.snapshot_apply(s, _state(spark, (1, "a3", "2024-01-03"), (3, "ignored", "2024-01-02")), rule, "2024-01-05")
    assert _versions(s) == [
        (1, "a", "1", "2"), (1, "a2", "2", "3"), (1, "a3", "3", None), (2, "b", "1", "5"), (3, "c", "2", None)
    ]
    assert s.select("scd_id").distinct().count() == 5


def test_snapshot_check_sees_nulls_and_new_columns(spark):
    rule = snapshots.SnapshotRule(["id"], "check", check_columns=["v"])
    s = snapshots.snapshot_start(_state(spark, (1, None, "2024-01-01"), (2, None, "2024-01-01")), rule, "2024-01-01")
    s = snapshots.snapshot_apply(s, _state(spark, (1, "x", "2024-01-01"), (2, None, "2024-01-01")), rule, "2024-01-02")
    assert _versions(s) == [(1, "x", "2", None), (1, None, "1", "2"), (2, None, "1", None)]
    wider = _state(spark, (1, "x", "2024-01-01"), (2, None, "2024-01-01")).withColumn("w", F.lit(None).cast("int"))
    everything = snapshots.SnapshotRule(["id"], "check")
    assert snapshots.snapshot_apply(s, wider, everything, "2024-01-03").filter("valid_to is null").count() == 2
    assert snapshots.snapshot_apply(s, wider, everything, "2024-01-03").count() == 5


def test_snapshot_sentinel_and_deleted_records(spark):
    rule = snapshots.SnapshotRule(["id"], "timestamp", "at", hard_deletes="new_record", valid_to_current="9999-12-31")
    s = snapshots.snapshot_start(_state(spark, (1, "a", "2024-01-01"), (2, "b", "2024-01-01")), rule)
    assert {str(r.valid_to)[:10] for r in s.collect()} == {"9999-12-31"}
    s = snapshots.snapshot_apply(s, _state(spark, (1, "a", "2024-01-01")), rule, "2024-01-09")
    got = sorted((r.id, str(r.valid_to)[:10], r.is_deleted) for r in s.collect())
    assert got == [(1, "9999-12-31", "False"), (2, "2024-01-09", "False"), (2, "9999-12-31", "True")]


def test_listagg_in_pieces(spark):
    """A group with most rows lies in many ranges; duplicates, nulls and groups of nulls as in one list."""
    rows = [("hot", f"v{(k * 7919) % 5000:05}", k % 3) for k in range(6000)]
    rows += [("cold", "b", 1), ("cold", "a", 2), ("cold", "a", None), ("cold", None, 0), ("none", None, 1), (None, "x", 1)]
    df = spark.createDataFrame(rows, "g string, v string, o int")

    def plain(key, distinct=False, ordered=False):
        held = [(o, v) for g, v, o in rows if g == key and v is not None]
        if ordered:
            return ",".join(v for _, v in sorted(held, key=lambda p: (p[0] is not None, p[0] or 0, p[1])))
        values = [v for _, v in held]
        return ",".join(sorted(set(values) if distinct else values))

    for options in ({}, {"distinct": True}, {"order_by": ["o"]}):
        out = {r.g: r["values"] for r in reshape.listagg_in_pieces(df, ["g"], "v", **options).collect()}
        want = {g: plain(g, options.get("distinct", False), "order_by" in options) for g in ("hot", "cold", "none", None)}
        assert out == want
    assert reshape.listagg_in_pieces(df.limit(0), ["g"], "v").isEmpty()

    counted = df.groupBy("g", "v").count().repartitionByRange(8, "g", "v").withColumn("range", F.spark_partition_id())
    assert counted.filter("g = 'hot'").select("range").distinct().count() >= 7
