"""Sources, sinks and streams."""

import uuid

import pytest
from pyspark.sql import functions as F

from earshot.operators import sessions
from earshot.plans import bridge
from earshot.schemas import PLAY_EVENT
from earshot.session import scratch_path, shared_dir
from earshot.sources import events, tables
from earshot.streaming import ingest, state

GOOD = '{"event_id":"1","user_id":"u","track_id":"t","duration_ms":"12","played_at":"2024-01-01T10:00:00Z","more":1}'


def messages(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_parse_and_dead_letters(spark):
    df = messages(spark, GOOD, '{"event_id": "2"', "nonsense", '{"event_id":"3","duration_ms":"long"}')
    out = {r.event_id: r for r in events.parse_events(df).collect()}
    assert events.parse_events(df).columns == PLAY_EVENT.fieldNames()
    assert set(out) == {"1", "3"}
    assert out["1"].duration_ms == 12 and out["1"].album_name is None and out["3"].duration_ms is None
    assert sorted(r.value for r in events.dead_letters(df).collect()) == ["nonsense", '{"event_id": "2"']


def test_flatten_page(spark):
    page = (
        '{"items":[{"track":{"id":"t1","name":"T","artists":[{"name":"A"},{"name":"B"}],"album":{"name":"L"},"duration_ms":5},'
        '"played_at":"2024-01-01T10:00:00Z","context":{"type":"playlist"}},'
        '{"track":{"id":"t2","name":"U","artists":[],"album":{"name":"L"},"duration_ms":6},"played_at":"x","context":null}]}'
    )
    df = spark.createDataFrame([("me", page)], "user_id string, value string")
    got = {r.track_id: r for r in events.flatten_recently_played(df).collect()}
    assert got["t1"].event_id == str(uuid.uuid5(uuid.NAMESPACE_DNS, "me_t1_2024-01-01T10:00:00Z"))
    assert (got["t1"].artist_name, got["t1"].device_type) == ("A", "playlist")
    assert (got["t2"].artist_name, got["t2"].device_type) == ("Unknown", "unknown")


def test_flatten_state(spark):
    full = (
        '{"item":{"id":"t","name":"T","artists":[{"name":"A"}],"album":{"name":"L"},"duration_ms":9},"device":{"type":"c","name":"d"},'
        '"context":{"type":"album","uri":"x:y"},"is_playing":true,"progress_ms":3,"shuffle_state":true,"repeat_state":"track"}'
    )
    df = messages(spark, full, '{"item":null,"is_playing":false}', '{"item":{"id":"s","name":"S"}}')
    got = {r.track_id: tuple(r) for r in events.flatten_playback_state(df).collect()}
    assert got == {
        "t": ("t", "T", "A", "L", True, 3, 9, "c", "d", True, "track", "album", "x:y"),
        "s": ("s", "S", "Unknown", "Unknown", False, 0, 0, "Unknown", "Unknown", False, "off", None, None),
    }


def test_landing_by_own_hour(spark):
    df = spark.createDataFrame(
        [("1", "u", "2024-01-01T10:30:00Z"), ("2", "u", "2024-01-01T12:30:00+01:00"), ("3", "u", "bad")],
        "event_id string, user_id string, played_at string",
    )
    root = scratch_path(spark, "landing")
    plays = events.conform_schema(df)
    tables.write_bronze(plays, root, fallback=F.lit("2020-05-05 05:05:05").cast("timestamp"))
    landed = tables.external_table_scan(spark, root)
    assert {r.event_id: (r.year, r.month, r.day, r.hour) for r in landed.collect()} == {
        "1": ("2024", "01", "01", "10"), "2": ("2024", "01", "01", "11"), "3": ("2020", "05", "05", "05")
    }
    assert {r.check_name: r.passed for r in tables.landing_checks(landed).collect()} == {
        "files_exist": True, "rows_readable": True, "partition_path": True, "missing_columns": True, "extra_columns_warn": True
    }
    misplaced = scratch_path(spark, "flat")
    plays.write.parquet(misplaced)
    checks = {r.check_name: r.passed for r in tables.landing_checks(spark.read.parquet(misplaced).drop("album_name")).collect()}
    assert not checks["partition_path"] and not checks["missing_columns"]


def test_folder_filter_skips_files(spark):
    root = scratch_path(spark, "prune")
    plays = events.conform_schema(
        spark.sql("SELECT string(id) AS event_id, '2024-01-0' || (1 + id % 3) || 'T00:00:00Z' AS played_at FROM range(30)")
    )
    tables.write_bronze(plays, root)
    plan = tables.external_table_scan(spark, root).filter("day = '02'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan


def test_scratch_lies_in_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(shared_dir(spark).rstrip("/"))


def test_kafka_source_needs_its_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        events.kafka_json_source(spark, "host:1", "plays")


@pytest.mark.parametrize("compact", [1, 2, 20])
def test_track_changes_over_batches_equal_one_batch(spark, compact):
    data = [("u", f"2024-01-01 10:00:{i:02d}", t, t.upper()) for i, t in enumerate("aabbbacca")]
    data += [("v", f"2024-01-01 10:00:{i:02d}", "a", "A") for i in range(4)]
    df = spark.createDataFrame(data, "user_id string, detected_at string, track_id string, track_name string").withColumn(
        "detected_at", F.col("detected_at").cast("timestamp_ntz")
    )
    path, root = scratch_path(spark, "d"), scratch_path(spark, "s")
    for lo, hi in ((0, 3), (3, 5), (5, 60)):
        df.filter((F.second("detected_at") >= lo) & (F.second("detected_at") < hi)).write.mode("append").parquet(path)
        stream = spark.readStream.schema(df.schema).parquet(path)
        ingest.run_to_end(
            state.run_with_keyed_state(stream, state.track_change_step(), root, root + "-p", ["user_id"], ["detected_at", "track_id"], compact=compact)
        )
    got = spark.read.schema(df.schema).parquet(root + "/out")
    want = sessions.track_changes(df)
    assert sorted(map(tuple, got.select(df.columns).collect())) == sorted(map(tuple, want.collect()))
    assert want.count() == 6


def test_a_batch_writes_the_state_of_its_own_users(spark):
    schema = "user_id string, detected_at timestamp_ntz, track_id string, track_name string"
    path, root = scratch_path(spark, "d"), scratch_path(spark, "s")
    for users in ("uvw", "v"):
        rows = spark.createDataFrame([(u, "2024-01-01", "t", "T") for u in users], schema.replace("timestamp_ntz", "string"))
        rows.withColumn("detected_at", F.col("detected_at").cast("timestamp_ntz")).write.mode("append").parquet(path)
        stream = spark.readStream.schema(schema).parquet(path)
        ingest.run_to_end(
            state.run_with_keyed_state(stream, state.track_change_step(), root, root + "-p", ["user_id"], ["detected_at", "track_id"])
        )
    held = [sorted(r.user_id for r in spark.read.parquet(f"{root}/state/batch={k}").collect()) for k in (0, 1)]
    assert held == [["u", "v", "w"], ["v"]]


def test_a_hot_hour_is_written_by_several_tasks(spark):
    hour = F.when(F.col("id") % 10 == 0, F.col("id") % 24).otherwise(7)
    plays = spark.range(60_000).select(
        *[F.sha2(F.concat_ws("-", F.lit(c), "id"), 512).alias(c) for c in ("event_id", "user_id", "event_type", "track_id", "track_name", "artist_name", "album_name")],
        F.col("id").alias("duration_ms"),
        F.format_string("2024-01-01T%02d:00:00Z", hour).alias("played_at"),
        F.lit("phone").alias("device_type"),
    )
    kept = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4m")
    try:
        root = scratch_path(spark, "hot")
        tables.write_bronze(plays, root)
        path = scratch_path(spark, "hot-messages")
        plays.select(F.to_json(F.struct(*plays.columns)).alias("value")).write.text(path)
        streamed = scratch_path(spark, "hot-stream")
        ingest.run_to_end(ingest.stream_bronze_ingest(events.file_json_source(spark, path), streamed, streamed + "-p", every=None))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", kept)
    for place in (root, streamed):
        files = tables.list_source_files(tables.external_table_scan(spark, place)).filter("file_path like '%hour=07%'")
        assert files.count() > 2 and files.agg(F.sum("row_count")).first()[0] == 54_000


def test_scratch_is_removed(spark):
    from earshot.session import build_session, materialize, remove_scratch, shared_dir

    kept = materialize(spark.range(3), "gone")
    assert kept.count() == 3
    before = spark.sparkContext.applicationId
    assert build_session().sparkContext.applicationId == before
    remove_scratch(spark)
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/earshot/{before}")
    assert not path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path)


def test_bad_messages_of_a_stream_are_kept(spark):
    path, root = scratch_path(spark, "m"), scratch_path(spark, "dead")
    messages(spark, GOOD, "nonsense").write.text(path)
    ingest.run_to_end(ingest.stream_dead_letters(events.file_json_source(spark, path), root, root + "-p", every=None))
    assert [r.value for r in spark.read.schema("value string").parquet(root).collect()] == ["nonsense"]


def test_late_rows_are_dropped(spark):
    """Our own rule: rows older than the watermark do not reopen a closed session."""
    path, out = scratch_path(spark, "late"), scratch_path(spark, "late-out")
    schema = "user_id string, event_time timestamp"
    for batch in ([("u", "2024-01-01 10:00:00")], [("u", "2024-02-01 10:00:00")], [("u", "2024-01-01 10:05:00")], [("u", "2024-03-01 10:00:00")]):
        rows = spark.createDataFrame(batch, "user_id string, t string").select("user_id", F.col("t").cast("timestamp").alias("event_time"))
        rows.write.mode("append").parquet(path)
        stream = spark.readStream.schema(schema).parquet(path)
        ingest.run_to_end(ingest.start_file_sink(ingest.stream_sessionize(stream, late="1 day"), out, out + "-p"))
    closed = spark.read.parquet(out)
    assert sorted(r.tracks_in_session for r in closed.collect()) == [1, 1]


def test_anchor_numbers(spark):
    """Row counts known for the smallest scale."""
    sf = "/root/testdata/sf0.001"
    silver = bridge.silver(spark, sf)
    assert bridge.bronze(spark, sf).count() == 1050
    assert silver.count() == 897
    assert silver.filter(F.col("event_id").cast("long") >= 100_000_000).count() == 43
    for gap, found, pairs in ((60, 822, 75), (1440, 129, 4420)):
        assert sessions.sessionize(silver, gap).select("user_id", "session_id").distinct().count() == found
        assert bridge.cooccurrence(spark, sf, gap).count() == pairs


def test_retention_adds_hours_and_drops_whole_ones(spark):
    schema = "user_id string, detected_at timestamp_ntz, hour int"
    path, root = scratch_path(spark, "d"), scratch_path(spark, "r")
    times = [
        ["2024-01-01 10:05:00", "2024-01-01 23:00:00", None],
        ["2024-01-02 10:04:59", "2024-01-01 11:00:00"],
        ["2024-01-02 12:30:00", "2024-01-01 12:30:00", "2024-01-01 12:29:59", "2024-01-01 10:59:00"],
    ]
    folders, files = [], []
    for batch in times:
        rows = spark.createDataFrame([("u", t, 7) for t in batch], "user_id string, detected_at string, hour int")
        rows.withColumn("detected_at", F.col("detected_at").cast("timestamp_ntz")).write.mode("append").parquet(path)
        stream = spark.readStream.schema(schema).parquet(path).drop("hour")
        ingest.run_to_end(state.run_retention(stream, root, root + "-p"))
        folders.append(state._hours(spark, root))
        files.append({r.f for r in spark.read.parquet(root).select(F.input_file_name().alias("f")).distinct().collect()})
    assert folders == [["2024010110", "2024010123"], ["2024010110", "2024010111", "2024010123", "2024010210"], ["2024010112", "2024010123", "2024010210", "2024010212"]]
    # What is stored stays as it is.
    assert files[0] < files[1] and len(files[1] & files[2]) == 2
    kept = state.retained(spark, spark.read.parquet(path).drop("hour").schema, root)
    assert sorted(str(r.detected_at) for r in kept.collect()) == ["2024-01-01 12:30:00", "2024-01-01 23:00:00", "2024-01-02 10:04:59", "2024-01-02 12:30:00"]
    assert state.retained(spark, kept.schema, root + "-none").count() == 0


def test_totals_are_kept_by_the_stream_itself(spark):
    path, root = scratch_path(spark, "d"), scratch_path(spark, "t")
    batches = [[("a", 1), ("b", 2), (None, 3)], [("b", 5)], [("c", 7), (None, 1)], [("a", 1)]]
    for k, batch in enumerate(batches):
        spark.createDataFrame(batch, "kind string, n long").write.mode("append").parquet(path)
        stream = spark.readStream.schema("kind string, n long").parquet(path)
        job = state.run_refresh(stream, ["kind"], [F.sum("n").alias("n"), F.count("*").alias("plays")], root, root + "-p")
        ingest.run_to_end(job)
        so_far = spark.read.parquet(path).groupBy("kind").agg(F.sum("n").alias("n"), F.count("*").alias("plays"))
        assert sorted(map(str, state.refreshed(spark, root, ["kind"]).collect())) == sorted(map(str, so_far.collect()))
        if k == 2:
            # A batch holds the totals of its own keys only.
            assert spark.read.parquet(f"{root}/batch=1").collect()[0][:3] == ("b", 7, 2)
            assert state.prune_refreshed(spark, root, ["kind"]) == 1 and state.prune_refreshed(spark, root, ["kind"]) == 0
            assert sorted(map(str, state.refreshed(spark, root, ["kind"]).collect())) == sorted(map(str, so_far.collect()))


def _exchanges_over(df, name):
    """Exchanges above the scan of a table in a plan."""
    above, found = [], None
    for line in df._jdf.queryExecution().sparkPlan().toString().splitlines(), df._jdf.queryExecution().executedPlan().toString().splitlines():
        above = []
        for row in line:
            depth = len(row) - len(row.lstrip(" :+-*"))
            above = [(d, t) for d, t in above if d < depth] + [(depth, row)]
            if "FileScan" in row and name in row:
                found = sum("Exchange" in t for _, t in above)
    return found


def test_merges_of_tables_in_buckets_do_not_shuffle_them(spark):
    from earshot.operators import incremental

    name = f"buckets_{uuid.uuid4().hex[:8]}"
    rows = spark.range(2_000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"), F.lit("old").alias("s"))
    new = spark.range(1_990, 2_010).select(F.col("id").alias("k"), F.lit(0).cast("long").alias("v"), F.lit("new").alias("s"))
    stored = incremental.store_bucketed(spark, name, rows, ["k"], 4)
    merged = incremental.merge(stored, new, ["k"])
    assert _exchanges_over(merged, name) == 0
    plain = incremental.replace_table(spark, f"plain_{name}", rows)
    assert _exchanges_over(incremental.merge(plain, new, ["k"]), f"plain_{name}") > 0
    want = sorted(map(tuple, incremental.merge(plain, new, ["k"]).collect()))
    stored = incremental.store_bucketed(spark, name, merged, ["k"], 4)
    assert sorted(map(tuple, stored.collect())) == want
    # One file for each bucket: the join's tasks wrote them as they were.
    assert stored.select(F.input_file_name()).distinct().count() == 4
    again = incremental.merge(stored, new.withColumn("s", F.lit("again")), ["k"])
    assert _exchanges_over(again, name) == 0
    assert again.filter("s = 'again'").count() == 20 and again.count() == 2_010
    replaced = incremental.delete_insert(stored, new, ["k"])
    assert _exchanges_over(replaced, name) == 0 and sorted(map(tuple, replaced.collect())) == want
    spark.sql(f"DROP TABLE {name}")
    spark.sql(f"DROP TABLE plain_{name}")


def test_a_second_load_reads_its_own_files(spark, tmp_path):
    root, listed = str(tmp_path / "landing"), str(tmp_path / "files")

    def load(day, n):
        rows = [(f"{day}-{k}", "u", "t", f"2024-01-{day:02}T0{k % 3}:00:00Z") for k in range(n)]
        names = "event_id string, user_id string, track_id string, played_at string"
        plays = spark.createDataFrame(rows, names)
        missing = [f for f in PLAY_EVENT.fields if f.name not in plays.columns]
        plays = plays.withColumns({f.name: F.lit(None).cast(f.dataType) for f in missing}).select(*PLAY_EVENT.fieldNames())
        tables.write_bronze(plays, root)
        run = ingest.register_files(spark, root, listed, listed + "-progress")
        ingest.run_to_end(run)
        return sum(p["numInputRows"] for p in run.recentProgress)

    assert load(1, 9) == 9
    first = {r.file_path: r.row_count for r in ingest.registered_files(spark, listed).collect()}
    assert load(2, 5) == 5  # not 14
    both = {r.file_path: r.row_count for r in ingest.registered_files(spark, listed).collect()}
    assert first.items() < both.items() and sum(first.values()) == 9 and sum(both.values()) == 14
    scanned = tables.list_source_files(tables.external_table_scan(spark, root)).collect()
    assert {r.file_path: r.row_count for r in scanned} == both
    again = ingest.register_files(spark, root, listed, listed + "-progress")
    ingest.run_to_end(again)
    assert ingest.registered_files(spark, listed).count() == len(both)
