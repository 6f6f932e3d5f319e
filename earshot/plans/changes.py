"""Incremental tables, snapshots, streams."""

from __future__ import annotations

from functools import partial

from pyspark.sql import functions as F

from ..operators import gold, incremental, sessions, snapshots
from ..session import run_name, scratch_path
from ..sources import events as event_sources
from ..sources import tables
from ..streaming import ingest, state
from . import bridge
from .bridge import with_tables
from .registry import query

CUT = "2000-01-01"


def _at(text: str):
    return F.lit(text).cast("timestamp_ntz")


# Orders summed per customer before and from a date on: the later ones update and add customers. Every order is on one side.
SPLIT = "1996-01-01"
_SUMS = "SELECT o_custkey, count(*) AS orders, max(o_orderdate) AS last_order, min(o_orderpriority) AS best FROM orders WHERE o_orderdate"
_BEFORE = f"{_SUMS} < TIMESTAMP '{SPLIT}' GROUP BY 1"
_AFTER = f"{_SUMS} >= TIMESTAMP '{SPLIT}' GROUP BY 1"
_TWO = f"WITH t AS ({_BEFORE}), s AS ({_AFTER})\n"


def _before_after(spark, sf):
    orders = bridge.table(spark, sf, "orders")

    def per_customer(rows):
        return rows.groupBy("o_custkey").agg(
            F.count("*").alias("orders"), F.max("o_orderdate").alias("last_order"), F.min("o_orderpriority").alias("best")
        )

    early = F.col("o_orderdate") < _at(SPLIT)
    return per_customer(orders.filter(early)), per_customer(orders.filter(~early))


@query("incremental_append", _TWO + "SELECT * FROM t UNION ALL SELECT * FROM s")
def _append(spark, sf):
    return incremental.append(*_before_after(spark, sf))


@query("incremental_merge", _TWO + """
SELECT coalesce(s.o_custkey, t.o_custkey) AS o_custkey, coalesce(s.orders, t.orders) AS orders,
       coalesce(s.last_order, t.last_order) AS last_order, coalesce(s.best, t.best) AS best
FROM t FULL JOIN s ON t.o_custkey = s.o_custkey""")
def _merge(spark, sf):
    return incremental.merge(*_before_after(spark, sf), ["o_custkey"])


@query("incremental_merge_columns", _TWO + """
SELECT coalesce(t.o_custkey, s.o_custkey) AS o_custkey, coalesce(t.orders, s.orders) AS orders,
       coalesce(s.last_order, t.last_order) AS last_order, coalesce(t.best, s.best) AS best
FROM t FULL JOIN s ON t.o_custkey = s.o_custkey""")
def _merge_columns(spark, sf):
    return incremental.merge(*_before_after(spark, sf), ["o_custkey"], update_columns=["last_order"])


@query("incremental_merge_predicate", _TWO + """
, inside AS (SELECT * FROM t WHERE last_order >= TIMESTAMP '1995-09-01')
SELECT coalesce(s.o_custkey, t.o_custkey) AS o_custkey, coalesce(s.orders, t.orders) AS orders,
       coalesce(s.last_order, t.last_order) AS last_order, coalesce(t.best, s.best) AS best
FROM inside t FULL JOIN s ON t.o_custkey = s.o_custkey
UNION ALL SELECT * FROM t WHERE last_order < TIMESTAMP '1995-09-01'""")
def _merge_predicate(spark, sf):
    recent = F.col("last_order") >= _at("1995-09-01")
    return incremental.merge(*_before_after(spark, sf), ["o_custkey"], exclude_columns=["BEST"], predicate=recent)


@query("incremental_delete_insert", _TWO + """
SELECT * FROM t WHERE o_custkey NOT IN (SELECT o_custkey FROM s) UNION ALL SELECT * FROM s""")
def _delete_insert(spark, sf):
    return incremental.delete_insert(*_before_after(spark, sf), ["o_custkey"])


@query("delete_keys_semi", "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderkey NOT IN (SELECT c_custkey FROM customer)")
def _delete_keys(spark, sf):
    """Orders, without those whose number is a customer's."""
    orders = bridge.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    customers = bridge.table(spark, sf, "customer").select(F.col("c_custkey").alias("o_orderkey"))
    return incremental.delete_keys(orders, customers, ["o_orderkey"])


@query("incremental_insert_overwrite", _TWO + """
SELECT * FROM t WHERE NOT (last_order >= TIMESTAMP '1995-09-01') UNION ALL SELECT * FROM s""")
def _insert_overwrite(spark, sf):
    target, source = _before_after(spark, sf)
    return incremental.insert_overwrite(target, source, F.col("last_order") >= _at("1995-09-01"))


@query("overwrite_partitions", """
SELECT o_orderkey, o_orderpriority, CAST(year(o_orderdate) AS INTEGER) AS year,
       CASE WHEN year(o_orderdate) >= 2000 THEN 'again' ELSE 'first' END AS load FROM orders""")
def _overwrite_partitions(spark, sf):
    """Years from 2000 on are loaded a second time; only their folders are replaced."""
    path = scratch_path(spark, "by_year")
    rows = bridge.table(spark, sf, "orders").select("o_orderkey", "o_orderpriority", F.year("o_orderdate").alias("year"))
    incremental.overwrite_partitions(rows.withColumn("load", F.lit("first")), path, ["year"])
    incremental.overwrite_partitions(rows.filter("year >= 2000").withColumn("load", F.lit("again")), path, ["year"])
    return spark.read.parquet(path).select("o_orderkey", "o_orderpriority", "year", "load")


@query("incremental_microbatch", """
SELECT event_id, ts, CASE WHEN ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-12' THEN 'corrected' ELSE event_type END
       AS event_type FROM events""")
def _microbatch(spark, sf):
    """Two days are replaced by a corrected load; rows of other days in it are left out."""
    rows = bridge.table(spark, sf, "events").select("event_id", "ts", "event_type")
    corrected = rows.withColumn("event_type", F.lit("corrected"))
    return incremental.microbatch(rows, corrected, "ts", "2024-01-10", "2024-01-12")


@query("new_rows_since", "SELECT event_id, ts, user_id FROM events WHERE ts > (SELECT max(ts) FROM events WHERE ts < TIMESTAMP '2024-01-16')")
def _new_rows_since(spark, sf):
    rows = bridge.table(spark, sf, "events").select("event_id", "ts", "user_id")
    return incremental.new_rows_since(rows, rows.filter(F.col("ts") < _at("2024-01-16")), "ts")


@query("schema_change", """
SELECT o_custkey AS id, CAST(count(*) AS DOUBLE) AS n, CAST(NULL AS VARCHAR) AS best FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01' GROUP BY 1
UNION ALL SELECT o_custkey, count(*) + 0.5::DOUBLE, min(o_orderpriority) FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01' GROUP BY 1""")
def _schema_change(spark, sf):
    """The new load has another column, lacks one and has one of another type."""
    orders = bridge.table(spark, sf, "orders")
    key = F.col("o_custkey").alias("id")
    target = orders.filter(F.col("o_orderdate") < _at(CUT)).groupBy(key).agg(
        F.count("*").alias("n"), F.max("o_totalprice").alias("gone")
    )
    source = orders.filter(F.col("o_orderdate") >= _at(CUT)).groupBy(key).agg(
        (F.count("*") + F.lit(0.5)).alias("n"), F.min("o_orderpriority").alias("best")
    )
    return incremental.append(*incremental.apply_schema_change(target, source, "sync_all_columns"))


# A customer's state at a date: its latest order of all before. Those whose latest order is of low priority are gone.
def _state_sql(day: str) -> str:
    return f"""SELECT o_custkey, arg_max(o_orderpriority, (o_orderdate, o_orderkey)) AS priority,
       arg_max(o_orderstatus, (o_orderdate, o_orderkey)) AS status, max(o_orderdate) AS changed_at
FROM orders WHERE o_orderdate < TIMESTAMP '{day}' GROUP BY 1
HAVING arg_max(o_orderpriority, (o_orderdate, o_orderkey)) <> '5-LOW'"""


def _state(spark, sf, day: str):
    orders = bridge.table(spark, sf, "orders")
    latest = F.struct("o_orderdate", "o_orderkey")
    states = orders.filter(F.col("o_orderdate") < _at(day)).groupBy("o_custkey").agg(
        F.max_by("o_orderpriority", latest).alias("priority"),
        F.max_by("o_orderstatus", latest).alias("status"),
        F.max("o_orderdate").alias("changed_at"),
    )
    return states.filter("priority <> '5-LOW'")


#: The second date lies after the last order, so every order counts.
FIRST, SECOND = "1999-01-01", "2002-01-01"


def _hash(key: str, stamp: str) -> str:
    return f"md5(CAST({key} AS VARCHAR) || '|' || CAST({stamp} AS VARCHAR))"


def _snapshot_sql(strategy: str, deletes: str) -> str:
    by_time = strategy == "timestamp"
    old_stamp = "o.changed_at" if by_time else f"TIMESTAMP '{FIRST}'"
    new_stamp = "n.changed_at" if by_time else f"TIMESTAMP '{SECOND}'"
    changed = (
        "o.changed_at < n.changed_at" if by_time
        else "(o.priority IS DISTINCT FROM n.priority OR o.status IS DISTINCT FROM n.status)"
    )
    gone_end = "NULL" if deletes == "ignore" else f"TIMESTAMP '{SECOND}'"
    flag = ", 'False' AS is_deleted" if deletes == "new_record" else ""
    parts = [f"""
SELECT o.*, {_hash('o.o_custkey', old_stamp)} AS scd_id, {old_stamp} AS updated_at_version, {old_stamp} AS valid_from,
       CASE WHEN n.o_custkey IS NULL THEN CAST({gone_end} AS TIMESTAMP) WHEN {changed} THEN {new_stamp} END AS valid_to{flag}
FROM o LEFT JOIN n ON o.o_custkey = n.o_custkey""", f"""
SELECT n.*, {_hash('n.o_custkey', new_stamp)}, {new_stamp}, {new_stamp}, CAST(NULL AS TIMESTAMP){flag}
FROM n LEFT JOIN o ON o.o_custkey = n.o_custkey WHERE o.o_custkey IS NULL OR {changed}"""]
    if deletes == "new_record":
        first_id = _hash("o.o_custkey", old_stamp)
        parts.append(f"""
SELECT o.*, md5({first_id} || '|' || '{SECOND} 00:00:00'), TIMESTAMP '{SECOND}', TIMESTAMP '{SECOND}', CAST(NULL AS TIMESTAMP), 'True'
FROM o WHERE o_custkey NOT IN (SELECT o_custkey FROM n)""")
    return f"WITH o AS ({_state_sql(FIRST)}), n AS ({_state_sql(SECOND)})" + " UNION ALL ".join(parts)


def _two_snapshots(spark, sf, rule):
    first = snapshots.snapshot_start(_state(spark, sf, FIRST), rule, FIRST)
    return snapshots.snapshot_apply(first, _state(spark, sf, SECOND), rule, SECOND)


@query("snapshot_timestamp", _snapshot_sql("timestamp", "ignore"))
def _snapshot_timestamp(spark, sf):
    return _two_snapshots(spark, sf, snapshots.SnapshotRule(["o_custkey"], "timestamp", "changed_at"))


@query("snapshot_check", _snapshot_sql("check", "invalidate"))
def _snapshot_check(spark, sf):
    rule = snapshots.SnapshotRule(
        ["o_custkey"], "check", check_columns=["priority", "status"], hard_deletes="invalidate"
    )
    return _two_snapshots(spark, sf, rule)


@query("snapshot_apply", _snapshot_sql("timestamp", "new_record"))
def _snapshot_apply(spark, sf):
    rule = snapshots.SnapshotRule(["o_custkey"], "timestamp", "changed_at", hard_deletes="new_record")
    return _two_snapshots(spark, sf, rule)


@query("replace_table", _TWO + """
SELECT coalesce(s.o_custkey, t.o_custkey) AS o_custkey, coalesce(s.orders, t.orders) AS orders,
       coalesce(s.last_order, t.last_order) AS last_order, coalesce(s.best, t.best) AS best
FROM t FULL JOIN s ON t.o_custkey = s.o_custkey""")
def _replace_table(spark, sf):
    """A table merged into itself: the next state is written beside it and the table moves there."""
    target, source = _before_after(spark, sf)
    name = run_name("customer_activity")
    stored = incremental.replace_table(spark, name, target)
    return incremental.replace_table(spark, name, incremental.merge(stored, source, ["o_custkey"]))


@query("bucketed_merge", _TWO + """
, merged AS (SELECT coalesce(s.o_custkey, t.o_custkey) AS o_custkey, coalesce(s.orders, t.orders) AS orders,
       coalesce(s.last_order, t.last_order) AS last_order, coalesce(s.best, t.best) AS best
FROM t FULL JOIN s ON t.o_custkey = s.o_custkey)
SELECT * FROM merged WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal < 0)""")
def _bucketed_merge(spark, sf):
    """Merge, then delete, on a table in buckets of its key; each next state is read as it lies."""
    target, source = _before_after(spark, sf)
    name = run_name("customer_buckets")
    stored = incremental.store_bucketed(spark, name, target, ["o_custkey"], 8)
    stored = incremental.store_bucketed(spark, name, incremental.merge(stored, source, ["o_custkey"]), ["o_custkey"], 8)
    overdrawn = bridge.table(spark, sf, "customer").filter("c_acctbal < 0").select(F.col("c_custkey").alias("o_custkey"))
    return incremental.delete_keys(stored, overdrawn, ["o_custkey"])


_CLEAN = "event_id, user_id, event_type, track_id, track_name, artist_name, album_name, duration_ms, played_at, device_type"


def _json_stream(spark, sf, rows):
    """Rows written as JSON lines and read back as a stream of text."""
    path = scratch_path(spark, "messages")
    rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).write.text(path)
    return event_sources.file_json_source(spark, path)


@query("stream_bronze_ingest", with_tables("bronze") + f"SELECT {_CLEAN} FROM bronze")
def _stream_bronze_ingest(spark, sf):
    root = scratch_path(spark, "bronze")
    messages = _json_stream(spark, sf, bridge.bronze(spark, sf))
    ingest.run_to_end(ingest.stream_bronze_ingest(messages, root, root + "-progress", every=None))
    return tables.external_table_scan(spark, root).drop(*tables.HOUR_PARTITIONS)


@query("bounded_stream_run", with_tables("bronze") + """
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS plays FROM bronze GROUP BY 1""")
def _bounded_stream_run(spark, sf):
    """Two bounded runs of one query: the second takes only what came after the first."""
    bronze, root, source = bridge.bronze(spark, sf), scratch_path(spark, "bronze"), scratch_path(spark, "messages")
    late = F.col("played_at") >= "2024-01-16"
    for part in (bronze.filter(~late), bronze.filter(late)):
        part.select(F.to_json(F.struct(*bronze.columns)).alias("value")).write.mode("append").text(source)
        messages = event_sources.file_json_source(spark, source)
        ingest.run_to_end(ingest.stream_bronze_ingest(messages, root, root + "-progress", every=None))
    landed = tables.external_table_scan(spark, root)
    day = F.concat_ws("-", "year", "month", "day").alias("day")
    return landed.groupBy(day).agg(F.count("*").alias("plays"))


def _play_stream(spark, rows):
    path = scratch_path(spark, "plays")
    rows.write.parquet(path)
    return spark.readStream.schema(rows.schema).parquet(path), path


def _close(spark, rows, path):
    """A last row far ahead in time, in a file of its own: moves the watermark past everything else."""
    end = {"played_at": F.lit("2030-01-01T00:00:00Z"), "event_time": F.lit("2030-01-01").cast("timestamp")}
    cells = [end.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in rows.schema.fields]
    spark.range(1).select(*cells).write.mode("append").parquet(path)


def _run(spark, rows, label):
    path = scratch_path(spark, label)
    ingest.run_to_end(ingest.start_file_sink(rows, path, path + "-progress"))
    return spark.read.schema(rows.schema).parquet(path)


@query("stream_dedup", with_tables("bronze") + "SELECT DISTINCT event_id FROM bronze WHERE event_id IS NOT NULL")
def _stream_dedup(spark, sf):
    """Every play is delivered twice."""
    bronze = bridge.bronze(spark, sf).filter(F.col("event_id").isNotNull())
    twice = bronze.withColumn("delivery", F.explode(F.array(F.lit(1), F.lit(2))))
    stream, _ = _play_stream(spark, twice)
    return _run(spark, ingest.stream_dedup(stream), "dedup").select("event_id")


def _some_unreadable(spark, sf):
    """Silver plays as they come off a stream, with times as text, of which some cannot be read."""
    text = F.when(F.col("event_id").cast("long") % 101 == 0, "not a time").otherwise(F.col("played_at").cast("string"))
    return bridge.silver(spark, sf).select("user_id", "track_id", "artist_name", "duration_ms", text.alias("played_at"))


_UNREADABLE = "CAST(event_id AS BIGINT) % 101 = 0"


def _run_untimed(spark, rows, path):
    """The plays without a readable time, as a bounded stream run leaves them."""
    out = scratch_path(spark, "untimed")
    stream = spark.readStream.schema(rows.schema).parquet(path)
    ingest.run_to_end(ingest.stream_without_time(stream, out, out + "-progress", every=None))
    return spark.read.schema(rows.schema).parquet(out)


@query("stream_sessionize", with_tables("silver", extra=f"""
timed AS (SELECT * FROM silver WHERE NOT ({_UNREADABLE})),
minutes AS (SELECT DISTINCT user_id, date_trunc('minute', played_at) AS minute FROM timed),
marked AS (SELECT *, coalesce(minute - lag(minute) OVER (PARTITION BY user_id ORDER BY minute) > INTERVAL 60 MINUTE, true) AS opens FROM minutes),
numbered AS (SELECT *, count(*) FILTER (opens) OVER (PARTITION BY user_id ORDER BY minute) AS n FROM marked)""") + f"""
SELECT t.user_id, count(*) AS tracks_in_session, min(t.played_at) AS session_start, max(t.played_at) AS session_end
FROM timed t JOIN numbered m ON m.user_id = t.user_id AND m.minute = date_trunc('minute', t.played_at) GROUP BY t.user_id, m.n
UNION ALL SELECT user_id, count(*), NULL, NULL FROM silver WHERE {_UNREADABLE} GROUP BY 1""")
def _stream_sessionize(spark, sf):
    """Closed sessions, and per user what the dead letters hold."""
    rows = _some_unreadable(spark, sf)
    stream, path = _play_stream(spark, rows)
    _close(spark, rows, path)
    closed = _run(spark, ingest.stream_sessionize(ingest.typed_time(stream), late="60 days"), "sessions").filter(F.col("user_id").isNotNull())
    closed = closed.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("session_start", "session_end")})
    untimed = _run_untimed(spark, rows, path).groupBy("user_id").agg(F.count("*").alias("tracks_in_session"))
    return closed.unionByName(untimed, allowMissingColumns=True)


@query("stream_daily_counts", with_tables("silver") + f"""
SELECT CASE WHEN NOT ({_UNREADABLE}) THEN CAST(played_at AS DATE) END AS date, user_id, count(*) AS total_plays,
       CAST(sum(duration_ms) AS BIGINT) AS total_listening_time_ms, count(DISTINCT track_id) AS unique_tracks
FROM silver GROUP BY 1, 2""")
def _stream_daily_counts(spark, sf):
    """The stream's days and the batch counts of its dead letters are together the batch result."""
    rows = _some_unreadable(spark, sf)
    stream, path = _play_stream(spark, rows)
    _close(spark, rows, path)
    daily = _run(spark, ingest.stream_daily_counts(stream, late="60 days"), "daily").filter(F.col("user_id").isNotNull())
    untimed = _run_untimed(spark, rows, path).withColumn("played_at", F.lit(None).cast("timestamp_ntz"))
    return daily.unionByName(gold.daily_user_stats(untimed).select(*daily.columns))


def _run_halves(spark, sf, run):
    """Detections of each half of the month come in and are processed, one half after the other."""
    rows, path, root = bridge.currently_playing(spark, sf), scratch_path(spark, "detections"), scratch_path(spark, "state")
    late = F.col("detected_at") >= _at("2024-01-16")
    for part in (rows.filter(~late), rows.filter(late)):
        part.write.mode("append").parquet(path)
        stream = spark.readStream.schema(rows.schema).parquet(path)
        ingest.run_to_end(run(stream, root=root, checkpoint=root + "-progress"))
    return rows, root


_CHANGES = """
SELECT user_id, detected_at, track_id, track_name FROM (
  SELECT *, lag(track_id) OVER (PARTITION BY user_id ORDER BY detected_at, track_id) AS prev FROM playing)
WHERE prev IS NULL OR track_id <> prev"""


@query("stream_track_change", with_tables("playing") + _CHANGES)
def _stream_track_change(spark, sf):
    """Run twice over half a month each; the second run continues from the first one's state."""
    run = partial(state.run_with_keyed_state, step=state.track_change_step(), keys=["user_id"], newest=["detected_at", "track_id"])
    rows, root = _run_halves(spark, sf, run)
    out = spark.read.schema(rows.schema).parquet(f"{root}/out")
    return out.select("user_id", "detected_at", "track_id", "track_name")


@query("track_changes", with_tables("playing") + _CHANGES)
def _track_changes(spark, sf):
    changes = sessions.track_changes(bridge.currently_playing(spark, sf))
    return changes.select("user_id", "detected_at", "track_id", "track_name")


@query("stream_retention", with_tables("playing") + """
SELECT user_id, detected_at, track_id FROM playing WHERE detected_at >= (SELECT max(detected_at) FROM playing) - INTERVAL 24 HOUR""")
def _stream_retention(spark, sf):
    """Each half of the month adds to the folders of its hours; those of the first half go with the second."""
    rows, root = _run_halves(spark, sf, state.run_retention)
    return state.retained(spark, rows.schema, root).select("user_id", "detected_at", "track_id")


@query("refresh_table", with_tables("playing") + """
SELECT device_type, count(*) AS total_plays, CAST(sum(duration_ms) AS BIGINT) AS total_listening_time_ms FROM playing GROUP BY 1""")
def _refresh_table(spark, sf):
    """Device totals kept up to date: the second half of the month adds to what the first one left."""
    totals = [F.count("*").alias("total_plays"), F.sum("duration_ms").alias("total_listening_time_ms")]
    _, root = _run_halves(spark, sf, partial(state.run_refresh, keys=["device_type"], measures=totals))
    return state.refreshed(spark, root, ["device_type"])
