"""Reshaping, set operations, tables and files."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import incremental, reshape
from ..schemas import PLAY_EVENT, SILVER_PLAYS
from ..session import materialize, run_name, scratch_path
from ..sources import events, tables
from ..streaming import ingest
from . import bridge
from .bridge import with_tables
from .registry import query


@query("star_except", """
SELECT c_custkey AS x_c_custkey_y, c_nationkey AS x_c_nationkey_y, c_mktsegment AS x_c_mktsegment_y FROM customer""")
def _star_except(spark, sf):
    customers = bridge.table(spark, sf, "customer").alias("c")
    return customers.select(reshape.star_except(customers, ["C_NAME", "c_acctbal"], "c", "x_", "_y"))


@query("nullcheck_table", """
SELECT event_id, user_id, nullif(CASE WHEN event_type = 'error' THEN '' ELSE event_type END, '') AS event_type FROM events""")
def _nullcheck_table(spark, sf):
    rows = bridge.table(spark, sf, "events").select(
        "event_id", "user_id", F.when(F.col("event_type") == "error", "").otherwise(F.col("event_type")).alias("event_type")
    )
    return reshape.nullcheck_table(rows)


@query("where_subquery", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_returnflag = 'R' AND l_discount > 0.05""")
def _where_subquery(spark, sf):
    rows = bridge.table(spark, sf, "lineitem").filter("l_returnflag = 'R' and l_discount > 0.05D")
    return rows.select("l_orderkey", "l_linenumber", "l_partkey")


@query("empty_like", with_tables("silver") + """
SELECT event_id, track_id, CAST(NULL AS TIMESTAMP) AS processed_at, duration_ms FROM silver""")
def _empty_like(spark, sf):
    """A declared schema's empty copy gives a table the columns that it lacks."""
    empty = reshape.empty_like(spark, SILVER_PLAYS)
    rows = bridge.silver(spark, sf).select("event_id", "track_id", "duration_ms")
    filled = empty.unionByName(rows, allowMissingColumns=True)
    return filled.select("event_id", "track_id", F.col("processed_at").cast("timestamp_ntz").alias("processed_at"), "duration_ms")


@query("pivot", """
SELECT l_shipmode_year AS ship_year, count(*) FILTER (l_returnflag = 'A') AS qty_A, count(*) FILTER (l_returnflag = 'N') AS qty_N,
       count(*) FILTER (l_returnflag = 'R') AS qty_R
FROM (SELECT *, CAST(year(l_shipdate) AS INTEGER) AS l_shipmode_year FROM lineitem) GROUP BY 1""")
def _pivot(spark, sf):
    """The values to pivot on are asked of the table."""
    lines = bridge.table(spark, sf, "lineitem")
    columns = reshape.pivot_columns("l_returnflag", reshape.pivot_values(lines, "l_returnflag", default=["A", "N", "R"]), prefix="qty_")
    return lines.groupBy(F.year("l_shipdate").alias("ship_year")).agg(*columns)


@query("pivot_default", """
SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS "F", count(*) FILTER (o_orderstatus = 'none') AS "none" FROM orders GROUP BY 1""")
def _pivot_default(spark, sf):
    """Where no value is found, the default is pivoted on."""
    orders = bridge.table(spark, sf, "orders")
    values = reshape.pivot_values(orders, "o_orderstatus", "o_totalprice < 0", default=["F", "none"])
    return orders.groupBy("o_orderpriority").agg(*reshape.pivot_columns("o_orderstatus", values))


@query("pivot_options", """
SELECT c_nationkey, max(CASE WHEN c_mktsegment >= 'BUILDING' THEN c_acctbal ELSE -1e0 END) AS from_building_up,
       max(CASE WHEN c_mktsegment >= 'MACHINERY' THEN c_acctbal ELSE -1e0 END) AS from_machinery_up FROM customer GROUP BY 1""")
def _pivot_options(spark, sf):
    columns = reshape.pivot_columns(
        "c_mktsegment", ["BUILDING", "MACHINERY"], agg="max", cmp=">=", prefix="From-", suffix=" up",
        then_value=F.col("c_acctbal"), else_value=-1.0, quote_identifiers=False,
    )
    return bridge.table(spark, sf, "customer").groupBy("c_nationkey").agg(*columns)


@query("pivot_distinct", """
SELECT o_orderstatus, count(DISTINCT CASE WHEN o_orderpriority = '1-URGENT' THEN o_custkey ELSE 0 END) AS "1-URGENT",
       count(DISTINCT CASE WHEN o_orderpriority = '5-LOW' THEN o_custkey ELSE 0 END) AS "5-LOW" FROM orders GROUP BY 1""")
def _pivot_distinct(spark, sf):
    columns = reshape.pivot_columns(
        "o_orderpriority", ["1-URGENT", "5-LOW"], agg="count", then_value=F.col("o_custkey"), distinct=True
    )
    return bridge.table(spark, sf, "orders").groupBy("o_orderstatus").agg(*columns)


_UNPIVOT = {"p_size": "CAST(p_size AS VARCHAR)", "p_name": "p_name", "is_large": "CAST(p_size > 25 AS VARCHAR)",
            "maybe": "CASE WHEN p_size > 40 THEN NULL ELSE p_type END"}


@query("unpivot", " UNION ALL ".join(
    f"SELECT p_partkey, p_brand, '{c}' AS prop, {e} AS val FROM part" for c, e in _UNPIVOT.items()))
def _unpivot(spark, sf):
    part = bridge.table(spark, sf, "part").select(
        "p_partkey", "p_brand", "p_size", "p_name", (F.col("p_size") > 25).alias("is_large"),
        F.when(F.col("p_size") <= 40, F.col("p_type")).alias("maybe"), "p_retailprice",
    )
    return reshape.unpivot(part, "string", ["p_partkey", "p_brand"], ["p_retailprice"], "prop", "val")


@query("unpivot_numbers", """
SELECT c_custkey, 'c_nationkey' AS field_name, CAST(c_nationkey AS DOUBLE) AS value FROM customer
UNION ALL SELECT c_custkey, 'c_acctbal', c_acctbal FROM customer""")
def _unpivot_numbers(spark, sf):
    return reshape.unpivot(
        bridge.table(spark, sf, "customer"), "double", ["c_custkey"], ["c_name", "c_mktsegment"]
    )


@query("union_relations", """
SELECT 'customer' AS source_relation, c_custkey AS id, c_name AS name, c_acctbal AS balance, c_mktsegment AS segment,
       CAST(NULL AS BIGINT) AS nation FROM customer WHERE c_acctbal > 0
UNION ALL SELECT 'supplier', s_suppkey, s_name, s_acctbal, NULL, CAST(s_nationkey AS BIGINT) FROM supplier WHERE s_acctbal > 0""")
def _union_relations(spark, sf):
    customers = bridge.table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"),
        F.col("c_mktsegment").alias("segment"), F.col("c_nationkey").alias("dropped"),
    )
    suppliers = bridge.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"),
        F.col("s_nationkey").alias("nation"),
    )
    return reshape.union_relations(
        {"customer": customers, "supplier": suppliers},
        column_override={"nation": "bigint"}, exclude=["DROPPED"], where="balance > 0",
    )


@query("deduplicate", """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey) AS rn FROM orders)
WHERE rn = 1""".replace("SELECT * FROM (", "SELECT * EXCLUDE (rn) FROM ("))
def _deduplicate(spark, sf):
    return reshape.deduplicate(
        bridge.table(spark, sf, "orders"), ["o_custkey"], [F.col("o_orderdate").desc(), F.col("o_orderkey").asc()]
    )


@query("natural_join_dedup", with_tables("bronze") + """
SELECT DISTINCT user_id, track_id, played_at, device_type FROM bronze WHERE user_id IS NOT NULL""")
def _natural_join_dedup(spark, sf):
    """One row per play and device out of repeated deliveries."""
    rows = bridge.bronze(spark, sf).filter(F.col("user_id").isNotNull())
    keys = ["user_id", "track_id", "played_at", "device_type"]
    return reshape.deduplicate(rows, keys, [F.col("event_id").asc()]).select(*keys)


@query("except_sets", "SELECT o_orderkey AS id FROM orders EXCEPT SELECT c_custkey FROM customer")
def _except_sets(spark, sf):
    """Order numbers that are no customer number."""
    orders = bridge.table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"))
    return reshape.except_sets(orders, bridge.table(spark, sf, "customer").select(F.col("c_custkey").alias("id")))


@query("intersect_sets", """
SELECT l_partkey AS id FROM lineitem WHERE l_returnflag = 'R' INTERSECT SELECT l_partkey FROM lineitem WHERE l_returnflag <> 'R'""")
def _intersect_sets(spark, sf):
    """Parts that were returned and also delivered for good."""
    lines = bridge.table(spark, sf, "lineitem")
    part = F.col("l_partkey").alias("id")
    return reshape.intersect_sets(
        lines.filter("l_returnflag = 'R'").select(part), lines.filter("l_returnflag <> 'R'").select(part)
    )


@query("column_values", "SELECT o_orderpriority AS value, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1 ORDER BY n DESC, value LIMIT 3")
def _column_values(spark, sf):
    return reshape.column_values(bridge.table(spark, sf, "orders"), "o_orderpriority", "o_orderstatus = 'F'", 3)


@query("listagg", "SELECT n_regionkey, string_agg(n_name, '; ' ORDER BY n_name) AS nations FROM nation GROUP BY 1")
def _listagg(spark, sf):
    return reshape.listagg_in_pieces(bridge.table(spark, sf, "nation"), ["n_regionkey"], "n_name", "; ", name="nations")


@query("listagg_limit", """
SELECT c_nationkey, array_to_string(list(c_name ORDER BY c_acctbal DESC, c_custkey)[1:3], ',') AS richest FROM customer GROUP BY 1""")
def _listagg_limit(spark, sf):
    richest = [F.col("c_acctbal").desc(), F.col("c_custkey").asc()]
    return reshape.listagg_first(bridge.table(spark, sf, "customer"), ["c_nationkey"], "c_name", richest, 3, name="richest")


@query("any_value_bool_or", """
SELECT l_partkey, true AS supplier_is_one_of_them, bool_or(l_discount > 0.09) AS has_large FROM lineitem GROUP BY 1""")
def _any_value_bool_or(spark, sf):
    """One of a part's suppliers, looked up among the suppliers that it has, and whether any line has a large discount."""
    lines = bridge.table(spark, sf, "lineitem")
    picked = lines.groupBy("l_partkey").agg(
        F.any_value("l_suppkey").alias("l_suppkey"), F.bool_or(F.col("l_discount") > 0.09).alias("has_large")
    )
    sold = lines.select("l_partkey", "l_suppkey", F.lit(True).alias("found")).distinct()
    found = F.coalesce("found", F.lit(False)).alias("supplier_is_one_of_them")
    return picked.join(sold, ["l_partkey", "l_suppkey"], "left").select("l_partkey", found, "has_large")


@query("not_null_proportion", with_tables("bronze") + """
SELECT device_type, round(count(user_id) / count(*), 6) AS share FROM bronze GROUP BY 1""")
def _not_null_proportion(spark, sf):
    return bridge.bronze(spark, sf).groupBy("device_type").agg(
        F.round(F.count("user_id") / F.count("*"), 6).alias("share")
    )


_CLEAN = "event_id, user_id, event_type, track_id, track_name, artist_name, album_name, duration_ms, played_at, device_type"


def _messages(spark, sf):
    """Bronze rows as JSON text; those without a user arrive cut off."""
    rows = bridge.bronze(spark, sf)
    whole = F.to_json(F.struct(*rows.columns))
    return rows.select(F.when(F.col("user_id").isNull(), F.left(whole, F.length(whole) - 5)).otherwise(whole).alias("value"))


@query("parse_events", with_tables("bronze") + f"SELECT {_CLEAN} FROM bronze WHERE user_id IS NOT NULL")
def _parse_events(spark, sf):
    return events.parse_events(_messages(spark, sf))


@query("dead_letter_split", with_tables("bronze") + """
SELECT user_id IS NULL AS dead, count(*) AS messages FROM bronze GROUP BY 1""")
def _dead_letter_split(spark, sf):
    return events.mark_dead(_messages(spark, sf)).groupBy("dead").agg(F.count("*").alias("messages"))


@query("conform_schema", with_tables("plays") + """
SELECT event_id, user_id, CAST(NULL AS VARCHAR) AS event_type, track_id, track_name, artist_name, album_name,
       CASE WHEN duration_ms > 600000 THEN NULL ELSE duration_ms END AS duration_ms, played_at, device_type FROM plays""")
def _conform_schema(spark, sf):
    """A frame without event_type, with an extra column and durations that are not all numbers."""
    loose = bridge.plays(spark, sf).drop("event_type").withColumns(
        {
            "duration_ms": F.when(F.col("duration_ms") > 600000, "too long").otherwise(F.col("duration_ms").cast("string")),
            "extra": F.lit(1),
        }
    )
    return events.conform_schema(loose, PLAY_EVENT)


@query("produce_events", with_tables("plays") + """
SELECT user_id AS key, '{"event_id":"' || event_id || '","track_id":"' || track_id || '","duration_ms":' || duration_ms || '}'
       AS value FROM plays""")
def _produce_events(spark, sf):
    plays = bridge.plays(spark, sf)
    out = events.produce_events(plays.select("user_id", "event_id", "track_id", "duration_ms"))
    return out.select("key", F.regexp_replace("value", r'"user_id":"[^"]*",', "").alias("value"))


def _pages(spark, sf):
    """One API page per play; pages overlap, as polled pages do, so each play is on its page twice."""
    plays = bridge.plays(spark, sf)
    artist = F.struct(F.col("artist_name").alias("name"))
    nobody = F.array().cast("array<struct<name:string>>")
    track = F.struct(
        F.col("track_id").alias("id"),
        F.col("track_name").alias("name"),
        F.when(F.col("device_type") != "tablet", F.array(artist)).otherwise(nobody).alias("artists"),
        F.struct(F.col("album_name").alias("name")).alias("album"),
        "duration_ms",
    )
    context = F.when(F.col("device_type") != "mobile", F.struct(F.lit("album").alias("type")))
    item = F.struct(track.alias("track"), "played_at", context.alias("context"))
    return plays.select("user_id", F.to_json(F.struct(F.array(item, item).alias("items"))).alias("value"))


@query("flatten_recently_played", with_tables("plays") + """
, d AS (SELECT *, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8')
               || encode(user_id || '_' || track_id || '_' || played_at)) AS h FROM plays)
SELECT substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-'
       || substr('89ab', 1 + (instr('0123456789abcdef', substr(h, 17, 1)) - 1) % 4, 1) || substr(h, 18, 3) || '-'
       || substr(h, 21, 12) AS event_id, user_id, 'play' AS event_type, track_id, track_name,
       CASE WHEN device_type = 'tablet' THEN 'Unknown' ELSE artist_name END AS artist_name, album_name, duration_ms, played_at,
       CASE WHEN device_type = 'mobile' THEN 'unknown' ELSE 'album' END AS device_type FROM d""")
def _flatten_recently_played(spark, sf):
    """The id made from user, track and time gives a repeated play away."""
    return events.flatten_recently_played(_pages(spark, sf)).dropDuplicates(["event_id"])


@query("flatten_playback_state", with_tables("plays") + """
SELECT event_id, track_id, track_name, artist_name, 'Unknown' AS album_name, device_type = 'desktop' AS is_playing, 0 AS progress_ms,
       CAST(duration_ms AS INTEGER) AS duration_ms, device_type, 'Unknown' AS device_name, false AS shuffle_state,
       'off' AS repeat_state, CASE WHEN device_type = 'desktop' THEN 'album' END AS context_type,
       CAST(NULL AS VARCHAR) AS context_uri FROM plays WHERE device_type <> 'tablet'""")
def _flatten_playback_state(spark, sf):
    """States with most optional parts missing; a tablet reports no track."""
    item = F.struct(
        F.col("track_id").alias("id"), F.col("track_name").alias("name"),
        F.array(F.struct(F.col("artist_name").alias("name"))).alias("artists"), "duration_ms",
    )
    state = F.struct(
        F.when(F.col("device_type") != "tablet", item).alias("item"),
        F.struct(F.col("device_type").alias("type")).alias("device"),
        F.when(F.col("device_type") == "desktop", F.struct(F.lit("album").alias("type"))).alias("context"),
        F.when(F.col("device_type") == "desktop", F.lit(True)).alias("is_playing"),
    )
    states = bridge.plays(spark, sf).select("event_id", F.to_json(state).alias("value"))
    return events.flatten_playback_state(states, "value", "event_id")


def _write(rows, root: str) -> None:
    tables.write_bronze(rows, root)


def _landed(spark, sf):
    """Hourly bronze files of the given events, stored once for each version of these."""
    return bridge.models(spark, sf).table("landed_bronze")


@query("bronze_partitioned_sink", with_tables("bronze") + f"""
SELECT {_CLEAN}, strftime(ts, '%Y') AS year, strftime(ts, '%m') AS month, strftime(ts, '%d') AS day, strftime(ts, '%H') AS hour
FROM bronze""")
def _bronze_partitioned_sink(spark, sf):
    return _landed(spark, sf)


@query("bronze_sink_by_date", with_tables("bronze") + """
SELECT event_id, track_id, played_at, CAST(ts AS DATE) AS event_date,
       CASE WHEN ts >= TIMESTAMP '2024-01-16' THEN device_type END AS device_type FROM bronze""")
def _bronze_sink_by_date(spark, sf):
    """Two appends by date, the second with a column more; the read merges both schemas."""
    rows, path = bridge.bronze(spark, sf).select("event_id", "track_id", "played_at", "device_type"), scratch_path(spark, "by_date")
    late = F.col("played_at") >= "2024-01-16"
    tables.append_by_date(rows.filter(~late).drop("device_type"), path)
    tables.append_by_date(rows.filter(late), path)
    return tables.merged_scan(spark, path)


@query("external_table_scan", with_tables("bronze") + """
SELECT strftime(ts, '%H') AS hour, count(*) AS plays FROM bronze
WHERE ts >= TIMESTAMP '2024-01-10' AND ts < TIMESTAMP '2024-01-11' GROUP BY 1""")
def _external_table_scan(spark, sf):
    """One day read by its folders: the other days' files are never opened."""
    landed = _landed(spark, sf)
    day = landed.filter("year = '2024' and month = '01' and day = '10'")
    return day.groupBy("hour").agg(F.count("*").alias("plays"))


@query("external_table_refresh", with_tables("bronze") + """
SELECT 'first' AS load, count(*) FILTER (ts < TIMESTAMP '2024-01-16') AS plays FROM bronze
UNION ALL SELECT 'both', count(*) FROM bronze""")
def _external_table_refresh(spark, sf):
    """A second load lands after the table was read; a refresh takes up its files, and only these."""
    bronze, root, listed = bridge.bronze(spark, sf), scratch_path(spark, "landing"), scratch_path(spark, "landed-files")
    late = F.col("played_at") >= "2024-01-16"
    plays = F.coalesce(F.sum("row_count"), F.lit(0)).alias("plays")
    shown = []
    for load, rows in (("first", bronze.filter(~late)), ("both", bronze.filter(late))):
        _write(rows, root)
        ingest.run_to_end(ingest.register_files(spark, root, listed, listed + "-progress"))
        # Written now: the same table of files has both loads after the second refresh.
        shown.append(materialize(ingest.registered_files(spark, listed).agg(plays).select(F.lit(load).alias("load"), "plays"), "load"))
    return shown[0].unionByName(shown[1])


@query("list_source_files", with_tables("bronze") + """
SELECT strftime(ts, '%Y-%m-%d %H') AS folder, count(*) AS row_count FROM bronze GROUP BY 1""")
def _list_source_files(spark, sf):
    files = tables.list_source_files(_landed(spark, sf))
    levels = F.regexp_extract_all("file_path", F.lit(r"(?:year|month|day|hour)=(\d+)"), 1)
    folder = F.concat(F.array_join(F.slice(levels, 1, 3), "-"), F.lit(" "), levels[3])
    return files.groupBy(folder.alias("folder")).agg(F.sum("row_count").alias("row_count"))


@query("row_lineage", """
SELECT 'orders.parquet' AS source_file, count(*) AS n, min(file_row_number) AS first_row, max(file_row_number) AS last_row
FROM (SELECT row_number() OVER () - 1 AS file_row_number FROM orders)""")
def _row_lineage(spark, sf):
    rows = tables.row_lineage(bridge.table(spark, sf, "orders"))
    return rows.groupBy("source_file").agg(
        F.count("*").alias("n"), F.min("row_in_file").alias("first_row"), F.max("row_in_file").alias("last_row")
    )


@query("wait_for_files", with_tables("bronze") + """
SELECT CAST(count(DISTINCT strftime(ts, '%Y-%m-%d %H')) AS BIGINT) AS folders, count(*) AS rows, count(*) > 0 AS ready FROM bronze""")
def _wait_for_files(spark, sf):
    """Ready when files have landed and their rows can be read."""
    files = tables.list_source_files(_landed(spark, sf))
    folder = F.regexp_extract("file_path", r"^(.*)/[^/]*$", 1)
    return files.agg(F.countDistinct(folder).alias("folders"), F.sum("row_count").alias("rows")).withColumn("ready", F.col("rows") > 0)


@query("landing_checks", with_tables("bronze") + """
SELECT 'rows_readable' AS check_name, count(*) AS value, true AS passed FROM bronze
UNION ALL SELECT 'files_exist', 1, true UNION ALL SELECT 'partition_path', 0, true UNION ALL SELECT 'missing_columns', 0, true
UNION ALL SELECT 'extra_columns_warn', 0, true""")
def _landing_checks(spark, sf):
    """The number of files depends on the writer's tasks; it is shown as 1 where there are any."""
    some = F.when(F.col("check_name") == "files_exist", F.least("value", F.lit(1))).otherwise(F.col("value"))
    return tables.landing_checks(_landed(spark, sf)).withColumn("value", some.cast("long"))


@query("append_currently_playing", with_tables("playing") + """
SELECT CAST(detected_at AS DATE) AS day, count(*) AS detections FROM playing GROUP BY 1""")
def _append_currently_playing(spark, sf):
    """Two bounded runs, one per half of the month."""
    rows, path, source = bridge.currently_playing(spark, sf), scratch_path(spark, "playing"), scratch_path(spark, "states")
    late = F.col("detected_at") >= F.lit("2024-01-16").cast("timestamp_ntz")
    for part in (rows.filter(~late), rows.filter(late)):
        part.write.mode("append").parquet(source)
        states = spark.readStream.schema(rows.schema).parquet(source)
        ingest.run_to_end(ingest.append_currently_playing(states, path, path + "-progress", every=None))
    landed = spark.read.schema(rows.schema).parquet(path)
    return landed.groupBy(F.to_date("detected_at").alias("day")).agg(F.count("*").alias("detections"))


@query("delete_where", with_tables("playing") + """
SELECT user_id, detected_at, track_id FROM playing WHERE NOT (duration_ms > 600000)""")
def _delete_where(spark, sf):
    kept = incremental.delete_where(bridge.currently_playing(spark, sf), "duration_ms > 600000")
    return kept.select("user_id", "detected_at", "track_id")


@query("retain_last_hours", with_tables("playing") + """
SELECT user_id, detected_at, track_id FROM playing WHERE detected_at >= TIMESTAMP '2024-01-30 00:00:00'""")
def _retain_last_hours(spark, sf):
    kept = incremental.retain_last_hours(bridge.currently_playing(spark, sf), "detected_at", 24, bridge.AS_OF)
    return kept.select("user_id", "detected_at", "track_id")


@query("seed_load", "SELECT n_nationkey, n_name, CAST(n_regionkey AS VARCHAR) AS n_regionkey, c_custkey FROM nation JOIN customer ON c_nationkey = n_nationkey")
def _seed_load(spark, sf):
    """A table written as CSV and read back with one type overridden."""
    path = scratch_path(spark, "seed")
    customers = bridge.table(spark, sf, "customer").select(F.col("c_nationkey").alias("n_nationkey"), "c_custkey")
    bridge.table(spark, sf, "nation").join(customers, "n_nationkey").write.option("header", True).csv(path)
    seed = tables.seed_load(spark, path, {"n_regionkey": "string", "c_custkey": "bigint"})
    return seed.select("n_nationkey", "n_name", "n_regionkey", "c_custkey")


@query("table_write", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def _table_write(spark, sf):
    counted = bridge.table(spark, sf, "orders").groupBy("o_orderstatus").agg(F.count("*").alias("n"))
    return tables.table_write(counted, run_name("order_status_counts"), scratch_path(spark, "order_status_counts"))


@query("view_define", "SELECT c_mktsegment, round(sum(c_acctbal), 2) AS balance FROM customer GROUP BY 1")
def _view_define(spark, sf):
    tables.view_define(bridge.table(spark, sf, "customer"), "customers_view")
    return spark.sql("SELECT c_mktsegment, round(sum(c_acctbal), 2) AS balance FROM customers_view GROUP BY c_mktsegment")


@query("clustered_write", """
SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem
WHERE l_shipdate >= TIMESTAMP '1998-01-01' AND l_shipdate < TIMESTAMP '1998-02-01'""")
def _clustered_write(spark, sf):
    """Written in ship-date order, then read by ship date."""
    lines = bridge.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    stored = tables.clustered_write(lines, scratch_path(spark, "clustered"), ["l_shipdate"])
    return stored.filter("l_shipdate >= timestamp_ntz'1998-01-01' and l_shipdate < timestamp_ntz'1998-02-01'")


@query("find_tables", """
SELECT 'events_day_1' AS table_name, count(*) AS n FROM events WHERE ts < TIMESTAMP '2024-01-11'
UNION ALL SELECT 'events_day_2', count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-11' AND ts < TIMESTAMP '2024-01-21'
UNION ALL SELECT 'events_day_3', count(*) FROM events WHERE ts >= TIMESTAMP '2024-01-21'""")
def _find_tables(spark, sf):
    """Tables found by prefix and put together again."""
    events_table = bridge.table(spark, sf, "events")
    cuts = ["2024-01-01", "2024-01-11", "2024-01-21", "2024-02-01"]
    for i, (lo, hi) in enumerate(zip(cuts, cuts[1:]), 1):
        part = events_table.filter(f"ts >= timestamp_ntz'{lo}' and ts < timestamp_ntz'{hi}'")
        tables.view_define(part, f"events_day_{i}")
    found = [r.table_name for r in tables.find_tables(spark, "EVENTS_day_", prefix=True).collect()]
    union = reshape.union_relations({n: spark.table(n) for n in sorted(found)}, source_column_name="table_name")
    return union.groupBy("table_name").agg(F.count("*").alias("n"))


@query("table_profile", """
SELECT 'orders' AS table_name, (SELECT count(*) FROM orders) AS row_count, ordinal, column_name, data_type
FROM (VALUES (1, 'o_orderkey', 'bigint'), (2, 'o_custkey', 'bigint'), (3, 'o_orderstatus', 'string'), (4, 'o_totalprice', 'double'),
             (5, 'o_orderdate', 'timestamp_ntz'), (6, 'o_orderpriority', 'string')) v(ordinal, column_name, data_type)""")
def _table_profile(spark, sf):
    return tables.table_profile(bridge.table(spark, sf, "orders"), "orders").drop("bytes", "last_modified")
