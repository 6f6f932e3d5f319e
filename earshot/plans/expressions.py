"""Column functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import dates, nested, numeric, text
from ..operators import reshape
from . import bridge
from .bridge import with_tables
from .registry import query


@query("dateadd", """
SELECT o_orderkey, o_orderdate + INTERVAL 10 DAY AS plus_days, o_orderdate - INTERVAL 3 MONTH AS minus_months,
       o_orderdate + INTERVAL 90 MINUTE AS plus_minutes FROM orders""")
def _dateadd(spark, sf):
    return bridge.table(spark, sf, "orders").select(
        "o_orderkey",
        dates.dateadd("day", 10, "o_orderdate").alias("plus_days"),
        dates.dateadd("month", -3, "o_orderdate").alias("minus_months"),
        dates.dateadd("minute", 90, "o_orderdate").alias("plus_minutes"),
    )


def _boundaries(part: str, a: str, b: str) -> str:
    """DuckDB counts whole elapsed weeks, so weeks are compared by their Mondays."""
    if part == "week":
        return f"CAST(date_diff('day', date_trunc('week', {a}), date_trunc('week', {b})) // 7 AS BIGINT)"
    return f"date_diff('{part}', {a}, {b})"


_PARTS = ("second", "minute", "hour", "day", "week", "month", "quarter", "year")


@query("datediff_boundary", "WITH span AS (SELECT event_id, TIMESTAMP '2023-12-30 23:59:59.5' AS a, ts FROM events) SELECT event_id, "
       + ", ".join(f"{_boundaries(p, 'a', 'ts')} AS {p}s" for p in _PARTS) + " FROM span")
def _datediff_boundary(spark, sf):
    start = F.lit("2023-12-30 23:59:59.5").cast("timestamp_ntz")
    return bridge.table(spark, sf, "events").select(
        "event_id", *[dates.datediff_boundary(p, start, F.col("ts")).alias(f"{p}s") for p in _PARTS]
    )


@query("date_trunc", "SELECT event_id, "
       + ", ".join(f"CAST(date_trunc('{p}', ts) AS TIMESTAMP) AS to_{p}" for p in _PARTS) + " FROM events")
def _date_trunc(spark, sf):
    return bridge.table(spark, sf, "events").select(
        "event_id", *[dates.trunc_to(p, "ts").alias(f"to_{p}") for p in _PARTS]
    )


@query("last_day", """
SELECT o_orderkey, last_day(o_orderdate) AS month_end,
       CAST(date_trunc('quarter', o_orderdate) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end,
       CAST(date_trunc('year', o_orderdate) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS year_end FROM orders""")
def _last_day(spark, sf):
    ends = {"month": "month_end", "quarter": "quarter_end", "year": "year_end"}
    return bridge.table(spark, sf, "orders").select(
        "o_orderkey", *[dates.last_day_of(p, "o_orderdate").alias(n) for p, n in ends.items()]
    )


@query("make_date", """
SELECT o_orderkey, make_date(year(o_orderdate), month(o_orderdate), 1) AS month_start FROM orders""")
def _make_date(spark, sf):
    return bridge.table(spark, sf, "orders").select(
        "o_orderkey", dates.make_date(F.year("o_orderdate"), F.month("o_orderdate"), 1).alias("month_start")
    )


@query("to_date_part", "SELECT event_id, CAST(ts AS DATE) AS day FROM events")
def _to_date_part(spark, sf):
    return bridge.table(spark, sf, "events").select("event_id", F.to_date("ts").alias("day"))


@query("date_spine", """
WITH b AS (SELECT date_trunc('day', min(ts)) AS lo, date_trunc('day', max(ts)) AS hi FROM events)
SELECT CAST(d.day AS TIMESTAMP) AS date_day, count(event_id) AS events
FROM (SELECT unnest(generate_series(lo, hi - INTERVAL 1 DAY, INTERVAL 1 DAY)) AS day FROM b) d
LEFT JOIN events e ON date_trunc('day', e.ts) = d.day GROUP BY 1""")
def _date_spine(spark, sf):
    """Events per day of the whole range, days without any included."""
    events = bridge.table(spark, sf, "events")
    bounds = events.agg(dates.trunc_to("day", F.min("ts")).alias("lo"), dates.trunc_to("day", F.max("ts")).alias("hi"))
    daily = events.groupBy(dates.trunc_to("day", "ts").alias("date_day")).agg(F.count("*").alias("n"))
    spine = dates.date_spine(bounds, "day", "lo", "hi")
    return spine.join(daily, "date_day", "left").select("date_day", F.coalesce("n", F.lit(0)).alias("events"))


@query("date_spine_per_customer", """
WITH b AS (SELECT o_custkey, min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders GROUP BY 1)
SELECT o_custkey, unnest(generate_series(date_trunc('month', lo), date_trunc('month', hi) - INTERVAL 1 MONTH, INTERVAL 1 MONTH)) AS date_month
FROM b""")
def _date_spine_per_customer(spark, sf):
    months = bridge.table(spark, sf, "orders").groupBy("o_custkey").agg(
        dates.trunc_to("month", F.min("o_orderdate")).alias("lo"), dates.trunc_to("month", F.max("o_orderdate")).alias("hi")
    )
    return dates.date_spine(months, "month", "lo", "hi")


@query("intervals_between", f"""
SELECT o_custkey, {_boundaries('week', 'min(o_orderdate)', 'max(o_orderdate)')} AS weeks FROM orders GROUP BY 1""")
def _intervals_between(spark, sf):
    return bridge.table(spark, sf, "orders").groupBy("o_custkey").agg(
        dates.intervals_between("week", F.min("o_orderdate"), F.max("o_orderdate")).alias("weeks")
    )


@query("generate_series", """
WITH n AS (SELECT count(*) AS upper FROM customer)
SELECT CAST(s.i AS BIGINT) AS generated_number, c.c_mktsegment
FROM (SELECT unnest(generate_series(1, upper)) AS i FROM n) s LEFT JOIN customer c ON c.c_custkey = s.i""")
def _generate_series(spark, sf):
    """1..number of customers, matched with the customers that exist."""
    customers = bridge.table(spark, sf, "customer")
    numbers = dates.generate_series(spark, customers.count())
    keyed = customers.select(F.col("c_custkey").alias("generated_number"), "c_mktsegment")
    return numbers.join(keyed, "generated_number", "left")


@query("dates_in_range", """
SELECT strftime(CAST(o_orderdate AS DATE), '%Y%m%d') AS day, count(*) AS orders FROM orders
WHERE o_orderdate BETWEEN TIMESTAMP '1997-01-15' AND TIMESTAMP '1997-03-15' GROUP BY 1""")
def _dates_in_range(spark, sf):
    """Orders of every day in an inclusive range given as two formatted dates."""
    days = bridge.table(spark, sf, "orders").filter(dates.within_days("o_orderdate", "19970115,19970315"))
    return days.groupBy(F.date_format("o_orderdate", "yyyyMMdd").alias("day")).agg(F.count("*").alias("orders"))


@query("parse_iso_ts", with_tables("plays") + "SELECT event_id, ts AS played FROM plays")
def _parse_iso_ts(spark, sf):
    return bridge.plays(spark, sf).select("event_id", dates.parse_iso_ts("played_at").cast("timestamp_ntz").alias("played"))


@query("try_cast_ts", with_tables("plays") + """
SELECT event_id, ts AS good, CAST(NULL AS TIMESTAMP) AS bad FROM plays""")
def _try_cast_ts(spark, sf):
    return bridge.plays(spark, sf).select(
        "event_id", dates.try_cast_ts("played_at").alias("good"), dates.try_cast_ts("track_name").alias("bad")
    )


@query("utc_now", with_tables("plays") + """
SELECT event_id, date_diff('hour', ts, TIMESTAMP '2024-01-31 00:00:00') AS hours_ago FROM plays""")
def _utc_now(spark, sf):
    now = dates.utc_now(bridge.AS_OF).cast("timestamp_ntz")
    played = dates.try_cast_ts("played_at")
    return bridge.plays(spark, sf).select("event_id", dates.datediff_boundary("hour", played, now).alias("hours_ago"))


@query("string_functions", """
SELECT c_custkey, c_name || '/' || c_mktsegment AS joined, length(c_name) AS len, replace(c_name, '#', '-') AS replaced,
       instr(c_name, '#') AS hash_at, right(c_name, 4) AS tail, '' AS nothing, 'x' AS literal FROM customer""".replace(
    "length(c_name)", "CAST(length(c_name) AS INTEGER)").replace("instr(c_name, '#')", "CAST(instr(c_name, '#') AS INTEGER)"))
def _string_functions(spark, sf):
    return bridge.table(spark, sf, "customer").select(
        "c_custkey",
        text.concat("c_name", F.lit("/"), "c_mktsegment").alias("joined"),
        F.length("c_name").alias("len"),
        F.replace("c_name", F.lit("#"), F.lit("-")).alias("replaced"),
        text.position("#", "c_name").alias("hash_at"),
        text.right("c_name", 4).alias("tail"),
        text.right("c_name", 0).alias("nothing"),
        F.lit("x").alias("literal"),
    )


@query("split_part", """
SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS first, split_part(o_orderpriority, '-', -1) AS last,
       split_part(o_orderpriority, '-', 9) AS past FROM orders""")
def _split_part(spark, sf):
    return bridge.table(spark, sf, "orders").select(
        "o_orderkey",
        *[text.split_part("o_orderpriority", "-", n).alias(a) for n, a in ((1, "first"), (-1, "last"), (9, "past"))],
    )


@query("listagg_left", """
SELECT c_nationkey, string_agg(DISTINCT left(c_mktsegment, 5), ', ' ORDER BY left(c_mktsegment, 5)) AS segments
FROM customer GROUP BY 1""")
def _listagg_left(spark, sf):
    start = F.left("c_mktsegment", F.lit(5))
    return reshape.listagg_in_pieces(bridge.table(spark, sf, "customer"), ["c_nationkey"], start, ", ", distinct=True, name="segments")


@query("slugify", """
SELECT o_orderkey, regexp_replace(regexp_replace(regexp_replace(lower(o_orderpriority), '[ -]+', '_', 'g'),
       '[^a-z0-9_]+', '', 'g'), '^([0-9])', '_\\1') AS slug FROM orders""")
def _slugify(spark, sf):
    return bridge.table(spark, sf, "orders").select("o_orderkey", text.slugify("o_orderpriority").alias("slug"))


_BARE = "replace(replace(url, 'http://', ''), 'https://', '')"


@query("get_url_host", """
SELECT page_id, regexp_extract(url, '^(?:android-app://|https?://)*([^/?]*)', 1) AS host FROM pages""")
def _get_url_host(spark, sf):
    return bridge.table(spark, sf, "pages").select("page_id", text.get_url_host("url").alias("host"))


@query("get_url_path", """
WITH bare AS (SELECT page_id, regexp_replace(url, 'https?://', '', 'g') AS u FROM pages),
cut AS (SELECT page_id, u, list_position(string_split(u, ''), '/') AS slash FROM bare)
SELECT page_id, CASE WHEN slash IS NOT NULL AND slash > 0 THEN string_split(substring(u, slash + 1), '?')[1]
                     WHEN contains(u, '?') THEN '' ELSE u END AS path FROM cut""")
def _get_url_path(spark, sf):
    return bridge.table(spark, sf, "pages").select("page_id", text.get_url_path("url").alias("path"))


@query("get_url_parameter", """
SELECT page_id, nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') AS page,
       nullif(split_part(split_part(url, 'ref=', 2), '&', 1), '') AS ref FROM pages""")
def _get_url_parameter(spark, sf):
    return bridge.table(spark, sf, "pages").select(
        "page_id", text.get_url_parameter("url", "page").alias("page"), text.get_url_parameter("url", "ref").alias("ref")
    )


@query("hash_md5", "SELECT doc_id, md5(text) AS text_hash, md5(CAST(n_chars AS VARCHAR)) AS length_hash FROM documents")
def _hash_md5(spark, sf):
    return bridge.table(spark, sf, "documents").select(
        "doc_id", text.hash_md5("text").alias("text_hash"), text.hash_md5("n_chars").alias("length_hash")
    )


@query("generate_surrogate_key", with_tables("bronze") + f"""
SELECT track_id, played_at, md5(coalesce(event_id, '{text.SURROGATE_NULL}') || '-' || coalesce(user_id, '{text.SURROGATE_NULL}')
       || '-' || CAST(duration_ms AS VARCHAR)) AS surrogate_key,
       md5(coalesce(event_id, '') || '-' || coalesce(user_id, '')) AS nulls_as_empty FROM bronze""")
def _generate_surrogate_key(spark, sf):
    return bridge.bronze(spark, sf).select(
        "track_id",
        "played_at",
        text.generate_surrogate_key(["event_id", "user_id", "duration_ms"]).alias("surrogate_key"),
        text.generate_surrogate_key(["event_id", "user_id"], nulls_as_empty=True).alias("nulls_as_empty"),
    )


@query("snapshot_hash", with_tables("bronze") + """
SELECT track_id, played_at, md5(coalesce(event_id, '') || '|' || coalesce(user_id, '')) AS version_id FROM bronze""")
def _snapshot_hash(spark, sf):
    return bridge.bronze(spark, sf).select(
        "track_id", "played_at", text.snapshot_hash(["event_id", "user_id"]).alias("version_id")
    )


@query("track_id_hash", with_tables("plays") + """
SELECT event_id, 'track_' || substr(md5(lower(track_name || '_' || artist_name)), 1, 12) AS hashed_id FROM plays""")
def _track_id_hash(spark, sf):
    return bridge.plays(spark, sf).select("event_id", text.track_id_hash("track_name", "artist_name").alias("hashed_id"))


@query("event_id_uuid5", with_tables("plays") + """
, d AS (SELECT event_id, sha1(unhex('6ba7b8109dad11d180b400c04fd430c8')
               || encode(user_id || '_' || track_id || '_' || played_at)) AS h FROM plays)
SELECT event_id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-5' || substr(h, 14, 3) || '-'
       || substr('89ab', 1 + (instr('0123456789abcdef', substr(h, 17, 1)) - 1) % 4, 1) || substr(h, 18, 3) || '-'
       || substr(h, 21, 12) AS uuid FROM d""")
def _event_id_uuid5(spark, sf):
    return bridge.plays(spark, sf).select(
        "event_id", text.event_id_uuid5("user_id", "track_id", "played_at").alias("uuid")
    )


@query("safe_cast", """
SELECT o_orderkey, TRY_CAST(o_orderpriority AS INTEGER) AS no_number, TRY_CAST(left(o_orderpriority, 1) AS INTEGER) AS level
FROM orders""")
def _safe_cast(spark, sf):
    return bridge.table(spark, sf, "orders").select(
        "o_orderkey",
        numeric.safe_cast("o_orderpriority", "int").alias("no_number"),
        numeric.safe_cast(F.left("o_orderpriority", F.lit(1)), "int").alias("level"),
    )


@query("cast_bool_to_text", """
SELECT c_custkey, CAST(c_acctbal > 0 AS VARCHAR) AS in_credit, CAST(CAST(c_acctbal AS DECIMAL(18,1)) AS DOUBLE) AS balance FROM customer""")
def _cast_bool_to_text(spark, sf):
    return bridge.table(spark, sf, "customer").select(
        "c_custkey",
        numeric.cast_bool_to_text(F.col("c_acctbal") > 0).alias("in_credit"),
        F.col("c_acctbal").cast("decimal(18,1)").cast("double").alias("balance"),
    )


@query("equals_null_safe", with_tables("bronze") + """
SELECT count(*) FILTER (event_id IS NOT DISTINCT FROM user_id) AS same,
       count(*) FILTER (event_id IS DISTINCT FROM user_id) AS different FROM bronze""")
def _equals_null_safe(spark, sf):
    same = numeric.equals_null_safe("event_id", "user_id")
    return bridge.bronze(spark, sf).agg(F.count_if(same).alias("same"), F.count_if(~same).alias("different"))


_NUMBERS = ", n AS (SELECT played_at, track_id, event_id, TRY_CAST(event_id AS BIGINT) AS a, TRY_CAST(user_id AS BIGINT) AS b, duration_ms AS c FROM bronze)"


def _numbers(spark, sf):
    return bridge.bronze(spark, sf).select(
        "played_at", "track_id", "event_id",
        F.col("event_id").try_cast("long").alias("a"), F.col("user_id").try_cast("long").alias("b"),
        F.col("duration_ms").alias("c"),
    )


@query("safe_add", with_tables("bronze") + _NUMBERS + """
SELECT played_at, track_id, event_id, coalesce(a, 0) + coalesce(b, 0) + coalesce(c, 0) AS total FROM n""")
def _safe_add(spark, sf):
    return _numbers(spark, sf).select("played_at", "track_id", "event_id", numeric.safe_add(["a", "b", "c"]).alias("total"))


@query("safe_subtract", with_tables("bronze") + _NUMBERS + """
SELECT played_at, track_id, event_id, coalesce(c, 0) - coalesce(a, 0) - coalesce(b, 0) AS rest FROM n""")
def _safe_subtract(spark, sf):
    rest = numeric.safe_subtract(["c", "a", "b"]).alias("rest")
    return _numbers(spark, sf).select("played_at", "track_id", "event_id", rest)


@query("safe_divide", """
SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice / nullif(l_discount, 0), 4) AS ratio,
       round(l_tax / nullif(l_tax - l_tax, 0), 4) AS never FROM lineitem""")
def _safe_divide(spark, sf):
    return bridge.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.round(numeric.safe_divide("l_extendedprice", "l_discount"), 4).alias("ratio"),
        F.round(numeric.safe_divide("l_tax", F.col("l_tax") - F.col("l_tax")), 4).alias("never"),
    )


@query("width_bucket", """
SELECT p_partkey, CAST(CASE WHEN p_size < 10 THEN 0 WHEN p_size >= 40 THEN 7 ELSE floor((p_size - 10) / 5.0) + 1 END AS BIGINT)
       AS bucket FROM part""")
def _width_bucket(spark, sf):
    return bridge.table(spark, sf, "part").select("p_partkey", numeric.width_bucket("p_size", 10, 40, 6).alias("bucket"))


# The angle between the two points' unit vectors, from their cross product and dot product.
_HAVERSINE = """3961 * atan2(sqrt(power(y1 * z2 - z1 * y2, 2) + power(z1 * x2 - x1 * z2, 2) + power(x1 * y2 - y1 * x2, 2)),
x1 * x2 + y1 * y2 + z1 * z2)"""


@query("haversine_distance", f"""
WITH p AS (SELECT doc_id, n_chars % 90 AS lat1, n_chars % 180 AS lon1, -(doc_id % 90) AS lat2, doc_id % 180 AS lon2 FROM documents),
v AS (SELECT doc_id, cos(radians(lat1)) * cos(radians(lon1)) AS x1, cos(radians(lat1)) * sin(radians(lon1)) AS y1, sin(radians(lat1)) AS z1,
             cos(radians(lat2)) * cos(radians(lon2)) AS x2, cos(radians(lat2)) * sin(radians(lon2)) AS y2, sin(radians(lat2)) AS z2 FROM p)
SELECT doc_id, round({_HAVERSINE}, 4) AS miles, round({_HAVERSINE} * 1.60934, 4) AS km FROM v""")
def _haversine_distance(spark, sf):
    spots = [F.col("n_chars") % 90, F.col("n_chars") % 180, -(F.col("doc_id") % 90), F.col("doc_id") % 180]
    return bridge.table(spark, sf, "documents").select(
        "doc_id",
        F.round(numeric.haversine_distance(*spots), 4).alias("miles"),
        F.round(numeric.haversine_distance(*spots, unit="km"), 4).alias("km"),
    )


@query("degrees_to_radians", "SELECT p_partkey, round(acos(-1) * p_size / 180, 10) AS angle FROM part")
def _degrees_to_radians(spark, sf):
    return bridge.table(spark, sf, "part").select(
        "p_partkey", F.round(numeric.degrees_to_radians("p_size"), 10).alias("angle")
    )


@query("array_functions", """
SELECT n_nationkey, array_to_string([n_name, 'x'], ',') AS built, array_to_string(list_append([n_name, 'x'], 'y'), ',') AS appended,
       array_to_string(list_concat([n_name, 'x'], ['p', 'q']), ',') AS joined FROM nation""")
def _array_functions(spark, sf):
    built = nested.array_construct("n_name", F.lit("x"))
    return bridge.table(spark, sf, "nation").select(
        "n_nationkey",
        F.array_join(built, ",").alias("built"),
        F.array_join(nested.array_append(built, F.lit("y")), ",").alias("appended"),
        F.array_join(nested.array_concat(built, F.array(F.lit("p"), F.lit("q"))), ",").alias("joined"),
    )


@query("json_parse", "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events")
def _json_parse(spark, sf):
    schema = T.StructType([T.StructField("k", T.IntegerType())])
    return bridge.table(spark, sf, "events").select("event_id", nested.json_parse("props", schema)["k"].alias("k"))


@query("json_emit", """
SELECT event_id, '{"user_id":' || user_id || ',"event_type":"' || event_type || '"}' AS message FROM events""")
def _json_emit(spark, sf):
    return bridge.table(spark, sf, "events").select("event_id", nested.json_emit("user_id", "event_type").alias("message"))


@query("scalar_sql_function", """
SELECT l_orderkey, l_linenumber, l_partkey, round(l_extendedprice * (1 - l_discount), 4) AS net FROM lineitem""")
def _scalar_sql_function(spark, sf):
    """A named SQL function; Spark inlines its body into the plan."""
    spark.sql(
        "CREATE OR REPLACE TEMPORARY FUNCTION net_price(price DOUBLE, discount DOUBLE) RETURNS DOUBLE "
        "RETURN price * (1 - discount)"
    )
    return bridge.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey",
        F.round(F.expr("net_price(l_extendedprice, l_discount)"), 4).alias("net"),
    )
