"""Data tests and monitors over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import gold, monitors, quality
from ..session import scratch_path
from . import bridge
from .bridge import AS_OF, with_tables
from .registry import query


def _ntz(text: str):
    return F.lit(text).cast("timestamp_ntz")


@query("test_unique", with_tables("bronze") + """
SELECT track_id AS unique_field, count(*) AS n_records FROM bronze WHERE track_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1""")
def _unique(spark, sf):
    return quality.unique(bridge.bronze(spark, sf), "track_id")


@query("test_not_null", with_tables("bronze") + "SELECT * EXCLUDE (ts) FROM bronze WHERE user_id IS NULL")
def _not_null(spark, sf):
    return quality.not_null(bridge.bronze(spark, sf), "user_id")


@query("test_accepted_values", """
SELECT event_type AS value_field, count(*) AS n_records FROM events WHERE event_type NOT IN ('click', 'view') GROUP BY 1""")
def _accepted_values(spark, sf):
    return quality.accepted_values(bridge.table(spark, sf, "events"), "event_type", ["click", "view"])


@query("test_not_accepted_values", """
SELECT DISTINCT o_orderstatus AS value_field FROM orders WHERE o_orderstatus IN ('P', 'X')""")
def _not_accepted_values(spark, sf):
    return quality.not_accepted_values(bridge.table(spark, sf, "orders"), "o_orderstatus", ["P", "X"])


@query("test_relationships", """
SELECT l_orderkey AS id FROM lineitem WHERE l_orderkey IS NOT NULL
AND NOT EXISTS (SELECT 1 FROM events WHERE event_id = l_orderkey)""")
def _relationships(spark, sf):
    """Lines whose order number is not that of an event."""
    return quality.relationships(bridge.table(spark, sf, "lineitem"), "l_orderkey", bridge.table(spark, sf, "events"), "event_id")


@query("anti_join_relationships", """
SELECT c_custkey AS id FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
UNION ALL SELECT o_custkey FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_acctbal > 0)""")
def _anti_join(spark, sf):
    customers, orders = bridge.table(spark, sf, "customer"), bridge.table(spark, sf, "orders")
    idle = quality.relationships(customers, "c_custkey", orders, "o_custkey")
    in_debt = quality.relationships(orders, "o_custkey", customers, "c_custkey", to_condition="c_acctbal > 0")
    return idle.unionAll(in_debt)


@query("test_relationships_where", """
SELECT o_custkey AS id FROM orders WHERE o_orderstatus = 'F'
AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_mktsegment <> 'BUILDING')""")
def _relationships_where(spark, sf):
    return quality.relationships(
        bridge.table(spark, sf, "orders"), "o_custkey", bridge.table(spark, sf, "customer"), "c_custkey",
        "o_orderstatus = 'F'", "c_mktsegment <> 'BUILDING'",
    )


@query("test_aggregated_not_null", with_tables("bronze") + """
SELECT 'event_id' AS column_name FROM bronze WHERE event_id IS NULL
UNION ALL SELECT 'user_id' FROM bronze WHERE user_id IS NULL
UNION ALL SELECT 'track_id' FROM bronze WHERE track_id IS NULL""")
def _aggregated_not_null(spark, sf):
    return quality.aggregated_not_null(bridge.bronze(spark, sf), ["event_id", "user_id", "track_id"])


_REPEATED = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS unique_field, count(*) AS n_records FROM orders"
    f" WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1"
    for c in ("o_orderkey", "o_custkey", "o_orderpriority")
)


@query("test_aggregated_unique", _REPEATED)
def _aggregated_unique(spark, sf):
    return quality.aggregated_unique(bridge.table(spark, sf, "orders"), ["o_orderkey", "o_custkey", "o_orderpriority"])


@query("aggregated_unique", f"SELECT column_name, count(*) AS repeated_values FROM ({_REPEATED}) GROUP BY 1")
def _aggregated_unique_counts(spark, sf):
    rows = quality.aggregated_unique(bridge.table(spark, sf, "orders"), ["o_orderkey", "o_custkey", "o_orderpriority"])
    return rows.groupBy("column_name").agg(F.count("*").alias("repeated_values"))


@query("test_accepted_range", with_tables("plays") + """
SELECT event_id, duration_ms FROM plays WHERE NOT (duration_ms >= 1) OR NOT (duration_ms <= 600000)""")
def _accepted_range(spark, sf):
    return quality.accepted_range(bridge.plays(spark, sf), "duration_ms", 1, 600_000).select("event_id", "duration_ms")


@query("test_at_least_one", """
SELECT o_custkey, count(CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey END) AS filler_column FROM orders
GROUP BY 1 HAVING count(CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderkey END) = 0""")
def _at_least_one(spark, sf):
    """Customers without any urgent order."""
    urgent = F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderkey")).alias("urgent_order")
    rows = bridge.table(spark, sf, "orders").select("o_custkey", urgent)
    return quality.at_least_one(rows, "urgent_order", ["o_custkey"])


@query("test_cardinality_equality", """
WITH a AS (SELECT o_custkey AS value_field, count(*) AS num_rows FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
b AS (SELECT o_custkey AS value_field, count(*) AS num_rows FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1)
(SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def _cardinality_equality(spark, sf):
    orders = bridge.table(spark, sf, "orders")
    done, open_ = orders.filter("o_orderstatus = 'F'"), orders.filter("o_orderstatus <> 'F'")
    return quality.cardinality_equality(done, "o_custkey", open_, "o_custkey")


_COUNTS = """
WITH a AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
b AS (SELECT o_custkey, count(*) AS n FROM orders WHERE o_orderstatus <> 'F' GROUP BY 1)
"""


@query("test_equal_rowcount", _COUNTS + """
SELECT a.o_custkey AS o_custkey_a, b.o_custkey AS o_custkey_b, a.n AS count_a, b.n AS count_b, abs(a.n - b.n) AS diff_count
FROM a FULL JOIN b ON a.o_custkey = b.o_custkey""")
def _equal_rowcount(spark, sf):
    orders = bridge.table(spark, sf, "orders")
    return quality.equal_rowcount(
        orders.filter("o_orderstatus = 'F'"), orders.filter("o_orderstatus <> 'F'"), ["o_custkey"]
    )


@query("full_join_counts", """
SELECT (SELECT count(*) FROM orders) AS count_a, (SELECT count(*) FROM lineitem) AS count_b,
       (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM orders) AS diff_count""")
def _full_join_counts(spark, sf):
    return quality.equal_rowcount(bridge.table(spark, sf, "orders"), bridge.table(spark, sf, "lineitem"))


@query("test_fewer_rows_than", _COUNTS + """
SELECT a.o_custkey AS o_custkey_a, b.o_custkey AS o_custkey_b, a.n AS count_our_model, b.n AS count_comparison_model,
       CAST(CASE WHEN a.n > b.n THEN a.n - b.n WHEN a.n = b.n THEN 1 ELSE 0 END AS BIGINT) AS row_count_delta
FROM a FULL JOIN b ON a.o_custkey = b.o_custkey""")
def _fewer_rows_than(spark, sf):
    orders = bridge.table(spark, sf, "orders")
    return quality.fewer_rows_than(
        orders.filter("o_orderstatus = 'F'"), orders.filter("o_orderstatus <> 'F'"), ["o_custkey"]
    )


@query("test_equality", """
WITH a AS (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A'),
b AS (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag <> 'A')
SELECT 'a_minus_b' AS which_diff, * FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
UNION ALL SELECT 'b_minus_a', * FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def _equality(spark, sf):
    lines = bridge.table(spark, sf, "lineitem")
    return quality.equality(
        lines.filter("l_returnflag = 'A'"), lines.filter("l_returnflag <> 'A'"), ["l_partkey", "l_suppkey"]
    )


@query("test_expression_is_true", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE NOT (l_extendedprice * (1 - l_discount) > 1000)""")
def _expression_is_true(spark, sf):
    bad = quality.expression_is_true(bridge.table(spark, sf, "lineitem"), "l_extendedprice * (1 - l_discount) > 1000")
    return bad.select("l_orderkey", "l_linenumber", "l_partkey")


_RANGES = """
WITH r AS (SELECT o_custkey AS partition_by_col, o_orderdate AS lower_bound, o_orderdate + INTERVAL 30 DAY AS upper_bound
           FROM orders),
w AS (SELECT *, lead(lower_bound) OVER (PARTITION BY partition_by_col ORDER BY lower_bound, upper_bound) AS next_lower_bound,
             lead(true) OVER (PARTITION BY partition_by_col ORDER BY lower_bound, upper_bound) IS NULL AS is_last
      FROM r)
"""


def _order_ranges(spark, sf):
    end = F.timestamp_add("DAY", F.lit(30), F.col("o_orderdate"))
    return bridge.table(spark, sf, "orders").select("o_custkey", "o_orderdate", end.alias("due"))


@query("test_mutually_exclusive_ranges", _RANGES + """
SELECT partition_by_col, lower_bound, upper_bound, next_lower_bound FROM w
WHERE NOT (coalesce(lower_bound < upper_bound, false) AND coalesce(upper_bound <= next_lower_bound, is_last, false))""")
def _mutually_exclusive_ranges(spark, sf):
    """Customers with a second order within 30 days."""
    return quality.mutually_exclusive_ranges(_order_ranges(spark, sf), "o_orderdate", "due", "o_custkey")


@query("range_overlap_window", _RANGES + """
, g AS (SELECT lower_bound, upper_bound, lead(lower_bound) OVER (ORDER BY lower_bound, upper_bound) AS next_lower_bound,
               lead(true) OVER (ORDER BY lower_bound, upper_bound) IS NULL AS is_last FROM r)
SELECT lower_bound, upper_bound, next_lower_bound FROM g
WHERE NOT (coalesce(lower_bound < upper_bound, false) AND coalesce(upper_bound = next_lower_bound, is_last, false))""")
def _range_overlap_window(spark, sf):
    """The same over the whole table as one group, no gaps allowed."""
    return quality.mutually_exclusive_ranges(_order_ranges(spark, sf), "o_orderdate", "due", gaps="not_allowed")


@query("test_not_constant", """
SELECT l_orderkey, count(DISTINCT l_returnflag) AS filler_column FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) = 1""")
def _not_constant(spark, sf):
    return quality.not_constant(bridge.table(spark, sf, "lineitem"), "l_returnflag", ["l_orderkey"])


@query("test_not_empty_string", """
SELECT trim(v) AS v FROM (SELECT CASE WHEN event_type = 'error' THEN '  ' ELSE event_type END AS v FROM events) WHERE trim(v) = ''""")
def _not_empty_string(spark, sf):
    rows = bridge.table(spark, sf, "events").select(
        F.when(F.col("event_type") == "error", "  ").otherwise(F.col("event_type")).alias("v")
    )
    return quality.not_empty_string(rows, "v")


@query("test_not_null_proportion", with_tables("bronze") + """
SELECT track_id, count(user_id) / count(*) AS not_null_proportion FROM bronze GROUP BY 1 HAVING count(user_id) / count(*) < 0.99""")
def _test_not_null_proportion(spark, sf):
    return quality.not_null_proportion(bridge.bronze(spark, sf), "user_id", 0.99, group_by=["track_id"])


@query("test_recency", with_tables("plays") + """
SELECT user_id, max(ts) AS most_recent, TIMESTAMP '2024-01-30 12:00:00' AS threshold FROM plays GROUP BY 1
HAVING max(ts) < TIMESTAMP '2024-01-30 12:00:00'""")
def _recency(spark, sf):
    return quality.recency(
        bridge.currently_playing(spark, sf), "detected_at", "hour", 12, _ntz(AS_OF), group_by=["user_id"]
    )


@query("test_sequential_values", """
SELECT * FROM (SELECT o_custkey, o_orderkey, lag(o_orderkey) OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS previous_o_orderkey
               FROM orders) WHERE NOT (o_orderkey = previous_o_orderkey + 1)""")
def _sequential_values(spark, sf):
    return quality.sequential_values(bridge.table(spark, sf, "orders"), "o_orderkey", group_by=["o_custkey"])


@query("sequential_lag", """
WITH d AS (SELECT DISTINCT date_trunc('hour', ts) AS hour FROM events)
SELECT * FROM (SELECT CAST(hour AS TIMESTAMP) AS hour, CAST(lag(hour) OVER (ORDER BY hour) AS TIMESTAMP) AS previous_hour FROM d)
WHERE NOT (hour = previous_hour + INTERVAL 2 HOUR)""")
def _sequential_lag(spark, sf):
    hours = bridge.table(spark, sf, "events").select(F.date_trunc("hour", "ts").cast("timestamp_ntz").alias("hour")).distinct()
    return quality.sequential_values(hours, "hour", 2, "hour")


@query("test_unique_combination", """
SELECT l_partkey, l_suppkey FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1""")
def _unique_combination(spark, sf):
    return quality.unique_combination(bridge.table(spark, sf, "lineitem"), ["l_partkey", "l_suppkey"])


@query("test_assert_equal", """
SELECT o_orderkey, o_orderstatus, l FROM orders JOIN (SELECT l_orderkey, min(l_linestatus) AS l FROM lineitem GROUP BY 1)
ON o_orderkey = l_orderkey WHERE o_orderstatus <> l""")
def _assert_equal(spark, sf):
    lines = bridge.table(spark, sf, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(
        F.min("l_linestatus").alias("l")
    )
    rows = bridge.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus").join(lines, "o_orderkey")
    return quality.assert_equal(rows, "o_orderstatus", "l")


@query("test_columns_match_set", """
SELECT 'o_comment' AS column_name, 'missing' AS problem, count(*) AS row_count FROM orders
UNION ALL SELECT 'o_orderpriority', 'unexpected', count(*) FROM orders""")
def _columns_match_set(spark, sf):
    """Columns that differ from the expected set, beside the number of rows concerned."""
    orders = bridge.table(spark, sf, "orders")
    expected = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_comment"]
    total = orders.agg(F.count("*")).scalar()
    return quality.columns_match_set(orders, expected).withColumn("row_count", total)


@query("contract_check", """
SELECT 'o_totalprice' AS column_name, 'decimal(18,2)' AS declared_type, 'double' AS actual_type, count(*) AS row_count FROM orders""")
def _contract_check(spark, sf):
    orders = bridge.table(spark, sf, "orders")
    declared = T.StructType([
        T.StructField(f.name, T.DecimalType(18, 2) if f.name == "o_totalprice" else f.dataType) for f in orders.schema.fields
    ])
    total = orders.agg(F.count("*")).scalar()
    return quality.contract_check(orders, declared).withColumn("row_count", total)


def _order_tests(spark, sf):
    orders, lines = bridge.table(spark, sf, "orders"), bridge.table(spark, sf, "lineitem")
    return [
        quality.DataTest("order_key_unique", quality.unique(orders, "o_orderkey")),
        quality.DataTest("customer_unique", quality.unique(orders, "o_custkey"), warn_if="> 10", error_if="> 1000000000"),
        quality.DataTest("status_known", quality.accepted_values(orders, "o_orderstatus", ["F", "O"]), error_if="> 0"),
        quality.DataTest(
            "fewer_orders_than_lines", quality.fewer_rows_than(orders, lines), quality.FEWER_ROWS_FAILURES
        ),
        quality.DataTest("same_rows", quality.equal_rowcount(orders, lines), quality.EQUAL_ROWCOUNT_FAILURES),
        quality.DataTest("same_customers", quality.equality(
            orders.filter("o_orderstatus = 'F'"), orders.filter("o_orderstatus <> 'F'"), ["o_custkey"]
        ), quality.EQUALITY_FAILURES),
    ]


_RUN_TESTS = """
WITH diff AS (
  SELECT 'a' AS side, * FROM (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus <> 'F')
  UNION ALL SELECT 'b', * FROM (SELECT o_custkey FROM orders WHERE o_orderstatus <> 'F' EXCEPT SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')),
counts AS (SELECT (SELECT count(*) FROM orders) AS o, (SELECT count(*) FROM lineitem) AS l),
f AS (
  SELECT 'order_key_unique' AS test_name, CAST((SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_orderkey HAVING count(*) > 1)) AS BIGINT) AS failures
  UNION ALL SELECT 'customer_unique', (SELECT count(*) FROM (SELECT 1 FROM orders GROUP BY o_custkey HAVING count(*) > 1))
  UNION ALL SELECT 'status_known', count(DISTINCT o_orderstatus) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
  UNION ALL SELECT 'fewer_orders_than_lines', CASE WHEN o > l THEN o - l WHEN o = l THEN 1 ELSE 0 END FROM counts
  UNION ALL SELECT 'same_rows', abs(o - l) FROM counts
  UNION ALL SELECT 'same_customers', count(*) + coalesce(abs(count(*) FILTER (side = 'a') - count(*) FILTER (side = 'b')), 0) FROM diff)
SELECT test_name, failures,
       CASE WHEN test_name = 'customer_unique' THEN failures > 10 ELSE failures <> 0 END AS should_warn,
       CASE WHEN test_name = 'customer_unique' THEN failures > 1000000000 ELSE failures <> 0 END AS should_error,
       CASE WHEN test_name <> 'customer_unique' AND failures <> 0 THEN 'fail' WHEN test_name = 'customer_unique' AND failures > 10 THEN 'warn'
            ELSE 'pass' END AS status FROM f"""


@query("run_tests", _RUN_TESTS)
def _run_tests(spark, sf):
    return quality.run_tests(_order_tests(spark, sf))


@query("run_tests_stored", _RUN_TESTS)
def _run_tests_stored(spark, sf):
    """Failing rows are written first and counted from what was written."""
    return quality.run_tests(_order_tests(spark, sf), scratch_path(spark, "failures"))


@query("aggregated_test_result", with_tables("bronze") + """
SELECT column_name, count(*) AS failures, true AS should_warn, true AS should_error FROM (
  SELECT 'event_id' AS column_name FROM bronze WHERE event_id IS NULL UNION ALL SELECT 'user_id' FROM bronze WHERE user_id IS NULL)
GROUP BY 1""")
def _aggregated_test_result(spark, sf):
    return quality.aggregated_test_result(quality.aggregated_not_null(bridge.bronze(spark, sf), ["event_id", "user_id"]))


@query("unit_diff", """
WITH a AS (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A'), b AS (SELECT l_partkey FROM lineitem WHERE l_returnflag <> 'A')
SELECT *, 'actual' AS actual_or_expected FROM (SELECT * FROM a EXCEPT ALL SELECT * FROM b)
UNION ALL SELECT *, 'expected' FROM (SELECT * FROM b EXCEPT ALL SELECT * FROM a)""")
def _unit_diff(spark, sf):
    lines = bridge.table(spark, sf, "lineitem")
    return quality.unit_diff(
        lines.filter("l_returnflag = 'A'").select("l_partkey"), lines.filter("l_returnflag <> 'A'").select("l_partkey")
    )


def _suite_sql(table: str, rules: dict, label: str = "") -> str:
    parts = [
        f"SELECT 'not_null_{c}' AS test_name, count(*) FILTER ({c} IS NULL) AS failures FROM {table}"
        for c in rules["not_null_columns"] if c != "processed_at"
    ]
    parts += [
        f"SELECT 'accepted_range_{c}', count(*) FILTER (NOT {c} >= {lo} OR NOT {c} <= {hi}) FROM {table}"
        for c, (lo, hi) in rules.get("ranges", {}).items()
    ]
    if "processed_at" in rules["not_null_columns"]:
        parts.append(f"SELECT 'not_null_processed_at', count(*) FILTER (false) FROM {table}")
    parts += [
        f"SELECT 'unique_{c}', (SELECT count(*) FROM (SELECT 1 FROM {table} WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1))"
        for c in rules.get("unique_columns", [])
    ]
    lead = f"'{label}' AS table_name, " if label else ""
    return f"SELECT {lead}*, CASE WHEN failures = 0 THEN 'pass' ELSE 'fail' END AS status FROM ({' UNION ALL '.join(parts)})"


@query("silver_test_suite", with_tables("silver") + _suite_sql("silver", quality.SILVER_RULES))
def _silver_test_suite(spark, sf):
    return quality.silver_test_suite(bridge.silver(spark, sf))


_GOLD_SQL = {"daily_user_stats": "daily", "top_tracks": "tracks", "top_artists": "artists", "device_usage": "devices"}


@query("gold_test_suite", with_tables(*_GOLD_SQL.values()) + " UNION ALL ".join(
    _suite_sql(t, quality.GOLD_RULES[n], n) for n, t in _GOLD_SQL.items()))
def _gold_test_suite(spark, sf):
    return quality.gold_test_suite(bridge.models(spark, sf).tables(*bridge.GOLD))


@query("monitor_row_retention", with_tables("silver") + """
SELECT 'row_retention' AS check_name, CAST(s AS DOUBLE) AS value, CAST(b * 0.95 AS DOUBLE) AS threshold, b > 0 AND s >= b * 0.95 AS passed
FROM (SELECT (SELECT count(*) FROM bronze) AS b, (SELECT count(*) FROM silver) AS s)""")
def _row_retention(spark, sf):
    return monitors.row_retention(bridge.bronze(spark, sf), bridge.silver(spark, sf))


@query("monitor_freshness", with_tables("silver") + """
SELECT 'freshness' AS check_name, round(age, 6) AS value, 24.0::DOUBLE AS threshold, age < 24 AS passed
FROM (SELECT floor(epoch(TIMESTAMP '2024-01-31 00:00:00' - max(played_at))) / 3600 AS age FROM silver)""")
def _freshness(spark, sf):
    return monitors.freshness(bridge.silver(spark, sf), AS_OF)


@query("source_freshness", with_tables("silver") + """
SELECT max(played_at) AS max_loaded_at, TIMESTAMP '2024-01-31 00:00:00' AS snapshotted_at FROM silver WHERE device_type = 'mobile'""")
def _source_freshness(spark, sf):
    return monitors.source_freshness(bridge.silver(spark, sf), "played_at", AS_OF, "device_type = 'mobile'")


@query("monitor_test_results", with_tables("silver") + f"""
SELECT 'test_results' AS check_name, CAST(count(*) FILTER (status = 'fail') AS DOUBLE) AS value, 0::DOUBLE AS threshold,
       count(*) FILTER (status = 'fail') = 0 AS passed
FROM ({_suite_sql("silver", quality.SILVER_RULES)})""")
def _test_results(spark, sf):
    results = quality.silver_test_suite(bridge.silver(spark, sf)).withColumn("executed_at", _ntz(AS_OF))
    return monitors.test_results(results)


@query("monitor_test_results_failing", with_tables("silver") + f"""
, doubled AS (SELECT * FROM silver UNION ALL SELECT * FROM silver WHERE device_type = 'tablet')
SELECT 'test_results' AS check_name, CAST(count(*) FILTER (status = 'fail') AS DOUBLE) AS value, 0::DOUBLE AS threshold,
       count(*) FILTER (status = 'fail') = 0 AS passed
FROM ({_suite_sql("doubled", quality.SILVER_RULES)})""")
def _test_results_failing(spark, sf):
    """A newest run of eleven results in which the unique event id fails, after an older run that passed."""
    silver = bridge.stored_silver(spark, sf)
    doubled = quality.silver_test_suite(silver.unionByName(silver.filter("device_type = 'tablet'")))
    older = quality.silver_test_suite(silver).withColumn("executed_at", _ntz("2024-01-30"))
    return monitors.test_results(doubled.withColumn("executed_at", _ntz(AS_OF)).unionByName(older))


_VOLUME = """
, daily AS (SELECT CAST(played_at AS DATE) AS day, count(*) AS n FROM silver WHERE played_at >= TIMESTAMP '2024-01-24' GROUP BY 1)"""


@query("monitor_event_volume", with_tables("silver") + _VOLUME + """
SELECT 'event_volume' AS check_name, CAST(latest AS DOUBLE) AS value, round(mean * 0.5::DOUBLE, 6) AS threshold,
       latest >= mean * 0.5::DOUBLE AS passed
FROM (SELECT arg_max(n, day) AS latest, CAST(sum(n) - arg_max(n, day) AS BIGINT) / (count(*) - 1) AS mean FROM daily)""")
def _event_volume(spark, sf):
    return monitors.event_volume(bridge.silver(spark, sf), AS_OF)


@query("monitor_event_volume_ratio", with_tables("silver") + """
, daily AS (SELECT CAST(played_at AS DATE) AS day, count(*) AS n FROM silver WHERE played_at >= TIMESTAMP '2024-01-23 23:00:00' GROUP BY 1)
SELECT max(n) FILTER (day = DATE '2024-01-30') AS today_count, round(avg(n) FILTER (day < DATE '2024-01-30'), 6) AS seven_day_avg,
       round(max(n) FILTER (day = DATE '2024-01-30') / avg(n) FILTER (day < DATE '2024-01-30'), 6) AS ratio,
       max(n) FILTER (day = DATE '2024-01-30') / avg(n) FILTER (day < DATE '2024-01-30') >= 0.5 AS passed FROM daily""")
def _event_volume_ratio(spark, sf):
    return monitors.event_volume_ratio(bridge.silver(spark, sf), "2024-01-30 23:00:00")


@query("monitor_gold_completeness", with_tables(*_GOLD_SQL.values()) + " UNION ALL ".join(
    f"SELECT '{n}_not_empty' AS check_name, CAST(count(*) AS DOUBLE) AS value, 1::DOUBLE AS threshold, count(*) > 0 AS passed FROM {t} "
    f"UNION ALL SELECT '{n}_current', 1, 1, true"
    for n, t in _GOLD_SQL.items()))
def _gold_completeness(spark, sf):
    """Of the stored tables, in the versions that the events call for."""
    stored = bridge.models(spark, sf)
    stored.build(*bridge.GOLD)
    return monitors.gold_completeness({name: stored.newest(name) for name in bridge.GOLD}, {name: stored.is_current(name) for name in bridge.GOLD})


def _runs(spark, sf):
    """Orders as a run log: one job per priority, run time from the price."""
    status = F.col("o_orderstatus")
    return bridge.table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("run_id"),
        F.col("o_orderpriority").alias("job"),
        F.when(F.col("o_totalprice") > 400000, "backfill").otherwise("scheduled").alias("run_type"),
        F.when(status == "F", "success").when(status == "P", "failed").otherwise("running").alias("state"),
        F.col("o_orderdate").alias("scheduled_at"),
        F.col("o_orderdate").alias("started_at"),
        F.when(status != "O", F.timestamp_add("SECOND", F.floor(F.col("o_totalprice") / 100), F.col("o_orderdate"))).alias("ended_at"),
    )


_RUN_LOG = """
WITH runs AS (SELECT o_orderkey AS run_id, o_orderpriority AS job, CASE WHEN o_totalprice > 400000 THEN 'backfill' ELSE 'scheduled' END AS run_type,
  CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'P' THEN 'failed' ELSE 'running' END AS state, o_orderdate AS scheduled_at,
  CASE WHEN o_orderstatus <> 'O' THEN floor(o_totalprice / 100) END AS seconds FROM orders)
"""


@query("run_history_health", _RUN_LOG + """
SELECT job, count(*) AS total_runs, round(count(*) FILTER (state = 'success') / count(*) * 100, 4) AS success_rate,
       max(scheduled_at) FILTER (state = 'success') AS last_success, max(scheduled_at) FILTER (state = 'failed') AS last_failure,
       round(avg(seconds / 60), 4) AS avg_minutes
FROM (SELECT *, row_number() OVER (PARTITION BY job ORDER BY scheduled_at DESC, run_id) AS rn FROM runs WHERE run_type <> 'backfill')
WHERE rn <= 10 GROUP BY 1""")
def _run_history_health(spark, sf):
    return monitors.run_history_health(_runs(spark, sf))


@query("monitoring_status", _RUN_LOG + """
SELECT count(*) AS total_checks, count(*) FILTER (state = 'success') AS passed, count(*) FILTER (state = 'failed') AS failed,
       max(scheduled_at) AS last_check FROM (SELECT * FROM runs ORDER BY scheduled_at DESC, run_id LIMIT 5)""")
def _monitoring_status(spark, sf):
    return monitors.monitoring_status(_runs(spark, sf))


@query("data_metrics", with_tables(*_GOLD_SQL.values()) + """
SELECT 'bronze_rows' AS metric, count(*) AS value FROM bronze UNION ALL SELECT 'silver_rows', count(*) FROM silver
UNION ALL SELECT 'events_last_24h', count(*) FROM silver WHERE played_at >= TIMESTAMP '2024-01-30 00:00:00' UNION ALL """
       + " UNION ALL ".join(f"SELECT '{n}_rows', count(*) FROM {t}" for n, t in _GOLD_SQL.items()))
def _data_metrics(spark, sf):
    stored = bridge.models(spark, sf)
    return monitors.data_metrics(bridge.bronze(spark, sf), stored.table("silver_plays"), stored.tables(*bridge.GOLD), AS_OF)


@query("system_health_rows", with_tables("cooc", "affinity", "playing") + """
SELECT 'Currently Playing' AS component, count(*) AS row_count, max(detected_at) AS last_updated FROM playing
UNION ALL SELECT 'Track Co-occurrence', count(*), NULL FROM cooc UNION ALL SELECT 'Artist Affinity', count(*), NULL FROM affinity""")
def _system_health_rows(spark, sf):
    newest = F.max("detected_at").alias("last_updated")
    never = F.max(F.lit(None).cast("timestamp_ntz")).alias("last_updated")
    cooc, liked = bridge.models(spark, sf).tables("track_cooccurrence", "artist_affinity").values()
    rows = [
        ("Currently Playing", bridge.currently_playing(spark, sf), newest),
        ("Track Co-occurrence", cooc, never),
        ("Artist Affinity", liked, never),
    ]
    parts = [
        df.agg(F.count("*").alias("row_count"), when).select(F.lit(name).alias("component"), "*") for name, df, when in rows
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@query("cross_layer_totals", with_tables("devices") + """
SELECT (SELECT count(*) FROM silver) AS silver_count, (SELECT CAST(sum(total_plays) AS BIGINT) FROM devices) AS gold_total_plays""")
def _cross_layer_totals(spark, sf):
    return monitors.cross_layer_totals(*bridge.models(spark, sf).tables("silver_plays", "device_usage").values())


@query("stored_models", with_tables("daily", "tracks", "artists", "devices", "recs", "scored") + " UNION ALL ".join(
    f"SELECT '{n}' AS model, true AS current, count(*) AS row_count FROM {t}"
    for n, t in {
        "silver_plays": "silver", **_GOLD_SQL, "track_cooccurrence": "cooc", "artist_affinity": "affinity", "scored_pairs": "scored",
        "track_recommendations": "recs", "landed_bronze": "bronze",
    }.items()))
def _stored_models(spark, sf):
    """Every table of the model graph after a build: current, and with the rows it must have."""
    stored = bridge.models(spark, sf)
    stored.build()
    return stored.status()


@query("stored_recommendations", with_tables("recs", "daily") + """
SELECT user_id, recommendations, mean_score, best_affinity, days
FROM (SELECT user_id, count(*) AS recommendations, round(avg(recommendation_score), 6) AS mean_score FROM recs GROUP BY 1)
JOIN (SELECT user_id, max(affinity_score) AS best_affinity FROM affinity GROUP BY 1) USING (user_id)
JOIN (SELECT user_id, count(*) AS days FROM daily GROUP BY 1) USING (user_id)""")
def _stored_recommendations(spark, sf):
    """Three stored tables read together: recommendations, affinity and daily statistics of each user."""
    recs, liked, daily = bridge.models(spark, sf).tables("track_recommendations", "artist_affinity", "daily_user_stats").values()
    best = liked.groupBy("user_id").agg(F.max("affinity_score").alias("best_affinity"))
    days = daily.groupBy("user_id").agg(F.count("*").alias("days"))
    per_user = recs.groupBy("user_id").agg(
        F.count("*").alias("recommendations"), F.round(F.avg("recommendation_score"), 6).alias("mean_score")
    )
    return per_user.join(best, "user_id").join(days, "user_id")
