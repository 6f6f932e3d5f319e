"""What Spark makes of the queries."""

import re

import pytest

import __spark_entry__ as entry_module

PLANS = entry_module.queries()


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df) -> str:
    df.collect()
    return plan(df)


@pytest.mark.parametrize(
    "name",
    ["track_cooccurrence", "track_recommendations", "device_usage", "artist_affinity", "sessionize", "monitor_row_retention",
     "full_join_counts", "order_line_pairs", "recommend_for_current", "incremental_merge", "snapshot_apply"],
)
def test_no_cross_joins(name, spark, sf):
    text = plan(PLANS[name](spark, sf))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["silver_plays", "deduplicate", "artist_affinity", "track_recommendations", "run_history_health"])
def test_groups_shrink_before_the_shuffle(name, spark, sf):
    """A filter on a rank drops rows in the map tasks already."""
    text = plan(PLANS[name](spark, sf))
    assert re.search(r"WindowGroupLimit .*Partial", text)


def test_filters_and_columns_reach_the_files(spark, sf):
    df = PLANS["where_subquery"](spark, sf)
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "EqualTo(l_returnflag,R)" in text and "GreaterThan(l_discount,0.05)" in text
    assert "l_extendedprice" not in text


def test_subquery_reuses_the_shuffle(spark, sf):
    assert "ReusedExchange" in final_plan(PLANS["device_usage"](spark, sf))
    assert "ReusedExchange" in final_plan(PLANS["artist_affinity"](spark, sf))


def test_session_items_read_plays_once(spark, sf):
    from earshot.operators.recommend import session_items
    from earshot.plans import bridge

    text = final_plan(session_items(bridge.silver(spark, sf), 1440))
    final = text.split("== Initial Plan ==")[0]
    assert final.count("FileScan") == 1 and "ReusedExchange" in final


def test_no_single_task_windows(spark, sf):
    """Ranks over a whole table go through ranges; the only global window is over one count per partition."""
    for name in ("top_tracks", "top_artists"):
        for line in plan(PLANS[name](spark, sf)).splitlines():
            if re.search(r"\bWindow \[.*\], \[\S* ?(ASC|DESC)", line) and "windowspecdefinition(_part" not in line:
                assert "_chunk" in line, line


def test_distinct_counts_do_not_multiply_rows(spark, sf):
    assert "Expand" not in plan(PLANS["daily_user_stats"](spark, sf))
    assert "Expand" not in plan(PLANS["dedup_verify"](spark, sf))


def test_one_scan_per_side(spark, sf):
    for name in ("test_equality", "unit_diff", "test_cardinality_equality"):
        assert plan(PLANS[name](spark, sf)).split("== Initial Plan ==")[0].count("FileScan") == 2


def test_counting_gold_tables_ranks_nothing(spark, sf):
    assert "rangepartitioning" not in plan(PLANS["monitor_gold_completeness"](spark, sf))


def test_neighbours_by_time_shuffle_rows_once(spark, sf):
    text = plan(PLANS["track_change_report"](spark, sf))
    assert "rangepartitioning" not in text
    full = [line for line in text.splitlines() if "Exchange hashpartitioning(_key" in line]
    assert len(full) == 2  # the rows, and one row per bucket


def test_lookups_read_the_stored_table_by_track(spark, sf):
    df = PLANS["recommend_for_track"](spark, sf)
    text = spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), "formatted")
    assert "EqualTo(track_a_id,track_26)" in text and "Exchange hash" not in text


def test_aggregates_run_compiled(spark, sf):
    text = final_plan(PLANS["dq_assessment"](spark, sf))
    assert re.search(r"\*\(\d+\) HashAggregate", text)
