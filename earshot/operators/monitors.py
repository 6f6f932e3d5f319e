"""Operational checks. Each gives one row: check, value, threshold, passed."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import dateadd


def _moment(as_of: str | None) -> Column:
    return (F.current_timestamp() if as_of is None else F.lit(as_of)).cast("timestamp_ntz")


def _verdict(df: DataFrame, check: str, value: Column, threshold: Column, passed: Column) -> DataFrame:
    return df.select(
        F.lit(check).alias("check_name"),
        value.cast("double").alias("value"),
        threshold.cast("double").alias("threshold"),
        passed.alias("passed"),
    )


def row_retention(bronze: DataFrame, silver: DataFrame, share: float = 0.95) -> DataFrame:
    """Silver keeps at least 95 % of bronze; an empty bronze fails."""
    kept = silver.agg(F.count("*").alias("n")).scalar()
    one = bronze.agg(F.count("*").alias("bronze")).withColumn("silver", kept)
    ok = (F.col("bronze") > 0) & (F.col("silver") >= F.col("bronze") * share)
    return _verdict(one, "row_retention", F.col("silver"), F.col("bronze") * share, ok)


def freshness(silver: DataFrame, as_of: str | None = None, max_hours: float = 24, ts: str = "played_at") -> DataFrame:
    """The newest play is less than 24 hours old; no play at all fails."""
    one = silver.agg(F.max(ts).alias("latest"))
    age = F.timestamp_diff("SECOND", F.col("latest"), _moment(as_of)) / 3600
    return _verdict(one, "freshness", F.round(age, 6), F.lit(max_hours), F.coalesce(age < max_hours, F.lit(False)))


def source_freshness(df: DataFrame, loaded_at: str, as_of: str | None = None, where: str | None = None) -> DataFrame:
    rows = df if where is None else df.filter(where)
    return rows.agg(F.max(loaded_at).alias("max_loaded_at")).withColumn("snapshotted_at", _moment(as_of))


def test_results(results: DataFrame, run: str = "executed_at", last: int | None = None) -> DataFrame:
    """No result of the newest run failed; its results share the largest ``run``. An empty log passes.

    With ``last`` only so many results, newest first, are judged instead.
    """
    if last is None:
        latest = results.filter(F.col(run) == results.agg(F.max(run)).scalar())
    else:
        latest = results.orderBy(F.col("executed_at").desc(), "test_name").limit(last)
    one = latest.agg(F.count_if(F.col("status") == "fail").alias("failed"))
    return _verdict(one, "test_results", F.col("failed"), F.lit(0), F.col("failed") == 0)


test_results.__test__ = False


def event_volume(silver: DataFrame, as_of: str | None = None, days: int = 7, share: float = 0.5) -> DataFrame:
    """The latest day has at least half the mean of the other days of the window; under two days is a skip."""
    since = F.to_date(dateadd("day", -days, _moment(as_of)))
    daily = (
        silver.filter(F.col("played_at") >= since.cast("timestamp_ntz"))
        .groupBy(F.to_date("played_at").alias("day"))
        .agg(F.count("*").alias("n"))
    )
    one = daily.agg(
        F.count("*").alias("days"), F.sum("n").alias("total"), F.max_by("n", "day").alias("latest")
    ).withColumn("mean", F.try_divide(F.col("total") - F.col("latest"), F.col("days") - 1))
    ok = F.when(F.col("days") < 2, F.lit(True)).otherwise(F.col("latest") >= F.col("mean") * share)
    return _verdict(one, "event_volume", F.col("latest"), F.round(F.col("mean") * share, 6), ok)


def event_volume_ratio(silver: DataFrame, as_of: str | None = None, days: int = 7, share: float = 0.5) -> DataFrame:
    """Variant: the day of ``as_of`` against the mean of the days before it."""
    now = _moment(as_of)
    today = F.to_date(now)
    daily = (
        silver.filter(F.col("played_at") >= dateadd("day", -days, now))
        .groupBy(F.to_date("played_at").alias("day"))
        .agg(F.count("*").alias("n"))
    )
    one = daily.agg(
        F.max(F.when(F.col("day") == today, F.col("n"))).alias("today_count"),
        F.avg(F.when(F.col("day") < today, F.col("n"))).alias("seven_day_avg"),
    )
    ratio = F.try_divide(F.col("today_count"), F.col("seven_day_avg"))
    return one.select(
        "today_count",
        F.round("seven_day_avg", 6).alias("seven_day_avg"),
        F.round(ratio, 6).alias("ratio"),
        (ratio >= share).alias("passed"),
    )


def gold_completeness(tables: Mapping[str, DataFrame | None], current: Mapping[str, bool] | None = None) -> DataFrame:
    """Every stored gold table has rows and, where ``current`` says so, is in the version of its inputs.

    A table that was never stored is None: it has no rows and is not current.
    """
    spark = SparkSession.active()
    rows = []
    for name, df in tables.items():
        counted = spark.range(1).select(F.lit(0).alias("n")) if df is None else df.agg(F.count("*").alias("n"))
        rows.append(_verdict(counted, f"{name}_not_empty", F.col("n"), F.lit(1), F.col("n") > 0))
        if current is not None:
            good = F.lit(bool(current.get(name)) and df is not None)
            rows.append(_verdict(spark.range(1), f"{name}_current", good.cast("int"), F.lit(1), good))
    return reduce(DataFrame.unionAll, rows)


def run_history_health(runs: DataFrame, last: int = 10) -> DataFrame:
    """Per job over its last runs (backfills aside): success rate, latest success and failure, mean minutes."""
    w = Window.partitionBy("job").orderBy(F.col("scheduled_at").desc(), F.col("started_at").desc(), F.col("run_id"))
    recent = (
        runs.filter(F.col("run_type") != "backfill").withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= last)
    )
    minutes = F.timestamp_diff("SECOND", F.col("started_at"), F.col("ended_at")) / 60
    good, bad = F.col("state") == "success", F.col("state") == "failed"
    return recent.groupBy("job").agg(
        F.count("*").alias("total_runs"),
        F.round(F.count_if(good) / F.count("*") * 100, 4).alias("success_rate"),
        F.max(F.when(good, F.col("scheduled_at"))).alias("last_success"),
        F.max(F.when(bad, F.col("scheduled_at"))).alias("last_failure"),
        F.round(F.avg(minutes), 4).alias("avg_minutes"),
    )


def monitoring_status(runs: DataFrame, last: int = 5) -> DataFrame:
    """Passed and failed among the latest runs of all jobs."""
    latest = runs.orderBy(F.col("scheduled_at").desc(), "run_id").limit(last)
    return latest.agg(
        F.count("*").alias("total_checks"),
        F.count_if(F.col("state") == "success").alias("passed"),
        F.count_if(F.col("state") == "failed").alias("failed"),
        F.max("scheduled_at").alias("last_check"),
    )


def data_metrics(bronze: DataFrame, silver: DataFrame, gold: Mapping[str, DataFrame], as_of: str | None = None) -> DataFrame:
    """Row counts of all layers and of the last 24 hours."""
    since = dateadd("hour", -24, _moment(as_of))
    rows = [
        bronze.agg(F.count("*").alias("value")).select(F.lit("bronze_rows").alias("metric"), "value"),
        silver.agg(
            F.count("*").alias("silver_rows"), F.count_if(F.col("played_at") >= since).alias("events_last_24h")
        ).unpivot([], ["silver_rows", "events_last_24h"], "metric", "value"),
    ]
    rows += [
        df.agg(F.count("*").alias("value")).select(F.lit(f"{name}_rows").alias("metric"), "value")
        for name, df in gold.items()
    ]
    return reduce(DataFrame.unionByName, rows)


def cross_layer_totals(silver: DataFrame, device_usage: DataFrame) -> DataFrame:
    """Silver rows beside the plays summed over devices."""
    total = device_usage.agg(F.sum("total_plays").alias("n")).scalar()
    return silver.agg(F.count("*").alias("silver_count")).withColumn("gold_total_plays", total)
