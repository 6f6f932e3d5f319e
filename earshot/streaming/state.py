"""Streams whose result is a table: track changes, retention by hours, refreshed totals.

Each micro-batch runs as an ordinary distributed job, so a user with a third
of its rows is spread like in batch. What a batch puts out goes to a folder
named after it; one that is run again after a failure replaces its own output.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators.incremental import overwrite_partitions
from ..operators.ordering import neighbours_in_buckets
from ..session import folder_names, materialize, remove_path

Step = Callable[[DataFrame | None, DataFrame], tuple[DataFrame, DataFrame | None]]


def run_with_keyed_state(
    rows: DataFrame, step: Step, root: str, checkpoint: str, keys: list[str], newest: list[str], every: str | None = None, compact: int = 20
) -> StreamingQuery:
    """``step(state, batch)`` gives the next state, one row per key, and the rows to put out.

    A batch costs what its own keys cost. It writes the state of its own keys to a folder of its own; a key's
    state is its row in the latest folder. ``step`` sees the state of the
    batch's keys only. Every ``compact`` batches one folder takes over the rows
    of all before it, so no more than that many are read. ``newest`` orders
    the rows of one key within a folder; the last counts.
    """
    spark = rows.sparkSession

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        state = None
        if batch_id:
            base = (batch_id - 1) // compact * compact
            folders = [f"{root}/state/batch={k}" for k in range(base, batch_id)]
            held = spark.read.option("basePath", f"{root}/state").parquet(*folders)
            latest = F.max_by(F.struct(*batch.columns), F.struct("batch", *newest))
            state = held.groupBy(*keys).agg(latest.alias("_row")).select("_row.*")
        touched = batch.select(*keys).distinct()
        next_state, out = step(state if state is None else state.join(touched, keys, "left_semi"), batch)
        if out is not None:
            out.write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")
        if state is not None and batch_id % compact == 0:
            next_state = next_state.unionByName(state.join(touched, keys, "left_anti"))
        next_state.write.mode("overwrite").parquet(f"{root}/state/batch={batch_id}")

    writer = rows.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


def track_change_step(user: str = "user_id", ts: str = "detected_at") -> Step:
    """Puts out a detection when its track differs from the user's previous one, or is the first.

    State is the last detection of each user.
    """

    def step(state: DataFrame | None, batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        fresh = batch.withColumn("_old", F.lit(0))
        known = fresh if state is None else fresh.unionByName(state.withColumn("_old", F.lit(1)))
        order = [-F.col("_old"), F.col(ts), F.col("track_id")]
        bucket = F.struct(-F.col("_old"), F.date_trunc("hour", ts))
        seen = neighbours_in_buckets(known, order, bucket, {"_prev": F.col("track_id")}, [user])
        new = seen.filter("_old = 0")
        changes = new.filter(F.col("_prev").isNull() | (F.col("track_id") != F.col("_prev")))
        last = F.max_by(F.struct(*batch.columns), F.struct(-F.col("_old"), ts, "track_id"))
        kept = known.groupBy(user).agg(last.alias("_last")).select("_last.*").select(*batch.columns)
        return kept, changes.drop("_prev", "_old")

    return step


def run_retention(rows: DataFrame, root: str, checkpoint: str, hours: int = 24, ts: str = "detected_at", every: str | None = None) -> StreamingQuery:
    """Keeps the rows of the last hours: a batch adds its rows to the folders of their hours, hours that are over go whole.

    Nothing that is stored is read or written again. A batch that is repeated
    replaces its own folders. Rows without a time are not kept.
    """
    spark = rows.sparkSession

    def on_batch(batch: DataFrame, batch_id: int) -> None:
        timed = batch.filter(F.col(ts).isNotNull()).withColumn("hour", F.date_format(ts, "yyyyMMddHH")).withColumn("batch", F.lit(batch_id))
        held = _hours(spark, root)
        if held:
            # An hour that ended before the last one began so many hours ago cannot come back.
            timed = timed.filter(F.col("hour") >= _oldest(held[-1], hours))
        overwrite_partitions(timed, root, ["hour", "batch"])
        held = _hours(spark, root)
        for hour in held:
            if hour < _oldest(held[-1], hours):
                remove_path(spark, f"{root}/hour={hour}")

    writer = rows.writeStream.foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


def retained(spark: SparkSession, schema: StructType, root: str, hours: int = 24, ts: str = "detected_at") -> DataFrame:
    """The rows kept by :func:`run_retention`, back from the newest; that one is looked for in the last hour's folder only."""
    held = _hours(spark, root)
    if not held:
        return spark.createDataFrame([], schema)
    stored = spark.read.schema(schema).option("basePath", root)
    newest = stored.parquet(f"{root}/hour={held[-1]}").agg(F.max(ts)).scalar()
    kept = stored.parquet(*[f"{root}/hour={h}" for h in held if h >= _oldest(held[-1], hours)])
    return kept.select(*schema.names).filter(F.col(ts) >= F.timestamp_add("HOUR", F.lit(-hours), newest))


def _oldest(newest: str, hours: int) -> str:
    """The first hour that may hold rows of the last ``hours``."""
    return (datetime.strptime(newest, "%Y%m%d%H") - timedelta(hours=hours)).strftime("%Y%m%d%H")


def _hours(spark: SparkSession, root: str) -> list[str]:
    return sorted(name.split("=", 1)[1] for name in folder_names(spark, root) if name.startswith("hour="))


def run_refresh(rows: DataFrame, keys: list[str], measures: list[Column], root: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Keeps totals per key up to date at the trigger's pace.

    The engine's own streaming aggregate holds them, and a batch writes the
    totals of the keys it has rows of to a folder of its own. A batch that is
    repeated writes the same totals again.
    """

    def on_batch(changed: DataFrame, batch_id: int) -> None:
        changed.write.mode("overwrite").parquet(f"{root}/batch={batch_id}")

    writer = rows.groupBy(*keys).agg(*measures).writeStream.outputMode("update").foreachBatch(on_batch).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


def refreshed(spark: SparkSession, root: str, keys: list[str]) -> DataFrame:
    """The totals of every key as the last batch that had rows of it left them."""
    written = spark.read.parquet(root)
    columns = [c for c in written.columns if c != "batch"]
    latest = F.max_by(F.struct(*columns), "batch").alias("_row")
    return written.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(latest).select("_row.*")


def prune_refreshed(spark: SparkSession, root: str, keys: list[str]) -> int:
    """Between two runs: puts all totals into one folder and removes the others; returns how many those are.

    The last batch keeps its folder, as the next run may repeat it.
    """
    held = sorted(int(name.split("=", 1)[1]) for name in folder_names(spark, root) if name.startswith("batch="))
    if len(held) < 3:
        return 0
    into, gone = held[-2], held[:-2]
    before = spark.read.option("basePath", root).parquet(*[f"{root}/batch={k}" for k in held[:-1]])
    columns = [c for c in before.columns if c != "batch"]
    latest = before.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(F.max_by(F.struct(*columns), "batch").alias("_row")).select("_row.*")
    # Read whole before its folder is replaced.
    materialize(latest, "totals").write.mode("overwrite").parquet(f"{root}/batch={into}")
    for batch in gone:
        remove_path(spark, f"{root}/batch={batch}")
    return len(gone)
