"""Messages to bronze files, and what else is done to a stream of plays."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.dates import try_cast_ts
from ..schemas import PLAY_EVENT
from ..sources.events import dead_letters, parse_events
from ..sources.tables import HOUR_PARTITIONS, spread_by_hour, with_hour_partitions


def start_file_sink(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    partition_by: tuple[str, ...] = (),
    every: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Write a stream to Parquet, each row once. Without ``every`` it takes what is there and stops."""
    writer = rows.writeStream.format("parquet").outputMode(mode).option("checkpointLocation", checkpoint)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start(path)


def run_to_end(query: StreamingQuery) -> None:
    """Wait for a bounded run; raises what the query raised."""
    query.awaitTermination()


#: What a table of landed files tells of each.
LANDED_FILE = "file_path string, file_size long, landed_at timestamp, row_count long"


def register_files(
    spark: SparkSession, root: str, registry: str, checkpoint: str, every: str | None = None, files_per_batch: int | None = None
) -> StreamingQuery:
    """Adds the files that landed since the last run to a table of files, with their rows counted.

    The file stream's own log knows which files were taken, so a run lists the
    folder but opens new files only, and of these no column. Files are never
    changed once they have landed; one without rows is not listed. A repeated
    batch writes its own folder again. ``files_per_batch`` bounds a batch.
    """
    levels = T.StructType([T.StructField(p, T.StringType()) for p in HOUR_PARTITIONS])
    landed = (
        spark.readStream.schema(T.StructType(PLAY_EVENT.fields + levels.fields))
        .option("pathGlobFilter", "*.parquet")
        # Files that were copied with an old date count too.
        .option("maxFileAge", "36500d")
    )
    if files_per_batch is not None:
        landed = landed.option("maxFilesPerTrigger", files_per_batch)
    meta = {"file_path": "file_path", "file_size": "file_size", "file_modification_time": "landed_at"}
    files = landed.parquet(root).select(*[F.col(f"_metadata.{field}").alias(name) for field, name in meta.items()])

    def put(batch: DataFrame, number: int) -> None:
        counted = batch.groupBy(*meta.values()).agg(F.count("*").alias("row_count"))
        counted.write.mode("overwrite").parquet(f"{registry}/batch={number}")

    writer = files.writeStream.foreachBatch(put).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if every is None else writer.trigger(processingTime=every)
    return writer.start()


def registered_files(spark: SparkSession, registry: str) -> DataFrame:
    """The table of files that ``register_files`` keeps: path, bytes, time and rows of each."""
    return spark.read.schema(LANDED_FILE).parquet(f"{registry}/batch=*")


def stream_bronze_ingest(
    messages: DataFrame,
    root: str,
    checkpoint: str,
    every: str | None = "60 seconds",
    files_per_hour: int | None = None,
    tasks: int | None = None,
) -> StreamingQuery:
    """JSON messages to hourly bronze files, every row under the hour of its own time.

    By default Spark rebalances a batch over the hours by size, so the hour
    that holds nearly all of it is written by several tasks; ``files_per_hour``
    fixes the number of files instead.
    """
    rows = with_hour_partitions(parse_events(messages))
    rows = rows.hint("rebalance", *HOUR_PARTITIONS) if files_per_hour is None else spread_by_hour(rows, files_per_hour, tasks)
    return start_file_sink(rows, root, checkpoint, HOUR_PARTITIONS, every)


def stream_dead_letters(messages: DataFrame, path: str, checkpoint: str, every: str | None = "60 seconds") -> StreamingQuery:
    """The messages the ingest leaves out, kept for inspection."""
    return start_file_sink(dead_letters(messages), path, checkpoint, every=every)


def append_currently_playing(states: DataFrame, path: str, checkpoint: str, every: str | None = "5 seconds") -> StreamingQuery:
    """Append detections; a state without a time is stamped on arrival."""
    stamped = states.withColumn(
        "detected_at", F.coalesce("detected_at", F.current_timestamp().cast("timestamp_ntz"))
    )
    return start_file_sink(stamped, path, checkpoint, every=every)


def typed_time(plays: DataFrame) -> DataFrame:
    return plays.withColumn("event_time", try_cast_ts("played_at").cast("timestamp"))


def with_event_time(plays: DataFrame, late: str) -> DataFrame:
    """Typed event time with a watermark. Rows later than ``late`` are dropped by stateful steps."""
    return typed_time(plays).withWatermark("event_time", late)


def without_time(plays: DataFrame) -> DataFrame:
    """Plays whose time does not parse: windows would pass over them, so they go to the dead letters."""
    return plays.filter(try_cast_ts("played_at").isNull())


def stream_without_time(plays: DataFrame, path: str, checkpoint: str, every: str | None = "60 seconds") -> StreamingQuery:
    """The plays that steps on event time leave out, kept for inspection and counting."""
    return start_file_sink(without_time(plays), path, checkpoint, every=every)


def stream_dedup(plays: DataFrame, late: str = "1 day", keys: tuple[str, ...] = ("event_id",)) -> DataFrame:
    """Each event id once, as long as its repeats come within ``late``."""
    return with_event_time(plays, late).dropDuplicatesWithinWatermark(list(keys)).drop("event_time")


def stream_sessionize(plays: DataFrame, gap_minutes: int = 60, late: str = "1 day") -> DataFrame:
    """Sessions per user as the watermark closes them.

    Session windows merge when the gap equals their length, so on whole
    minutes they split exactly where more than ``gap_minutes`` boundaries lie
    between two plays, as the batch operator does.
    """
    minute = F.date_trunc("minute", "event_time")
    return (
        plays.withColumn("minute", minute)
        .withWatermark("minute", late)
        .groupBy("user_id", F.session_window("minute", f"{gap_minutes} minutes").alias("session"))
        .agg(
            F.count("*").alias("tracks_in_session"),
            F.min("event_time").alias("session_start"),
            F.max("event_time").alias("session_end"),
        )
        .drop("session")
    )


def stream_daily_counts(plays: DataFrame, late: str = "1 day") -> DataFrame:
    """Plays, listening time and distinct tracks per user and day, once a day is closed.

    Exact distinct counts come from a first aggregate per track, whose state
    is one row per (day, user, track).
    """
    per_track = (
        with_event_time(plays, late)
        .groupBy(F.window("event_time", "1 day"), "user_id", "track_id")
        .agg(F.count("*").alias("n"), F.sum("duration_ms").alias("ms"))
    )
    return (
        per_track.groupBy(F.window(F.window_time("window"), "1 day").alias("day"), "user_id")
        .agg(
            F.sum("n").alias("total_plays"),
            F.sum("ms").alias("total_listening_time_ms"),
            F.count("*").alias("unique_tracks"),
        )
        .select(F.to_date("day.start").alias("date"), "user_id", "total_plays", "total_listening_time_ms", "unique_tracks")
    )
