"""Play events from JSON: messages, API pages, playback states."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import event_id_uuid5
from ..schemas import PLAY_EVENT, PLAYBACK_STATE, RECENTLY_PLAYED_PAGE

CORRUPT = "_corrupt"


def kafka_json_source(
    spark: SparkSession, servers: str, topic: str, starting: str = "earliest", max_per_trigger: int | None = None
) -> DataFrame:
    """Streaming (key, value) text of a topic; needs the Kafka connector on the class path.

    Progress lives in the query's checkpoint, so no consumer group commits.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", starting)
    )
    if max_per_trigger is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().select(F.col("key").cast("string"), F.col("value").cast("string"))


def file_json_source(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same (value) text from files of JSON lines."""
    reader = spark.readStream.schema("value string").format("text")
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def _parsed(messages: DataFrame, value: str) -> DataFrame:
    """Every field read as text first, so that one odd number spoils a cell and not the message."""
    text_schema = T.StructType(
        [T.StructField(f.name, T.StringType()) for f in PLAY_EVENT.fields] + [T.StructField(CORRUPT, T.StringType())]
    )
    read = F.from_json(F.col(value), text_schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    return messages.withColumn("_event", read)


def parse_events(messages: DataFrame, value: str = "value") -> DataFrame:
    """JSON text to plays; malformed messages are left out, see :func:`dead_letters`."""
    rows = _parsed(messages, value).filter(F.col("_event").isNotNull() & F.col(f"_event.{CORRUPT}").isNull())
    return conform_schema(rows.select("_event.*").drop(CORRUPT), PLAY_EVENT)


def dead_letters(messages: DataFrame, value: str = "value") -> DataFrame:
    """The messages :func:`parse_events` leaves out, as they came."""
    rows = _parsed(messages, value)
    return rows.filter(F.col("_event").isNull() | F.col(f"_event.{CORRUPT}").isNotNull()).drop("_event")


def mark_dead(messages: DataFrame, value: str = "value") -> DataFrame:
    """The messages with ``dead``: whether :func:`parse_events` leaves them out. One scan serves both sides."""
    rows = _parsed(messages, value)
    return rows.withColumn("dead", F.col("_event").isNull() | F.col(f"_event.{CORRUPT}").isNotNull()).drop("_event")


def conform_schema(df: DataFrame, schema: T.StructType = PLAY_EVENT) -> DataFrame:
    """Exactly the columns of ``schema``: missing ones null, extra ones gone, bad cells null."""
    have = {c.lower(): c for c in df.columns}
    return df.select(
        *[
            (F.col(have[f.name.lower()]) if f.name.lower() in have else F.lit(None)).try_cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def produce_events(plays: DataFrame, key: str = "user_id") -> DataFrame:
    """(key, value) messages; one user's plays share a key and so a topic partition."""
    return plays.select(F.col(key).alias("key"), F.to_json(F.struct("*")).alias("value"))


def _first_artist(track: str) -> Column:
    return F.coalesce(F.try_element_at(F.col(f"{track}.artists"), F.lit(1))["name"], F.lit("Unknown"))


def flatten_recently_played(pages: DataFrame, value: str = "value", user: str = "user_id") -> DataFrame:
    """API pages (JSON text beside the user's id) to one play per item."""
    items = pages.select(
        user, F.explode(F.from_json(F.col(value), RECENTLY_PLAYED_PAGE)["items"]).alias("item")
    )
    track = F.col("item.track")
    return items.select(
        event_id_uuid5(user, track["id"], F.col("item.played_at")).alias("event_id"),
        F.col(user).alias("user_id"),
        F.lit("play").alias("event_type"),
        track["id"].alias("track_id"),
        track["name"].alias("track_name"),
        _first_artist("item.track").alias("artist_name"),
        track["album"]["name"].alias("album_name"),
        track["duration_ms"].alias("duration_ms"),
        F.col("item.played_at").alias("played_at"),
        F.coalesce(F.col("item.context.type"), F.lit("unknown")).alias("device_type"),
    )


def flatten_playback_state(states: DataFrame, value: str = "value", *keep: str) -> DataFrame:
    """Playback states (JSON text) to one flat row each; states without a track are dropped."""
    rows = states.select(*keep, F.from_json(F.col(value), PLAYBACK_STATE).alias("p")).filter(F.col("p.item").isNotNull())

    def field(path: str, default, name: str) -> Column:
        return F.coalesce(F.col(f"p.{path}"), F.lit(default)).alias(name)

    return rows.select(
        *keep,
        F.col("p.item.id").alias("track_id"),
        F.col("p.item.name").alias("track_name"),
        _first_artist("p.item").alias("artist_name"),
        field("item.album.name", "Unknown", "album_name"),
        field("is_playing", False, "is_playing"),
        field("progress_ms", 0, "progress_ms"),
        field("item.duration_ms", 0, "duration_ms").cast("int").alias("duration_ms"),
        field("device.type", "Unknown", "device_type"),
        field("device.name", "Unknown", "device_name"),
        field("shuffle_state", False, "shuffle_state"),
        field("repeat_state", "off", "repeat_state"),
        F.col("p.context.type").alias("context_type"),
        F.col("p.context.uri").alias("context_uri"),
    )
