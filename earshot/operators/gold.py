"""Aggregated tables over silver plays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.numeric import percent_of_total, whole_number
from .ordering import global_rank


def daily_user_stats(silver: DataFrame, with_minutes: bool = False) -> DataFrame:
    """Plays, listening time, distinct tracks and artists per user and day.

    Plays are summed per track first, which also bounds what a heavy user
    sends on; distinct names are then counted among the sums.
    """
    per_track = silver.groupBy(F.to_date("played_at").alias("date"), "user_id", "track_id", "artist_name").agg(
        F.count("*").alias("_n"), F.sum("duration_ms").alias("_ms")
    )
    # Each sum counts once with its track and once with its artist, so both kinds of name are made distinct together.
    track, artist = (F.struct(F.lit(k).alias("kind"), F.col(c).alias("name")) for k, c in (("t", "track_id"), ("a", "artist_name")))
    per_name = (
        per_track.select("date", "user_id", "_n", "_ms", F.inline(F.array(track, artist)))
        .groupBy("date", "user_id", "kind", "name")
        .agg(F.sum("_n").alias("_n"), F.sum("_ms").alias("_ms"))
    )
    by_track = F.col("kind") == "t"
    out = (
        per_name.groupBy("date", "user_id")
        .agg(
            F.sum(F.when(by_track, F.col("_n"))).alias("total_plays"),
            F.sum(F.when(by_track, F.col("_ms"))).alias("total_listening_time_ms"),
            F.count(F.when(by_track, F.col("name"))).alias("unique_tracks"),
            F.count(F.when(~by_track, F.col("name"))).alias("unique_artists"),
        )
        .withColumn(
            "avg_track_duration_ms",
            whole_number(F.col("total_listening_time_ms") / F.col("total_plays")),
        )
    )
    if with_minutes:
        out = out.withColumn("minutes_listened", F.col("total_listening_time_ms") / F.lit(60000.0))
    return out


def _play_totals(silver: DataFrame, *keys: str, extra=()) -> DataFrame:
    return silver.groupBy(*keys).agg(
        F.count("*").alias("total_plays"),
        F.sum("duration_ms").alias("total_listening_time_ms"),
        *extra,
        F.min("played_at").alias("first_played_at"),
        F.max("played_at").alias("last_played_at"),
    )


def _by_popularity(*ties: str):
    return [
        F.col("total_plays").desc(),
        F.col("total_listening_time_ms").desc(),
        *[F.col(t).asc_nulls_first() for t in ties],
    ]


def top_tracks(silver: DataFrame) -> DataFrame:
    """Every track with its totals and rank. A renamed track keeps one row per name."""
    keys = ("track_id", "track_name", "artist_name", "album_name")
    return global_rank(_play_totals(silver, *keys), _by_popularity(*keys))


def top_artists(silver: DataFrame) -> DataFrame:
    """Every artist with totals, distinct tracks and rank."""
    totals = _play_totals(silver, "artist_name", extra=[F.countDistinct("track_id").alias("unique_tracks")])
    return global_rank(totals, _by_popularity("artist_name"))


def device_usage(silver: DataFrame) -> DataFrame:
    """Totals per device and its share of all plays."""
    per_device = silver.groupBy("device_type").agg(
        F.count("*").alias("total_plays"),
        F.sum("duration_ms").alias("total_listening_time_ms"),
    )
    # Both sums are asked for so that the subquery needs the very same shuffle and Spark reuses it.
    overall = per_device.select(
        F.struct(F.sum("total_plays").alias("plays"), F.sum("total_listening_time_ms").alias("ms"))
    ).scalar()
    return per_device.select(
        "device_type",
        "total_plays",
        "total_listening_time_ms",
        percent_of_total("total_plays", overall.getField("plays")).alias("play_percentage"),
        whole_number(F.col("total_listening_time_ms") / F.col("total_plays")).alias("avg_track_duration_ms"),
    )


def track_popularity(silver: DataFrame) -> DataFrame:
    """Plays, distinct listeners and mean duration per track."""
    return silver.groupBy("track_id", "track_name", "artist_name").agg(
        F.count("*").alias("play_count"),
        F.countDistinct("user_id").alias("unique_listeners"),
        F.avg("duration_ms").alias("avg_duration_ms"),
    )
