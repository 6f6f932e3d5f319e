"""Counts, duplicates and ranges: the questions asked of a table before trusting it."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import datediff_boundary
from .silver import MAX_DURATION_MS


def having_duplicates(df: DataFrame, *keys: str, name: str = "occurrences") -> DataFrame:
    """Keys held by more than one row."""
    return df.groupBy(*keys).agg(F.count("*").alias(name)).filter(F.col(name) > 1)


def dq_assessment(plays: DataFrame) -> DataFrame:
    return plays.agg(
        F.count("*").alias("total_records"),
        F.count_if(F.col("user_id").isNull()).alias("null_user_ids"),
        F.count_if(F.col("duration_ms") <= 0).alias("invalid_durations"),
        F.count_if(F.col("duration_ms") > MAX_DURATION_MS).alias("suspiciously_long_tracks"),
    )


def dedup_verify(silver: DataFrame) -> DataFrame:
    """Rows against distinct ids and distinct plays; the same numbers when all is well.

    Distinct plays are counted over the columns, not over their joined text;
    like ids, those with a null do not count.
    """
    plays = silver.select("user_id", "track_id", "played_at").distinct().dropna()
    per_id = silver.groupBy("event_id").agg(F.count("*").alias("_n"))
    return per_id.agg(F.sum("_n").alias("total_records"), F.count("event_id").alias("unique_event_ids")).withColumn(
        "unique_plays", plays.agg(F.count("*")).scalar()
    )


def track_id_consistency(silver: DataFrame) -> DataFrame:
    return silver.groupBy("track_name").agg(
        F.countDistinct("track_id").alias("unique_ids"), F.count("*").alias("total_plays")
    )


def user_breakdown(silver: DataFrame) -> DataFrame:
    return silver.groupBy("user_id").agg(
        F.count("*").alias("play_count"), F.min("played_at").alias("first_play"), F.max("played_at").alias("last_play")
    )


def data_range_profile(silver: DataFrame, *by: str) -> DataFrame:
    return (
        silver.groupBy(*by)
        .agg(
            F.count("*").alias("total_plays"),
            F.countDistinct("track_id").alias("unique_tracks"),
            F.min("played_at").alias("earliest_play"),
            F.max("played_at").alias("latest_play"),
        )
        .withColumn("days_of_data", datediff_boundary("day", "earliest_play", "latest_play"))
    )


def processed_at_profile(silver: DataFrame) -> DataFrame:
    return silver.agg(
        F.min("processed_at").alias("earliest_processed"),
        F.max("processed_at").alias("latest_processed"),
        F.countDistinct("processed_at").alias("unique_timestamps"),
    )


def playback_state_summary(detections: DataFrame) -> DataFrame:
    return detections.groupBy("is_playing").agg(
        F.count("*").alias("detection_count"),
        F.min("detected_at").alias("first_detection"),
        F.max("detected_at").alias("last_detection"),
    )


def labelled_counts(tables: Mapping[str, DataFrame], label: str = "layer", *extra: Column) -> DataFrame:
    """One row per table: its name, its row count and any further aggregates."""
    rows = [df.agg(F.count("*").alias("row_count"), *extra).select(F.lit(n).alias(label), "*") for n, df in tables.items()]
    return reduce(DataFrame.unionByName, rows)


def model_stats(df: DataFrame, score: str) -> DataFrame:
    return df.agg(
        F.count("*").alias("total_rows"),
        F.countDistinct("user_id").alias("unique_users"),
        F.max(score).alias("max_score"),
        F.min(score).alias("min_score"),
    )


def overview(daily: DataFrame) -> DataFrame:
    """Totals of the daily table. Summing daily distinct counts counts a track once per user and day."""
    return daily.agg(
        F.sum("total_plays").alias("total_plays"),
        F.sum("unique_tracks").alias("unique_tracks"),
        F.sum("unique_artists").alias("unique_artists"),
        F.round(F.sum("total_listening_time_ms") / 1000 / 60, 6).alias("total_minutes"),
        F.min("date").alias("first_date"),
        F.max("date").alias("last_date"),
    )


def trends(daily: DataFrame) -> DataFrame:
    return daily.groupBy("date").agg(
        F.sum("total_plays").alias("total_plays"),
        F.round(F.sum("total_listening_time_ms") / 1000 / 60 / 60, 6).alias("listening_hours"),
    )


def pair_totals(pairs: DataFrame) -> DataFrame:
    """All pairs and the sessions that have any."""
    return pairs.agg(
        F.count("*").alias("total_pairs"), F.countDistinct("user_id", "session_id").alias("sessions_with_pairs")
    )


def top_k(df: DataFrame, k: int, *order: Column | str, columns: Sequence[str] | None = None) -> DataFrame:
    """First k rows along an order; Spark keeps only k per task."""
    out = df.orderBy(*order).limit(k)
    return out if columns is None else out.select(*columns)


def distinct_recent(df: DataFrame, keys: Sequence[str], ts: str, k: int, agg=F.max, name: str = "seen_at") -> DataFrame:
    """Distinct keys, those seen last first."""
    return df.groupBy(*keys).agg(agg(ts).alias(name)).orderBy(F.col(name).desc(), *keys).limit(k)
