"""Listening sessions: a new one starts after a gap of more than N minutes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import datediff_boundary, trunc_to
from .ordering import neighbours_in_buckets

GAP_MINUTES = 60


def session_minutes(
    rows: DataFrame,
    gap_minutes: int = GAP_MINUTES,
    user: str = "user_id",
    ts: str = "played_at",
    plays: Column | None = None,
) -> DataFrame:
    """(user, minute) to ``session_id``.

    Gaps count minute boundaries, so every play of one minute is in the same
    session and sessions can be found on distinct minutes alone. Those are
    pre-aggregated before the shuffle and a user has at most 525,600 of them a
    year, however many plays there are: the window below stays small even for
    a user with a third of all rows.

    Plays without a time come last. Each of them but the first starts a
    session (its predecessor has no time), and as ties they share the number
    of the last one. ``plays`` counts them where a row stands for several.
    """
    minutes = rows.groupBy(F.col(user).alias("user_id"), trunc_to("minute", ts).alias("minute")).agg(
        (F.count("*") if plays is None else plays).alias("_plays")
    )
    w = Window.partitionBy("user_id").orderBy(F.col("minute").asc_nulls_last())
    gap = datediff_boundary("minute", F.lag("minute").over(w), F.col("minute"))
    first = F.row_number().over(w) == 1
    starts = (
        F.when(F.col("minute").isNull(), F.col("_plays") - F.when(first, 0).otherwise(1))
        .when(first | (gap > gap_minutes), 1)
        .otherwise(0)
    )
    return minutes.withColumn("_starts", starts).select(
        "user_id", "minute", F.sum("_starts").over(w).alias("session_id")
    )


def sessionize(plays: DataFrame, gap_minutes: int = GAP_MINUTES, user: str = "user_id", ts: str = "played_at") -> DataFrame:
    """Plays plus ``session_id``, numbered per user from 1."""
    found = session_minutes(plays, gap_minutes, user, ts).select(
        F.col("user_id").alias("_user"), F.col("minute").alias("_minute"), "session_id"
    )
    here = F.col(user).eqNullSafe(F.col("_user")) & trunc_to("minute", ts).eqNullSafe(F.col("_minute"))
    return plays.join(found, here).select(*plays.columns, "session_id")


def clock_hour_sessions(plays: DataFrame, ts: str = "played_at") -> DataFrame:
    """Tumbling variant: the session is the clock hour."""
    return plays.withColumn("session_id", trunc_to("hour", ts))


def session_summary(sessionized: DataFrame, name_chars: int | None = None) -> DataFrame:
    """Size, start, end, length and track names per session.

    Names are made distinct before they meet, so the list holds each once;
    with ``name_chars`` only so many characters of them count.
    """
    name = F.col("track_name") if name_chars is None else F.left("track_name", F.lit(name_chars))
    per_name = sessionized.groupBy("user_id", "session_id", name.alias("_name")).agg(
        F.count("*").alias("_n"), F.min("played_at").alias("_lo"), F.max("played_at").alias("_hi")
    )
    return (
        per_name.groupBy("user_id", "session_id")
        .agg(
            F.sum("_n").alias("tracks_in_session"),
            F.min("_lo").alias("session_start"),
            F.max("_hi").alias("session_end"),
            F.array_join(F.array_sort(F.collect_list("_name")), " | ").alias("tracks_played"),
        )
        .withColumn("session_duration_minutes", datediff_boundary("minute", "session_start", "session_end"))
    )


def _before(rows: DataFrame, user: str, ts: str, tie: str, shifted: dict[str, Column]) -> DataFrame:
    """Values of the user's row before; hours cut a user of any size."""
    return neighbours_in_buckets(rows, [F.col(ts), F.col(tie)], F.date_trunc("hour", ts), shifted, [user])


def play_gaps(plays: DataFrame, user: str = "user_id", ts: str = "played_at", tie: str = "event_id") -> DataFrame:
    """Previous play of the user and the minutes since."""
    out = _before(plays, user, ts, tie, {"previous_play": F.col(ts)})
    return out.withColumn("minutes_since_last", datediff_boundary("minute", "previous_play", ts))


def track_change_report(detections: DataFrame, user: str = "user_id", ts: str = "detected_at") -> DataFrame:
    """Previous track and whether this detection differs from it.

    The first detection of a user has nothing to differ from: 'SAME TRACK'.
    """
    prev = {"previous_track_id": F.col("track_id"), "previous_track_name": F.col("track_name")}
    out = _before(detections, user, ts, "track_id", prev)
    changed = F.col("track_id") != F.col("previous_track_id")
    return out.withColumn("change_status", F.when(changed, "TRACK CHANGE").otherwise("SAME TRACK"))


def track_changes(detections: DataFrame, user: str = "user_id", ts: str = "detected_at") -> DataFrame:
    """Only the detections that start a track: the first, and each that differs from the one before."""
    out = _before(detections, user, ts, "track_id", {"_prev": F.col("track_id")})
    return out.filter(F.col("_prev").isNull() | (F.col("track_id") != F.col("_prev"))).drop("_prev")


def poll_latency(detections: DataFrame, user: str = "user_id", ts: str = "detected_at") -> DataFrame:
    """Seconds between detections of a user."""
    out = _before(detections, user, ts, "track_id", {"previous_detection": F.col(ts)})
    return out.withColumn("seconds_since_last", datediff_boundary("second", "previous_detection", ts))
