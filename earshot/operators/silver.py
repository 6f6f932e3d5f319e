"""Bronze to silver: type, filter, keep one row per play."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import try_cast_ts
from ..schemas import PLAY_EVENT

MAX_DURATION_MS = 600_000
PLAY_KEY = ("user_id", "track_id", "played_at")


def extract_plays(raw: DataFrame, value: str = "value") -> DataFrame:
    """Typed play columns out of one semi-structured (variant) column."""
    return raw.select(
        *[
            F.variant_get(F.col(value), f"$.{f.name}", f.dataType.simpleString()).alias(f.name)
            for f in PLAY_EVENT.fields
        ]
    )


def silver_filter(plays: DataFrame) -> DataFrame:
    """Rows with a user, an event id and a duration strictly between 0 and ten minutes."""
    return plays.filter(
        F.col("user_id").isNotNull()
        & F.col("event_id").isNotNull()
        & (F.col("duration_ms") > 0)
        & (F.col("duration_ms") < MAX_DURATION_MS)
    )


def dedup_first(plays: DataFrame, key=PLAY_KEY, order: Column | None = None) -> DataFrame:
    """One row per key, the one with the smallest event id.

    Spark drops all but the first row of each key before the shuffle
    (WindowGroupLimit), so a key with very many copies stays cheap. Only key
    and id are compared: columns a query does not use are neither read nor
    shuffled. Copies with the same id are one event delivered again.
    """
    w = Window.partitionBy(*key).orderBy(F.col("event_id").asc() if order is None else order)
    return plays.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def silver_plays(plays: DataFrame, as_of: str | None = None, distinct_rows: bool = False) -> DataFrame:
    """Clean plays. Duplicates are found on the raw time text, before it is typed.

    A time that does not parse becomes null and the row is kept.
    ``distinct_rows`` drops only fully equal rows.
    """
    stamp = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    named = plays.select(*PLAY_EVENT.fieldNames())
    kept = silver_filter(named)
    unique = kept.distinct() if distinct_rows else dedup_first(kept)
    return unique.withColumn("played_at", try_cast_ts("played_at")).withColumn("processed_at", stamp)
