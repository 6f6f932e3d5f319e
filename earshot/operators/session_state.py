"""Sessions kept up to date load by load, instead of found again over all plays.

A play that comes late can lengthen a session, close the gap between two or
open one of its own; it never splits one. So the sessions themselves are all
that has to be kept: one row each, with its first and last play. A load merges
its minutes with the sessions of the users it is about. Nobody's plays are read
again, and the folders of other users are not opened.

A load writes ``load=<number>/part=<hash of the user>`` for the parts it
touches; of each part the newest load counts. Running a load again reads what
was there before it and replaces what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.dates import datediff_boundary, trunc_to
from ..session import materialize
from .sessions import GAP_MINUTES

#: Folders that the users are dealt to.
PARTS = 64
_SPAN = "user_id string, session_start timestamp_ntz, session_end timestamp_ntz, plays long"


def _part(parts: int):
    return F.pmod(F.xxhash64("user_id"), F.lit(parts)).cast("int")


def _folders(spark: SparkSession, root: str, before: int | None = None) -> dict[int, tuple[int, str]]:
    """Newest load of each part (below ``before``) and its path; a load that did not end has no mark and does not count."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    newest: dict[int, tuple[int, str]] = {}
    for load in fs.listStatus(path) if fs.exists(path) else []:
        number = int(load.getPath().getName().partition("=")[2])
        if before is not None and number >= before or not fs.exists(spark._jvm.org.apache.hadoop.fs.Path(load.getPath(), "_SUCCESS")):
            continue
        for part in fs.listStatus(load.getPath()):
            name, _, value = part.getPath().getName().partition("=")
            if name == "part" and (int(value) not in newest or newest[int(value)][0] < number):
                newest[int(value)] = (number, part.getPath().toString())
    return newest


def _read(spark: SparkSession, folders: dict[int, tuple[int, str]]) -> DataFrame:
    paths = [path for _, path in folders.values()]
    return spark.read.schema(_SPAN).parquet(*paths) if paths else spark.createDataFrame([], _SPAN)


def merge_spans(spans: DataFrame, gap_minutes: int = GAP_MINUTES) -> DataFrame:
    """Spans of plays (``user_id, session_start, session_end, plays``) as sessions: those within the gap become one.

    Spans without a time are one row for each user, at the end.
    """
    w = Window.partitionBy("user_id").orderBy(F.col("session_start").asc_nulls_last(), "session_end")
    latest = F.max("session_end").over(w.rowsBetween(Window.unboundedPreceding, -1))
    opens = F.col("session_start").isNotNull() & F.coalesce(datediff_boundary("minute", latest, F.col("session_start")) > gap_minutes, F.lit(True))
    numbered = spans.withColumn("_opens", opens.cast("int")).withColumn("_no", F.sum("_opens").over(w))
    return numbered.groupBy("user_id", F.col("session_start").isNull().alias("_untimed"), "_no").agg(
        F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"), F.sum("plays").alias("plays")
    ).drop("_untimed", "_no")


def load_plays(
    spark: SparkSession, root: str, plays: DataFrame, load: int, gap_minutes: int = GAP_MINUTES, parts: int = PARTS, user: str = "user_id",
    ts: str = "played_at",
) -> list[int]:
    """Adds the plays of one load to the sessions below ``root``; returns the parts that were read and written.

    Loads have rising numbers, their plays may come in any order of time. A
    load without plays writes nothing. Users without an id are one user.
    """
    own = plays.select(F.col(user).cast("string").alias("user_id"), F.col(ts).cast("timestamp_ntz").alias("_at"))
    minutes = own.groupBy("user_id", trunc_to("minute", "_at").alias("_minute")).agg(
        F.min("_at").alias("session_start"), F.max("_at").alias("session_end"), F.count("*").alias("plays")
    )
    new = materialize(minutes.drop("_minute").withColumn("part", _part(parts)), "new_minutes")
    touched = sorted(row["part"] for row in new.select("part").distinct().collect())
    if not touched:
        return []
    kept = {part: found for part, found in _folders(spark, root, load).items() if part in set(touched)}
    old = _read(spark, kept)
    users = new.select(F.col("user_id").alias("_user")).distinct()
    same = F.col("user_id").eqNullSafe(F.col("_user"))
    changed = merge_spans(old.join(users, same, "left_semi").unionByName(new.drop("part")), gap_minutes)
    out = changed.unionByName(old.join(users, same, "left_anti")).withColumn("part", _part(parts))
    spread = out.hint("rebalance", "part").sortWithinPartitions("part", "user_id")
    spread.write.mode("overwrite").partitionBy("part").parquet(f"{root.rstrip('/')}/load={load:09d}")
    return touched


def stored_sessions(spark: SparkSession, root: str) -> DataFrame:
    """``user_id, session_id, session_start, session_end, plays`` after all loads, with the numbers that :func:`sessionize` gives.

    Numbers depend on all earlier sessions of a user, so they are not stored
    but counted over the sessions when these are read.
    """
    spans = _read(spark, _folders(spark, root))
    w = Window.partitionBy("user_id").orderBy(F.col("session_start").asc_nulls_last())
    steps = F.when(F.col("session_start").isNotNull(), 1).otherwise(F.col("plays") - F.when(F.row_number().over(w) == 1, 0).otherwise(1))
    numbered = spans.withColumn("_steps", steps).withColumn("session_id", F.sum("_steps").over(w))
    return numbered.groupBy("user_id", "session_id").agg(
        F.min("session_start").alias("session_start"), F.max("session_end").alias("session_end"), F.sum("plays").alias("plays")
    )


def prune_loads(spark: SparkSession, root: str) -> int:
    """Deletes the folders that newer loads have superseded; returns how many."""
    kept = {path for _, path in _folders(spark, root).values()}
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    gone = [
        part.getPath() for load in fs.listStatus(path) for part in fs.listStatus(load.getPath())
        if part.getPath().getName().startswith("part=") and part.getPath().toString() not in kept
    ]
    for part in gone:
        fs.delete(part, True)
    return len(gone)
