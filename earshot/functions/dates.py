"""Date and time expressions."""

from __future__ import annotations

from datetime import date, datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

NTZ = "timestamp_ntz"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def dateadd(part: str, n: int | Column, ts: Column | str) -> Column:
    """``ts`` moved by ``n`` units of ``part``."""
    return F.timestamp_add(part.upper(), F.lit(n) if isinstance(n, int) else n, _col(ts))


def trunc_to(part: str, ts: Column | str) -> Column:
    """``ts`` cut down to ``part``; stays zone-less."""
    return F.date_trunc(part, _col(ts)).cast(NTZ)


def datediff_boundary(part: str, start: Column | str, end: Column | str) -> Column:
    """Number of ``part`` boundaries between two moments.

    10:59:59 to 11:00:00 is one minute and one hour apart here, whereas
    ``timestampdiff`` alone counts whole elapsed units and gives zero.
    """
    return F.timestamp_diff(part.upper(), trunc_to(part, start), trunc_to(part, end))


def last_day_of(part: str, ts: Column | str) -> Column:
    """Last date of the month, quarter, year or week that holds ``ts``."""
    next_start = F.timestamp_add(part.upper(), F.lit(1), trunc_to(part, ts))
    return F.date_sub(F.to_date(next_start), 1)


def parse_iso_ts(text: Column | str, fallback: Column | None = None) -> Column:
    """ISO text (``Z`` or offset) to a moment; bad text becomes ``fallback`` (default: now)."""
    parsed = F.try_to_timestamp(_col(text))
    return F.coalesce(parsed, F.current_timestamp() if fallback is None else fallback)


def try_cast_ts(text: Column | str) -> Column:
    """Text to a zone-less timestamp, null when it does not parse."""
    return _col(text).try_cast(NTZ)


def utc_now(as_of: str | None = None) -> Column:
    """Now in UTC, or the given fixed moment for reproducible runs."""
    if as_of is None:
        return F.to_utc_timestamp(F.current_timestamp(), F.current_timezone())
    return F.lit(as_of).cast("timestamp")


def intervals_between(part: str, start: Column | str, end: Column | str) -> Column:
    """How many steps of ``part`` a spine from start to end (excluded) has."""
    return datediff_boundary(part, start, end)


SPINE_RUN = 10_000


def date_spine(bounds: DataFrame, part: str, start: str, end: str, name: str | None = None) -> DataFrame:
    """One row per step from ``start`` up to, not including, ``end``.

    ``bounds`` holds the two moments as columns (one row, or one row per
    entity, whose other columns are kept).
    """
    begin, stop = trunc_to("second", start), trunc_to("second", end)
    name = name or f"date_{part}"
    keep = [c for c in bounds.columns if c not in (start, end)]
    steps = bounds.select(*keep, begin.alias("_begin"), intervals_between(part, begin, stop).cast("long").alias("_steps")).filter("_steps > 0")
    # Steps are counted out in runs, so that no array holds a long spine whole.
    runs = steps.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.greatest(F.col("_steps") - 1, F.lit(0).cast("long")), F.lit(SPINE_RUN).cast("long"))).alias("_run"))
    last = F.least(F.col("_run") + SPINE_RUN, F.col("_steps")) - 1
    each = runs.select(*keep, "_begin", F.explode(F.sequence("_run", last)).alias("_step"))
    return each.select(*keep, F.timestamp_add(part.upper(), F.col("_step"), F.col("_begin")).alias(name))


def generate_series(spark: SparkSession, upper: int) -> DataFrame:
    """1..upper as ``generated_number``, made in parallel by Spark's range source."""
    if upper <= 0:
        raise ValueError("upper bound must be positive")
    return spark.range(1, upper + 1).withColumnRenamed("id", "generated_number")


def dates_in_range(start: str, end: str | None = None, in_fmt: str = "%Y%m%d", out_fmt: str = "%Y%m%d") -> list[str]:
    """Every date from start to end, both included, as text."""
    first = datetime.strptime(start, in_fmt).date()
    last = datetime.strptime(end, in_fmt).date() if end else first
    if last < first:
        raise ValueError("end date lies before start date")
    return [(first + timedelta(days=i)).strftime(out_fmt) for i in range((last - first).days + 1)]


def partition_range(raw: str, fmt: str = "%Y%m%d") -> list[str]:
    """``"a"`` or ``"a,b"`` to the dates it covers."""
    parts = [p.strip() for p in raw.split(",")]
    if len(parts) > 2:
        raise ValueError("expected one date or two dates joined by a comma")
    return dates_in_range(parts[0], parts[-1], fmt, fmt)


def within_days(column: Column | str, raw: str, fmt: str = "%Y%m%d") -> Column:
    """Whether a time lies on the days of ``"a"`` or ``"a,b"``, as two comparisons that reach the files."""
    days = partition_range(raw, fmt)
    first = datetime.strptime(days[0], fmt)
    after = datetime.strptime(days[-1], fmt) + timedelta(days=1)
    moment = F.col(column) if isinstance(column, str) else column
    low, high = (F.lit(str(d)).cast("timestamp_ntz") for d in (first, after))
    return (moment >= low) & (moment < high)


def make_date(year: int | Column, month: int | Column, day: int | Column) -> Column:
    as_col = [F.lit(v) if isinstance(v, int) else v for v in (year, month, day)]
    return F.make_date(*as_col)


__all__ = [n for n in dir() if not n.startswith("_") and n not in ("date", "datetime", "timedelta")]
