"""Row numbers and neighbours over a total order, without a single-task window.

``row_number() over (order by ...)`` and ``lag`` over one hot key both pull all
their rows into one task. Here the rows are range-partitioned on the order,
written to the shared folder, and numbered by adding each partition's offset to the place of the
row inside it. Only one count per partition meets in a single task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize

CHUNK_ROWS = 200_000
_ROW_BITS = 33  # monotonically_increasing_id: partition above, row below


def _break_ties(df: DataFrame, order: Sequence[Column]) -> tuple[DataFrame, list[Column]]:
    """A last order column that no two rows share.

    The rows are written first: an id given in flight could change when a
    task runs again, and rows would then be lost or doubled.
    """
    tied = materialize(df.withColumn("_tie", F.monotonically_increasing_id()), "tied")
    return tied, [*order, F.col("_tie").asc()]


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "rank", unique: bool = True) -> DataFrame:
    """Add ``name`` = 1, 2, 3, ... along ``order``.

    With ``unique`` the order tells all rows apart (up to few ties), so ranges
    come out even. Without, one value may be shared by very many rows: ties
    are then broken by an id, so that such a value spreads over many ranges.
    """
    columns = df.columns
    if not unique:
        df, order = _break_ties(df, order)
    spread = df.repartitionByRange(*order).sortWithinPartitions(*order)
    placed = materialize(spread.withColumn("_pos", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_pos", _ROW_BITS)
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count("*").alias("_rows"))
        .select("_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    )
    # One row per partition of `placed`: bounded by the shuffle width, so it may be broadcast.
    joined = placed.join(F.broadcast(offsets), part == F.col("_part"))
    row = F.col("_pos").bitwiseAND((1 << _ROW_BITS) - 1) + F.col("_offset") + 1
    return joined.select(*columns, row.alias(name))


def neighbours(
    df: DataFrame,
    order: Sequence[Column],
    shifted: dict[str, Column],
    group: Sequence[str] = (),
    offset: int = -1,
    unique: bool = True,
    chunk_rows: int = CHUNK_ROWS,
) -> DataFrame:
    """``lag`` (offset -1) or ``lead`` (offset 1) inside ``group`` along ``order``.

    ``shifted`` maps new column names to expressions read from the neighbour.
    Rows get a global number over (group, order) and are cut into chunks of
    ``chunk_rows``; the row at a chunk's edge is also given to the next chunk
    for reading. So a group of any size spreads over many tasks. ``unique`` as
    in :func:`global_rank`.
    """
    if offset not in (-1, 1):
        raise ValueError("offset must be -1 or 1")
    keys = [F.col(g).asc_nulls_first() for g in group]
    numbered = global_rank(df, [*keys, *order], "_no", unique)
    chunk = F.floor((F.col("_no") - 1) / chunk_rows)
    # The last row of a chunk serves the next one (lag), the first row the one before (lead).
    edge = (F.col("_no") if offset == -1 else F.col("_no") - 1) % chunk_rows == 0
    homes = F.when(edge, F.array(chunk, chunk - offset)).otherwise(F.array(chunk))
    spread = numbered.select("*", chunk.alias("_own"), F.explode(homes).alias("_chunk"))
    w = Window.partitionBy("_chunk").orderBy("_no")
    step = F.lag if offset == -1 else F.lead
    payload = F.struct(
        *[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)],
        *[expr.alias(name) for name, expr in shifted.items()],
    )
    seen = spread.withColumn("_seen", step(payload).over(w)).filter(F.col("_own") == F.col("_chunk"))
    same = F.col("_seen").isNotNull()
    for i, g in enumerate(group):
        same = same & F.col(g).eqNullSafe(F.col(f"_seen._g{i}"))
    return seen.select(*df.columns, *[F.when(same, F.col(f"_seen.{n}")).alias(n) for n in shifted])


def natural_bucket(df: DataFrame, column: str) -> Column | None:
    """Hours of a time, months of a date, runs of 4,096 of a whole number; None for a type without such steps."""
    kind = df.schema[column].dataType
    if isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
        return F.date_trunc("hour", column)
    if isinstance(kind, T.DateType):
        return F.date_trunc("month", column)
    return F.shiftright(F.col(column).cast("long"), 12) if isinstance(kind, T.IntegralType) else None


def neighbours_in_buckets(
    df: DataFrame, order: Sequence[Column], bucket: Column, shifted: dict[str, Column], group: Sequence[str] = (), offset: int = -1
) -> DataFrame:
    """``lag`` (offset -1) or ``lead`` (offset 1) inside ``group`` along rising ``order``, nulls last.

    ``bucket`` must rise with the order. Rows are shuffled once, by group and
    bucket, so a large group is cut by its buckets. What a bucket hands to the
    next one is one row, taken by an aggregate before its shuffle.
    """
    if offset not in (-1, 1):
        raise ValueError("offset must be -1 or 1")
    keyed = df.withColumn("_key", F.struct(*[F.col(g).alias(f"g{i}") for i, g in enumerate(group)], bucket.alias("bucket")))
    payload = F.struct(*[expr.alias(name) for name, expr in shifted.items()])
    inside = Window.partitionBy("_key").orderBy(*[c.asc_nulls_last() for c in order])
    seen = keyed.withColumn("_near", (F.lag if offset == -1 else F.lead)(payload).over(inside))
    place = F.struct(*[F.struct(c.isNull(), c) for c in order])
    edge = F.max_by(payload, place) if offset == -1 else F.min_by(payload, place)
    edges = keyed.groupBy("_key").agg(edge.alias("_edge"))
    along = Window.partitionBy(*[F.col(f"_key.g{i}") for i in range(len(group))]).orderBy(F.col("_key.bucket").asc_nulls_last())
    handed = edges.select("_key", (F.lag if offset == -1 else F.lead)("_edge").over(along).alias("_handed"))
    joined = seen.join(handed, "_key")
    found = F.coalesce("_near", "_handed")
    return joined.select(*df.columns, *[found.getField(name).alias(name) for name in shifted])
