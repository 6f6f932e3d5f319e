"""Column selection, pivoting, unions, set operations."""

from __future__ import annotations

import operator
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.nested import listagg
from ..functions.text import slugify_name

_COMPARE = {
    "=": operator.eq,
    "!=": operator.ne,
    "<>": operator.ne,
    "<": operator.lt,
    "<=": operator.le,
    ">": operator.gt,
    ">=": operator.ge,
}


def star_except(
    df: DataFrame, drop: Sequence[str] = (), alias: str | None = None, prefix: str = "", suffix: str = ""
) -> list[Column]:
    """All columns but ``drop`` (any case), renamed with prefix and suffix."""
    gone = {c.lower() for c in drop}
    source = (lambda c: F.col(f"{alias}.{c}")) if alias else F.col
    return [source(c).alias(prefix + c + suffix) for c in df.columns if c.lower() not in gone]


def nullcheck(df: DataFrame) -> list[Column]:
    """Columns with '' as null in text ones."""
    return [
        F.nullif(F.col(f.name), F.lit("")).alias(f.name) if isinstance(f.dataType, T.StringType) else F.col(f.name)
        for f in df.schema.fields
    ]


def nullcheck_table(df: DataFrame) -> DataFrame:
    return df.select(*nullcheck(df))


def empty_like(spark: SparkSession, shape: DataFrame | T.StructType) -> DataFrame:
    """No rows, the columns of a table or of a declared schema."""
    return shape.limit(0) if isinstance(shape, DataFrame) else spark.createDataFrame([], shape)


def pivot_columns(
    column: str,
    values: Sequence,
    agg: str = "sum",
    cmp: str = "=",
    prefix: str = "",
    suffix: str = "",
    then_value=1,
    else_value=0,
    quote_identifiers: bool = True,
    distinct: bool = False,
) -> list[Column]:
    """One conditional aggregate per value, for use in ``groupBy(...).agg(*...)``."""

    def operand(v) -> Column:
        return v if isinstance(v, Column) else F.lit(v)

    out = []
    for value in values:
        hit = _COMPARE[cmp](F.col(column), F.lit(value))
        case = F.when(hit, operand(then_value)).otherwise(operand(else_value))
        if distinct:
            total = {"count": F.count_distinct, "sum": F.sum_distinct}[agg](case)
        else:
            total = getattr(F, agg)(case)
        name = f"{prefix}{value}{suffix}"
        out.append(total.alias(name if quote_identifiers else slugify_name(name)))
    return out


def column_values(
    df: DataFrame, column: str, where: Column | str | None = None, max_records: int | None = None, order_by: Sequence[Column] | None = None
) -> DataFrame:
    """Distinct values with their counts, most frequent first."""
    rows = df if where is None else df.filter(where)
    counted = rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    ordered = counted.orderBy(*(order_by or [F.col("n").desc(), F.col("value").asc_nulls_first()]))
    return ordered if max_records is None else ordered.limit(max_records)


def pivot_values(
    df: DataFrame, column: str, where: Column | str | None = None, max_records: int = 1000, default: Sequence = ()
) -> list:
    """The most frequent values as a list, at most ``max_records`` of them; ``default`` where there is none."""
    found = [r.value for r in column_values(df.filter(F.col(column).isNotNull()), column, where, max_records).collect()]
    return found or list(default)


def unpivot(
    df: DataFrame,
    cast_to: str = "string",
    exclude: Sequence[str] = (),
    remove: Sequence[str] = (),
    field_name: str = "field_name",
    value_name: str = "value",
) -> DataFrame:
    """Wide to long in one pass; nulls keep their row, booleans become text first."""
    out = {c.lower() for c in (*exclude, *remove)}
    ids = [c for c in df.columns if c.lower() in {e.lower() for e in exclude}]
    values = []
    for f in df.schema.fields:
        if f.name.lower() not in out:
            as_text = isinstance(f.dataType, T.BooleanType)
            value = F.col(f.name).cast("string") if as_text else F.col(f.name)
            values.append(value.cast(cast_to).alias(f.name))
    names = [f.name for f in df.schema.fields if f.name.lower() not in out]
    return df.select(*ids, *values).unpivot(ids, names, field_name, value_name)


def union_relations(
    relations: Mapping[str, DataFrame],
    column_override: Mapping[str, str] | None = None,
    include: Sequence[str] = (),
    exclude: Sequence[str] = (),
    source_column_name: str | None = "source_relation",
    where: str | None = None,
) -> DataFrame:
    """Union over the superset of columns; what a table lacks is null."""
    if include and exclude:
        raise ValueError("give either include or exclude, not both")
    override = dict(column_override or {})
    wanted, unwanted = {c.lower() for c in include}, {c.lower() for c in exclude}
    types: dict[str, str] = {}
    for df in relations.values():
        for f in df.schema.fields:
            name = f.name.lower()
            if name in unwanted or (wanted and name not in wanted):
                continue
            types.setdefault(f.name, override.get(f.name, f.dataType.simpleString()))
    if not types:
        raise ValueError("no columns left to union")
    parts = []
    for label, df in relations.items():
        rows = df if where is None else df.filter(where)
        source = [] if source_column_name is None else [F.lit(label).alias(source_column_name)]
        cells = [(F.col(c) if c in df.columns else F.lit(None)).cast(t).alias(c) for c, t in types.items()]
        parts.append(rows.select(*source, *cells))
    return reduce(DataFrame.unionByName, parts)


def deduplicate(df: DataFrame, partition_by: Sequence[str], order_by: Sequence[Column]) -> DataFrame:
    """First row of each group. All but one row per group and task go before the shuffle."""
    w = Window.partitionBy(*partition_by).orderBy(*order_by)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def listagg_first(
    df: DataFrame, group_by: Sequence[str], measure: str, order_by: Sequence[Column], limit: int, delimiter: str = ",", name: str = "values"
) -> DataFrame:
    """Text of the first ``limit`` values of each group; the others go before the shuffle."""
    w = Window.partitionBy(*group_by).orderBy(*order_by)
    first = (
        df.filter(F.col(measure).isNotNull()).withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= limit)
    )
    return first.groupBy(*group_by).agg(listagg(measure, delimiter, F.col("_rn")).alias(name))


def listagg_in_pieces(
    df: DataFrame, group_by: Sequence[str], measure: Column | str, delimiter: str = ",", order_by: Sequence[str] = (),
    distinct: bool = False, name: str = "values",
) -> DataFrame:
    """Text of all values of each group, in order of ``order_by`` and the value, put together in pieces.

    Rows are dealt by ranges of (group, order, value), so that a group with a
    third of all rows is many ranges; each becomes one piece of text where it
    lies, and only pieces meet, one for each range of a group. Equal rows are
    counted before they are dealt; ``distinct`` takes each value once, in order of
    the values. Nulls are left out, a group of nothing else
    has the empty text. A text is one cell and so at most 2 GB.
    """
    keys = [f"_k{i}" for i in range(len(order_by))]
    text = (F.col(measure) if isinstance(measure, str) else measure).cast("string")
    rows = df.select(*group_by, *[F.col(c).alias(k) for c, k in zip(order_by, keys)], text.alias("_value"))
    if distinct:
        keys = []
    counted = rows.groupBy(*group_by, *keys, "_value").agg(F.lit(1).alias("_n") if distinct else F.count("*").cast("int").alias("_n"))
    ranged = counted.repartitionByRange(*group_by, *keys, "_value").withColumn("_range", F.spark_partition_id())
    item = F.when(F.col("_value").isNotNull(), F.struct(*keys, "_value", "_n"))
    pieces = ranged.groupBy(*group_by, "_range").agg(F.array_sort(F.collect_list(item)).alias("_items"))
    words = F.flatten(F.transform("_items", lambda i: F.array_repeat(i["_value"], i["_n"])))
    piece = F.when(F.size("_items") > 0, F.struct("_range", F.array_join(words, delimiter).alias("text")))
    joined = pieces.select(*group_by, piece.alias("_piece")).groupBy(*group_by).agg(F.array_sort(F.collect_list("_piece")).alias("_pieces"))
    return joined.select(*group_by, F.array_join(F.transform("_pieces", lambda p: p["text"]), delimiter).alias(name))


def except_sets(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows of a that b lacks, once each. Copies collapse before the join."""
    return a.distinct().subtract(b.distinct())


def intersect_sets(a: DataFrame, b: DataFrame) -> DataFrame:
    """Rows in both, once each."""
    return a.distinct().intersect(b.distinct())


def group_by_ordinals(df: DataFrame, n: int, *aggs: Column) -> DataFrame:
    """Group by the first ``n`` columns."""
    return df.groupBy(*df.columns[:n]).agg(*aggs)
