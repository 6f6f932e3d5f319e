"""Bringing a table up to date from new rows.

Parquet tables take neither MERGE nor DELETE, so these operators give the
table's next state as a DataFrame; :func:`replace_table` writes it to a new
folder and points the table there, so a table is never overwritten while read.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_path


def append(target: DataFrame, source: DataFrame) -> DataFrame:
    return target.unionByName(source.select(*target.columns))


def new_rows_since(source: DataFrame, target: DataFrame, ts: str) -> DataFrame:
    """Source rows newer than the newest target row; all of them for an empty target."""
    newest = target.agg(F.max(ts).alias("m")).scalar()
    return source.filter(newest.isNull() | (F.col(ts) > newest))


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    update_columns: Sequence[str] | None = None,
    exclude_columns: Sequence[str] | None = None,
    predicate: Column | None = None,
    order_by: Sequence[Column] | None = None,
) -> DataFrame:
    """Upsert: matched rows take the update columns from the source, new keys are added.

    One full join, so each side is shuffled once. Without keys every source
    row is added. Target rows outside ``predicate`` (for example old
    partitions) are passed through and never shuffled. A source that holds a
    key more than once is refused, or, with ``order_by``, gives the first of
    its rows along that order. Null keys match nothing and may repeat.
    """
    if update_columns and exclude_columns:
        raise ValueError("give either update_columns or exclude_columns, not both")
    source = source.select(*target.columns)
    if not keys:
        return target.unionByName(source)
    source = _one_per_key(source, keys, order_by)
    excluded = {c.lower() for c in exclude_columns or ()}
    updated = set(update_columns) if update_columns else {c for c in target.columns if c.lower() not in excluded}
    inside = None if predicate is None else F.coalesce(predicate, F.lit(False))
    touched = target if inside is None else target.filter(inside)
    t = touched.withColumn("_hit", F.lit(True)).alias("t")
    s = source.withColumn("_hit", F.lit(True)).alias("s")
    both = t.join(s, [F.col(f"t.{k}") == F.col(f"s.{k}") for k in keys], "full")

    def cell(c: str) -> Column:
        first, second = ("s", "t") if c in updated else ("t", "s")
        chosen = F.when(F.col(f"{first}._hit"), F.col(f"{first}.{c}")).otherwise(F.col(f"{second}.{c}"))
        return chosen.alias(c)

    merged = both.select(*[cell(c) for c in target.columns])
    return merged if inside is None else merged.unionByName(target.filter(~inside))


def _one_per_key(source: DataFrame, keys: Sequence[str], order_by: Sequence[Column] | None) -> DataFrame:
    whole = reduce(Column.__and__, [F.col(k).isNotNull() for k in keys])
    if order_by is not None:
        w = Window.partitionBy(*keys).orderBy(*order_by)
        first = source.filter(whole).withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
        return first.unionByName(source.filter(~whole))
    repeated = source.filter(whole).groupBy(*keys).agg(F.count("*").alias("_n")).filter("_n > 1")
    if not repeated.isEmpty():
        raise ValueError(f"the source holds a key of {list(keys)} more than once; give order_by to choose a row")
    return source


def delete_keys(target: DataFrame, source: DataFrame, keys: Sequence[str], predicate: Column | None = None) -> DataFrame:
    """Target rows whose key the source does not hold."""
    gone = source.select(*keys).distinct()
    if predicate is None:
        return target.join(gone, list(keys), "left_anti").select(*target.columns)
    inside = F.coalesce(predicate, F.lit(False))
    kept = target.filter(inside).join(gone, list(keys), "left_anti").select(*target.columns)
    return kept.unionByName(target.filter(~inside))


def delete_insert(target: DataFrame, source: DataFrame, keys: Sequence[str], predicate: Column | None = None) -> DataFrame:
    """Delete matching keys, then add every source row."""
    return delete_keys(target, source, keys, predicate).unionByName(source.select(*target.columns))


def delete_where(target: DataFrame, condition: Column | str) -> DataFrame:
    """Rows for which the condition is not true."""
    rule = F.expr(condition) if isinstance(condition, str) else condition
    return target.filter(~F.coalesce(rule, F.lit(False)))


def retain_last_hours(target: DataFrame, ts: str, hours: int, as_of: str | None = None) -> DataFrame:
    now = (F.current_timestamp() if as_of is None else F.lit(as_of)).cast("timestamp_ntz")
    return delete_where(target, F.col(ts) < F.timestamp_add("HOUR", F.lit(-hours), now))


def insert_overwrite(target: DataFrame, source: DataFrame, predicate: Column | None = None) -> DataFrame:
    """Replace the rows under ``predicate`` (all of them without one) by the source."""
    source = source.select(*target.columns)
    return source if predicate is None else delete_where(target, predicate).unionByName(source)


def overwrite_partitions(source: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Write, replacing only the partitions the source holds rows for; files follow the partitions' sizes."""
    (
        source.hint("rebalance", *partition_by)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partition_by)
        .parquet(path)
    )


def microbatch(target: DataFrame, source: DataFrame, event_time: str, start: str, end: str) -> DataFrame:
    """Replace the window [start, end) by the source rows of that window."""
    lo, hi = F.lit(start).cast("timestamp_ntz"), F.lit(end).cast("timestamp_ntz")
    window = (F.col(event_time) >= lo) & (F.col(event_time) < hi)
    return insert_overwrite(target, source.filter(window), window)


def schema_diff(source: DataFrame, target: DataFrame) -> dict[str, dict[str, str]]:
    """Columns added by, removed by and retyped in the source."""
    have = {f.name: f.dataType.simpleString() for f in target.schema.fields}
    come = {f.name: f.dataType.simpleString() for f in source.schema.fields}
    return {
        "added": {c: t for c, t in come.items() if c not in have},
        "removed": {c: t for c, t in have.items() if c not in come},
        "retyped": {c: t for c, t in come.items() if c in have and have[c] != t},
    }


def apply_schema_change(target: DataFrame, source: DataFrame, mode: str = "ignore") -> tuple[DataFrame, DataFrame]:
    """Both frames with the columns they need to be combined, by the chosen policy."""
    if mode not in ("ignore", "fail", "append_new_columns", "sync_all_columns"):
        mode = "ignore"
    diff = schema_diff(source, target)
    if mode == "fail" and any(diff.values()):
        raise ValueError(f"source and target are out of sync: {diff}")
    if mode in ("append_new_columns", "sync_all_columns"):
        target = target.withColumns({c: F.lit(None).cast(t) for c, t in diff["added"].items()})
    if mode == "sync_all_columns":
        target = target.drop(*diff["removed"])
        target = target.withColumns({c: F.col(c).cast(t) for c, t in diff["retyped"].items()})
    kinds = {f.name: f.dataType for f in target.schema.fields}
    source = source.select(
        *[(F.col(c) if c in source.columns else F.lit(None)).cast(kinds[c]).alias(c) for c in target.columns]
    )
    return target, source


def store_bucketed(spark: SparkSession, name: str, state: DataFrame, keys: Sequence[str], buckets: int, root: str | None = None) -> DataFrame:
    """A table whose rows lie in ``buckets`` files by a hash of the keys, sorted by them; its next state if it exists.

    Choose so many buckets that one fits a task. :func:`merge`,
    :func:`delete_insert` and snapshots on the keys then read it as it lies:
    only the new rows are shuffled, and the next state, which comes out of the
    join in the same buckets, is written without a shuffle.
    """
    path = scratch_path(spark, name) if root is None else f"{root}/{scratch_path(spark, name).rsplit('/', 1)[-1]}"
    known = spark.catalog.tableExists(name)
    written = f"{name}_next" if known else name
    if known:
        spark.sql(f"DROP TABLE IF EXISTS {written}")
    by = list(keys)
    state.write.bucketBy(buckets, *by).sortBy(*by).option("path", path).format("parquet").saveAsTable(written)
    if known:
        # A table with a path of its own leaves its files behind.
        spark.sql(f"DROP TABLE {written}")
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    return spark.table(name)


def replace_table(spark: SparkSession, name: str, state: DataFrame, root: str | None = None) -> DataFrame:
    """Write the next state to a folder of its own and point the table at it."""
    path = scratch_path(spark, name) if root is None else f"{root}/{scratch_path(spark, name).rsplit('/', 1)[-1]}"
    state.write.parquet(path)
    if spark.catalog.tableExists(name):
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{path}'")
        spark.catalog.refreshTable(name)
    else:
        spark.catalog.createTable(name, path=path, source="parquet")
    return spark.table(name)
