"""Files and catalog tables: scans, lineage, seeds, writes, profiles."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import parse_iso_ts
from ..schemas import PLAY_EVENT

HOUR_PARTITIONS = ("year", "month", "day", "hour")
HOUR_PATH = r"/year=\d{4}/month=\d{2}/day=\d{2}/hour=\d{2}/[^/]+\.parquet$"


def with_hour_partitions(plays: DataFrame, ts: str = "played_at", fallback: Column | None = None) -> DataFrame:
    """Adds year, month, day, hour of each row's own time (now, or ``fallback``, if it does not parse)."""
    moment = parse_iso_ts(ts, fallback)
    parts = {"year": "yyyy", "month": "MM", "day": "dd", "hour": "HH"}
    return plays.withColumns({name: F.date_format(moment, fmt) for name, fmt in parts.items()})


def spread_by_hour(rows: DataFrame, files_per_hour: int, tasks: int | None = None) -> DataFrame:
    """Rows grouped by hour, each hour cut into ``files_per_hour`` shares by a hash of the play.

    A hot hour is so written by several tasks, and no hour gets a file per task.
    """
    share = F.pmod(F.xxhash64("event_id", "user_id", "track_id", "played_at"), F.lit(files_per_hour))
    keys = [*map(F.col, HOUR_PARTITIONS), share]
    return rows.repartition(*keys) if tasks is None else rows.repartition(tasks, *keys)


def write_bronze(
    plays: DataFrame, root: str, mode: str = "append", fallback: Column | None = None, files_per_hour: int | None = None,
    tasks: int | None = None,
) -> None:
    """Snappy Parquet under year=/month=/day=/hour=.

    By default Spark rebalances the rows over the hours by size, splitting
    large hours; ``files_per_hour`` fixes the number of files instead.
    """
    rows = with_hour_partitions(plays, fallback=fallback)
    if files_per_hour is None:
        spread = rows.hint("rebalance", *HOUR_PARTITIONS)
    else:
        spread = spread_by_hour(rows, files_per_hour, tasks)
    spread.write.mode(mode).option("compression", "snappy").partitionBy(*HOUR_PARTITIONS).parquet(root)


def append_by_date(plays: DataFrame, root: str, ts: str = "played_at", fallback: Column | None = None) -> None:
    """Variant: append under event_date=, spread over the dates by size."""
    dated = plays.withColumn("event_date", F.to_date(parse_iso_ts(ts, fallback)))
    dated.hint("rebalance", "event_date").write.mode("append").partitionBy("event_date").parquet(root)


def merged_scan(spark: SparkSession, root: str) -> DataFrame:
    """All files of a folder whose loads had different columns; what a load lacks is null."""
    return spark.read.option("mergeSchema", "true").parquet(root)


def external_table_scan(spark: SparkSession, root: str, schema: T.StructType = PLAY_EVENT) -> DataFrame:
    """All landed files, with the folder levels as columns so that a filter on them skips files."""
    levels = T.StructType([T.StructField(p, T.StringType()) for p in HOUR_PARTITIONS])
    return (
        spark.read.schema(T.StructType(schema.fields + levels.fields))
        .option("recursiveFileLookup", "false")
        .option("pathGlobFilter", "*.parquet")
        .option("mergeSchema", "false")
        .parquet(root)
    )


def refresh(spark: SparkSession, table_or_path: str) -> None:
    """Forget cached file listings, and register new folders if it is a catalog table."""
    if "/" in table_or_path:
        spark.catalog.refreshByPath(table_or_path)
        return
    spark.catalog.recoverPartitions(table_or_path)
    spark.catalog.refreshTable(table_or_path)


def list_source_files(df: DataFrame) -> DataFrame:
    """Files a scan reads, with their row counts."""
    return df.groupBy(F.col("_metadata.file_path").alias("file_path")).agg(F.count("*").alias("row_count"))


def row_lineage(df: DataFrame) -> DataFrame:
    """Rows with the file they came from and their place in it."""
    return df.select(
        "*", F.col("_metadata.file_name").alias("source_file"), F.col("_metadata.row_index").alias("row_in_file")
    )


def landing_checks(df: DataFrame, schema: T.StructType = PLAY_EVENT) -> DataFrame:
    """Rows present, every file under year/month/day/hour, all columns there; extra columns only warn."""
    have = {c.lower() for c in df.columns}
    want = {f.name.lower() for f in schema.fields}
    missing, extra = len(want - have), len(have - want - set(HOUR_PARTITIONS))
    files = list_source_files(df)
    one = files.agg(
        F.count("*").alias("files"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("rows"),
        F.count_if(~F.col("file_path").rlike(HOUR_PATH)).alias("misplaced"),
    )

    def check(name: str, value: Column, passed: Column) -> Column:
        return F.struct(F.lit(name).alias("check_name"), value.cast("long").alias("value"), passed.alias("passed"))

    checks = F.array(
        check("files_exist", F.col("files"), F.col("files") > 0),
        check("rows_readable", F.col("rows"), F.col("rows") > 0),
        check("partition_path", F.col("misplaced"), F.col("misplaced") == 0),
        check("missing_columns", F.lit(missing), F.lit(missing == 0)),
        check("extra_columns_warn", F.lit(extra), F.lit(True)),
    )
    return one.select(F.inline(checks))


def seed_load(
    spark: SparkSession, path: str, column_types: Mapping[str, str] | None = None, schema: str | None = None
) -> DataFrame:
    """CSV with a header; types inferred unless given, single columns overridable."""
    reader = spark.read.option("header", True).option("ignoreLeadingWhiteSpace", True)
    df = reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)
    return df.withColumns({c: F.col(c).cast(t) for c, t in (column_types or {}).items()})


def table_write(df: DataFrame, name: str, path: str) -> DataFrame:
    """Create or replace a table from a query; its files lie at ``path``."""
    df.write.mode("overwrite").option("path", path).saveAsTable(name)
    return df.sparkSession.table(name)


def view_define(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def clustered_write(df: DataFrame, path: str, keys: Sequence[str]) -> DataFrame:
    """Write sorted by the keys, so that Parquet min/max lets a filter on them skip files.

    A hash of the row follows the keys, so that one key with very many rows
    is still cut into several ranges.
    """
    spread = df.repartitionByRange(*keys, F.xxhash64(*df.columns)).sortWithinPartitions(*keys)
    spread.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def find_tables(spark: SparkSession, pattern: str, exclude: str = "", prefix: bool = False) -> DataFrame:
    """Catalog tables and views whose name matches a LIKE pattern (or prefix), any case.

    Catalog entries are names, not rows: the list is small by nature.
    """
    rows = [(".".join(t.namespace or []), t.name, "view" if "VIEW" in (t.tableType or "") or t.isTemporary else "table") for t in spark.catalog.listTables()]
    found = spark.createDataFrame(rows, "table_schema string, table_name string, table_type string")
    like = pattern + "%" if prefix else pattern
    found = found.filter(F.col("table_name").ilike(like))
    return found.filter(~F.col("table_name").ilike(exclude)) if exclude else found


def table_profile(df: DataFrame, name: str) -> DataFrame:
    """Columns of a file-backed table with its row count, bytes and last change."""
    files = df.groupBy(
        F.col("_metadata.file_path"), F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("changed"),
    ).agg(F.count("*").alias("n"))
    total = files.agg(
        F.sum("n").alias("row_count"), F.sum("size").alias("bytes"), F.max("changed").alias("last_modified")
    )
    columns = F.array(
        *[
            F.struct(
                F.lit(i).alias("ordinal"), F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type")
            )
            for i, f in enumerate(df.schema.fields, 1)
        ]
    )
    return total.select(F.lit(name).alias("table_name"), "row_count", "bytes", "last_modified", F.inline(columns))
