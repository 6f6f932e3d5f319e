"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def build_session(app_name: str = "earshot", master: str | None = None, **conf: str) -> SparkSession:
    """Session with the settings the operators assume: UTC, ANSI, AQE."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # Sessions of one user are merged inside each task before they are shuffled.
        .config("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
        .config("spark.ui.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared folder, as named by ``spark.checkpoint.dir``.

    Only a local-mode session without the setting gets a folder of its own;
    a cluster session without it is an error, because a folder on one machine
    is lost with that machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="earshot-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path under the shared folder."""
    return f"{_own_folder(spark)}/{label}-{uuid.uuid4().hex}"


def own_path(spark: SparkSession, label: str) -> str:
    """A path of this application under the shared folder, the same at every call."""
    return f"{_own_folder(spark)}/{label}"


def _own_folder(spark: SparkSession) -> str:
    return f"{shared_dir(spark).rstrip('/')}/earshot/{spark.sparkContext.applicationId}"


def remove_scratch(spark: SparkSession) -> None:
    """Deletes what this application wrote below the shared folder; call it once the results are stored."""
    remove_path(spark, _own_folder(spark))


def _file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove_path(spark: SparkSession, path: str) -> None:
    """Deletes a folder with all it holds; one that is not there is passed over."""
    files, place = _file_system(spark, path)
    files.delete(place, True)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders right below a path, none if it is not there."""
    files, place = _file_system(spark, path)
    if not files.exists(place):
        return []
    return [found.getPath().getName() for found in files.listStatus(place) if found.isDirectory()]


def run_name(label: str) -> str:
    """A table name that no other run uses."""
    return f"{label}_{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame, label: str = "step") -> DataFrame:
    """Write a step to the shared folder as Parquet and go on from the files.

    Used where several branches read one step, so that it is computed once,
    and where row positions must survive a lost executor. Readers then fetch
    only the columns they need, and Spark knows the step's true size.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
