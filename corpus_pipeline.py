"""From raw documents to a training mix, as stages that each read what the one before wrote."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from earshot.llm import decontaminate, exact_dedup, mixing, near_dup, quality
from earshot.llm.common import row_key
from earshot.session import materialize


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are more likely good than poor or toxic, by the ratings in ``labels``."""
    return quality.select(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that is equal but for white space."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 of five-word shingles."""
    return near_dup.drop_near_copies(docs, percent=80, size=5)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no item of ``benchmark``."""
    return decontaminate.drop_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with how often it takes them (``copies``) and their words (``size``).

    Repeated rows are taken equally often. Columns of these names are replaced.
    """
    taken = mixing.mix(docs).filter("copies > 0").groupBy("key").agg(F.max("copies").alias("copies"), F.max("size").alias("size"))
    kept = docs.drop("copies", "size")
    return kept.withColumn("_key", row_key()).join(taken.withColumnRenamed("key", "_key"), "_key").drop("_key")


STAGES = [
    ("quality", select_quality),
    ("exact_dedup", drop_exact_copies),
    ("near_dedup", drop_near_copies),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
]

#: The classifier, the fingerprints and the rounding are not SQL; ``tests/llm`` hold the stages against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
