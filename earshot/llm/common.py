"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize

#: What separates words, and what a word is, in every operator.
SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other character as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def row_key(doc_id: str = "doc_id", text: str = "text") -> Column:
    """128 bits of id and text: the same for repeated rows, defined where either is null."""
    return F.unhex(F.md5(F.to_json(F.struct(F.col(doc_id).cast("string").alias("i"), F.col(text).alias("t")))))


def keep_rows(docs: DataFrame, verdicts: DataFrame, key: Column) -> DataFrame:
    """Rows of ``docs`` whose key a verdict (``key, kept``) keeps; of repeated rows one. Columns as they were.

    Only keys that are dropped or repeated are joined, and only rows that are
    repeated are compared with each other.
    """
    per_key = verdicts.groupBy(F.col("key").alias("_key")).agg(F.max("kept").alias("kept"), F.count("*").alias("n"))
    per_key = materialize(per_key.filter(~F.col("kept") | (F.col("n") > 1)), "verdicts")
    keyed = docs.withColumn("_key", key)
    left = keyed.join(per_key.select("_key"), "_key", "left_anti")
    repeated = per_key.filter("kept").select("_key")
    if not repeated.isEmpty():
        left = left.unionByName(keyed.join(repeated, "_key", "left_semi").dropDuplicates(["_key"]))
    return left.select(*docs.columns)
