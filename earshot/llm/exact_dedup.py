"""Exact duplicates by content-defined chunk recipes.

A text without its white space is cut where its own characters say so, so an
edit moves only the cuts near it. Every chunk is moved once, to be checked:
chunks with one fingerprint must be one text. From then on a document is the
ordered list of its chunks' identifiers, and two documents are equal when
their lists are. Only DataFrame functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import SPACE, keep_rows, row_key, text_of

#: A cut comes after one of these two-character ends, or after a CJK sentence mark.
CUT_AFTER = r"(?<=[nrstlm][.,;:!?|]|[。、！？])"
MIN_CHUNK, MAX_CHUNK = 256, 4096
#: Each identifier starts with two 64-bit words and gets twice as many after a failed check.
WORDS = 2


def normalised(column: str = "text") -> Column:
    return F.regexp_replace(text_of(column), f"{SPACE}+", "")


def chunks(text: Column, min_chars: int = MIN_CHUNK, max_chars: int = MAX_CHUNK) -> Column:
    """Array of the text's chunks; they join to the whole text, and an empty text has none."""
    pattern = f"(?s).{{{min_chars},{max_chars - 1}}}?(?:{CUT_AFTER}|\\z)|.{{1,{max_chars}}}"
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(0))


def identifier(chunk: Column, words: int, mask: int) -> Column:
    """``words`` independent 64-bit hashes; the salt comes first, so that a clash in one says nothing of the next."""
    return F.array(*[F.xxhash64(F.lit(salt), chunk).bitwiseAND(F.lit(mask)) for salt in range(words)])


def verified_words(docs: DataFrame, text: str = "text", words: int = WORDS, mask: int = -1) -> int:
    """How many words an identifier needs so that no two different chunks of ``docs`` share one.

    The chunks are grouped by identifier and compared byte by byte. Copies are
    dropped inside each task before the shuffle, so a chunk that a third of all
    documents hold is moved once per task.
    """
    while True:
        found = docs.select(F.explode(chunks(normalised(text))).alias("chunk"))
        clashes = (
            found.groupBy(identifier(F.col("chunk"), words, mask).alias("id"))
            .agg(F.collect_set("chunk").alias("texts"))
            .filter(F.size("texts") > 1)
        )
        if clashes.isEmpty():
            return words
        words *= 2


def chunk_recipes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, mask: int = -1) -> DataFrame:
    """One row per document: ``row_no, key, doc_id, chars, text_sha256, recipe``, as a written table.

    ``row_no`` tells repeated rows apart; ``chars`` counts the code points of
    the text as it came. Null texts count as empty and have an empty recipe.
    """
    words = verified_words(docs, text, words, mask)
    short = normalised(text)
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_no"),
        row_key(doc_id, text).alias("key"),
        F.col(doc_id).alias("doc_id"),
        F.length(text_of(text)).cast("long").alias("chars"),
        F.sha2(short, 256).alias("text_sha256"),
        F.flatten(F.transform(chunks(short), lambda c: identifier(c, words, mask))).alias("recipe"),
    )
    return materialize(rows, "recipes")


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, mask: int = -1) -> DataFrame:
    """Every document with the one that stays for it.

    Returns ``doc_id, keep_id, group_size, kept, text_sha256, key`` (``common.row_key``). Texts are equal
    without their white space; the longest original stays, then the smallest
    doc_id (null last), then the first of repeated rows, so exactly one row of
    a group is kept. Null texts are empty, and all empty texts are one group.
    Other columns are not read.
    """
    recipes = chunk_recipes(docs, doc_id, text, words, mask)
    rank = F.struct((-F.col("chars")).alias("c"), F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("i"), F.col("row_no").alias("r"))
    groups = recipes.groupBy("recipe").agg(F.min(rank).alias("best"), F.count("*").alias("group_size"))
    return recipes.join(groups, "recipe").select(
        "doc_id",
        F.col("best.i").alias("keep_id"),
        "group_size",
        (F.col("row_no") == F.col("best.r")).alias("kept"),
        "text_sha256",
        "key",
    )


def drop_exact_copies(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each group of equal texts; columns as they were."""
    return keep_rows(docs, exact_groups(docs, **options).select("key", "kept"), row_key())
