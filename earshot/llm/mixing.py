"""Mixing sources to target weights by pivotal dependent rounding.

A source that is to give ``target`` of its ``size`` words gives each document
``target / size`` copies on average: the whole part at once, the rest as a
probability. Two documents with open probabilities meet and one hands the
other words until a probability is 0 or 1. Words are never made or lost on
the way, so what a source gives differs from its target by one document at
most; long ones meet first, so that it is a short one as a rule. Documents
meet inside blocks of a source, the one that each block leaves open goes to
the next level, and so on up a tree.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import reduce

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import WORD, row_key, text_of

#: Documents that meet in one block, so the most one task holds of a source at a time.
BLOCK = 4096
OPEN = 1e-9


def sizes(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """``row_no, key, doc_id, source, size`` and a place in a fixed random order, as a written table; a null text has no words."""
    rows = docs.select(
        F.monotonically_increasing_id().alias("row_no"),
        row_key(doc_id, text).alias("key"),
        F.col(doc_id).cast("long").alias("doc_id"),
        F.col(source).cast("string").alias("source"),
        F.regexp_count(text_of(text), F.lit(WORD)).cast("long").alias("size"),
        F.xxhash64(F.lit("place"), F.col(doc_id), F.col(text)).alias("place"),
    )
    return materialize(rows, "sizes")


def targets(sized: DataFrame, weights: Sequence[float] = (1, 2, 3), max_repeats: float = 3) -> DataFrame:
    """``source, source_size, target``: one row per source.

    Sources by code point, null last, take the weights in turn and share all
    words by them; where that is more than ``max_repeats`` times the source,
    it gets that much and the rest share what is over, until none is above.
    Sources fill up in the order of size by weight, so the last filled one
    follows from running sums; the windows see one row per source.
    """
    per_source = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").isNull(), F.encode(F.col("source"), "UTF-8"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int"))
    by_room = Window.orderBy(F.col("source_size") / F.col("weight"), F.col("source").isNull(), "source")
    everything = Window.partitionBy()
    before = by_room.rowsBetween(Window.unboundedPreceding, -1)
    room = F.col("source_size") * F.lit(float(max_repeats))
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum(room).over(before), F.lit(0.0))
    weights_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    level = F.when(room <= left / weights_left * F.col("weight"), F.lit(None).cast("double")).otherwise(left / weights_left)
    levelled = per_source.withColumn("weight", weight).withColumn("level", level)
    # The first source that is not filled sets the level of all that follow.
    from_here = by_room.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    share = F.first("level", ignorenulls=True).over(from_here) * F.col("weight")
    return levelled.select("source", "source_size", F.coalesce(share, room).cast("double").alias("target"))


def _uniform(seed: int, *keys: int) -> float:
    """A number in [0, 1) that depends on the keys alone."""
    x = seed & 0xFFFFFFFFFFFFFFFF
    for key in keys:
        x = (x ^ (key & 0xFFFFFFFFFFFFFFFF)) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF
        x = (x ^ (x >> 31)) * 0xBF58476D1CE4E5B9 & 0xFFFFFFFFFFFFFFFF
        x ^= x >> 29
    return (x >> 11) / float(1 << 53)


def _meet(p: float, m: int, q: float, n: int, u: float) -> tuple[float, float]:
    """New probabilities of documents of m and n words: words move one way or the other until one is closed.

    ``up`` words go to the first or ``down`` words to the second, with chances
    that keep both expectations.
    """
    up, down = min((1 - p) * m, q * n), min(p * m, (1 - q) * n)
    moved = up if u * (up + down) < down else -down
    return p + moved / m, q - moved / n


def _pivot(seed: int, last: bool):
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come in blocks; every block leaves at most one row open, or none if ``last``."""
        block = held = None

        def close(row):
            _, place, size, p, no = row
            if last:
                return (no, 1.0 if _uniform(seed, place, -1) < p else 0.0)
            return (no, p)

        for batch in batches:
            out = []
            for key, place, size, p, no in zip(batch["key"], batch["place"], batch["size"], batch["p"], batch["row_no"]):
                row = (key, int(place), int(size), float(p), int(no))
                if key != block:
                    if held is not None:
                        out.append(close(held))
                    block, held = key, None
                if held is None:
                    held = row
                    continue
                a, b = _meet(held[3], held[2], row[3], row[2], _uniform(seed, held[1], row[1]))
                open_rows = []
                for old, new in ((held, a), (row, b)):
                    if new < OPEN or new > 1 - OPEN:
                        out.append((old[4], float(round(new))))
                    else:
                        open_rows.append((*old[:3], new, old[4]))
                held = open_rows[0] if open_rows else None
            yield pd.DataFrame(out, columns=["row_no", "p"])
        if held is not None:
            yield pd.DataFrame([close(held)], columns=["row_no", "p"])

    return run


def pivotal_copies(rows: DataFrame, seed: int = 7, block: int = BLOCK) -> DataFrame:
    """``row_no, p`` with p 0 or 1, from ``row_no, source, place, size, p`` with 0 < p < 1 and size > 0.

    One job per level of the tree; a level holds a row for each block of the
    one below, so there are about log(rows) / log(block / 2) of them.
    """
    level, done, still = 0, [], rows
    while True:
        counts = still.groupBy("source").agg(F.count("*").alias("open_rows"))
        most = counts.agg(F.max("open_rows")).first()[0]
        if most is None:
            break
        last = most <= block
        # Even blocks by a hash of the place, also where one source holds most rows.
        cell = F.lit(0) if last else F.pmod(F.xxhash64(F.lit(level), "place"), F.ceil(F.col("open_rows") / (block // 2)))
        keyed = still.alias("s").join(counts.alias("c"), F.col("s.source").eqNullSafe(F.col("c.source")))
        keyed = keyed.select("row_no", "place", "size", "p", F.xxhash64(F.lit(level), "s.source", cell).alias("key"))
        dealt = keyed.repartition("key").sortWithinPartitions("key", F.desc("size"), "place", "row_no")
        solved = dealt.select("key", "place", "size", "p", "row_no").mapInPandas(_pivot(seed + level, last), "row_no long, p double")
        solved = materialize(solved, "pivot")
        is_open = (F.col("p") > 0) & (F.col("p") < 1)
        done.append(solved.filter(~is_open))
        if last:
            break
        still = materialize(still.drop("p").join(solved.filter(is_open), "row_no"), "open")
        level += 1
    if not done:
        return rows.select("row_no", "p").filter(F.lit(False))
    return reduce(DataFrame.unionByName, done)


def mix(
    docs: DataFrame, weights: Sequence[float] = (1, 2, 3), max_repeats: float = 3, doc_id: str = "doc_id", text: str = "text",
    source: str = "source", seed: int = 7, block: int = BLOCK,
) -> DataFrame:
    """How often the mix takes each document: ``doc_id, size, source_size, target, taken, source, copies, key``.

    ``taken = copies * size``; no document is taken more than ``max_repeats``
    times, rounded up. Null sources are a source of their own, documents
    without words are taken as often as the whole part says and count nothing,
    repeated rows are rounded each by itself, an empty table gives no rows.
    ``key`` is ``common.row_key`` of the row. Equal inputs give equal results:
    chance comes from hashes of ids and texts.
    """
    sized = sizes(docs, doc_id, text, source)
    wanted = materialize(targets(sized, weights, max_repeats), "targets")
    joined = sized.alias("d").join(wanted.alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    rated = joined.select("d.*", "source_size", "target", F.floor(each).alias("whole"), (each - F.floor(each)).alias("p"))
    rounding = rated.filter((F.col("size") > 0) & (F.col("p") > OPEN) & (F.col("p") < 1 - OPEN))
    rounded = pivotal_copies(rounding.select("row_no", "source", "place", "size", "p"), seed, block)
    nearly = F.when(F.col("p") >= 1 - OPEN, 1).otherwise(0)
    copies = (F.col("whole") + F.coalesce(F.col("r.up"), nearly)).cast("long")
    return (
        rated.join(rounded.select("row_no", F.col("p").cast("int").alias("up")).alias("r"), "row_no", "left")
        .withColumn("copies", copies)
        .select("doc_id", "size", "source_size", "target", (F.col("copies") * F.col("size")).alias("taken"), "source", "copies", "key")
    )
