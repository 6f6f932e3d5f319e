"""Benchmark passages in documents, by SimHash of item-sized windows.

For each length that benchmark items have, windows of that length slide over
every document. A window's SimHash is the vote of its weighted five-word
shingles: votes are kept as bytes (or two bytes) packed in 64-bit words, so a
prefix sum per plane gives the votes of any window by one subtraction.

Fingerprints are looked up in four block tables. Two that differ in at most r
of 64 bits differ in at most r / 4 bits of one of their four 16-bit blocks, so
a table of all block values that near to an item's misses none within r. What
it finds within the radius is aligned word by word, and the weighted shingles
of the best windows are compared exactly.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .words import U, byte_view, mix, plain_letters, slices, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
#: Largest distance of a window that lies near an item's place, and of one that is aligned with it.
NEAR, ALIGNED = 19, 15
#: A window starts every so many parts of its length.
STEPS = 5
#: Items looked up in one pass over the documents.
ITEMS = 4096

#: Runs whose votes are counted at a time; they stay in the processor's cache.
_RUNS = 4096
_LETTERS = plain_letters()


def _rolling(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of the run of ``size`` words that starts at each word; those over the end are worthless."""
    padded = np.concatenate([hashes, np.zeros(size, U)])
    out = np.full(len(hashes), U(size))
    factors = mix(np.arange(1, size + 1, dtype=U) * U(0xC2B2AE3D27D4EB4F)) | U(1)
    for k in range(size):
        out += padded[k : k + len(hashes)] * factors[k]
    return mix(out)


@lru_cache(maxsize=8)
def _block_values(radius: int) -> np.ndarray:
    """All 16-bit values with at most ``radius`` bits set."""
    every = np.arange(1 << 16, dtype=np.uint32)
    return every[np.bitwise_count(every) <= radius]


@dataclass(frozen=True)
class Group:
    """Items of one length: their numbers, fingerprints, shingle weights and block tables."""

    words: int
    size: int
    numbers: np.ndarray
    prints: np.ndarray
    shingles: list
    tables: np.ndarray

    @property
    def span(self) -> int:
        return self.words - self.size + 1


class Votes:
    """Votes of shingles, so that the fingerprint of any run of them is a subtraction."""

    def __init__(self, shingles: np.ndarray, weights: np.ndarray, lane: int) -> None:
        self.lane = lane
        ones = U(sum(1 << k for k in range(0, 64, lane)))
        self.ones, self.high = ones, ones << U(lane - 1)
        planes = ((shingles[:, None] >> np.arange(lane, dtype=U)[None, :]) & ones) * weights.astype(U)[:, None]
        self.sums = np.zeros((len(shingles) + 1, lane), U)
        np.cumsum(planes, axis=0, out=self.sums[1:])
        self.weight = np.concatenate([[0], np.cumsum(weights, dtype=np.int64)])

    def prints(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Fingerprint of each run: a bit is set where more than half of the weight votes for it."""
        out = np.empty(len(starts), U)
        for at in range(0, len(starts), _RUNS):
            part = slice(at, at + _RUNS)
            out[part] = self._prints(starts[part], ends[part])
        return out

    def _prints(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        half = (self.weight[ends] - self.weight[starts]) >> 1
        lift = ((1 << (self.lane - 1)) - 1 - half).astype(U) * self.ones
        votes = np.take(self.sums, ends, axis=0)
        votes -= np.take(self.sums, starts, axis=0)
        votes += lift[:, None]
        votes &= self.high
        votes >>= np.arange(self.lane - 1, -1, -1, dtype=U)[None, :]
        planes = self.lane
        while planes > 1:
            planes //= 2
            votes = votes[:, :planes] | votes[:, planes : 2 * planes]
        return votes[:, 0]


def _weights(shingles: np.ndarray, common: np.ndarray) -> np.ndarray:
    """2 for a shingle, 1 for one that several items share."""
    if not len(common):
        return np.full(len(shingles), 2, np.int64)
    at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
    return np.where(common[at] == shingles, 1, 2)


@dataclass(frozen=True)
class Items:
    """What every task needs of a block of benchmark items."""

    ids: list
    groups: list
    common: np.ndarray


def _item_shingles(text: str | None) -> tuple[int, np.ndarray]:
    """Number of words of an item and its shingles; an item shorter than a shingle is one."""
    data = np.frombuffer((text or "").encode(), np.uint8)
    hashes = word_hashes(data, np.array([0, len(data)]), _LETTERS)[0]
    size = min(SHINGLE, len(hashes))
    return len(hashes), _rolling(hashes, size)[: len(hashes) - size + 1] if size else np.zeros(0, U)


def _item_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``shingle`` once for each item that has it."""
    for batch in batches:
        for text in batch.column(0).to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array(np.unique(_item_shingles(text)[1]).view(np.int64))], ["shingle"])


def prepare(ids: list, texts: list, common: np.ndarray, near: int = NEAR) -> Items:
    """Fingerprints of the items, one without words is left out; ``common`` are the shingles that several items share, in order."""
    found = [_item_shingles(text) for text in texts]
    sets = [shingles for _, shingles in found]
    groups = []
    lengths = np.array([words for words, _ in found])
    for words in np.unique(lengths[lengths > 0]):
        numbers = np.flatnonzero(lengths == words)
        prints = []
        for number in numbers:
            weights = _weights(sets[number], common)
            votes = Votes(sets[number], weights, _lane(len(sets[number])))
            prints.append(votes.prints(np.array([0]), np.array([len(sets[number])]))[0])
        prints = np.array(prints, U)
        tables = np.zeros((4, 1 << 16), bool)
        for k in range(4):
            block = ((prints >> U(16 * k)) & U(0xFFFF)).astype(np.uint32)
            tables[k, (block[:, None] ^ _block_values(near // 4)[None, :]).ravel()] = True
        weighted = [dict(zip(sets[n].tolist(), _weights(sets[n], common).tolist())) for n in numbers]
        groups.append(Group(int(words), int(min(SHINGLE, words)), numbers, prints, weighted, tables))
    return Items(list(ids), groups, common)


def _lane(span: int) -> int:
    return next(lane for lane in (8, 16, 32) if 2 * span < 1 << lane)


def _similarity(window: np.ndarray, item: dict, common: np.ndarray) -> float:
    """Weighted Jaccard similarity of a window's shingles and an item's."""
    own = np.unique(window)
    weight = _weights(own, common)
    shared = sum(item.get(s, 0) for s in own.tolist())
    return shared / (sum(item.values()) + int(weight.sum()) - shared)


def matches(content: np.ndarray, starts: np.ndarray, items: Items, least: float, near: int = NEAR, aligned: int = ALIGNED) -> list[tuple]:
    """``row, item number, similarity, distance, first word, words`` of the best window of each item in each text."""
    hashes, _, first = word_hashes(content, starts, _LETTERS)
    best: dict[tuple[int, int], tuple] = {}
    row_of = np.repeat(np.arange(len(first) - 1), np.diff(first))
    votes: dict[tuple[int, int], tuple] = {}
    for group in items.groups:
        size, span = group.size, group.span
        key = (size, _lane(span))
        if key not in votes:
            shingles = _rolling(hashes, size)
            # Windows end where their text's last shingle does.
            stop = (first[1:] - size + 1)[row_of]
            votes[key] = (shingles, stop, Votes(shingles, _weights(shingles, items.common), key[1]))
        shingles, stop, ballot = votes[key]
        step = max(1, span // STEPS)
        at = np.arange(0, len(hashes), step)
        ends = np.minimum(at + span, stop[at])
        enough = math.ceil(span * least)
        fits = ends - at >= max(1, enough - step)
        at, ends = at[fits], ends[fits]
        prints = ballot.prints(at, ends)
        hit = group.tables[0][prints & U(0xFFFF)]
        for k in range(1, 4):
            hit |= group.tables[k][(prints >> U(16 * k)) & U(0xFFFF)]
        at, prints = at[hit], prints[hit]
        for k, mark in enumerate(group.prints):
            places = at[np.bitwise_count(prints ^ mark) <= near]
            if not len(places):
                continue
            shifts = np.arange(-step + 1, step)
            moved = (places[:, None] + shifts[None, :]).ravel()
            rows = np.repeat(row_of[places], len(shifts))
            moved = np.unique(np.clip(moved, first[rows], np.maximum(first[rows], stop[np.clip(moved, 0, len(stop) - 1)] - 1)))
            until = np.minimum(moved + span, stop[moved])
            moved, until = moved[until - moved >= enough], until[until - moved >= enough]
            distance = np.bitwise_count(ballot.prints(moved, until) ^ mark)
            for a, b, d in zip(moved[distance <= aligned], until[distance <= aligned], distance[distance <= aligned]):
                similarity = _similarity(shingles[a:b], group.shingles[k], items.common)
                if similarity >= least:
                    row = int(row_of[a])
                    pair = (row, int(group.numbers[k]))
                    rank = (similarity, -int(d), -int(a))
                    if pair not in best or rank > best[pair][0]:
                        best[pair] = (rank, (*pair, similarity, int(d), int(a - first[row]), int(b - a + size - 1)))
    return [found for _, found in best.values()]


def _searching(items, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content, starts = byte_view(batch.column(1))
            for first, last in slices(starts):
                found = matches(content, starts[first : last + 1], items.value, least)
                if found:
                    row, number, similarity, distance, word, words = zip(*found)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(row) if not first else pa.array([first + r for r in row])),
                            pa.array([items.value.ids[n] for n in number], pa.int64()),
                            pa.array(similarity, pa.float64()),
                            *(pa.array(x, pa.int64()) for x in (distance, word, words)),
                        ],
                        ["doc_id", "item_id", "similarity", "distance", "first_word", "n_words"],
                    )

    return run


def _clean(items, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The last column is the text in lower case."""
        for batch in batches:
            content, starts = byte_view(batch.column(batch.num_columns - 1))
            for first, last in slices(starts):
                dirty = {found[0] for found in matches(content, starts[first : last + 1], items.value, least)}
                kept = pa.array([k not in dirty for k in range(last - first)])
                yield batch.slice(first, last - first).filter(kept)

    return run


def _item_blocks(benchmark: DataFrame, item_id: str, text: str, size: int) -> Iterator[Items]:
    """The benchmark in blocks of about ``size`` items, each small enough for every task; what is common is so in all of it."""
    rows = benchmark.select(F.col(item_id).cast("long").alias("i"), F.lower(F.col(text)).alias("t")).filter("t IS NOT NULL")
    count = rows.count()
    parts = -(-count // size)
    if not parts:
        return
    sets = rows.select("t").mapInArrow(_item_sets, "shingle long")
    shared = sets.groupBy("shingle").agg(F.count("*").alias("n")).filter("n > 1").select("shingle")
    common = np.sort(shared.toArrow()["shingle"].to_numpy().view(U))
    for part in range(parts):
        block = rows.filter(F.pmod(F.xxhash64("i", "t"), F.lit(parts)) == part) if parts > 1 else rows
        found = sorted(block.collect(), key=lambda r: (r.i is None, r.i or 0, r.t))
        if found:
            yield prepare([r.i for r in found], [r.t for r in found], common)


def find_leaks(
    docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", block: int = ITEMS,
) -> DataFrame:
    """One row per document and item found in it: ``doc_id, item_id, similarity, distance, first_word, n_words``.

    Words are compared in lower case and without ASCII marks. The
    similarity is that of the weighted five-word shingles of the item and of
    the best window of its length; a window at a text's end may be shorter.
    Null and empty texts and items match nothing, repeated documents and items
    each have their rows, an empty benchmark gives no rows. The benchmark is
    the stated query set: it is taken in blocks, each one pass over the
    documents, and only a block's fingerprints and the shingles that several
    items of the whole benchmark share are sent to the tasks.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.lower(F.col(text)).alias("text"))
    schema = "doc_id long, item_id long, similarity double, distance long, first_word long, n_words long"
    out = None
    for items in _item_blocks(benchmark, item_id, item_text, block):
        found = rows.mapInArrow(_searching(spark.sparkContext.broadcast(items), least), schema)
        out = found if out is None else out.unionByName(found)
    return out if out is not None else spark.createDataFrame([], schema)


def drop_leaks(
    docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY, text: str = "text", item_id: str = "item_id", item_text: str = "text",
    block: int = ITEMS,
) -> DataFrame:
    """``docs`` without the documents that hold a benchmark item; columns as they were."""
    names = docs.columns
    plain = docs.toDF(*[f"c{i}" for i in range(len(names))])
    plain = plain.withColumn(f"c{len(names)}", F.lower(F.col(f"c{names.index(text)}")))
    kind = plain.schema
    for items in _item_blocks(benchmark, item_id, item_text, block):
        plain = plain.mapInArrow(_clean(docs.sparkSession.sparkContext.broadcast(items), least), kind)
    return plain.drop(f"c{len(names)}").toDF(*names)
