"""Exact ranked search over bit-sliced Bloom signatures.

Every document gets a Bloom signature of its terms, and of each term again for
every power of two that its frequency reaches. Documents with signatures of
one length lie side by side in blocks: a slice is one bit of all signatures of
a block, so a term's documents are the AND of a few slices. They hold all
documents that have the term and a few that do not.

The slices of a term, weighted by what the term can add at that frequency, sum
to an upper bound of each document's score. The documents with the largest
bounds are scored exactly, which gives the least score that an answer must
have; then every document whose bound reaches it is scored exactly. No document
is left out unless its bound proves that it is not among the answers.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .words import U, byte_view, mix, plain_letters, slices, word_ends, word_hashes

#: Fixed values of the score: length share in per cent, scale, saturation.
LENGTH, SCALE, SATURATION = 25, 1_000_000_000, 12
TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
TOP = 20
#: Items looked up in one pass over the index.
ITEMS = 1024
#: Signature bits for each key, slices for each key, bits of a block, most documents and most slices of one.
KEY_BITS, PROBES, BLOCK_BITS, BLOCK_DOCS, MOST_SLICES = 10, 4, 1 << 24, 1024, 1 << 21
#: Documents scored exactly for the least score of an item's answers.
SEEDS = 64
#: Terms whose slices are held at a time.
_TERMS = 4096
_LEVELS = 16
_LETTERS = plain_letters()
_UPPER = {c: c + 32 for c in range(65, 91)}
#: Bits of a term's hash that go into signatures; rows of a slice of texts take the others.
_HASH = U(20)


def _probe(terms: np.ndarray, level: int, bits: int) -> np.ndarray:
    """Slices of each term at a level, ``PROBES`` in a row; ``bits`` is a power of two."""
    first = mix(terms + U(level * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
    step = mix(first) | U(1)
    return ((first[:, None] + np.arange(PROBES, dtype=U) * step[:, None]) & U(bits - 1)).astype(np.int64)


def _add(tf, length):
    """What a term adds for each unit of its weight."""
    return (SCALE * tf) // (1000 * tf + SATURATION * length)


@dataclass(frozen=True)
class Query:
    """A block of items: their terms in order of hash, and which terms each item has how often."""

    ids: list
    terms: list[bytes]
    hashes: np.ndarray
    item_terms: list[np.ndarray]
    item_counts: list[np.ndarray]

    @cached_property
    def lengths(self) -> np.ndarray:
        return np.array([len(t) for t in self.terms], np.int64)

    @cached_property
    def letters(self) -> tuple[np.ndarray, np.ndarray]:
        return np.frombuffer(b"".join(self.terms), np.uint8), np.cumsum(self.lengths) - self.lengths

    @cached_property
    def heads(self) -> np.ndarray:
        """Which first 16 bits the hashes have."""
        table = np.zeros(1 << 16, bool)
        table[self.hashes >> U(48)] = True
        return table


def query_of(rows: list[tuple]) -> Query:
    found = [TERM.findall((text or "").translate(_UPPER)) for _, text in rows]
    terms = sorted({t.encode() for own in found for t in own})
    data = np.frombuffer(b" ".join(terms), np.uint8)
    hashes = word_hashes(data, np.array([0, len(data)]), _LETTERS)[0]
    order = np.argsort(hashes, kind="stable")
    number = {terms[k].decode(): i for i, k in enumerate(order.tolist())}
    pairs = [np.unique(np.array([number[t] for t in own], np.int64), return_counts=True) for own in found]
    return Query([i for i, _ in rows], [terms[k] for k in order.tolist()], hashes[order], [p[0] for p in pairs], [p[1] for p in pairs])


def _occurrences(content: np.ndarray, starts: np.ndarray, query: Query, found: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Text and term of every occurrence of a query term; lengths and bytes are compared, not hashes alone."""
    hashes, places, first = found
    at = np.flatnonzero(query.heads[hashes >> U(48)]) if len(query.terms) else np.zeros(0, np.int64)
    term = np.searchsorted(query.hashes, hashes[at])
    same = query.hashes[np.minimum(term, len(query.hashes) - 1)] == hashes[at] if len(at) else np.zeros(0, bool)
    at, term = at[same], term[same]
    if not len(at):
        return at, at
    size = word_ends(content, starts, _LETTERS)[at] - places[at]
    fits = size == query.lengths[term]
    at, term, size = at[fits], term[fits], size[fits]
    letters, begin = query.letters
    inner = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
    own = content[int(starts[0]) + np.repeat(places[at], size) + inner]
    own = np.where((own >= 65) & (own <= 90), own + 32, own)
    equal = own == letters[np.repeat(begin[term], size) + inner]
    whole = np.add.reduceat(equal, np.cumsum(size) - size) == size if len(at) else fits
    return np.searchsorted(first, at[whole], "right") - 1, term[whole]


class _Block:
    """Signatures of one length that are still being gathered."""

    def __init__(self, bits: int, most: int) -> None:
        self.bits, self.most = bits, int(min(most, max(8, BLOCK_BITS // bits)))
        self.docs: list = []
        self.sizes: list = []
        self.places: list[np.ndarray] = []

    def row(self) -> tuple:
        table = np.zeros((self.bits, -(-len(self.docs) // 8) * 8), bool)
        for column, places in enumerate(self.places):
            table[places, column] = True
        return self.bits, self.docs, self.sizes, np.packbits(table, axis=1, bitorder="little").tobytes()


def _signatures(found: tuple, key_bits: int) -> Iterator[tuple[int, int, int, np.ndarray]]:
    """Text, number of terms, signature length and set bits, for each text with terms."""
    hashes, _, first = found
    sizes = np.diff(first)
    row = np.repeat(np.arange(len(sizes), dtype=U), sizes)
    key, tf = np.unique((row << (U(64) - _HASH)) | (hashes >> _HASH), return_counts=True)
    of, term = (key >> (U(64) - _HASH)).astype(np.int64), key & ((U(1) << (U(64) - _HASH)) - U(1))
    level = np.minimum(np.frexp(tf)[1] - 1, _LEVELS - 1)
    edges = np.searchsorted(of, np.arange(len(sizes) + 1))
    for text in np.flatnonzero(sizes):
        own, high = term[edges[text] : edges[text + 1]], level[edges[text] : edges[text + 1]]
        keys = int(len(own) + high.sum())
        bits = int(min(MOST_SLICES, max(64, 1 << (key_bits * keys - 1).bit_length())))
        places = [_probe(own[high >= k], k, bits).ravel() for k in range(int(high.max()) + 1)]
        yield int(text), int(sizes[text]), bits, np.concatenate(places)


_INDEX = "bits int, docs array<{id}>, sizes array<long>, slices binary, n_docs long, n_terms long, terms array<long>, held array<long>"


def build_index(docs: DataFrame, query: Query | None = None, key_bits: int = KEY_BITS, block_docs: int = BLOCK_DOCS) -> DataFrame:
    """Blocks of signatures of ``docs(doc_id, text)``, and per task the counts of documents and terms, as a written table.

    With a query, also how many documents hold each of its terms.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = _INDEX.format(id=kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        blocks: dict[int, _Block] = {}
        n_docs = n_terms = 0
        held = np.zeros(len(query.terms) if query else 0, np.int64)
        ids_type = None

        def out(bits=None, docs=None, sizes=None, cut=None, totals=(None, None, None, None)):
            columns = [
                pa.array([bits], pa.int32()), pa.array([docs], pa.list_(ids_type)), pa.array([sizes], pa.list_(pa.int64())),
                pa.array([cut], pa.binary()), pa.array([totals[0]], pa.int64()), pa.array([totals[1]], pa.int64()),
                pa.array([totals[2]], pa.list_(pa.int64())), pa.array([totals[3]], pa.list_(pa.int64())),
            ]
            return pa.RecordBatch.from_arrays(columns, ["bits", "docs", "sizes", "slices", "n_docs", "n_terms", "terms", "held"])

        for batch in batches:
            ids_type = batch.column(0).type
            ids = batch.column(0).to_pylist()
            content, starts = byte_view(batch.column(1))
            for first, last in slices(starts):
                part = starts[first : last + 1]
                found = word_hashes(content, part, _LETTERS)
                n_docs += int((np.diff(found[2]) > 0).sum())
                n_terms += len(found[0])
                if query:
                    row, term = _occurrences(content, part, query, found)
                    each = np.unique(row * len(query.terms) + term)
                    held += np.bincount(each % len(query.terms), minlength=len(held)) if len(each) else 0
                for text, size, bits, places in _signatures(found, key_bits):
                    block = blocks.setdefault(bits, _Block(bits, block_docs))
                    block.docs.append(ids[first + text])
                    block.sizes.append(size)
                    block.places.append(places)
                    if len(block.docs) == block.most:
                        yield out(*blocks.pop(bits).row())
        for block in blocks.values():
            yield out(*block.row())
        if n_docs:
            some = np.flatnonzero(held)
            yield out(totals=(n_docs, n_terms, some.tolist(), held[some].tolist()))

    return materialize(docs.select("doc_id", "text").mapInArrow(run, schema), "signatures")


def _weights(index: DataFrame, query: Query) -> tuple[int, int, np.ndarray]:
    """Documents, terms, and the weight of each query term (0 if no document has it)."""
    sums = index.agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n_docs, n_terms = int(sums[0] or 0), int(sums[1] or 0)
    pairs = index.select(F.explode(F.arrays_zip("terms", "held")).alias("p")).groupBy("p.terms").agg(F.sum("p.held").alias("df"))
    weights = np.zeros(len(query.terms), np.int64)
    for term, df in pairs.collect():
        weights[term] = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))
    return n_docs, n_terms, weights


def _length(sizes: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    return 100 - LENGTH + (LENGTH * sizes * n_docs) // n_terms


def block_bounds(bits: int, sizes: np.ndarray, cut: bytes, query: Query, weights: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """Upper bound of the score of each item (rows) in each document of a block (columns)."""
    table = np.frombuffer(cut, np.uint8).reshape(bits, -1)
    length = _length(sizes, n_docs, n_terms)
    out = np.zeros((len(query.ids), len(sizes)))
    # The most that a term adds up to each level; the last one has no upper end.
    most = [_add((2 << k) - 1, length) if k < _LEVELS - 1 else np.full(len(sizes), SCALE // 1000) for k in range(_LEVELS)]
    for low in range(0, len(query.terms), _TERMS):
        hashes = query.hashes[low : low + _TERMS] >> _HASH
        bounds = np.zeros((len(hashes), len(sizes)))
        left, reached = np.arange(len(hashes)), None
        for level in range(_LEVELS):
            rows = table[_probe(hashes[left], level, bits)]
            held = np.bitwise_and.reduce(rows, axis=1)
            held = held if reached is None else held & reached
            some = held.any(axis=1)
            left, reached = left[some], held[some]
            if not len(left):
                break
            step = most[level] - (most[level - 1] if level else 0)
            bounds[left] += np.unpackbits(reached, axis=1, count=len(sizes), bitorder="little") * step
        for item, terms in enumerate(query.item_terms):
            a, b = np.searchsorted(terms, (low, low + _TERMS))
            if a < b:
                out[item] += (weights[terms[a:b]] * query.item_counts[item][a:b]).astype(np.float64) @ bounds[terms[a:b] - low]
    return out


def _bound_rows(index: DataFrame, query: Query, weights: np.ndarray, n_docs: int, n_terms: int, least: np.ndarray | None, seeds: int = SEEDS) -> DataFrame:
    """``item, doc_id, bound``: documents whose bound is ``least`` or more, or without it the ``seeds`` best of each task."""
    kind = index.schema["docs"].dataType.elementType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: list[list[tuple]] = [[] for _ in query.ids]
        ids_type = None

        def out(item, docs, bounds):
            return pa.RecordBatch.from_arrays(
                [pa.array(item, pa.int32()), docs, pa.array(bounds, pa.float64())], ["item", "doc_id", "bound"]
            )

        for batch in batches:
            for row in range(batch.num_rows):
                docs = batch.column(1)[row].values
                ids_type = docs.type
                sizes = np.array(batch.column(2)[row].values, np.int64)
                bounds = block_bounds(batch.column(0)[row].as_py(), sizes, batch.column(3)[row].as_py(), query, weights, n_docs, n_terms)
                if least is not None:
                    item, at = np.nonzero(bounds >= least[:, None])
                    if len(item):
                        yield out(item, docs.take(pa.array(at)), bounds[item, at])
                    continue
                some = min(seeds, bounds.shape[1])
                top = np.argpartition(bounds, bounds.shape[1] - some, axis=1)[:, bounds.shape[1] - some :]
                for item, at in enumerate(top):
                    own = [(bounds[item, k], int(k)) for k in at if bounds[item, k] > 0]
                    if own:
                        best[item] += [(bound, docs[k].as_py()) for bound, k in own]
                        if len(best[item]) > 8 * seeds:
                            best[item] = sorted(best[item], key=lambda x: -x[0])[:seeds]
        for item, own in enumerate(best):
            own = sorted(own, key=lambda x: -x[0])[:seeds]
            if own:
                yield out([item] * len(own), pa.array([d for _, d in own], ids_type), [b for b, _ in own])

    blocks = index.filter("bits is not null").select("bits", "docs", "sizes", "slices")
    return blocks.mapInArrow(run, f"item int, doc_id {kind}, bound double")


def _exact(docs: DataFrame, wanted: DataFrame, query: Query, weights: np.ndarray, n_docs: int, n_terms: int) -> DataFrame:
    """``item, doc_id, score`` of the wanted items of each document, from its whole text."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    lists = wanted.groupBy("doc_id").agg(F.collect_set("item").alias("items"))
    marked = lists.select(F.col("doc_id").alias("_id"), "items")
    joined = docs.join(marked, docs["doc_id"].eqNullSafe(marked["_id"])).select("doc_id", "text", "items")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = len(query.terms)
        for batch in batches:
            content, starts = byte_view(batch.column(1))
            for first, last in slices(starts):
                part = starts[first : last + 1]
                found = word_hashes(content, part, _LETTERS)
                row, term = _occurrences(content, part, query, found)
                key, tf = np.unique(row * count + term, return_counts=True)
                items = batch.column(2).slice(first, last - first)
                item = np.array(items.flatten(), np.int64)
                of = np.repeat(np.arange(last - first), np.array(items.value_lengths(), np.int64))
                if not len(key) or not len(item):
                    continue
                length = _length(np.diff(found[2]), n_docs, n_terms)
                terms = np.concatenate([query.item_terms[k] for k in item])
                times = np.concatenate([query.item_counts[k] for k in item])
                each = np.array([len(query.item_terms[k]) for k in item])
                text = np.repeat(of, each)
                at = np.minimum(np.searchsorted(key, text * count + terms), len(key) - 1)
                has = np.where(key[at] == text * count + terms, tf[at], 0)
                added = times * weights[terms] * _add(has, length[text])
                total = np.concatenate([[0], np.cumsum(added)])
                ends = np.cumsum(each)
                score = total[ends] - total[ends - each]
                good = np.flatnonzero(score > 0)
                ids = batch.column(0).take(pa.array(first + of[good]))
                yield pa.RecordBatch.from_arrays([pa.array(item[good].astype(np.int32)), ids, pa.array(score[good])], ["item", "doc_id", "score"])

    return joined.mapInArrow(run, f"item int, doc_id {kind}, score long")


def _blocks_of(items: DataFrame, size: int) -> Iterator[list[tuple]]:
    rows: list[tuple] = []
    for row in items.toLocalIterator():
        rows.append(tuple(row))
        if len(rows) == size:
            yield rows
            rows = []
    if rows:
        yield rows


def search(
    docs: DataFrame, items: DataFrame, top: int = TOP, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id",
    item_text: str = "text", block: int = ITEMS, seeds: int = SEEDS, key_bits: int = KEY_BITS, block_docs: int = BLOCK_DOCS,
) -> DataFrame:
    """The ``top`` documents with the highest scores above 0 for every item: ``item_id, rank, doc_id, score``.

    Items are the query set and go through in blocks of ``block``; each block is
    held against every document. Equal scores go by ascending ``doc_id``, null
    last, then any order of repeated rows, each of which counts. Null and empty
    texts have no terms: as documents they do not count, as items they have no
    answers. An item that stands twice is answered twice. Other columns are not
    read; an empty table on either side gives no rows. ``seeds``, ``key_bits`` and
    ``block_docs`` change what is scored exactly, not the answers.
    """
    docs = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    items = items.select(F.col(item_id).alias("item_id"), F.col(item_text).alias("text"))
    kinds = f"item int, item_id {items.schema['item_id'].dataType.simpleString()}"
    answers = None
    index = None
    for rows in _blocks_of(items, block):
        query = query_of(rows)
        if not query.terms:
            continue
        # Signatures do not depend on the items and serve all blocks; the counts of a block's terms are its own.
        counted = build_index(docs, query, key_bits, block_docs) if index is None else _held(docs, query, index)
        index = counted if index is None else index
        n_docs, n_terms, weights = _weights(counted, query)
        if not n_docs:
            break
        totals = (query, weights, n_docs, n_terms)
        best = Window.partitionBy("item").orderBy(F.col("bound").desc())
        first = _bound_rows(index, *totals, None, seeds).withColumn("turn", F.row_number().over(best)).filter(F.col("turn") <= seeds)
        order = Window.partitionBy("item").orderBy(F.col("score").desc(), F.col("doc_id").asc_nulls_last())
        ranked = _exact(docs, first, *totals).withColumn("rank", F.row_number().over(order))
        least = np.ones(len(rows))
        for item, score in ranked.filter(F.col("rank") == top).select("item", "score").collect():
            least[item] = score
        wanted = _bound_rows(index, *totals, least)
        names = docs.sparkSession.createDataFrame([(k, i) for k, i in enumerate(query.ids)], kinds)
        scored = _exact(docs, wanted, *totals).withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)
        named = scored.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
        answers = named if answers is None else answers.unionByName(named)
    if answers is None:
        empty = f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id {docs.schema['doc_id'].dataType.simpleString()}, score long"
        return docs.sparkSession.createDataFrame([], empty)
    return answers


def _held(docs: DataFrame, query: Query, index: DataFrame) -> DataFrame:
    """Counts of a further block's terms, beside the totals of the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(len(query.terms), np.int64)
        for batch in batches:
            content, starts = byte_view(batch.column(0))
            for first, last in slices(starts):
                part = starts[first : last + 1]
                row, term = _occurrences(content, part, query, word_hashes(content, part, _LETTERS))
                each = np.unique(row * len(held) + term)
                held += np.bincount(each % len(held), minlength=len(held)) if len(each) else 0
        some = np.flatnonzero(held)
        yield pa.RecordBatch.from_arrays(
            [pa.array([some.tolist()], pa.list_(pa.int64())), pa.array([held[some].tolist()], pa.list_(pa.int64()))], ["terms", "held"]
        )

    counted = docs.select("text").mapInArrow(run, "terms array<long>, held array<long>")
    totals = index.filter("n_docs is not null").select("n_docs", "n_terms")
    return materialize(totals.unionByName(counted, allowMissingColumns=True), "held")
