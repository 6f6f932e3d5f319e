"""Long byte strings that occur more than once, found by sorting sparse suffixes with hashed comparisons.

A string of ``LENGTH`` bytes is a repeat if it starts at another place too.
Which places to look at follows from the bytes: the smallest hash among the
``GRAM``-byte strings of a window is its anchor, so equal windows have equal
anchors at the same distance, and a text has few. An anchor stands for all
windows that chose it; they lie within its context.

Anchors that occur once are done. Where all contexts of an anchor are equal,
every window repeats. The others are moved once and sorted by what follows the
anchor: a mergesort whose comparisons find the common extension of two suffixes
by binary search over prefix polynomial hashes. Neighbours whose extension
reaches the window's end form a class, classes are split by the hash of what
precedes the anchor, and the bytes of what then counts as equal are compared.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .words import U, byte_view, mix, powers, slices

LENGTH, GRAM = 200, 32
#: Bytes of text whose anchors are found at a time.
SLICE = 1 << 19
#: Bits of a place in a slice; the rest of a number compares hashes.
_PLACE = U(34)
_BYTE = mix(np.arange(1, 257, dtype=U) * U(0x8EBC6AF09C88C6E3)) | U(1)
_OTHER = mix(np.arange(1, 257, dtype=U) * U(0x589965CC75374CC3)) | U(1)
#: Contexts compared at a time.
_CONTEXTS = 8_192


def _prefix(data: np.ndarray, table: np.ndarray = _BYTE) -> np.ndarray:
    """Polynomial hashes of all prefixes of ``data``."""
    out = np.zeros(len(data) + 1, U)
    np.cumsum(table[data] * powers(len(data) + 1)[0][: len(data)], out=out[1:])
    return out


def _run(prefix: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hash of each run of bytes, wherever it stands."""
    return (prefix[end] - prefix[begin]) * powers(len(prefix))[1][begin]


def _sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Smallest of each ``width`` values in a row."""
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(U).max, U)
    padded[: len(values)] = values
    table = padded.reshape(blocks, width)
    up = np.minimum.accumulate(table, axis=1).ravel()
    down = np.minimum.accumulate(table[:, ::-1], axis=1)[:, ::-1].ravel()
    count = len(values) - width + 1
    return np.minimum(down[:count], up[width - 1 : width - 1 + count])


def anchors(content: np.ndarray, starts: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """``row, place, low, high, gram hash, context hash`` arrays; windows low to high of a text chose its byte ``place``."""
    begin, end = int(starts[0]), int(starts[-1])
    data = content[begin:end]
    empty = np.zeros(0, np.int64)
    if len(data) < length:
        return empty, empty, empty, empty, empty.astype(U), empty.astype(U)
    prefix = _prefix(data)
    grams = mix((prefix[gram:] - prefix[:-gram]) * powers(len(prefix))[1][: len(data) - gram + 1])
    ranked = (grams >> _PLACE << _PLACE) | np.arange(len(grams), dtype=U)
    chosen = (_sliding_min(ranked, length - gram + 1) & ((U(1) << _PLACE) - U(1))).astype(np.int64)
    # Windows stay inside their text.
    edges = starts - begin
    sizes = np.diff(edges)
    inside = np.zeros(len(data) + 1, np.int8)
    fits = sizes >= length
    np.add.at(inside, edges[:-1][fits], 1)
    np.add.at(inside, edges[1:][fits] - length + 1, -1)
    valid = np.flatnonzero(np.cumsum(inside)[: len(chosen)])
    picked = chosen[valid]
    new = np.ones(len(valid), bool)
    new[1:] = (picked[1:] != picked[:-1]) | (valid[1:] != valid[:-1] + 1)
    at = np.flatnonzero(new)
    low = valid[at]
    high = valid[np.append(at[1:], len(valid)) - 1]
    place = picked[at]
    other = _prefix(data, _OTHER)
    shape = (place - low).astype(U) * U(0x9E3779B97F4A7C15) + (high - low).astype(U)
    context = mix(_run(other, low, high + length) + mix(shape))
    row = np.searchsorted(edges, low, "right") - 1
    base = edges[row]
    return row, place - base, low - base, high - base, grams[place], context


def _anchor_rows(length: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content, starts = byte_view(batch.column(1))
            for first, last in slices(starts, SLICE):
                row, place, low, high, grams, context = anchors(content, starts[first : last + 1], length, gram)
                if len(row):
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(grams.view(np.int64)),
                            pa.array(context.view(np.int64)),
                            batch.column(0).take(pa.array(first + row)),
                            pa.array(place.astype(np.int32)),
                            pa.array((place - low).astype(np.int16)),
                            pa.array((high - low).astype(np.int16)),
                        ],
                        ["gram", "context", "key", "place", "before", "windows"],
                    )

    return run


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts as compressed bytes, for the shuffles; the last column is the text."""
    packer = zstandard.ZstdCompressor(level=1)
    for batch in batches:
        content, starts = byte_view(batch.column(batch.num_columns - 1))
        packed = [packer.compress(content[a:b].tobytes()) for a, b in zip(starts[:-1], starts[1:])]
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(packed, pa.binary())], [f"c{k}" for k in range(batch.num_columns)])


def _cut_contexts(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for key, packed, wanted in zip(*(batch.column(k).to_pylist() for k in range(2)), batch.column(2)):
                text = opener.decompress(packed)
                for w in wanted.as_py():
                    low = w["place"] - w["before"]
                    rows.append((w["gram"], key, w["place"], w["before"], w["windows"], w["known"], text[low : low + w["windows"] + length]))
            if rows:
                columns = list(zip(*rows))
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int16(), pa.int16(), pa.bool_(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], ["gram", "key", "place", "before", "windows", "known", "bytes"])

    return run


class Suffixes:
    """What follows the anchors of some contexts, comparable by hashes."""

    def __init__(self, texts: list[bytes], before: np.ndarray) -> None:
        data = np.frombuffer(b"".join(texts), np.uint8)
        self.ends = np.cumsum([len(t) for t in texts])
        self.starts = np.concatenate([[0], self.ends[:-1]]) + before
        self.begins = self.starts - before
        self.prefix = _prefix(data)
        self.data = data

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of the suffixes of each pair."""
        low = np.zeros(len(a), np.int64)
        high = np.minimum(self.ends[a] - self.starts[a], self.ends[b] - self.starts[b])
        sa, sb = self.starts[a], self.starts[b]
        while True:
            open_ = low < high
            if not open_.any():
                return low
            middle = (low + high + 1) >> 1
            same = _run(self.prefix, sa, sa + middle) == _run(self.prefix, sb, sb + middle)
            low = np.where(open_ & same, middle, low)
            high = np.where(open_ & ~same, middle - 1, high)

    def below(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-1, 0 or 1 for each pair as the suffix of a is smaller than, equal to or larger than that of b."""
        shared = self.common(a, b)
        pa_, pb = self.starts[a] + shared, self.starts[b] + shared
        last = len(self.data) - 1
        va = np.where(pa_ < self.ends[a], self.data[np.minimum(pa_, last)].astype(np.int16), -1)
        vb = np.where(pb < self.ends[b], self.data[np.minimum(pb, last)].astype(np.int16), -1)
        return np.sign(va - vb)

    def sort(self, group: np.ndarray) -> np.ndarray:
        """Order of the suffixes within their groups; ``group`` holds rising numbers, one per suffix.

        A mergesort from runs of one: an element's place in two merged runs is
        its place in its own plus the number of smaller ones in the other.
        """
        order = np.arange(len(group))
        first = np.searchsorted(group, group)
        size = np.searchsorted(group, group, "right") - first
        width = 1
        while width < size.max(initial=0):
            at = np.flatnonzero(size > width)  # places in groups that still have two runs
            inside = at - first[at]
            run = inside // width
            pair = first[at] + (run // 2) * 2 * width
            left = run % 2 == 0
            limit = first[at] + size[at]
            low = np.where(left, np.minimum(pair + width, limit), pair)
            high = np.where(left, np.minimum(pair + 2 * width, limit), pair + width)
            begin = low.copy()
            own = order[at]
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) >> 1
                sign = self.below(order[middle], own[open_])
                # Equal ones of the left run come first.
                smaller = np.where(left[open_], sign < 0, sign <= 0)
                low[open_] = np.where(smaller, middle + 1, low[open_])
                high[open_] = np.where(smaller, high[open_], middle)
            place = pair + (inside - run * width) + (low - begin)
            merged = order.copy()
            merged[place] = own
            order = merged
            width *= 2
        return order


def repeated_windows(texts: list[bytes], group: np.ndarray, before: np.ndarray, windows: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Which windows of each context occur in another context of its group (contexts x distances before the anchor)."""
    suffixes = Suffixes(texts, before)
    order = suffixes.sort(group)
    shared = np.zeros(len(order), np.int64)
    shared[1:] = suffixes.common(order[:-1], order[1:])
    new = np.ones(len(order), bool)
    new[1:] = group[order[1:]] != group[order[:-1]]
    start = suffixes.starts[order]
    own_before, own_least = before[order], before[order] - windows[order]
    found = np.zeros((len(order), int(before.max(initial=0)) + 1), bool)
    data, checked = suffixes.data, []
    for distance in range(found.shape[1]):
        here = np.flatnonzero((own_least <= distance) & (distance <= own_before))
        if not len(here):
            continue
        classes = np.cumsum(new | (shared < length - distance))[here]
        left = _run(suffixes.prefix, start[here] - distance, start[here])
        key = mix(left + mix(classes.astype(U)))
        by = np.argsort(key, kind="stable")
        same = key[by][1:] == key[by][:-1]
        one, two = here[by[:-1][same]], here[by[1:][same]]
        found[one, distance] = found[two, distance] = True
        checked.append((one, two, distance))
    # The bytes of what hashes call equal; each pair's longest reach is compared once.
    reach: dict[tuple[int, int], tuple[int, int]] = {}
    for one, two, distance in checked:
        for pair in zip(one.tolist(), two.tolist()):
            low, high = reach.get(pair, (distance, distance))
            reach[pair] = (min(low, distance), max(high, distance))
    for (one, two), (low, high) in reach.items():
        a, b = int(start[one]), int(start[two])
        if data[a - high : a].tobytes() != data[b - high : b].tobytes() or data[a : a + length - low].tobytes() != data[b : b + length - low].tobytes():
            raise ValueError("two different strings have one hash")
    out = np.zeros_like(found)
    out[order] = found
    return out


def _compare(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Contexts come sorted by gram; a gram's contexts are compared together."""
        held: list[pa.RecordBatch] = []

        def solve(table: pa.Table) -> Iterator[pa.RecordBatch]:
            grams, keys, place, before, windows, known = (table.column(k).to_numpy() for k in range(6))
            group = np.cumsum(np.append([0], grams[1:] != grams[:-1]))
            before, windows = before.astype(np.int64), windows.astype(np.int64)
            found = repeated_windows(table.column(6).to_pylist(), group, before, windows, length)
            found[known] = False  # all their windows are known to repeat
            edge = np.diff(np.pad(found.astype(np.int8), ((0, 0), (1, 1))), axis=1)
            row, near = np.nonzero(edge == 1)
            far = np.nonzero(edge == -1)[1] - 1
            if len(row):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[row]), pa.array((place[row] - far).astype(np.int32)), pa.array((place[row] - near).astype(np.int32))], ["key", "low", "high"]
                )

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < _CONTEXTS:
                continue
            table = pa.Table.from_batches(held)
            grams = table.column(0).to_numpy()
            cut = int(np.searchsorted(grams, grams[-1]))
            if cut:
                yield from solve(table.slice(0, cut).combine_chunks())
                held = table.slice(cut).combine_chunks().to_batches()
        if held:
            table = pa.Table.from_batches(held)
            if table.num_rows:
                yield from solve(table.combine_chunks())

    return run


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opener = zstandard.ZstdDecompressor()
        for batch in batches:
            rows = []
            for packed, ranges in zip(batch.column(1).to_pylist(), batch.column(2)):
                text = opener.decompress(packed)
                spans = []
                for low, high in sorted((r["low"], r["high"] + length) for r in ranges.as_py() or ()):
                    if spans and low <= spans[-1][1]:
                        spans[-1][1] = max(spans[-1][1], high)
                    else:
                        spans.append([low, high])
                digest, at = hashlib.sha256(), 0
                for low, high in spans:
                    digest.update(text[at:low])
                    at = high
                digest.update(text[at:])
                rows.append((len(text), sum(b - a for a, b in spans), len(spans), digest.hexdigest(), [{"start": a, "end": b} for a, b in spans]))
            columns = list(zip(*rows)) if rows else [[]] * 5
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, k in zip(columns, kinds))], ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
            )

    return run


def _keyed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """``key, doc_id, text`` with a 64-bit key of id and text; another salt is taken if two different rows share one."""
    salt = 0
    while True:
        rows = docs.select(F.xxhash64(F.lit(salt), F.col(doc_id), F.col(text)).alias("key"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
        print_ = F.md5(F.to_json(F.struct("doc_id", "text")))
        if rows.groupBy("key").agg(F.min(print_).alias("a"), F.max(print_).alias("b")).filter("a <> b").isEmpty():
            return rows
        salt += 1


def cut_repeats(docs: DataFrame, length: int = LENGTH, gram: int = GRAM, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` for every document, as UTF-8 bytes.

    Every byte is removed that lies in a string of ``length`` bytes which also
    starts anywhere else, in the same text too, overlaps included. Null and
    empty texts have 0 bytes; texts shorter than ``length`` keep all. Repeated
    rows are places of their own, so both lose what they share. ``spans`` are
    the maximal removed runs. Other columns are not read.

    A gram's contexts are counted before they are moved, equal ones as one, so
    a passage that a third of all texts hold costs what its edges cost.
    """
    rows = _keyed(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), "doc_id", "text")
    schema = "gram long, context long, key long, place int, before short, windows short"
    found = rows.select("key", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_anchor_rows(length, gram), schema)
    grams = found.groupBy("gram").agg(F.count("*").alias("n"), F.min("context").alias("a"), F.max("context").alias("b")).filter("n > 1")
    shared = found.join(grams.select("gram", (F.col("a") != F.col("b")).alias("mixed")), "gram")
    shared = materialize(shared, "anchors")

    # Contexts that occur twice, and one of each kind to compare the others with.
    kinds = shared.filter("mixed").groupBy("gram", "context").agg(F.count("*").alias("n"), F.min(F.struct("key", "place", "before", "windows")).alias("one"))
    kinds = materialize(kinds, "contexts")
    wanted = kinds.select("one.key", F.struct("gram", "one.place", "one.before", "one.windows", (F.col("n") > 1).alias("known")).alias("w"))
    wanted = wanted.groupBy("key").agg(F.collect_list("w").alias("wanted"))
    packed = rows.select("key", "doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(_pack, "c0 long, c1 long, c2 binary").toDF("key", "doc_id", "packed")
    # A row that is repeated is opened once.
    texts = packed.select("key", "packed").join(wanted, "key").select("key", "packed", "wanted").dropDuplicates(["key"])
    contexts = texts.mapInArrow(_cut_contexts(length), "gram long, key long, place int, before short, windows short, known boolean, bytes binary")
    compared = contexts.repartition("gram").sortWithinPartitions("gram").mapInArrow(_compare(length), "key long, low int, high int")

    first = F.col("place") - F.col("before")
    equal = shared.filter(~F.col("mixed"))
    twice = shared.filter("mixed").join(kinds.filter("n > 1").select("gram", "context"), ["gram", "context"])
    whole = equal.select("key", "place", "before", "windows").union(twice.select("key", "place", "before", "windows"))
    ranges = whole.select("key", first.cast("int").alias("low"), (first + F.col("windows")).cast("int").alias("high")).union(compared)
    per_text = ranges.groupBy("key").agg(F.collect_set(F.struct("low", "high")).alias("ranges"))
    joined = packed.join(per_text, "key", "left").select("doc_id", "packed", "ranges")
    return joined.mapInArrow(
        _cut(length), "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"
    )
