"""Near duplicates by SuperMinHash signatures, banding, full verification and union-find.

A SuperMinHash signature gives every shingle a random order of the slots and
lets it claim the slot of its j-th choice with a value in [j, j + 1). As soon
as every slot holds a value below j, no later choice can win, so a text of
many shingles needs two or three choices of each. Slots depend on each other,
which makes the estimate tighter than independent minima do.

Texts with one set of shingles are one class, so copies are never compared.
Classes that agree on whole bands are candidates, and every link is confirmed
on the full sets.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from .common import keep_rows, row_key
from .components import components
from .words import U, byte_view, mix, shingle_hashes, slices, word_hashes

#: 30 bands of 5 slots: two sets of similarity 0.85 miss all but one band with a chance of 6e-7, of 0.8 with 1e-4.
BANDS, ROWS = 30, 5
#: Turns in which a class is compared with one member of each bucket.
TURNS = 2
#: Words of 64 bits in which the parity of a set's hashes is kept.
PARITY = 8
#: Choices made without a table of each shingle's order; later ones are for short texts only.
_SPARSE = 6


def _distinct(shingles: np.ndarray, begin: np.ndarray) -> list[np.ndarray]:
    return [np.unique(shingles[a:b]) for a, b in zip(begin[:-1], begin[1:])]


def super_min_hash(sets: list[np.ndarray], slots: int) -> np.ndarray:
    """Signatures (sets x slots, float64) of arrays of distinct 64-bit hashes; an empty set's are infinite."""
    count = np.array([len(s) for s in sets], np.int64)
    owner = np.repeat(np.arange(len(sets)), count)
    item = np.concatenate(sets) if len(owner) else np.zeros(0, U)
    values = np.full(len(sets) * slots, np.inf)
    swaps: list[np.ndarray] = []
    order = None
    for j in range(slots):
        if not len(item):
            break
        state = mix(item + U((j + 1) * 0x9E3779B97F4A7C15 & 0xFFFFFFFFFFFFFFFF))
        other = j + ((state >> U(32)) * U(slots - j) >> U(32)).astype(np.int64)
        value = j + (mix(state) >> U(11)).astype(np.float64) / (1 << 53)
        if order is None and j >= _SPARSE:
            order = np.tile(np.arange(slots, dtype=np.int16), (len(item), 1))
            rows = np.arange(len(item))
            for t, k in enumerate(swaps):
                order[rows, t], order[rows, k] = order[rows, k], order[rows, t].copy()
        if order is None:
            slot = other.copy()  # where the chosen place's content stood at first
            for t in range(j - 1, -1, -1):
                k = swaps[t]
                slot = np.where(slot == k, t, np.where(slot == t, k, slot))
            swaps.append(other)
        else:
            rows = np.arange(len(item))
            slot = order[rows, other].astype(np.int64)
            order[rows, other] = order[rows, j]
            order[rows, j] = slot
        np.minimum.at(values, owner * slots + slot, value)
        # A set whose slots are all below j + 1 is done.
        still = values.reshape(len(sets), slots).max(axis=1) >= j + 1
        keep = still[owner]
        if not keep.all():
            item, owner = item[keep], owner[keep]
            swaps = [k[keep] for k in swaps]
            order = order[keep] if order is not None else None
    return values.reshape(len(sets), slots)


def band_keys(signatures: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """One 64-bit key for each band of each signature; equal keys mean equal slots in the same band."""
    bits = np.ascontiguousarray(signatures).view(U).reshape(len(signatures), bands, rows)
    factors = mix(np.arange(1, rows + 1, dtype=U) * U(0x9FB21C651E98DF25)) | U(1)
    keys = (mix(bits) * factors).sum(axis=2, dtype=U)
    return mix(keys + mix(np.arange(1, bands + 1, dtype=U))).view(np.int64)


def sketches(signatures: np.ndarray) -> np.ndarray:
    """Four bits of each slot, as planes of 64 slots a word (signatures x 4 words each), to count equal slots by xor."""
    slots = signatures.shape[1]
    words = -(-slots // 64)
    codes = np.zeros((len(signatures), words * 64), np.uint8)
    codes[:, :slots] = mix(np.ascontiguousarray(signatures).view(U)) >> U(60)
    planes = [np.packbits(codes >> k & 1, axis=1, bitorder="little").view(np.int64) for k in range(4)]
    return np.concatenate(planes, axis=1)


def equal_slots(a: str, b: str, slots: int) -> Column:
    """In how many slots two sketches agree."""
    words = -(-slots // 64)

    def differ(word: int) -> Column:
        planes = [F.get(a, F.lit(k * words + word)).bitwiseXOR(F.get(b, F.lit(k * words + word))) for k in range(4)]
        return F.bit_count(reduce(Column.bitwiseOR, planes))

    return F.lit(slots) - reduce(Column.__add__, [differ(w) for w in range(words)])


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """For every set, each of 64 * PARITY bits says whether an odd number of its hashes falls on it (sets x words)."""
    bits = 64 * PARITY
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    place = (mix(np.concatenate(sets)) >> U(33)).astype(np.int64) % bits if len(owner) else np.zeros(0, np.int64)
    odd = np.bincount(owner * bits + place, minlength=len(sets) * bits).reshape(len(sets), bits) & 1
    return np.packbits(odd.astype(np.uint8), axis=1, bitorder="little").view(np.int64)


def least_apart(a: str, b: str) -> Column:
    """Shingles that only one of two sets has, at the least: bits that differ, as shared shingles cancel out."""
    return reduce(Column.__add__, [F.bit_count(F.get(a, F.lit(k)).bitwiseXOR(F.get(b, F.lit(k)))) for k in range(PARITY)])


def least_equal(percent: int, slots: int) -> int:
    """Equal slots that a pair of this similarity has but for a chance of 3e-7 (five standard deviations)."""
    share = percent / 100 + (1 - percent / 100) / 16
    return math.floor(slots * share - 5 * math.sqrt(slots * share * (1 - share)))


def _signatures(size: int, bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content, starts = byte_view(batch.column(2))
            for first, last in slices(starts):
                hashes, _, begin = word_hashes(content, starts[first : last + 1])
                sets = _distinct(*shingle_hashes(hashes, begin, size))
                signed = super_min_hash(sets, bands * rows)
                tables = [band_keys(signed, bands, rows), sketches(signed), parities(sets)]
                lists = [pa.ListArray.from_arrays(pa.array(np.arange(len(sets) + 1) * t.shape[1], pa.int32()), pa.array(t.ravel())) for t in tables]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(k).slice(first, last - first) for k in (0, 1)),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], pa.binary()),
                        *lists,
                    ],
                    ["doc_id", "key", "n_shingles", "set_key", "bands", "sketch", "parity"],
                )

    return run


def _sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content, starts = byte_view(batch.column(1))
            for first, last in slices(starts):
                hashes, _, begin = word_hashes(content, starts[first : last + 1])
                sets = _distinct(*shingle_hashes(hashes, begin, size))
                ends = np.concatenate([[0], np.cumsum([len(s) for s in sets])])
                lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(sets).view(np.int64)))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, last - first), lists], ["node", "shingles"])

    return run


def near_duplicates(
    docs: DataFrame, percent: int = 80, size: int = 5, bands: int = BANDS, rows: int = ROWS, doc_id: str = "doc_id", text: str = "text",
) -> DataFrame:
    """Every document with its group: ``doc_id, n_shingles, component_id, kept, key``.

    Two documents are linked when ``100 * common >= percent * all`` of their
    distinct shingles of ``size`` words (lower-cased A-Z). ``component_id`` is
    the smallest doc_id that links reach. Null and empty texts and texts
    without words have no shingles and no links, their component is their own
    id. Repeated rows have one set and so one component. Where a component has
    only null ids its id is null, and its documents are kept. ``key`` is
    ``common.row_key`` of the row; other columns are not read.

    Pairs inside a bucket are not all compared. In each turn every class is
    compared with one member of each of its buckets, the smallest or one by
    chance, if they are not in one component yet; what is linked is joined by
    union-find. A family of thousands is so settled by a few comparisons of
    each. Then all pairs of classes that are still in different components,
    share two bands, agree in enough slots and cannot be seen to differ by too
    much from the parities of their hashes, are compared. So every pair that
    could be a link is in one component already or has been compared.
    """
    slots, enough = bands * rows, least_equal(percent, bands * rows)
    keyed = docs.select(F.col(doc_id).cast("long").alias("doc_id"), row_key(doc_id, text).alias("key"), F.col(text).alias("text"))
    signed = keyed.mapInArrow(
        _signatures(size, bands, rows),
        "doc_id long, key binary, n_shingles long, set_key binary, bands array<long>, sketch array<long>, parity array<long>",
    )
    signed = materialize(signed, "signatures")

    classes = (
        signed.filter("n_shingles > 0")
        .groupBy("set_key")
        .agg(*[F.first(c).alias(c) for c in ("n_shingles", "bands", "sketch", "parity")], F.min("doc_id").alias("least_id"), F.min("key").alias("key"))
        .withColumnRenamed("n_shingles", "n")
        .withColumn("node", F.monotonically_increasing_id())
    )
    classes = materialize(classes, "classes")

    banded = classes.select("node", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.count("*").alias("members")).filter("members > 1").select("band")
    members = materialize(banded.join(shared, "band"), "buckets")

    def fits(a: str, b: str) -> Column:
        """Sizes, parities and slots allow a link."""
        near = F.least(f"{a}_n", f"{b}_n") * 100 >= F.greatest(f"{a}_n", f"{b}_n") * percent
        apart = least_apart(f"{a}_parity", f"{b}_parity") * (100 + percent) <= (F.col(f"{a}_n") + F.col(f"{b}_n")) * (100 - percent)
        return near & apart & (equal_slots(f"{a}_sketch", f"{b}_sketch", slots) >= enough)

    def side(name: str) -> DataFrame:
        return classes.select(F.col("node").alias(name), *[F.col(c).alias(f"{name}_{c}") for c in ("n", "sketch", "parity")])

    def sets_of(nodes: DataFrame) -> DataFrame:
        """Full sets of some classes, from one text of each."""
        texts = keyed.select("key", "text").join(classes.join(nodes, "node", "left_semi").select("key", "node"), "key")
        # Repeated rows have one key: their sets are equal, the first one counts.
        return texts.dropDuplicates(["key"]).select("node", "text").mapInArrow(_sets(size), "node long, shingles array<long>")

    def linked(pairs: DataFrame) -> DataFrame:
        """Of the pairs (a, b), those that full sets confirm."""
        pairs = pairs.distinct().join(side("a"), "a").join(side("b"), "b").filter(fits("a", "b")).select("a", "b", "a_n", "b_n")
        pairs = materialize(pairs, "candidates")
        wanted = pairs.select(F.col("a").alias("node")).union(pairs.select("b")).distinct()
        sets = materialize(sets_of(wanted), "sets")
        first = sets.select(F.col("node").alias("a"), F.col("shingles").alias("a_set"))
        second = sets.select(F.col("node").alias("b"), F.col("shingles").alias("b_set"))
        common = F.size(F.array_intersect("a_set", "b_set"))
        confirmed = pairs.join(first, "a").join(second, "b").withColumn("common", common)
        return materialize(confirmed.filter(F.col("common") * 100 >= (F.col("a_n") + F.col("b_n") - F.col("common")) * percent).select("a", "b"), "confirmed")

    def placed(rows: DataFrame, roots: DataFrame | None) -> DataFrame:
        if roots is None:
            return rows.withColumn("root", F.col("node"))
        return rows.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))

    links: DataFrame | None = None
    roots: DataFrame | None = None
    for turn in range(TURNS):
        here = placed(members, roots)
        rank = F.col("node") if turn == 0 else F.xxhash64(F.lit(turn), "band", "node")
        hubs = here.groupBy("band").agg(
            F.min_by("node", rank).alias("hub"), F.min_by("root", rank).alias("hub_root"), F.min("root").alias("low"), F.max("root").alias("high")
        )
        pairs = here.join(hubs.filter("low < high"), "band").filter("root <> hub_root")
        found = linked(pairs.select(F.least("node", "hub").alias("a"), F.greatest("node", "hub").alias("b")))
        if found.isEmpty():
            break
        links = found if links is None else links.unionByName(found)
        roots = components(links)

    # What is still apart: pairs that share two bands. A class has one row for each of its bands, not for each two of
    # them, and the join looks at the other bands. A shingle that no other of these classes has is common to no pair,
    # which settles most of a large family whose members have drifted too far from each other.
    here = placed(members, roots)
    apart = here.groupBy("band").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high").select("band")
    waiting = materialize(here.join(apart, "band"), "waiting")
    shingled = sets_of(waiting.select("node").distinct()).select("node", F.explode("shingles").alias("shingle"))
    lone = shingled.groupBy("shingle").agg(F.count("*").alias("holders"), F.min("node").alias("node")).filter("holders = 1")
    own = lone.groupBy("node").agg(F.count("*").alias("own"))
    common = classes.join(own, "node", "left").select("node", (F.col("n") - F.coalesce("own", F.lit(0))).alias("c"), "n", "sketch", "parity", "bands")
    # Whoever is linked shares so many shingles with a class of at least percent of its size.
    common = common.filter(F.col("c") * 100 >= F.col("n") * percent)
    rest = materialize(waiting.join(common, "node"), "apart")
    parts = ("root", "c", "n", "sketch", "parity", "bands")
    left, right = (rest.select("band", F.col("node").alias(x), *[F.col(c).alias(f"{x}_{c}") for c in parts]) for x in "ab")
    # The work is in the pairs looked at, not in the bytes by which Spark would make fewer tasks.
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    enough_common = F.least("a_c", "b_c") * (100 + percent) >= (F.col("a_n") + F.col("b_n")) * percent
    # The smaller of two linked sets shares so much with others that a set of its own size could be linked with it.
    rich = F.col("a_c") * (100 + percent) >= F.col("a_n") * (2 * percent)
    smaller = (F.col("a_n") < F.col("b_n")) | ((F.col("a_n") == F.col("b_n")) & (F.col("a") < F.col("b")))
    # A pair comes out of one bucket only, that of the first band in which it agrees, and if another band agrees. The
    # function of arrays is looked at last; it also keeps the condition out of one large generated method, which the
    # JVM would not compile.
    agree = F.filter(F.zip_with("a_bands", "b_bands", lambda x, y: F.when(x == y, x)), lambda band: band.isNotNull())
    first_band = (F.size(agree) >= 2) & (F.get(agree, F.lit(0)) == left["band"])
    across = left.filter(rich).repartition(tasks, "band").join(
        right.repartition(tasks, "band"),
        (left["band"] == right["band"]) & (F.col("a_root") != F.col("b_root")) & smaller & enough_common & fits("a", "b") & first_band,
    )
    across = across.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    found = linked(materialize(across, "across"))
    if not found.isEmpty():
        links = found if links is None else links.unionByName(found)
        roots = components(links)

    labelled = placed(classes.select("set_key", "node", "least_id"), roots)
    least = labelled.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_set = labelled.join(least, "root").select("set_key", "component_id")
    out = signed.select("doc_id", "n_shingles", "set_key", "key").join(by_set, "set_key", "left")
    own = F.when(F.col("n_shingles") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return out.withColumn("component_id", own).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.col("component_id").isNull()).alias("kept"), "key"
    )


def drop_near_copies(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with one document of each group, the one with the smallest id; columns as they were."""
    return keep_rows(docs, near_duplicates(docs, **options).select("key", "kept"), row_key())
