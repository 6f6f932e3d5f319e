"""Phrases that occur more often than their parts explain, from streams of counts kept in two orders.

Phrases are counted by length, the short ones first. A phrase that occurs often
enough has only parts that do, so of the next length only those are counted
whose two shorter parts may be frequent; a bitmap of fixed size says which
(a wrong yes costs a row and no more). Every task sorts and adds up what it
finds before anything is shuffled.

What is left are the counts of frequent phrases. In prefix order they are
merged with the heads of the candidates, in suffix order with their tails, and
what extends a phrase to the left or right is the longer phrase less its first
or last word. All three are sort-merge joins of ordered streams.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import materialize
from .words import LETTER, U, byte_view, mix, slices, word_hashes

#: What ends a piece, and what separates words inside one.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
WORD_GAPS = b"\x20\x09"
#: Bits of the map of frequent phrases: 16 MB, whatever the input.
BITS = 27
#: Bytes of text that a task counts at a time.
SLICE = 1 << 22
#: Rows that a task hands on at a time.
ROWS = 1 << 16

_GAP = np.zeros(256, bool)
_GAP[list(PIECE_ENDS + WORD_GAPS)] = True
_END = np.zeros(256, bool)
_END[list(PIECE_ENDS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Every byte counts in the hash of a word; the last one separates.
_HASHED = np.where(LETTER == 0, U(0x9FB21C651E98DF25), LETTER)
_HASHED[65:91] = mix(np.arange(65, 91, dtype=U)) | U(1)
_HASHED[9] = 0


def _split(content: np.ndarray, starts: np.ndarray) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The words of all texts, the text and the piece that each is in."""
    begin = int(starts[0])
    data, edges = content[begin : int(starts[-1])], starts - begin
    gap = _GAP[data]
    opens = ~gap
    opens[1:] &= gap[:-1]
    inner = edges[:-1][edges[:-1] < len(data)]
    opens[inner] = ~gap[inner]
    places = np.flatnonzero(opens)
    # With the gaps taken out, the words lie side by side.
    letters = _LOWER[data[~gap]]
    kept = np.cumsum(~gap, dtype=np.int32)
    offsets = np.append(kept[places] - 1, len(letters)).astype(np.int32)
    words = pa.Array.from_buffers(pa.string(), len(places), [None, pa.py_buffer(offsets), pa.py_buffer(letters)])
    piece = np.cumsum(_END[data], dtype=np.int32)[places] if len(data) else np.zeros(0, np.int64)
    return words, np.searchsorted(edges, places, "right") - 1, piece


def _hashes(texts: pa.Array) -> np.ndarray:
    """Hash of each string; the strings hold no tab."""
    joined = pc.binary_join_element_wise(pc.fill_null(texts, "").cast(pa.large_string()), pa.scalar("", pa.large_string()), pa.scalar("\t", pa.large_string()))
    content, starts = byte_view(joined)
    out = np.zeros(len(texts), U)
    found, _, first = word_hashes(content, starts, _HASHED)
    some = np.flatnonzero(np.diff(first))
    out[some] = found[first[:-1][some]]
    return out


def _place(chained: np.ndarray, width: int) -> np.ndarray:
    return mix(chained) >> U(64 - width)


def _chain(hashes: np.ndarray, word: np.ndarray) -> np.ndarray:
    """Hash of a phrase (or of a language) with one more word."""
    return mix(hashes * U(0xD1342543DE82EF95) + word)


def _may_be(bits: np.ndarray, places: np.ndarray) -> np.ndarray:
    return (bits[places >> U(3)] >> (places & U(7)).astype(np.uint8)) & np.uint8(1) == 1


def _count(lang: pa.Array, content: np.ndarray, starts: np.ndarray, size: int, bits: np.ndarray | None) -> pa.RecordBatch | None:
    """``phrase, n``: phrases of ``size`` words with their language before a tab, each once."""
    words, row, piece = _split(content, starts)
    if len(words) < size:
        return None
    encoded = words.dictionary_encode()
    names, ids = encoded.dictionary, encoded.indices.to_numpy().astype(np.int64)
    langs = lang.dictionary_encode()
    lang_names, lang_of = langs.dictionary, langs.indices.to_numpy().astype(np.int64)
    count = len(ids) - size + 1
    whole = (row[:count] == row[size - 1 :]) & (piece[:count] == piece[size - 1 :])
    if size > 1:
        part = size - 1
        hashes, hashed = _hashes(names)[ids], _hashes(lang_names)[lang_of[row]]
        places = hashed[: len(ids) - part + 1]
        for k in range(part):
            places = _chain(places, hashes[k : len(ids) - part + 1 + k])
        frequent = _may_be(bits, _place(places, (len(bits) * 8).bit_length() - 1))
        whole &= frequent[:-1] & frequent[1:]
    at = np.flatnonzero(whole)
    if not len(at):
        return None
    # A phrase is numbered by the number of all but its last word, then that word.
    key = lang_of[row[at]]
    steps = []
    for k in range(size):
        if k:
            seen, key = np.unique(key, return_inverse=True)
            steps.append(seen)
        key = key * len(names) + ids[at + k]
    seen, n = np.unique(key, return_counts=True)
    columns = []
    for k in range(size - 1, -1, -1):
        columns.append(names.take(pa.array(seen % len(names))))
        seen = seen // len(names)
        if k:
            seen = steps[k - 1][seen]
    phrase = columns[-1] if size == 1 else pc.binary_join_element_wise(*columns[::-1], " ")
    phrase = pc.binary_join_element_wise(lang_names.take(pa.array(seen)), phrase, "\t")
    return pa.RecordBatch.from_arrays([phrase, pa.array(n.astype(np.int64))], ["phrase", "n"])


def phrase_counts(
    docs: DataFrame, size: int, frequent: DataFrame | None = None, lang: str = "lang", text: str = "text", width: int = BITS
) -> DataFrame:
    """``phrase, a``: occurrences of the phrases of ``size`` words inside pieces, the language before a tab.

    ``frequent`` are the counts of phrases one word shorter; only phrases whose
    two parts may be among them are counted, and all those whose parts are.
    """
    held = None if frequent is None else docs.sparkSession.sparkContext.broadcast(_bitmap(frequent, width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = None if held is None else np.frombuffer(held.value, np.uint8)
        for batch in batches:
            langs = batch.column(0)
            content, starts = byte_view(batch.column(1))
            for first, last in slices(starts, SLICE):
                out = _count(langs.slice(first, last - first), content, starts[first : last + 1], size, bits)
                for at in range(0, out.num_rows if out is not None else 0, ROWS):
                    yield out.slice(at, ROWS)
                # Workers stay after the task; what they no longer use goes back to the machine.
                del out
                pa.default_memory_pool().release_unused()

    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"), F.col(text).alias("text"))
    found = rows.mapInArrow(run, "phrase string, n long")
    return found.groupBy("phrase").agg(F.sum("n").alias("a"))


def _bitmap(frequent: DataFrame, width: int) -> bytes:
    """A bit for each phrase at the place of its hash; 2 to the power ``width`` bits however many there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = pc.split_pattern(batch.column(0), "\t", max_splits=1, reverse=True)
            chained = _hashes(pc.list_element(parts, 0))
            words = pc.split_pattern(pc.list_element(parts, 1), " ")
            sizes = pc.list_value_length(words).to_numpy()
            hashes, begin = _hashes(pc.list_flatten(words)), np.cumsum(sizes) - sizes
            for k in range(int(sizes.max()) if len(sizes) else 0):
                more = np.flatnonzero(sizes > k)
                chained[more] = _chain(chained[more], hashes[begin[more] + k])
            yield pa.RecordBatch.from_arrays([pa.array(_place(chained, width).astype(np.int64))], ["place"])

    # Spark's bitmaps hold 32,768 places each and count buckets from 1.
    places = frequent.select("phrase").mapInArrow(run, "place long").select((F.col("place") + 1).alias("place"))
    parts = places.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")
    )
    out = bytearray(1 << (width - 3))
    for bucket, bits in parts.toLocalIterator():
        out[(bucket - 1) * len(bits) : bucket * len(bits)] = bits
    return bytes(out)


def _words(phrase: Column, first: int, last: int, size: int) -> Column:
    """Words ``first`` to ``last`` of a phrase of ``size`` words with its language, which stays before the tab."""
    lang = F.regexp_extract(phrase, r"(?s)^.*\t", 0)
    words = F.split(F.substring_index(phrase, "\t", -1), " ")
    return F.concat(lang, F.array_join(F.slice(words, first, last - first + 1), " "))


def collocations(
    docs: DataFrame, top: int = 2000, least: int = 10, longest: int = 3, absorb: int = 50, lang: str = "lang", text: str = "text",
    width: int = BITS,
) -> DataFrame:
    """The first ``top`` phrases of 2 to ``longest`` words of each language by how much they hang together.

    Returns ``lang, rank, phrase, a, l, r, n, score, cut``: occurrences of the
    phrase, of both parts of its weakest cut, of all words of the language, and
    ``floor(1000000 a a / (l r))`` at that cut (of equal ones the first). A
    phrase counts from ``least`` occurrences on; it goes if a longer one around
    it has ``absorb`` per cent of its occurrences. Ties are broken by count and
    then by the phrase. Texts are cut at ``PIECE_ENDS`` and split at
    ``WORD_GAPS``, A-Z is lower-cased. Null texts are empty, a null language is
    ``und``, repeated rows count again; other columns are not read. Empty
    tables give no rows. The result does not depend on ``width`` (15 or more).
    """
    docs = docs.select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    words = materialize(phrase_counts(docs, 1), "words")
    of_lang = words.groupBy(F.regexp_extract("phrase", r"(?s)^(.*)\t", 1).alias("lang")).agg(F.sum("a").alias("n"))
    levels = [words.filter(F.col("a") >= least)]
    for size in range(2, longest + 1):
        counted = phrase_counts(docs, size, levels[-1], width=width).filter(F.col("a") >= least)
        # Prefix order: a phrase stands beside those that begin as it does.
        levels.append(materialize(counted.sortWithinPartitions("phrase"), "phrases"))
    best = None
    for size in range(2, longest + 1):
        scored = _scored(levels, size)
        best = scored if best is None else best.unionByName(scored)
    kept = best
    longer = _extensions(levels, longest)
    if longer is not None:
        joined = best.hint("merge").join(longer, "phrase", "left")
        kept = joined.filter(F.coalesce(100 * F.col("most") < absorb * F.col("a"), F.lit(True))).drop("most")
    kept = kept.select(
        F.regexp_extract("phrase", r"(?s)^(.*)\t", 1).alias("lang"), F.substring_index("phrase", "\t", -1).alias("phrase"), "a", "best.*"
    )
    order = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(order).cast("long")).filter(F.col("rank") <= top)
    return ranked.join(of_lang, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut")


def _scored(levels: list[DataFrame], size: int) -> DataFrame:
    """``phrase, a, best``: the candidates of ``size`` words with their weakest cut."""
    phrase = F.col("phrase")
    out = levels[size - 1]
    cuts = []
    for cut in range(1, size):
        heads = levels[cut - 1].select(phrase.alias(f"head_{cut}"), F.col("a").alias(f"l_{cut}"))
        tails = levels[size - cut - 1].select(phrase.alias(f"tail_{cut}"), F.col("a").alias(f"r_{cut}"))
        out = out.withColumn(f"head_{cut}", _words(phrase, 1, cut, size)).withColumn(f"tail_{cut}", _words(phrase, cut + 1, size, size))
        # Both sides are streams in the order of the part; a part of a frequent phrase is never missing.
        out = out.hint("merge").join(heads, f"head_{cut}").hint("merge").join(tails, f"tail_{cut}")
        a, left, right = (F.col(c).cast("decimal(19,0)") for c in ("a", f"l_{cut}", f"r_{cut}"))
        score = F.call_function("div", (a * a).cast("decimal(31,0)") * F.lit(1_000_000).cast("decimal(7,0)"), left * right)
        cuts.append(F.struct(score.cast("long").alias("score"), F.lit(cut).alias("cut"), F.col(f"l_{cut}").alias("l"), F.col(f"r_{cut}").alias("r")))
    best = F.least(*cuts) if len(cuts) > 1 else cuts[0]
    return out.select("phrase", "a", best.alias("best"))


def _extensions(levels: list[DataFrame], longest: int) -> DataFrame | None:
    """``phrase, most``: the most occurrences of a longer phrase with the phrase's words in it."""
    inner = None
    for size in range(3, longest + 1):
        parts = [
            _words(F.col("phrase"), first, first + part - 1, size) for part in range(2, size) for first in range(1, size - part + 2)
        ]
        found = levels[size - 1].select(F.explode(F.array(*parts)).alias("phrase"), "a")
        inner = found if inner is None else inner.unionByName(found)
    return None if inner is None else inner.groupBy("phrase").agg(F.max("a").alias("most"))
