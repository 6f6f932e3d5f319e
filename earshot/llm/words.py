"""Words and word shingles of whole texts as 64-bit hashes, straight from Arrow's bytes.

Everything works on slices of a batch, so memory follows the slice (or one
very long text), not the batch. White space and A-Z are single bytes in UTF-8,
so splitting and lower-casing bytes splits and lower-cases the text.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U = np.uint64
SLICE = 1 << 20

_BASE = U(0x9E3779B97F4A7C15 | 1)
_INVERSE = U(pow(int(_BASE), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits."""
    x = (x ^ (x >> U(32))) * U(0xD6E8FEB86659FD93)
    x = (x ^ (x >> U(29))) * U(0xA0761D6478BD642F)
    return x ^ (x >> U(32))


def _letter_table() -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=U) * U(0x2545F4914F6CDD1D)) | U(1)
    values[65:91] = values[97:123]
    values[[32, *range(9, 14)]] = 0
    return values


LETTER = _letter_table()


@lru_cache(maxsize=4)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    with np.errstate(over="ignore"):
        up, down = np.full(size, _BASE, U), np.full(size, _INVERSE, U)
        up[0] = down[0] = 1
        return np.cumprod(up, dtype=U), np.cumprod(down, dtype=U)


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, at least ``size`` of each."""
    return _powers(1 << max(20, int(size).bit_length()))


def byte_view(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string or binary column and where each text starts; null strings are empty."""
    if column.null_count:
        column = pc.fill_null(column, "")
    kind = np.int64 if pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type) else np.int32
    _, places, data = column.buffers()
    starts = np.frombuffer(places, kind)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    content = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return content, starts


def slices(starts: np.ndarray, limit: int = SLICE) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``limit`` bytes each; a longer text is alone."""
    first, rows = 0, len(starts) - 1
    while first < rows:
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + limit, "right")) - 1)
        yield first, min(last, rows)
        first = last


def plain_letters() -> np.ndarray:
    """As ``LETTER``, but ASCII marks separate words as white space does."""
    values = LETTER.copy()
    marks = [c for c in range(128) if not chr(c).isalnum()]
    values[marks] = 0
    return values


def word_hashes(
    content: np.ndarray, starts: np.ndarray, letters: np.ndarray = LETTER
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word, the byte where it starts, and where the words of each text begin in these (rows + 1).

    Bytes whose ``letters`` value is 0 separate words.
    """
    begin, end = int(starts[0]), int(starts[-1])
    data, edges = content[begin:end], starts - begin
    if not len(data):
        return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(len(starts), np.int64)
    space = letters[data] == 0
    opens = ~space
    opens[1:] &= space[:-1]
    edge = edges[:-1][edges[:-1] < len(data)]
    opens[edge] = ~space[edge]
    places = np.flatnonzero(opens)
    first = np.searchsorted(places, edges)
    if not len(places):
        return np.zeros(0, U), places, first
    up, down = powers(len(data))
    sums = np.add.reduceat(letters[data] * up[: len(data)], places)
    return mix(sums * down[places]), places, first


def word_ends(content: np.ndarray, starts: np.ndarray, letters: np.ndarray = LETTER) -> np.ndarray:
    """The byte after each word, in the order of ``word_hashes`` and counted as its places are."""
    begin, end = int(starts[0]), int(starts[-1])
    space = letters[content[begin:end]] == 0
    closes = ~space
    closes[:-1] &= space[1:]
    edges = starts[1:] - begin - 1
    edges = edges[edges >= 0]
    closes[edges] = ~space[edges]
    return np.flatnonzero(closes) + 1


def shingle_hashes(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each run of ``size`` words within a text, and where the shingles of each text begin.

    A text with fewer words is one shingle; one without words has none.
    """
    words = np.diff(first)
    count = np.where(words >= size, words - size + 1, np.minimum(words, 1))
    begin = np.concatenate([[0], np.cumsum(count)])
    if not len(hashes):
        return np.zeros(0, U), begin
    factors = mix(np.arange(1, size + 1, dtype=U) * U(0x632BE59BD9B4E019)) | U(1)
    padded = np.concatenate([hashes, np.zeros(size, U)])
    rolling = np.full(len(hashes), U(size))
    for k in range(size):
        rolling += padded[k : k + len(hashes)] * factors[k]
    at = np.arange(begin[-1]) + np.repeat(first[:-1] - begin[:-1], count)
    out = rolling[at]
    for row in np.flatnonzero((words > 0) & (words < size)):
        own = hashes[first[row] : first[row + 1]]
        out[begin[row]] = U(len(own)) + (own * factors[: len(own)]).sum(dtype=U)
    return mix(out), begin
