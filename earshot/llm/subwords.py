"""Subword ids of words, with each distinct word encoded once per worker."""

from __future__ import annotations

import base64
import re
from functools import lru_cache

import numpy as np

from .words import U, mix, powers, word_hashes

#: Fixed value: runs of letters, digits or marks, each with the space before it.
PATTERN = r" ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"
#: Words kept per worker; then it starts anew.
CACHE = 800_000
#: Words that are given to the tokeniser as one text.
_TOGETHER = 4_096
_SPACES = b" \t\n\v\f\r"
_OTHER_SPACE = re.compile(r"[^\S ]")


class Numbers:
    """Numbers 0, 1, ... of distinct well-mixed 64-bit keys, looked up for whole arrays."""

    def __init__(self, size: int = 0) -> None:
        self.count = 0
        self._make(max(16, (2 * size).bit_length()))

    def _make(self, bits: int) -> None:
        self._shift, self._mask = U(64 - bits), (1 << bits) - 1
        self._keys, self._numbers = np.zeros(1 << bits, U), np.full(1 << bits, -1, np.int32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 for one that is not here."""
        slots = (keys >> self._shift).astype(np.int64)
        found = self._numbers.take(slots)
        left = np.flatnonzero((self._keys.take(slots) != keys) & (found >= 0))
        while len(left):
            slots[left] = (slots[left] + 1) & self._mask
            at = slots[left]
            found[left] = self._numbers.take(at)
            left = left[(self._keys.take(at) != keys[left]) & (found[left] >= 0)]
        return found

    def add(self, keys: np.ndarray) -> None:
        """Gives the next numbers to distinct keys that are not here."""
        if 2 * (self.count + len(keys)) > len(self._keys):
            held = np.flatnonzero(self._numbers >= 0)
            kept, numbers = self._keys[held], self._numbers[held]
            self._make((4 * (self.count + len(keys))).bit_length())
            self._put(kept, numbers)
        self._put(keys, np.arange(self.count, self.count + len(keys), dtype=np.int32))
        self.count += len(keys)

    def learn(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The number of each key, and where each of the new ones stands first, in the order of their numbers."""
        found = self.find(keys)
        new = np.flatnonzero(found < 0)
        if not len(new):
            return found, new
        values, first = np.unique(keys[new], return_index=True)
        self.add(values)
        found[new] = self.find(keys[new])
        return found, new[first]

    def _put(self, keys: np.ndarray, numbers: np.ndarray) -> None:
        slots = (keys >> self._shift).astype(np.int64)
        left = np.arange(len(keys))
        while len(left):
            free = self._numbers[slots[left]] < 0
            at, own = slots[left[free]], left[free]
            self._numbers[at] = numbers[own]  # of several for one slot the last stays
            self._keys[at] = keys[own]
            left = left[self._numbers[slots[left]] != numbers[left]]
            slots[left] = (slots[left] + 1) & self._mask


class Subwords:
    """A public byte-level vocabulary, read from a file of ranks; the id after the last is the end of a text."""

    def __init__(self, path: str) -> None:
        import tiktoken

        with open(path, encoding="ascii") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}
        self.end = max(ranks.values()) + 1
        self.size = self.end + 1
        #: Ids as they are stored.
        self.kind = np.dtype("<u2" if self.size <= 1 << 16 else "<u4")
        # Words hold no space and each is encoded with one before it: ids that begin with a space begin a word.
        self.opens = np.zeros(self.size, bool)
        self.opens[[number for part, number in ranks.items() if part[:1] == b" "]] = True
        self._bytes = [ranks[bytes([k])] for k in range(256)]
        self._values = mix(np.arange(1, self.size + 1, dtype=U) * U(0x2545F4914F6CDD1D)) | U(1)
        self._values[self.end] = 0
        self._encoding = tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._forget()

    def _forget(self) -> None:
        self._index = Numbers(CACHE)
        self._lengths = np.zeros(0, np.int32)
        self._starts = np.zeros(0, np.int32)
        self._flat = np.zeros(0, self.kind)

    def _encoded(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of words one after the other, and how many each has."""
        try:
            text = b" " + b" ".join(words)
            if not _OTHER_SPACE.search(text := text.decode()):
                # No piece of the pattern reaches over the space before a word.
                flat = np.array(self._encoding.encode_ordinary(text), self.kind)
                return flat, np.diff(np.append(np.flatnonzero(self.opens[flat]), len(flat)))
        except UnicodeDecodeError:
            pass
        found = [self._alone(word) for word in words]
        return np.array([i for ids in found for i in ids], self.kind), np.array([len(ids) for ids in found])

    def _alone(self, word: bytes) -> list[int]:
        try:
            return self._encoding.encode_ordinary(" " + word.decode())
        except UnicodeDecodeError:  # not UTF-8: byte by byte
            return [self._bytes[k] for k in b" " + word]

    def _numbers(self, hashes: np.ndarray, places: np.ndarray, content: np.ndarray) -> np.ndarray:
        """Cache numbers of words given by hash and first byte in ``content``."""
        if self._index.count > CACHE:
            self._forget()
        numbers, new = self._index.learn(hashes)
        if not len(new):
            return numbers
        raw = content.tobytes().translate(_LOWER)
        spans = list(zip(places[new].tolist(), np.append(places, len(raw))[new + 1].tolist()))  # to the next word
        flat, sizes = zip(*(self._encoded([raw[a:b].rstrip(_SPACES) for a, b in spans[at : at + _TOGETHER]]) for at in range(0, len(spans), _TOGETHER)))
        sizes = np.concatenate(sizes)
        self._starts = np.concatenate([self._starts, (len(self._flat) + np.cumsum(sizes) - sizes).astype(np.int32)])
        self._lengths = np.concatenate([self._lengths, sizes.astype(np.int32)])
        self._flat = np.concatenate([self._flat, *flat])
        return numbers

    def encode(self, content: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the texts between ``edges`` with an end after each, and where each text begins in these (texts + 1)."""
        hashes, places, first = word_hashes(content, edges)
        numbers = self._numbers(hashes, places, content[edges[0] : edges[-1]]) if len(hashes) else np.zeros(0, np.int32)
        lengths, starts = self._lengths.take(numbers), self._starts.take(numbers)
        # Ends move what follows them by one place each.
        texts = np.arange(len(edges))
        edge = np.concatenate([[0], np.cumsum(lengths)])[first] + texts
        ids = np.full(edge[-1], self.end, self.kind)
        inside = np.ones(len(ids), bool)
        inside[edge[1:] - 1] = False
        ends = np.cumsum(lengths)
        at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)
        ids[inside] = self._flat.take(at)
        return ids, edge

    def word_keys(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """64-bit keys of the words in encoded texts, equal for equal words, and the place where each begins."""
        heads = np.flatnonzero(self.opens.take(ids))
        if not len(heads):
            return np.zeros(0, U), heads
        up, down = powers(len(ids))
        values = self._values.take(ids)
        values *= up[: len(ids)]
        return mix(np.add.reduceat(values, heads) * down.take(heads)), heads


_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


@lru_cache(maxsize=2)
def subwords(path: str) -> Subwords:
    return Subwords(path)
