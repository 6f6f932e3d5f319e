"""Plain versions of the corpus operators, over all pairs or all places, to hold the Spark ones against."""

from __future__ import annotations

import collections
import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")
UPPER = {c: c + 32 for c in range(65, 91)}


def words(text: str | None) -> list[str]:
    return WORD.findall((text or "").translate(UPPER))


def shingles(text: str | None, size: int) -> frozenset:
    own = words(text)
    if len(own) < size:
        return frozenset([tuple(own)] if own else [])
    return frozenset(zip(*(own[k:] for k in range(size))))


def near_groups(rows: list[tuple[int, str | None]], size: int, percent: int) -> dict[int, tuple[int, int]]:
    """doc_id to (number of shingles, smallest doc_id reachable)."""
    sets = {i: shingles(t, size) for i, t in rows}
    root = {i: i for i in sets}

    def find(i: int) -> int:
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    holders = collections.defaultdict(list)
    for i, own in sets.items():
        for s in own:
            holders[s].append(i)
    shared: collections.Counter = collections.Counter()
    for own in holders.values():
        for a in range(len(own)):
            for b in range(a + 1, len(own)):
                shared[own[a], own[b]] += 1
    for (a, b), common in shared.items():
        if 100 * common >= percent * (len(sets[a]) + len(sets[b]) - common):
            x, y = sorted((find(a), find(b)))
            root[y] = x
    return {i: (len(sets[i]), find(i)) for i in sets}


def repeats(texts: list[str | None], length: int) -> list[tuple[int, int, int, str]]:
    """Per text: bytes, removed bytes, removed runs, hash of the rest."""
    data = [(t or "").encode() for t in texts]
    seen: collections.Counter = collections.Counter()
    for d in data:
        for s in range(len(d) - length + 1):
            seen[d[s : s + length]] += 1
    out = []
    for d in data:
        cover = bytearray(len(d))
        for s in range(len(d) - length + 1):
            if seen[d[s : s + length]] > 1:
                cover[s : s + length] = b"\1" * length
        runs = len(re.findall(b"\1+", bytes(cover)))
        kept = bytes(b for b, c in zip(d, cover) if not c)
        out.append((len(d), sum(cover), runs, hashlib.sha256(kept).hexdigest()))
    return out


PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def _luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def personal(text: str | None) -> list[tuple[int, int, int, str]]:
    """start, place of the kind, end, kind."""
    out = []
    for turn, (kind, pattern) in enumerate(PLAIN.items()):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and _luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            out.append((m.start(), turn, m.end(), kind))
    return sorted(out)
