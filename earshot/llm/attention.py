"""A small causal self-attention model in numpy.

It predicts the class of the next subword from a window of ids before it. Keys,
values and queries depend on the id alone; how far a key lies back is a learned
bias. Windows overlap: the last ``STRIDE`` places of each are scored, the ones
before them are context only, so every token is scored once.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np

WINDOW, STRIDE, WIDTH = 32, 24, 16
#: Frequent ids have an input vector of their own, the rest share by remainder; two more stand for a text's and a block's start.
INPUTS, SHARED = 1024, 62
#: Frequent ids are classes of their own, the rest are cut into bands of equal weight.
HEAD, BANDS = 56, 8
#: Rows of a product that sums over rows: it is faster in pieces that stay in the processor's cache.
_PIECE = 32 * STRIDE


@dataclass(frozen=True)
class Classes:
    """How ids become inputs and classes, and the natural logs of an id's chance within its class and of a class's chance."""

    inputs: np.ndarray
    classes: np.ndarray
    within: np.ndarray
    mass: np.ndarray

    @property
    def start(self) -> int:
        return INPUTS + SHARED

    @property
    def middle(self) -> int:
        return INPUTS + SHARED + 1


def make_classes(counts: np.ndarray) -> Classes:
    """Classes by the counts of all ids; an id never seen has half a count, so every id has a chance above 0."""
    size = len(counts)
    order = np.argsort(-counts, kind="stable")
    rank = np.empty(size, np.int64)
    rank[order] = np.arange(size)
    inputs = np.where(rank < INPUTS, rank, INPUTS + np.arange(size) % SHARED)
    weight = counts[order] + 0.5
    tail = np.cumsum(weight[HEAD:])
    band = np.minimum((tail - weight[HEAD:] / 2) * BANDS / tail[-1], BANDS - 1).astype(np.int64) if size > HEAD else np.zeros(0, np.int64)
    by_rank = np.concatenate([np.arange(min(HEAD, size)), HEAD + band])
    total = np.bincount(by_rank, weight, HEAD + BANDS)
    classes, within = np.empty(size, np.int64), np.empty(size)
    classes[order] = by_rank
    within[order] = np.log(weight / total[by_rank])
    mass = np.log(np.maximum(total, 1e-3) / total.sum())
    return Classes(inputs.astype(np.int64), classes, within, mass)


SHAPES = {
    "embed": (INPUTS + SHARED + 2, WIDTH), "query": (WIDTH, WIDTH), "key": (WIDTH, WIDTH), "value": (WIDTH, WIDTH), "out": (WIDTH, WIDTH),
    "far": (WINDOW,), "last": (WIDTH, HEAD + BANDS), "prior": (HEAD + BANDS,),
}


def new_parameters(mass: np.ndarray | None = None, seed: int = 3) -> dict[str, np.ndarray]:
    """Small random numbers; with ``mass`` the model begins as the classes' own frequencies, whatever the context."""
    random = np.random.default_rng(seed)
    made = {}
    for name, shape in SHAPES.items():
        scale = 0 if name in ("far", "prior") else 0.3 if name == "embed" else 1 / np.sqrt(shape[0])
        made[name] = (random.standard_normal(shape) * scale).astype(np.float32)
    if mass is not None:
        made["last"][:] = 0
        made["prior"][:] = mass
    return made


def flat(parameters: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([parameters[n].ravel() for n in SHAPES])


def unflat(values: np.ndarray) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for name, shape in SHAPES.items():
        size = int(np.prod(shape))
        out[name] = values[at : at + size].reshape(shape).astype(np.float32)
        at += size
    return out


def windows(begin: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places (windows x WINDOW) of sequences given by begin and length, which of them exist, and each window's sequence."""
    count = -(-length // STRIDE)
    owner = np.repeat(np.arange(len(length)), count)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    inside = number[:, None] * STRIDE + np.arange(STRIDE - WINDOW, STRIDE)[None, :]
    exists = (inside >= 0) & (inside < length[owner][:, None])
    return np.where(exists, inside, 0) + begin[owner][:, None], exists, owner


def _geometry() -> tuple[np.ndarray, np.ndarray]:
    """How far each key lies before each scored place, and which may be seen."""
    back = np.arange(WINDOW - STRIDE, WINDOW)[:, None] - np.arange(WINDOW)[None, :]
    return np.maximum(back, 0), back >= 0


_BACK, _SEEN = _geometry()


class Room:
    """Arrays by name that are used again at every step: fresh memory costs more than the sums that go into it."""

    def __init__(self) -> None:
        self._held: dict[str, np.ndarray] = {}

    def __call__(self, name: str, dtype: np.dtype, *shape: int) -> np.ndarray:
        size = math.prod(shape)
        held = self._held.get(name)
        if held is None or held.size < size or held.dtype != dtype:
            held = self._held[name] = np.empty(size, dtype)
        return held[:size].reshape(shape)

    def rows(self, name: str, table: np.ndarray, ids: np.ndarray) -> np.ndarray:
        """The table's row of every id."""
        return table.take(ids, 0, self(name, table.dtype, *ids.shape, table.shape[1]), "clip")

    def product(self, name: str, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.matmul(a, b, out=self(name, a.dtype, *a.shape[:-1], b.shape[-1]))


class Tables:
    """Parameters made ready: queries (scaled), keys and values of every input, and what is added to logits by distance."""

    def __init__(self, p: dict) -> None:
        kind = p["embed"].dtype
        self.embed, self.out = p["embed"], p["out"]
        self.queries = p["embed"] @ (p["query"] / np.sqrt(WIDTH)).astype(kind)
        self.keys, self.values = p["embed"] @ p["key"], p["embed"] @ p["value"]
        self.far = np.where(_SEEN, p["far"].take(_BACK), -1e9).astype(kind)
        # Hidden values lie between -1 and 1, so no class can score above this: shifted by it, nothing overflows.
        self.shift = float((np.abs(p["last"]).sum(0) + p["prior"]).max())
        # The prior is the weight of one more hidden value, which is always 1.
        self.last = np.concatenate([p["last"], (p["prior"] - kind.type(self.shift))[None]])
        # Turned over: products with contiguous tables are the faster ones.
        self.back = {name: np.ascontiguousarray(p[name].T) for name in ("query", "key", "value", "out", "last")}
        # Sums over a row, given to every place of a row: faster as products than as sums and broadcasts of short rows.
        self.over_window, self.over_width = np.ones((WINDOW, WIDTH), kind), np.ones((WIDTH, WINDOW), kind)


def _forward(t: Tables, inputs: np.ndarray, exists: np.ndarray, room: Room):
    asked = inputs[:, WINDOW - STRIDE :]
    q, k, v = room.rows("q", t.queries, asked), room.rows("k", t.keys, inputs), room.rows("v", t.values, inputs)
    weights = room.product("weights", q, k.transpose(0, 2, 1))
    weights += t.far
    np.minimum(weights, 30, out=weights)
    np.exp(weights, out=weights)
    # Only the places before a sequence are missing for those asked; what follows its end is seen by none that counts.
    weights[~exists[:, 0], :, : WINDOW - STRIDE] = 0
    # A scored place sees itself, so its weights sum to more than 0.
    share = room.product("share", weights.reshape(-1, WINDOW), t.over_window)
    share += 1e-30
    np.reciprocal(share, out=share)
    mixed = room.product("mixed", weights, v).reshape(-1, WIDTH)
    mixed *= share
    own = room.rows("own", t.embed, asked).reshape(-1, WIDTH)
    inner = room.product("inner", mixed, t.out)
    inner += own
    hidden = room("hidden", mixed.dtype, len(mixed), WIDTH + 1)
    hidden[:, :WIDTH] = np.tanh(inner, out=inner)
    hidden[:, WIDTH] = 1
    scores = room.product("scores", hidden.reshape(len(inputs), STRIDE, -1), t.last)
    return q, k, v, weights, share, mixed, own, inner, hidden, scores.reshape(len(hidden), -1)


def log_chances(t: Tables, inputs: np.ndarray, exists: np.ndarray, targets: np.ndarray, room: Room | None = None) -> np.ndarray:
    """Natural log of the chance of each target class (windows x STRIDE)."""
    scores = _forward(t, inputs, exists, room or Room())[-1]
    chosen = scores.ravel().take(np.arange(0, scores.size, scores.shape[1]) + targets.ravel())
    total = np.exp(scores, out=scores) @ np.ones(scores.shape[1], scores.dtype)
    return (chosen - np.log(total + 1e-38)).reshape(targets.shape)


def _across(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """``a.T @ b`` for two tall matrices."""
    whole = len(a) // _PIECE * _PIECE
    pieces = a[:whole].reshape(-1, _PIECE, a.shape[1]).transpose(0, 2, 1) @ b[:whole].reshape(-1, _PIECE, b.shape[1])
    return pieces.sum(0) + a[whole:].T @ b[whole:]


def _row_sums(ids: np.ndarray, size: int, part: np.ndarray, room: Room) -> np.ndarray:
    """Sum of the part's rows by the id that they belong to, one row per id."""
    order = np.argsort(ids.astype(np.int16), kind="stable")
    placed = ids.take(order)
    begin = np.flatnonzero(np.concatenate([[True], placed[1:] != placed[:-1]]))
    sums = np.zeros((size, part.shape[1]), part.dtype)
    sums[placed.take(begin)] = np.add.reduceat(room.rows("placed", part, order), begin, axis=0)
    return sums


def gradients(p: dict, inputs: np.ndarray, exists: np.ndarray, targets: np.ndarray, counts: np.ndarray, room: Room | None = None) -> dict[str, np.ndarray]:
    """Mean gradient of the log loss over the places that count (windows x STRIDE)."""
    t, room, kind, g = Tables(p), room or Room(), p["embed"].dtype, {}
    q, k, v, weights, share, mixed, own, inner, hidden, chance = _forward(t, inputs, exists, room)
    np.exp(chance, out=chance)
    scale = (counts.ravel() / max(counts.sum(), 1)).astype(kind)
    chance *= (scale / (chance @ np.ones(chance.shape[1], kind) + 1e-38))[:, None]
    chance.ravel()[np.arange(0, chance.size, chance.shape[1]) + targets.ravel()] -= scale
    last = _across(hidden, chance)
    g["last"], g["prior"] = last[:WIDTH], last[WIDTH]
    d_inner = room.product("d_inner", chance.reshape(len(inputs), STRIDE, -1), t.back["last"]).reshape(-1, WIDTH)
    np.square(inner, out=inner)
    d_inner *= np.subtract(1, inner, out=inner)
    g["out"] = _across(mixed, d_inner)
    # Weights are left as they are before they are shared out; what meets them is divided instead.
    d_mixed = room.product("d_mixed", d_inner, t.back["out"])
    d_mixed *= share
    offset = room.product("offset", np.multiply(d_mixed, mixed, out=inner), t.over_width)
    d_mixed = d_mixed.reshape(q.shape)
    d_logits = room.product("d_logits", d_mixed, v.transpose(0, 2, 1))
    d_logits -= offset.reshape(d_logits.shape)
    d_logits *= weights
    by_place = np.ones(len(d_logits), kind) @ d_logits.reshape(len(d_logits), -1)
    g["far"] = np.bincount(_BACK[_SEEN], by_place.reshape(_SEEN.shape)[_SEEN], WINDOW).astype(kind)
    # The queries hold the scale already.
    d_q = room.product("d_q", d_logits, k).reshape(-1, WIDTH)
    d_k = room.product("d_k", d_logits.transpose(0, 2, 1), q).reshape(-1, WIDTH)
    d_v = room.product("d_v", weights.transpose(0, 2, 1), d_mixed).reshape(-1, WIDTH)
    d_q *= kind.type(1 / np.sqrt(WIDTH))
    embed = room.rows("embed", t.embed, inputs).reshape(-1, WIDTH)
    g["query"], g["key"], g["value"] = _across(own, d_q), _across(embed, d_k), _across(embed, d_v)
    # What every place adds to the vector of its id; those that are asked add more.
    d_embed = room.product("d_embed", d_k, t.back["key"])
    d_embed += room.product("more", d_v, t.back["value"])
    d_inner += room.product("more", d_q, t.back["query"])
    d_embed.reshape(*inputs.shape, WIDTH)[:, WINDOW - STRIDE :] += d_inner.reshape(q.shape)
    g["embed"] = _row_sums(inputs.ravel(), len(p["embed"]), d_embed, room)
    return g


class Trainer:
    """Adam from given parameters."""

    def __init__(self, parameters: dict[str, np.ndarray], rate: float) -> None:
        # All parameters lie in one array, so that a step is a few operations.
        self._all, self._room = flat(parameters), Room()
        self.p, at = {}, 0
        for name in SHAPES:
            size = parameters[name].size
            self.p[name] = self._all[at : at + size].reshape(SHAPES[name])
            at += size
        self.rate, self.steps, self.tokens = rate, 0, 0
        self._first, self._second = np.zeros_like(self._all), np.zeros_like(self._all)

    def step(self, inputs: np.ndarray, exists: np.ndarray, targets: np.ndarray, counts: np.ndarray) -> None:
        self.steps += 1
        self.tokens += int(counts.sum())
        first, second, change = self._first, self._second, self._room("change", self._all.dtype, self._all.size)
        gradient = flat(gradients(self.p, inputs, exists, targets, counts, self._room))
        np.subtract(gradient, first, out=change)
        change *= 0.1
        first += change
        np.square(gradient, out=gradient)
        gradient -= second
        gradient *= 0.01
        second += gradient
        np.sqrt(second, out=change)
        change += 1e-7
        np.divide(first, change, out=change)
        change *= self.rate * float(np.sqrt(1 - 0.99**self.steps) / (1 - 0.9**self.steps))
        self._all -= change
