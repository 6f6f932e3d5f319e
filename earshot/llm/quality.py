"""Quality by ordinal cumulative-link regression on graded ratings.

One weight per hashed feature serves all grades; ordered thresholds cut the
score into them: P(grade <= k) = logistic(threshold_k - score). The model gives
the expected grade and, for the selection, the chance of at least a grade.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import materialize
from .words import U, byte_view, mix, plain_letters, slices, word_hashes

#: Words are known by so many bits of their hash; only those that tell something have a weight, so the model stays small.
HASH_BITS = 40
#: The model is fitted on at most so many labelled rows, chosen by a hash of their id.
FIT_ROWS = 20_000
GRADES = 3
#: A word's mean grade must lie so many standard errors off the overall mean, over at least so many documents.
TELLING, SUPPORT = 4.0, 5

_LETTERS = plain_letters()


def grade(quality: str = "quality", toxic: str = "toxic") -> Column:
    """0 toxic, 1 not toxic but poor, 2 good; null where the ratings do not say."""
    good = F.when(F.col(quality) == 0, 1).when(F.col(quality) == 1, 2)
    return F.when(F.col(toxic) == 1, 0).otherwise(good).cast("int")


def _shape(content: np.ndarray, starts: np.ndarray, first: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Shares and means of each text, each cut into 16 steps (rows x figures)."""
    data = content[starts[0] : starts[-1]]
    edges = starts - starts[0]
    size = np.maximum(np.diff(edges), 1)

    def share(kind: np.ndarray) -> np.ndarray:
        total = np.concatenate([[0], np.cumsum(kind[data], dtype=np.int64)])
        return (total[edges[1:]] - total[edges[:-1]]) / size

    def of(characters: str) -> np.ndarray:
        kind = np.zeros(256, bool)
        kind[[ord(c) for c in characters]] = True
        return kind

    words = np.diff(first)
    distinct = np.array([len(np.unique(hashes[a:b])) for a, b in zip(first[:-1], first[1:])])
    again = np.zeros(len(hashes) + 1, np.int64)
    again[2:] = np.cumsum(hashes[1:] == hashes[:-1])
    repeated = again[np.maximum(first[1:], first[:-1])] - again[np.minimum(first[:-1] + 1, first[1:])]
    figures = [
        share(of("ABCDEFGHIJKLMNOPQRSTUVWXYZ")) * 2,
        share(of("#$%&*@^~_=+<>/\\")) * 4,
        share(of("|")) * 8,
        share(of("!?")) * 8,
        share(of("0123456789")) * 4,
        share(of("\n")) * 16,
        share(of(" \t\n")) * 4,
        np.minimum(size / np.maximum(words, 1), 16) / 16,
        np.log2(words + 1) / 16,
        distinct / np.maximum(words, 1),
        repeated / np.maximum(words, 1) * 2,
    ]
    return np.minimum(np.sqrt(np.stack(figures, 1)) * 16, 15).astype(np.int64)


def features(content: np.ndarray, starts: np.ndarray, bits: int = HASH_BITS) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature numbers of each text, and where those of each text begin: its words and its shape."""
    hashes, _, first = word_hashes(content, starts, _LETTERS)
    shape = _shape(content, starts, first, hashes)
    figure = np.arange(shape.shape[1]) * 16
    own = mix((shape + figure + 1).astype(U)) >> U(64 - bits)
    words = hashes >> U(64 - bits)
    found = [np.unique(np.concatenate([words[a:b], row])) for a, b, row in zip(first[:-1], first[1:], own)]
    begin = np.concatenate([[0], np.cumsum([len(x) for x in found])]).astype(np.int64)
    return np.concatenate(found).astype(np.int64), begin


def _collected(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            content, starts = byte_view(batch.column(3))
            for first, last in slices(starts):
                found, begin = features(content, starts[first : last + 1], bits)
                lists = pa.ListArray.from_arrays(pa.array(begin, pa.int32()), pa.array(found, pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).slice(first, last - first) for k in range(3)), lists], ["doc_id", "grade", "tie", "found"]
                )

    return run


def _only(numbers: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(2)
            values = np.asarray(lists.flatten(), np.int64)
            at = np.minimum(np.searchsorted(numbers, values), max(len(numbers) - 1, 0))
            held = numbers[at] == values if len(numbers) else np.zeros(len(values), bool)
            ends = np.cumsum(np.asarray(lists.value_lengths(), np.int64))
            kept = np.concatenate([[0], np.cumsum(held)])[np.concatenate([[0], ends])]
            places = pa.ListArray.from_arrays(pa.array(kept, pa.int32()), pa.array(at[held], pa.int32()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), places], ["doc_id", "grade", "places"])

    return run


def _telling_numbers(rows: DataFrame, telling: float, support: int) -> np.ndarray:
    """Numbers of the features that tell something, in order, counted in Spark by the rule of ``_telling``."""
    size, grade = F.size("found").cast("long"), F.col("grade")
    n, total, squares = rows.agg(F.sum(size), F.sum(size * grade), F.sum(size * grade * grade)).first()
    if not n:
        return np.zeros(0, np.int64)
    mean = total / n
    spread = max(squares / n - mean * mean, 0.0) ** 0.5
    counted = rows.select(F.explode("found").alias("number"), "grade").groupBy("number").agg(F.count("*").alias("n"), F.sum("grade").alias("sum"))
    off = F.abs(F.col("sum") - F.lit(mean) * F.col("n"))
    far = off >= telling * max(spread, 1e-9) * F.sqrt(F.col("n"))
    return np.sort(counted.filter((F.col("n") >= support) & far).select("number").toArrow()["number"].to_numpy())


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


@dataclass(frozen=True)
class OrdinalModel:
    """Weights of features by rising number, and thresholds in rising order."""

    numbers: np.ndarray
    weights: np.ndarray
    thresholds: np.ndarray
    bits: int

    def tails(self, scores: np.ndarray) -> np.ndarray:
        """P(grade >= k) for k = 1, 2, ... (rows x thresholds)."""
        return _logistic(scores[:, None] - self.thresholds[None, :])

    def scores(self, found: np.ndarray, begin: np.ndarray) -> np.ndarray:
        if not len(self.numbers):
            return np.zeros(len(begin) - 1)
        at = np.minimum(np.searchsorted(self.numbers, found), len(self.numbers) - 1)
        own = np.where(self.numbers[at] == found, self.weights[at], 0.0)
        total = np.concatenate([[0.0], np.cumsum(own)])
        return total[begin[1:]] - total[begin[:-1]]


def _telling(numbers: np.ndarray, where: np.ndarray, grades: np.ndarray, telling: float, support: int) -> np.ndarray:
    """Which features lie far enough off the mean grade, over enough documents."""
    times = np.bincount(where, minlength=len(numbers))
    off = np.bincount(where, grades - grades.mean(), len(numbers))
    return (times >= support) & (np.abs(off) >= telling * max(grades.std(), 1e-9) * np.sqrt(times))


def fit(
    found: Sequence[np.ndarray], grades: np.ndarray, bits: int = HASH_BITS, levels: int = GRADES, steps: int = 400, rate: float = 0.2,
    decay: float = 1e-4, telling: float = TELLING, support: int = SUPPORT,
) -> OrdinalModel:
    """Most likely weights and thresholds by gradient steps over all rows (Adagrad, small L2), of the features that tell something."""
    sizes = np.array([len(f) for f in found])
    numbers, where = np.unique(np.concatenate(found), return_inverse=True)
    row = np.repeat(np.arange(len(found)), sizes)
    kept = _telling(numbers, where, np.repeat(grades, sizes), telling, support) if len(numbers) else np.zeros(0, bool)
    place = np.cumsum(kept) - 1
    use = kept[where]
    row, where, numbers = row[use], place[where[use]], numbers[kept]
    weights, seen = np.zeros(len(numbers)), np.full(len(numbers), 1e-8)
    shares = np.clip(np.cumsum(np.bincount(grades, minlength=levels))[:-1] / max(len(grades), 1), 1e-3, 1 - 1e-3)
    cuts = np.maximum.accumulate(np.log(shares / (1 - shares)) + np.arange(levels - 1) * 1e-3)
    cut_seen = np.full(levels - 1, 1e-8)
    every = np.arange(len(grades))
    for _ in range(steps):
        score = np.bincount(row, weights[where], len(grades))
        below = np.concatenate([np.zeros((len(grades), 1)), _logistic(cuts[None, :] - score[:, None]), np.ones((len(grades), 1))], 1)
        upper, lower = below[every, grades + 1], below[every, grades]
        # d log P / d score = P(<= k) + P(<= k - 1) - 1
        step = np.bincount(where, (upper + lower - 1)[row], len(numbers)) / len(grades) - decay * weights / max(len(numbers), 1)
        seen += step**2
        weights += rate * step / np.sqrt(seen)
        chance = np.maximum(upper - lower, 1e-9)
        dense = np.zeros((len(grades), levels + 1))
        dense[every, grades + 1] += upper * (1 - upper) / chance
        dense[every, grades] -= lower * (1 - lower) / chance
        cut_step = dense[:, 1:-1].mean(0)
        cut_seen += cut_step**2
        cuts = np.maximum.accumulate(cuts + rate * cut_step / np.sqrt(cut_seen) + np.arange(levels - 1) * 1e-9)
    return OrdinalModel(numbers, weights, cuts, bits)


def train(
    docs: DataFrame, labels: DataFrame, fit_rows: int = FIT_ROWS, bits: int = HASH_BITS, doc_id: str = "doc_id", text: str = "text"
) -> OrdinalModel | None:
    """The model of at most ``fit_rows`` labelled documents; None if there is none.

    A document with several ratings counts with the worst, rows without id or
    grade are not labels, and of documents that share an id the one whose text
    has the smallest hash is used. Features are counted in Spark, and only the
    places of those that tell something come to the driver.
    """
    rated = labels.select(F.col(doc_id).cast("long").alias("doc_id"), grade().alias("grade")).filter("doc_id IS NOT NULL AND grade IS NOT NULL")
    rated = rated.groupBy("doc_id").agg(F.min("grade").alias("grade"))
    chosen = rated.orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    # At most fit_rows rows of two numbers.
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(chosen), "doc_id")
    hashed = texts.select("doc_id", "grade", F.xxhash64("text").alias("tie"), "text")
    rows = hashed.mapInArrow(_collected(bits), "doc_id long, grade int, tie long, found array<long>")
    first = F.min_by(F.struct("grade", "found"), "tie").alias("first")
    rows = materialize(rows.groupBy("doc_id").agg(first).select("doc_id", "first.*"), "rated")
    numbers = _telling_numbers(rows, TELLING, SUPPORT)
    table = rows.mapInArrow(_only(numbers), "doc_id long, grade int, places array<int>").toArrow()
    if not table.num_rows:
        return None
    table = table.sort_by("doc_id").combine_chunks()
    lists = table["places"].combine_chunks()
    values, starts = lists.values.to_numpy(zero_copy_only=False), lists.offsets.to_numpy()
    places = [values[a:b] for a, b in zip(starts[:-1], starts[1:])]
    # All that come are used.
    model = fit(places, table["grade"].to_numpy().astype(np.int64), bits, telling=0.0, support=0)
    return replace(model, numbers=numbers[model.numbers])


def _scored(model, place: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared = model.value
        for batch in batches:
            content, starts = byte_view(batch.column(place))
            for first, last in slices(starts):
                scores = shared.scores(*features(content, starts[first : last + 1], shared.bits))
                tails = shared.tails(scores)
                own = batch.slice(first, last - first)
                arrays = [pa.array(tails.sum(1)), *(pa.array(t) for t in tails.T)]
                yield pa.RecordBatch.from_arrays([*own.columns, *arrays], [f"c{i}" for i in range(own.num_columns + len(arrays))])

    return run


def score(docs: DataFrame, labels: DataFrame, text: str = "text", fit_rows: int = FIT_ROWS, at_least: int = 2, chance: float = 0.5) -> DataFrame:
    """``docs`` with ``expected_grade``, ``p_grade_1``, ``p_grade_2`` (chance of at least that grade) and ``selected``.

    Columns of the same names are replaced. Null and empty texts are scored by
    their shape alone. Without any label the figures are null and every
    document is selected. ``selected`` is P(grade >= at_least) >= chance.
    """
    names = ["expected_grade", *(f"p_grade_{k}" for k in range(1, GRADES)), "selected"]
    kept = docs.drop(*names)
    model = train(docs, labels, fit_rows, text=text)
    if model is None:
        blank = {n: F.lit(None).cast("double") for n in names[:-1]}
        return kept.withColumns({**blank, "selected": F.lit(True)})
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = [*kept.schema.fields, *(T.StructField(n, T.DoubleType()) for n in names[:-1])]
    # Columns go through by place, whatever their names are.
    inner = T.StructType([T.StructField(f"c{i}", f.dataType) for i, f in enumerate(fields)])
    plain = kept.toDF(*[f"c{i}" for i in range(len(kept.columns))])
    scored = plain.mapInArrow(_scored(shared, kept.columns.index(text)), inner).toDF(*[f.name for f in fields])
    return scored.withColumn("selected", F.col(f"p_grade_{at_least}") >= chance)


def select(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """The selected documents, with their columns as they were."""
    return score(docs, labels, **options).filter("selected").select(*docs.columns)
