"""Scores of whole texts under language models learnt from the corpus.

The base model counts words. The attention model (``attention``) predicts
subwords: class by class from its window, and within a class by the corpus
counts of the ids. Both learn from the documents that are not held out.

Counts cover all training text. The attention model is trained in rounds: every
task goes on from the same parameters over its own documents, the parameters
are then averaged by tokens in a shuffle, one row per parameter. The rounds
deal the blocks of words of every training document among them: each block is
learnt from in exactly one round, so together they are one full pass.

Texts are read and encoded once (``encode``); every later pass reads the stored
ids, from which the words follow too.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import materialize
from . import attention as att
from .subwords import Numbers, Subwords, subwords
from .words import U, byte_view, slices

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: A word with at least 1 / FREQUENT of all tokens is looked up in the tasks; there can be no more than FREQUENT of them.
FREQUENT = 500_000
#: Words of a block, and the rounds that a full pass over all blocks is dealt to.
BLOCK, ROUNDS = 96, 2
END = np.int64(np.uint64(0xE0F0A5C31B7D9F42).astype(np.int64))
#: Windows of a step, and of a scored batch.
_BATCH, _SCORED = 96, 96
#: Counts that a task holds before it hands them on.
_HELD = 1_500_000


def held_out(doc_id: str = "doc_id") -> Column:
    """The documents that nothing is learnt from; a null id is not one."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 7 == 2, F.lit(False))


def _id_slices(batch: pa.RecordBatch, own: Subwords) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Ranges of rows with their ids and where each row begins in these, from texts or from ids as ``encode`` stores them."""
    if "text" in batch.schema.names:
        content, starts = byte_view(batch.column("text"))
        for low, high in slices(starts):
            yield low, high, *own.encode(content, starts[low : high + 1])
        return
    content, starts = byte_view(batch.column("ids"))
    for low, high in slices(np.concatenate([[0], np.cumsum(batch.column("size").to_numpy())])):
        edge = starts[low : high + 1]
        yield low, high, content[edge[0] : edge[-1]].view(own.kind), (edge - edge[0]) // own.kind.itemsize


def _encoding(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = subwords(path)
        for batch in batches:
            _, starts = byte_view(batch.column("text"))
            sizes = np.diff(starts)
            for low, high, ids, edge in _id_slices(batch, own):
                places = pa.py_buffer((edge * own.kind.itemsize).astype(np.int32))
                stored = pa.Array.from_buffers(pa.binary(), high - low, [None, places, pa.py_buffer(ids)])
                kept = (batch.column(name).slice(low, high - low) for name in ("doc_id", "held_out"))
                yield pa.RecordBatch.from_arrays([*kept, pa.array(sizes[low:high], pa.int64()), stored], ["doc_id", "held_out", "size", "ids"])

    return run


def _counting(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = subwords(path)
        per_id = np.zeros(own.size, np.int64)
        index, values, counts = Numbers(), [], np.zeros(0, np.int64)
        texts = 0

        def rows(kind: int, keys: np.ndarray, counts: np.ndarray) -> Iterator[pa.RecordBatch]:
            for at in range(0, len(keys), 100_000):
                part = slice(at, at + 100_000)
                size = len(keys[part])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(size, kind, np.int32)), pa.array(keys[part].astype(np.int64)), pa.array(counts[part])], ["kind", "key", "count"]
                )

        for batch in batches:
            for low, high, ids, _ in _id_slices(batch, own):
                texts += high - low
                per_id += np.bincount(ids, minlength=own.size)
                keys, _ = own.word_keys(ids)
                numbers, new = index.learn(keys)
                values.append(keys[new])
                times = np.bincount(numbers, minlength=index.count)
                times[: len(counts)] += counts
                counts = times
                if index.count > _HELD:
                    yield from rows(0, np.concatenate(values).view(np.int64), counts)
                    index, values, counts = Numbers(), [], np.zeros(0, np.int64)
        if index.count:
            yield from rows(0, np.concatenate(values).view(np.int64), counts)
        if texts:
            yield from rows(0, np.array([END]), np.array([texts]))
            seen = np.flatnonzero(per_id)
            yield from rows(1, seen, per_id[seen])

    return run


def _block_words(first: np.ndarray, keys: np.ndarray, turn: int, rounds: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Begin and end of each block of this round in words, whether a text starts and whether it ends with it."""
    words = np.diff(first)
    count = np.maximum(-(-words // BLOCK), 1)
    owner = np.repeat(np.arange(len(words)), count)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    chosen = (number + keys[owner]) % rounds == turn
    owner, number = owner[chosen], number[chosen]
    begin = first[owner] + number * BLOCK
    return begin, np.minimum(begin + BLOCK, first[owner + 1]), number == 0, number == count[owner] - 1


def _training(shared, path: str, turn: int, rounds: int, rate: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, (start, classes) = subwords(path), shared.value
        trainer = att.Trainer(att.unflat(start), rate)
        for batch in batches:
            salts = batch.column("salt").to_numpy(zero_copy_only=False)
            for low, high, ids, edge in _id_slices(batch, own):
                # Words and ends in one order: word number w of text t is unit w + t, the end of a text follows its words.
                units = np.flatnonzero(own.opens.take(ids) | (ids == own.end))
                first = np.searchsorted(units, edge) - np.arange(len(edge))
                begin, end, opens, closes = _block_words(first, salts[low:high], turn, rounds)
                if not len(begin):
                    continue
                # Every block is a sequence; only a text's last one has its end to predict. A block without words is an end alone.
                text = np.minimum(np.searchsorted(first, begin, "right") - 1, high - low - 1)
                start, stop = units[begin + text], units[end + text]
                bounds = np.concatenate([[0], np.cumsum(stop - start + 1)])
                taken = ids.take(np.arange(bounds[-1]) + np.repeat(start - bounds[:-1], stop - start + 1))
                taken[bounds[1:] - 1] = own.end
                counted = np.ones(len(taken), bool)
                counted[bounds[1:][~closes] - 1] = False
                _train_on(trainer, classes, taken, bounds, np.where(opens, classes.start, classes.middle), counted)
        if trainer.tokens:
            values = att.flat(trainer.p).astype(np.float64) * trainer.tokens
            values = np.concatenate([values, [trainer.tokens]])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values), dtype=np.int32)), pa.array(values)], ["place", "value"])

    return run


def _sequences(classes: att.Classes, ids: np.ndarray, edge: np.ndarray, opening: np.ndarray):
    """Inputs (each sequence's opening, then its ids but the last) and windows over them."""
    inputs = np.empty(len(ids), np.int64)
    inputs[1:] = classes.inputs.take(ids[:-1])
    inputs[edge[:-1]] = opening
    return inputs, *att.windows(edge[:-1], np.diff(edge))


def _train_on(trainer, classes: att.Classes, ids: np.ndarray, edge: np.ndarray, opening: np.ndarray, counted: np.ndarray) -> None:
    inputs, places, exists, _ = _sequences(classes, ids, edge, opening)
    targets = classes.classes.take(ids)
    scored = slice(att.WINDOW - att.STRIDE, None)
    order = np.random.default_rng(len(ids)).permutation(len(places))
    for at in range(0, len(order), _BATCH):
        part = order[at : at + _BATCH]
        where, there = places[part], exists[part]
        asked = where[:, scored]
        trainer.step(inputs.take(where), there, targets.take(asked), there[:, scored] & counted.take(asked))


def _scoring(shared, path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = subwords(path)
        values, classes, words, logs = shared.value
        tables, room = att.Tables(att.unflat(values)), att.Room()
        index = Numbers(len(words))
        index.add(words.view(U))
        scored = slice(att.WINDOW - att.STRIDE, None)
        for batch in batches:
            for low, high, ids, edge in _id_slices(batch, own):
                inputs, where, exists, owner = _sequences(classes, ids, edge, np.full(high - low, classes.start))
                targets = classes.classes.take(ids)
                total = np.add.reduceat(classes.within.take(ids), edge[:-1])
                for at in range(0, len(where), _SCORED):
                    part = slice(at, at + _SCORED)
                    asked = where[part, scored]
                    found = att.log_chances(tables, inputs.take(where[part]), exists[part], targets.take(asked), room)
                    sums = np.where(exists[part, scored], found, 0).sum(1, dtype=np.float64)
                    total = total + np.bincount(owner[part], sums, high - low)
                # Words in the table of frequent ones are settled here, the rest goes on with its key.
                keys, heads = own.word_keys(ids)
                first = np.searchsorted(heads, edge)
                row = np.repeat(np.arange(high - low), np.diff(first))
                found_at = index.find(keys)
                known = found_at >= 0
                known_logs = np.bincount(row[known], logs[found_at[known]], high - low).astype(np.float64)
                known_count = np.bincount(row[known], minlength=high - low)
                rare = np.flatnonzero(~known)
                rest = pa.ListArray.from_arrays(pa.array(np.searchsorted(row[rare], np.arange(high - low + 1)), pa.int32()), pa.array(keys[rare].view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(name).slice(low, high - low) for name in ("row_no", "doc_id")),
                        pa.array(np.diff(first) + 1, pa.int64()),
                        pa.array(total / math.log(10)),
                        pa.array(known_count, pa.int64()),
                        pa.array(known_logs),
                        rest,
                    ],
                    ["row_no", "doc_id", "n_tokens", "score", "known", "logs", "rare"],
                )

    return run


def encode(rows: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``doc_id, held_out``, the bytes of the text (``size``) and its subword ids with the end, for all of ``rows``."""
    return materialize(rows.mapInArrow(_encoding(vocabulary), "doc_id long, held_out boolean, size long, ids binary"), "encoded")


def count_tokens(training: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """``kind, key, count`` over all of ``training`` (text, or size and ids): kind 0 words by key and the end, kind 1 subword ids."""
    partial = training.mapInArrow(_counting(vocabulary), "kind int, key long, count long")
    return materialize(partial.groupBy("kind", "key").agg(F.sum("count").alias("count")), "counts")


def train(training: DataFrame, classes: att.Classes, vocabulary: str = VOCABULARY, rounds: int = ROUNDS, rate: float = 0.01) -> np.ndarray:
    """Flat parameters of the attention model after one pass over all of ``training`` (text, or size and ids; salt), dealt to ``rounds``."""
    parameters = att.flat(att.new_parameters(classes.mass))
    for turn in range(rounds):
        shared = training.sparkSession.sparkContext.broadcast((parameters, classes))
        sums = training.mapInArrow(_training(shared, vocabulary, turn, rounds, rate / (turn + 1)), "place int, value double")
        found = sorted(sums.groupBy("place").agg(F.sum("value").alias("value")).collect())  # one row per parameter
        if not found:
            continue  # a small corpus may have no block in this round
        values = np.array([r.value for r in found])
        parameters = (values[:-1] / values[-1]).astype(np.float32)
    return parameters


def score(docs: DataFrame, vocabulary: str = VOCABULARY, frequent: int = FREQUENT, rounds: int = ROUNDS, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every document.

    Scores are log10 chances of the whole text with its end; a null text is
    empty and has one token, the end. Words are lower-cased (A-Z) and known by
    64-bit hashes of their subwords. The base chance of a token is (c + 1) / (N + V + 1), so it
    is 1 where there is no training text. Repeated rows are scored, and learnt
    from, each by itself. A null id is not held out. Other columns are not read.
    """
    spark = docs.sparkSession
    context = spark.sparkContext
    rows = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"), held_out(doc_id).alias("held_out"), F.col(text).alias("text"),
    )
    encoded = encode(rows, vocabulary)
    learnt = encoded.filter(~F.col("held_out"))
    counts = count_tokens(learnt.select("size", "ids"), vocabulary)
    words = counts.filter("kind = 0")
    total = words.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()

    own = subwords(vocabulary)
    ids = np.zeros(own.size, np.int64)
    for key, count in counts.filter("kind = 1").select("key", "count").toArrow().to_pandas().itertuples(index=False):  # at most the vocabulary
        ids[key] = count
    classes = att.make_classes(ids)
    # A salt is below the number of rounds, so that short documents do not all go to one of them.
    salted = learnt.select("size", "ids", F.pmod(F.xxhash64("doc_id"), F.lit(max(rounds, 1))).alias("salt"))
    parameters = train(salted, classes, vocabulary, rounds)

    ends = words.filter(F.col("key") == int(END)).agg(F.coalesce(F.sum("count"), F.lit(0)).alias("c")).first().c
    ground = math.log10(total.n + total.v + 1)

    # No more than ``frequent`` words can have a share of 1 / frequent.
    often = words.filter((F.col("count") >= total.n / frequent) & (F.col("key") != int(END))).select("key", "count").toArrow()
    keys, times = (often[c].to_numpy() for c in ("key", "count"))
    order = np.argsort(keys)
    shared = context.broadcast((parameters, classes, keys[order], np.log10(times[order] + 1.0) - ground))
    numbered = encoded.select(F.monotonically_increasing_id().alias("row_no"), "doc_id", "size", "ids")
    scored = numbered.mapInArrow(
        _scoring(shared, vocabulary),
        "row_no long, doc_id long, n_tokens long, score double, known long, logs double, rare array<long>",
    )
    scored = materialize(scored, "scored")

    rare = scored.select("row_no", F.explode("rare").alias("key"))
    seldom = words.filter(F.col("count") < total.n / frequent).select("key", "count")
    found = rare.join(seldom, "key").groupBy("row_no").agg(F.count("*").alias("more"), F.sum(F.log10(F.col("count") + 1.0) - ground).alias("more_logs"))
    # Each known word is summed as its chance, not as its count: equal parts of two long sums would cost digits.
    known = F.col("known") + F.coalesce("more", F.lit(0))
    return (
        scored.drop("rare")
        .join(found, "row_no", "left")
        .select(
            "doc_id",
            held_out("doc_id").alias("held_out"),
            "n_tokens",
            (known + int(ends > 0)).alias("n_known"),
            F.lit(int(total.n)).cast("long").alias("train_tokens"),
            (F.col("logs") + F.coalesce("more_logs", F.lit(0.0)) + (math.log10(ends + 1) - ground) - (F.col("n_tokens") - 1 - known) * ground).alias("base_score"),
            "score",
        )
    )
