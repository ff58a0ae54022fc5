"""Toxicity scores from subword embeddings averaged into a linear softmax.

A text is the bag of the character n-grams of its words; its vector is the average of their
embeddings, and a softmax over two classes reads that vector.  Embeddings and softmax are trained
together in numpy.  A misspelt or inflected word shares most n-grams with the words that were seen, so
it scores like them.  Scoring uses that averaging and the softmax are linear: each n-gram's embedding
is multiplied by the softmax weights once, and a text averages these numbers.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from curveloom.llm.subwords import chunks, grams
from curveloom.llm.tables import slices

ORDERS = range(3, 7)
BITS = 18
#: bits that are left beside a slot for a count
COUNT_BITS = 32 - BITS
MOST_COUNT = (1 << COUNT_BITS) - 1
BLOCK_ENTRIES = 1 << 24
DIMENSIONS = 8
#: the sample that the model is fitted on: rows of each label, and the longest text taken
SAMPLE_PER_LABEL = 3_000
SAMPLE_CHARS = 8_000
STEPS, BATCH, RATE, SCALE = 400, 128, 0.15, 40.0
#: texts of the sample that an n-gram must be in; embeddings of the others stay zero
LEAST_TEXTS = 4
#: n-grams without weight that every text has besides its own: a text of few words is no extreme
SILENT = 100
SEED = 20_262


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 5 == 0


@dataclass(frozen=True)
class Model:
    """``weights``: what each n-gram adds to the log odds before averaging; ``bias``: log odds of no n-gram."""

    weights: np.ndarray
    bias: float

    def scores(self, texts: list[str | None]) -> np.ndarray:
        out = np.full(len(texts), self.bias)
        for first, last, data, starts in chunks(texts):
            total, count = np.zeros(last - first), np.zeros(last - first)
            for slots, counts in grams(data, ORDERS, BITS):
                total += np.add.reduceat(np.where(counts, self.weights[slots], 0.0), starts)
                count += np.add.reduceat(counts.astype(np.int64), starts)
            out[first:last] += SCALE * total / (count + SILENT)
        with np.errstate(over="ignore"):
            return 1 / (1 + np.exp(-out))


def bags(texts: Iterable[str | None]) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Entries of each text, its n-grams in all, and how many texts hold each slot.

    An entry is an n-gram slot and, in the lower ``COUNT_BITS``, how often the text holds it; a larger count takes
    several entries.  They lie in large blocks, which go back to the system as a whole.
    """
    entries, sizes, seen, free = [], [], np.zeros(1 << BITS, np.int32), np.empty(0, np.uint32)
    for text in texts:
        for _, _, data, _ in chunks([text]):
            found = np.concatenate([s[counts] for s, counts in grams(data, ORDERS, BITS)])
            values, held = np.unique(found, return_counts=True)
            seen[values] += 1
            full = (held - 1) // MOST_COUNT
            counts = np.full(len(held) + full.sum(), MOST_COUNT)
            counts[np.cumsum(full + 1) - 1] = held - full * MOST_COUNT
            n = len(counts)
            if len(free) < n:
                free = np.empty(max(BLOCK_ENTRIES, n), np.uint32)
            free[:n] = np.repeat(values, full + 1) << COUNT_BITS | counts
            entries.append(free[:n])
            free = free[n:]
            sizes.append(len(found))
    return entries, np.array(sizes, np.int64), seen


def train(texts: Iterable[str | None], labels: list[int]) -> Model:
    """Minibatch AdaGrad over embeddings and softmax.  One label only, or none: a constant score."""
    target = np.array(labels, np.float64)
    if not len(target) or target.min() == target.max():
        rate = (target.sum() + 0.5) / (len(target) + 1) if len(target) else 0.0
        return Model(np.zeros(1 << BITS), float(np.log(rate / (1 - rate))) if rate else -np.inf)
    entries, sizes, seen = bags(texts)
    common = seen >= LEAST_TEXTS
    rng = np.random.default_rng(SEED)
    embeddings = rng.uniform(-1, 1, (1 << BITS, DIMENSIONS)).astype(np.float32) / DIMENSIONS
    embeddings[~common] = 0
    softmax = rng.uniform(-1, 1, (2, DIMENSIONS)).astype(np.float32)
    bias = np.zeros(2, np.float32)
    seen = [np.full(x.shape, 1e-6, np.float32) for x in (embeddings[:, 0], softmax, bias)]
    for _ in range(-(-STEPS * BATCH // len(target))):  # as many steps whatever the size of the sample
        order = rng.permutation(len(target))
        for at in range(0, len(order), BATCH):
            rows = order[at : at + BATCH]
            entry = np.concatenate([entries[r] for r in rows])
            slot, count = entry >> COUNT_BITS, entry & MOST_COUNT
            held = common[slot]
            row = np.repeat(np.arange(len(rows)), [len(entries[r]) for r in rows])[held]
            slot, share = slot[held], (count[held] / (sizes[rows] + SILENT)[row]).astype(np.float32) * np.float32(SCALE)
            vectors = np.stack([
                np.bincount(row, share * embeddings[slot, k], len(rows)) for k in range(DIMENSIONS)
            ], axis=1)
            logits = vectors @ softmax.T + bias
            logits -= logits.max(axis=1, keepdims=True)
            chance = np.exp(logits)
            chance /= chance.sum(axis=1, keepdims=True)
            error = (chance - np.stack([1 - target[rows], target[rows]], axis=1)) / len(rows)
            # both classes have opposite errors, so an embedding's gradient is one number times a vector
            strength = np.bincount(slot, share * error[row, 1], 1 << BITS).astype(np.float32)
            used = np.flatnonzero(strength)
            direction = softmax[1] - softmax[0]
            for value, gradient, total in (
                (softmax, (error.T @ vectors).astype(np.float32), seen[1]),
                (bias, error.sum(axis=0).astype(np.float32), seen[2]),
            ):
                total += gradient**2
                value -= RATE * gradient / np.sqrt(total)
            seen[0][used] += strength[used] ** 2 * (direction @ direction)
            embeddings[used] -= RATE * (strength[used] / np.sqrt(seen[0][used]))[:, None] * direction
    return Model((embeddings @ (softmax[1] - softmax[0])).astype(np.float64), float(bias[1] - bias[0]))


def fitted(docs: DataFrame, labels: DataFrame) -> Model:
    """The model of a bounded sample of the labelled rows that are not held out.

    Of each label the ``SAMPLE_PER_LABEL`` rows with the smallest hash of their doc_id; their texts of
    at most ``SAMPLE_CHARS`` code points.  The driver holds no more than these.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic")).where(
        ~held_out()
    )
    chosen = None
    for label in (0, 1):
        some = known.where(F.col("toxic") == label).distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_PER_LABEL)
        chosen = some if chosen is None else chosen.union(some)
    rows = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .where(F.length("text") <= SAMPLE_CHARS)
        .join(F.broadcast(chosen), "doc_id")  # at most two times SAMPLE_PER_LABEL rows
        .select("doc_id", "text", "toxic")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "toxic", "text")
        .limit(2 * SAMPLE_PER_LABEL)
        .toArrow()
    )
    return train((text.as_py() for text in rows["text"]), rows["toxic"].to_pylist())


def scorer(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds ``score`` to record batches with ``text``."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            scores = pa.array(model.scores(batch.column("text").to_pylist()), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], [*batch.schema.names, "score"])

    return score


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that score below 0.5, with all their columns."""
    names = [f"c{i}" for i in range(len(docs.columns))]  # columns may have any names
    text = names[docs.columns.index("text")]
    plain = docs.toDF(*names)
    scored = plain.select("*", F.col(text).cast("string").alias("text")).mapInArrow(
        scorer(model), plain.schema.add("text", "string").add("score", "double")
    )
    return scored.where("score < 0.5").select(*names).toDF(*docs.columns)


def toxicity(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, score (0 to 1), predicted (1 from 0.5 on).

    Scores come from the whole text alone; ``labels(doc_id, toxic)`` serves the fit only, rows with
    other labels than 0 and 1 or without a doc_id are left out, and a label for an unknown document
    is ignored.  A text without words (NULL, empty) scores what the bias says, equal texts score equal.
    With labels of one kind all scores are that kind's smoothed share; without labels they are 0.
    held_out of a NULL doc_id is NULL.  Rows that repeat a doc_id are scored each.
    """
    model = fitted(docs, labels)
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .mapInArrow(scorer(model), "doc_id long, text string, score double")
        .select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
    )
