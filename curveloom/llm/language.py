"""Language identification as a mixture of languages per document.

Each language has n-gram likelihoods learnt from all labelled documents.  Expectation-maximisation
gives every document the language proportions that explain its words best, and of the sets of its one,
two, ... strongest languages the one with the best penalised likelihood is taken.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from curveloom.llm.subwords import chunks, grams

ORDER = 3
BITS = 16
SMOOTHING = 0.5
ROUNDS = 10
CLOSE = 5e-3
#: log likelihood that each further language must earn, times the logarithm of the number of words
PENALTY = 2.0
UNKNOWN = "und"


def held_out() -> Column:
    return F.crc32(F.col("doc_id").cast("string")) % 3 == 1


def _units(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Slots of the trigrams around the bytes of words, and where each word begins among them."""
    slots, counts = next(grams(data, range(ORDER, ORDER + 1), BITS))
    return slots[counts], np.flatnonzero(data[:-2][counts] == 32)


def _counted(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[str, np.ndarray] = {}
    for batch in batches:
        for lang, texts in batch.groupby("lang")["text"]:
            total = held.setdefault(lang, np.zeros(1 << BITS, np.int64))
            for _, _, data, _ in chunks(texts.tolist()):
                total += np.bincount(_units(data)[0], minlength=1 << BITS)
    for lang, total in held.items():
        slots = np.flatnonzero(total)
        yield pd.DataFrame({"lang": lang, "slot": slots, "n": total[slots]})


@dataclass(frozen=True)
class Model:
    """Log likelihoods of the n-gram slots, one column per language."""

    languages: list[str]
    likelihoods: np.ndarray

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        wanted = [i for i, t in enumerate(texts) if t and any(map(str.isalpha, t))] if self.languages else []
        for first, last, data, starts in chunks([texts[i] for i in wanted]):
            slots, begins = _units(data)
            words = np.add.reduceat(self.likelihoods[slots], begins, axis=0)
            where = np.flatnonzero((data[1:-1] != 32) & (data[:-2] == 32))
            ends = np.searchsorted(where, np.append(starts[1:], len(data)))
            best, share = _chosen(words, np.diff(ends, prepend=0))
            for i, b, s in zip(wanted[first:last], best.tolist(), share.tolist()):
                names[i], scores[i] = self.languages[b], s
        return names, scores


def _mixture(chances: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Language proportions of each run of rows, and their log likelihood, by expectation-maximisation."""
    starts = np.cumsum(size) - size
    share = (chances.any(axis=0) if not len(size) else np.maximum.reduceat(chances, starts, axis=0) > 0).astype(float)
    share /= share.sum(axis=1, keepdims=True)
    # each text stops on its own, so its share does not depend on the texts beside it
    going, left, n = np.arange(len(size)), chances, size
    for _ in range(ROUNDS):
        if not len(going):
            break
        weighted = left * np.repeat(share[going], n, axis=0)
        weighted /= weighted.sum(axis=1, keepdims=True)
        after = np.add.reduceat(weighted, np.cumsum(n) - n, axis=0) / n[:, None]
        moving = np.abs(after - share[going]).max(axis=1) >= CLOSE
        share[going] = after
        if not moving.all():
            going, left, n = going[moving], left[np.repeat(moving, n)], n[moving]
    explained = (chances * np.repeat(share, size, axis=0)).sum(axis=1)
    return share, np.add.reduceat(np.log(explained), starts)


def _chosen(words: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Main language and its proportion for each text; ``words`` has log likelihoods, ``size`` words per text."""
    best, share = np.zeros(len(size), np.int64), np.ones(len(size))
    some = np.flatnonzero(size)  # letters outside words cannot occur, but a text may hold no unit
    if not len(some):
        return best, np.zeros(len(size))
    size = size[some]
    starts = np.cumsum(size) - size
    top = words.max(axis=1)
    chances = np.maximum(np.exp(words - top[:, None]), 1e-300)
    alone = np.add.reduceat(words - top[:, None], starts, axis=0)
    penalty = PENALTY * np.log(size + 1)
    best[some], value = alone.argmax(axis=1), alone.max(axis=1) - penalty
    # no mixture explains a text better than the best language of each word would, which counts as 0 here
    open_ = np.flatnonzero(-2 * penalty > value)
    if not len(open_):
        return best, share
    row = np.repeat(np.arange(len(size)), size)
    mixed, fit = np.zeros(alone.shape), np.zeros(len(size))
    mixed[open_], fit[open_] = _mixture(chances[np.isin(row, open_)], size[open_])
    open_ = open_[fit[open_] - 2 * penalty[open_] > value[open_]]
    ranks = np.argsort(-mixed, axis=1, kind="stable")
    for k in range(2, words.shape[1] + 1):
        open_ = open_[fit[open_] - k * penalty[open_] > value[open_]]
        if not len(open_):
            break
        inside = np.isin(row, open_)
        allowed = np.zeros(mixed.shape, bool)
        np.put_along_axis(allowed, ranks[:, :k], True, axis=1)
        part, explained = _mixture(np.where(allowed[row[inside]], chances[inside], 0.0), size[open_])
        better = explained - k * penalty[open_] > value[open_]
        at = open_[better]
        value[at] = explained[better] - k * penalty[at]
        best[some[at]] = part[better].argmax(axis=1)
        share[some[at]] = part[better].max(axis=1)
    return best, share


def fitted(docs: DataFrame) -> Model:
    """n-gram likelihoods of every language named in documents that are not held out, over whole texts.

    The driver holds one number per language and n-gram slot, whatever the number of documents.
    """
    counts = (
        docs.select(F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), "doc_id")
        .where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~F.coalesce(held_out(), F.lit(False)))
        .select("lang", "text")
        .mapInPandas(_counted, "lang string, slot int, n long")
        .groupBy("lang", "slot").agg(F.sum("n").alias("n"))
        .toPandas()
    )
    languages = sorted(counts["lang"].unique())
    table = np.full((1 << BITS, len(languages)), SMOOTHING)
    table[counts["slot"], np.searchsorted(languages, counts["lang"])] += counts["n"]
    return Model(languages, np.log(table / table.sum(axis=0)))


def predictor(model: Model) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = model.predict(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                ["doc_id", "lang_pred", "score"],
            )

    return predict


def languages(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, held_out, lang_pred, score (the language's share of the text).

    Learns from text and lang where lang is not NULL and the row is not held out; predicts from the
    whole text alone.  ``und`` with score 0 where the text is NULL or has no letter, and everywhere
    when there is nothing to learn from.  Equal texts get equal results; of equally likely languages
    the first by name.  held_out of a NULL doc_id is NULL, and such a row is learnt from.
    """
    model = fitted(docs)
    return (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .mapInArrow(predictor(model), "doc_id long, lang_pred string, score double")
        .select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
    )
