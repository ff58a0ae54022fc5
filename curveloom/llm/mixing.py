"""Mixing a corpus to target weights by iterative proportional fitting.

Documents are counted into cells of equal source, language and topic.  The cells' tokens are raked until
the sums over each of the three have their target shares, while no cell keeps more than it has; a document
is then drawn with the share of its cell that is kept.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

ROUNDS = 200
CLOSE = 1e-9
TEMPERATURE = 0.7
KEEP = 0.6
SEED = 20_269
#: the driver holds one number per combination of categories; more combinations stop the job
MOST_CELLS = 100_000
MISSING = "(none)"


def tokens_of(text: Column) -> Column:
    """Words between white space; 0 for NULL or blank text."""
    trimmed = F.trim(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), r"\s+", " "))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.length(trimmed) - F.length(F.replace(trimmed, F.lit(" "), F.lit(""))) + 1).cast("long")


def topic_of(text: Column) -> Column:
    """What a text is made of, as a stand-in for a topic label: table, web, prose or empty."""
    plain = F.coalesce(text.cast("string"), F.lit(""))
    return (
        F.when(F.trim(plain) == "", "empty")
        .when(plain.contains(" | "), "table")
        .when(plain.contains("http") | plain.contains("@"), "web")
        .otherwise("prose")
    )


def tempered(totals: np.ndarray, temperature: float) -> np.ndarray:
    """Shares that flatten ``totals``: 1 leaves them as they are, 0 makes all equal that have any."""
    raised = np.where(totals > 0, np.maximum(totals, 1e-300) ** temperature, 0.0)
    return raised / raised.sum() if raised.any() else raised


def shares(names: list[str], totals: np.ndarray, target: Mapping[str, float] | None, temperature: float) -> np.ndarray:
    """Target share of each name: given ones scaled to what is present, the others keep their own.

    Without ``target`` the shares are the tempered totals.
    """
    if target is None:
        return tempered(totals, temperature)
    own = totals / totals.sum() if totals.any() else totals
    given = np.array([n in target for n in names], bool)
    wanted = np.array([float(target.get(n, 0.0)) for n in names]) * (totals > 0)
    if not wanted.any():
        return own
    rest = own[~given].sum()
    return np.where(given, wanted / wanted.sum() * (1 - rest), own)


def rake(held: np.ndarray, places: list[np.ndarray], wanted: list[np.ndarray], keep: float) -> np.ndarray:
    """Kept share (0 to 1) of each cell, by iterative proportional fitting under the cells' bounds.

    ``places[d]`` is the category of each cell in dimension d, ``wanted[d]`` the target share of each
    category.  Where bounds make the targets impossible, the last round's shares stand.
    """
    kept, total = held * keep, held.sum() * keep
    for _ in range(ROUNDS):
        before = kept
        for place, share in zip(places, wanted):
            now = np.bincount(place, kept, len(share))
            factor = np.divide(share * total, now, out=np.zeros(len(share)), where=now > 0)
            kept = np.minimum(kept * factor[place], held)
        if np.abs(kept - before).max(initial=0.0) <= CLOSE * max(total, 1.0):
            break
    return np.divide(kept, held, out=np.zeros(len(held)), where=held > 0)


def mixed(
    docs: DataFrame,
    dimensions: Mapping[str, Column],
    targets: Mapping[str, Mapping[str, float]] | None = None,
    keep: float = KEEP,
    temperature: float = TEMPERATURE,
) -> DataFrame:
    """(doc, categories, tokens, probability, sampled): every row of ``docs`` and its draw.

    ``doc`` is the whole row, ``categories`` its value in each of ``dimensions`` (NULL counts as a category
    of its own).  ``keep`` is the share of all tokens to draw; ``targets`` gives shares per dimension,
    by name.  The draw is a hash of doc_id and text, so a task that runs again draws the same, and repeated
    rows share their fate.  A document without tokens is drawn with probability ``keep``.  No documents
    give no rows.
    """
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.array(*[F.coalesce(c.cast("string"), F.lit(MISSING)) for c in dimensions.values()]).alias("categories"),
        tokens_of(F.col("text")).alias("tokens"),
    )
    cells = rows.groupBy("categories").agg(F.sum("tokens").alias("tokens")).limit(MOST_CELLS + 1).collect()
    if len(cells) > MOST_CELLS:
        raise ValueError(f"more than {MOST_CELLS} combinations of {', '.join(dimensions)}")
    cells = sorted(cells, key=lambda c: c["categories"])
    held = np.array([c["tokens"] for c in cells], float)
    places, wanted = [], []
    for d, name in enumerate(dimensions):
        names, place = np.unique([c["categories"][d] for c in cells], return_inverse=True) if cells else ([], np.zeros(0, int))
        places.append(place)
        wanted.append(shares(list(names), np.bincount(place, held, len(names)), (targets or {}).get(name), temperature))
    kept = np.where(held > 0, rake(held, places, wanted, keep), keep)
    chances = docs.sparkSession.createDataFrame(
        [(c["categories"], float(p)) for c, p in zip(cells, kept)], "categories array<string>, probability double"
    )
    draw = F.pmod(F.xxhash64(F.lit(SEED), F.col("doc.doc_id"), F.col("doc.text")), F.lit(1 << 53)) / F.lit(float(1 << 53))
    # at most MOST_CELLS rows: broadcast, so that texts stay where they are and no category is hot
    return rows.join(F.broadcast(chances), "categories").select(
        "doc", "categories", "tokens", "probability", (draw < F.col("probability")).alias("sampled")
    )


def dimensions_of() -> dict[str, Column]:
    """Source, language and topic of the documents table."""
    return {"source": F.col("source"), "lang": F.col("lang"), "topic": topic_of(F.col("text"))}


def mixture(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, source, lang, topic, tokens, probability, sampled."""
    names = list(dimensions_of())
    return mixed(docs, dimensions_of()).select(
        F.col("doc.doc_id").cast("long").alias("doc_id"),
        *[F.col("categories")[i].alias(n) for i, n in enumerate(names)],
        "tokens", "probability", "sampled",
    )
