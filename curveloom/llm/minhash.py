"""Near-duplicate documents by circulant MinHash, banding and exact Jaccard verification.

Two permutations of a universe of ``UNIVERSE`` slots make every signature coordinate: the first
scatters the shingles of a document, the second is read at its slots shifted by k places, and
coordinate k is the smallest value read.  So a shingle costs one contiguous read of the second
permutation instead of one hash function per coordinate.

Whole texts are compared, not signatures: a pair that shares a band counts only when the full sets
of 64-bit shingle hashes satisfy ``100 * shared >= percent * all``: 85 percent, unless a caller asks for less.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache, partial

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window, functions as F

from curveloom.llm.components import components, contracted
from curveloom.llm.tables import discard, stored

WORDS = 5
PERCENT = 85
BANDS, ROWS = 24, 6
#: bands of likenesses below ``PERCENT``: at 80 % a pair shares none of them with probability 0.000015
LOWER_BANDS, LOWER_ROWS = 28, 5
UNIVERSE = 1 << 20
SEED = 20_261
BLOCK_SETS = 256
COLUMNS = 4096
BLOCK = 2048
#: stands for a NULL doc_id where rows are looked up
NO_ID = -(1 << 63)
_ODD = np.random.default_rng(SEED).integers(1 << 62, 1 << 63, size=WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the five-word shingles; of all words when there are fewer."""
    words = text.encode("utf-8", "surrogatepass").lower().split() if text else []  # bytes: A-Z and ASCII blanks only
    if not words:
        return np.empty(0, np.uint64)
    if len(words) < WORDS:
        return np.array([xxhash.xxh3_64_intdigest(b" ".join(words), seed=len(words))], np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(words) - WORDS + 1
    joined = hashes[:n] * _ODD[0]
    for i in range(1, WORDS):
        joined += mix(hashes[i : i + n] + np.uint64(i)) * _ODD[i]
    return np.unique(mix(joined))


@lru_cache(1)
def permutations() -> tuple[np.ndarray, np.ndarray]:
    """The scattering permutation, and windows of the shifted one: row s holds its values from slot s on."""
    rng = np.random.default_rng(SEED)
    first, second = (rng.permutation(UNIVERSE).astype(np.uint32) for _ in range(2))
    k = BANDS * ROWS
    return first, sliding_window_view(np.concatenate([second, second[: k - 1]]), k)


def signature(hashes: np.ndarray) -> np.ndarray:
    first, shifted = permutations()
    slots = first[hashes & np.uint64(UNIVERSE - 1)]
    parts = [shifted[slots[i : i + BLOCK]].min(axis=0) for i in range(0, len(slots), BLOCK)]
    return np.minimum.reduce(parts)


def bands(hashes: np.ndarray, percent: int = PERCENT) -> list[int]:
    n, size = (BANDS, ROWS) if percent >= PERCENT else (LOWER_BANDS, LOWER_ROWS)
    rows = signature(hashes)[: n * size].reshape(n, size).astype(np.uint64)
    keys = np.arange(n, dtype=np.uint64)
    for i in range(size):
        keys = mix(keys * np.uint64(0x9E3779B97F4A7C15) + rows[:, i])
    return keys.view(np.int64).tolist()


def digest(hashes: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(hashes.tobytes())


def _signed(batches: Iterator[pa.RecordBatch], percent: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sizes, names, keys = [], [], []
        for text in batch.column("text"):
            found = shingles(text.as_py())
            sizes.append(len(found))
            names.append(digest(found) if len(found) else None)
            keys.append(bands(found, percent) if len(found) else None)
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("doc"), batch.column("text_hash"), pa.array(sizes, pa.int64()),
             pa.array(names, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
            ["doc_id", "doc", "text_hash", "n_shingles", "set_id", "bands"],
        )


def _plain(docs: DataFrame) -> DataFrame:
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"),
        F.col("text").cast("string").alias("text"),
        F.xxhash64(F.col("text").cast("string")).alias("text_hash"),
    )


def signed(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(doc_id, doc, text_hash, n_shingles, set_id, bands); set_id and bands are NULL for a document without words."""
    return _plain(docs).mapInArrow(
        partial(_signed, percent=percent), "doc_id long, doc long, text_hash long, n_shingles long, set_id binary, bands array<long>"
    )


def _verified(batches: Iterator[pd.DataFrame], percent: int) -> Iterator[pd.DataFrame]:
    """Tests pairs of texts; the text seen last on each side is not read twice."""
    last: dict[str, tuple[str | None, np.ndarray]] = {"a": ("", shingles("")), "b": ("", shingles(""))}

    def of(side: str, text: str) -> np.ndarray:
        if last[side][0] != text:
            last[side] = (text, shingles(text))
        return last[side][1]

    for batch in batches:
        linked = []
        for left, right in zip(batch["text_a"], batch["text_b"]):
            x, y = of("a", left), of("b", right)
            shared = len(np.intersect1d(x, y, assume_unique=True))
            linked.append(100 * shared >= percent * (len(x) + len(y) - shared))
        yield pd.DataFrame({"a": batch["a"], "b": batch["b"], "linked": np.array(linked, bool)})


def _tested(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """(a, b, linked) of each pair of set ids, by the full sets of their texts."""
    with_b = pairs.join(texts.select(F.col("set_id").alias("b"), F.col("text").alias("text_b")), "b")
    both = with_b.join(texts.select(F.col("set_id").alias("a"), F.col("text").alias("text_a")), "a")
    return both.select("a", "b", "text_a", "text_b").mapInPandas(partial(_verified, percent=percent), "a binary, b binary, linked boolean")


def _named(sets: DataFrame, roots: DataFrame) -> DataFrame:
    return sets.join(roots.withColumnRenamed("node", "set_id"), "set_id", "left").withColumn(
        "root", F.coalesce("root", "set_id")
    )


def _forest(left: list[np.ndarray], right: list[np.ndarray], percent: int = PERCENT) -> list[tuple[int, int]]:
    """Links between two lists of sets, as (position, position in its group's lowest) without cycles.

    Positions run through ``left`` and then ``right``.  Shared elements are counted exactly by
    products of 0/1 matrices over the elements that at least two of the sets hold.
    """
    sets = left + right
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, column, held = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    useful = held[column] > 1
    owner, column = owner[useful], np.cumsum(held > 1)[column[useful]] - 1
    order = np.argsort(column, kind="stable")
    owner, column = owner[order], column[order]
    shared = np.zeros((len(left), len(right)))
    for start in range(0, int((held > 1).sum()), COLUMNS):
        low, high = np.searchsorted(column, [start, start + COLUMNS])
        grid = np.zeros((len(sets), COLUMNS), np.float32)
        grid[owner[low:high], column[low:high] - start] = 1
        shared += grid[: len(left)] @ grid[len(left) :].T
    size = np.array([len(s) for s in sets])
    linked = 100 * shared >= percent * (size[: len(left), None] + size[None, len(left) :] - shared)
    group = np.arange(len(sets))
    for i in np.flatnonzero(linked.any(axis=1)):
        joined = np.append(group[len(left) :][linked[i]], group[i])
        group[np.isin(group, joined)] = joined.min()
    return [(int(i), int(group[i])) for i in np.flatnonzero(group != np.arange(len(sets)))]


def _linked_blocks(batches: Iterator[pd.DataFrame], percent: int) -> Iterator[pd.DataFrame]:
    """Edges within each run of rows with one (bucket, i, j); asked sets meet the others."""

    def edges(asked: dict[bytes, np.ndarray], others: dict[bytes, np.ndarray]) -> pd.DataFrame:
        names = [*asked, *others]
        found = _forest([*asked.values()], [*others.values()], percent) if asked and others else []
        return pd.DataFrame({"a": [names[x] for x, _ in found], "b": [names[y] for _, y in found]})

    key, sides = None, ({}, {})
    for batch in batches:
        for bucket, i, j, side, name, text in batch.itertuples(index=False):
            if (bucket, i, j) != key:
                yield edges(*sides)
                key, sides = (bucket, i, j), ({}, {})
            sides[side][bytes(name)] = shingles(text)
    yield edges(*sides)


def _unsettled(members: DataFrame, roots: DataFrame) -> DataFrame:
    """Members of buckets of over two sets that hold several components; ``asked``: outside the bucket's largest.

    Of buckets with the same members one is enough.
    """
    inside = _named(members.where("size > 2").select("bucket", "set_id"), roots)
    held = inside.groupBy("bucket", "root").agg(
        F.count("*").alias("n"), F.sum(F.xxhash64("set_id").cast("decimal(38,0)")).alias("sum")
    )
    several = (
        held.groupBy("bucket")
        .agg(F.sum("n").alias("size"), F.sum("sum").alias("sum"), F.max(F.struct("n", "root")).alias("main"))
        .where(F.col("size") > F.col("main.n"))
        .groupBy("size", "sum")
        .agg(F.min(F.struct("bucket", "main")).alias("r"))
        .select("r.bucket", "size", F.col("r.main.root").alias("main"), (F.col("size") - F.col("r.main.n")).alias("n_asked"))
    )
    return inside.join(several, "bucket").withColumn("asked", F.col("root") != F.col("main"))


def _blocks(unsettled: DataFrame) -> DataFrame:
    """(bucket, i, j, side, set_id): every asked set meets every set of its bucket in one block (i, j).

    Blocks hold about ``BLOCK_SETS`` sets of either side, so a bucket is never in one task.
    """
    count = lambda n: F.ceil(F.col(n) / BLOCK_SETS).cast("int")
    place = lambda n: F.pmod(F.xxhash64("set_id"), count(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), count(n) - 1))
    asked = unsettled.where("asked").select(
        "bucket", place("n_asked").alias("i"), every("size").alias("j"), F.lit(0).alias("side"), "set_id"
    )
    others = unsettled.select(
        "bucket", every("n_asked").alias("i"), place("size").alias("j"), F.lit(1).alias("side"), "set_id"
    )
    return asked.union(others)


def set_components(signs: DataFrame, docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """(node, root): the distinct shingle sets that links join, and one set that stands for each group.

    Copies are one set.  First every set of a bucket meets the bucket's smallest set, which joins most
    of a group of near copies.  In buckets that still hold several components, every set outside the
    largest one then meets all sets of the bucket, in blocks.  So each two sets that share a band are
    compared or known to be connected; nothing is capped, and only links leave a task.
    """
    first = signs.where(F.col("set_id").isNotNull()).groupBy("set_id").agg(
        F.min(F.struct("doc", "text_hash", "bands")).alias("r")
    )
    rows = stored(first.select("set_id", "r.doc", "r.text_hash", F.explode("r.bands").alias("bucket")), "bands")
    shared = rows.groupBy("bucket").agg(F.count("*").alias("size"), F.min("set_id").alias("pivot")).where("size > 1")
    members = stored(rows.join(shared, "bucket"), "buckets")
    discard(rows)
    named = members.groupBy("set_id").agg(F.min("doc").alias("doc"), F.min("text_hash").alias("text_hash"))
    # rows that repeat both a doc_id and a text stand for one set, and one text of it is enough
    texts = _plain(docs).where("text IS NOT NULL").join(named, ["doc", "text_hash"]).select("set_id", "text")
    texts = stored(texts.dropDuplicates(["set_id"]), "texts")
    stars = members.where(F.col("set_id") != F.col("pivot")).select(
        F.col("set_id").alias("a"), F.col("pivot").alias("b")
    ).distinct()
    links = stored(_tested(stars, texts, percent).where("linked").select("a", "b"), "links")
    roots = stored(components(contracted(links)), "roots")
    blocks = _blocks(_unsettled(members, roots)).join(texts, "set_id")
    more = (
        blocks.select("bucket", "i", "j", "side", "set_id", "text")
        .repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "side")
        .mapInPandas(partial(_linked_blocks, percent=percent), "a binary, b binary")
    )
    return stored(components(contracted(links.union(stored(more, "links")))), "roots")


def _placed(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """doc_id, text_hash, n_shingles, component_id and kept of each row, as ``near_duplicates`` defines them."""
    signs = stored(signed(docs, percent), "signatures")
    named = _named(signs.drop("bands"), set_components(signs, docs, percent))
    lowest = named.where(F.col("root").isNotNull()).groupBy("root").agg(F.min("doc_id").alias("component_id"))
    component = F.coalesce("component_id", "doc_id")
    return named.join(lowest, "root", "left").select(
        "doc_id", "text_hash", "n_shingles", component.alias("component_id"),
        F.when(component.isNotNull(), F.col("doc_id").eqNullSafe(component)).alias("kept"),
    )


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept.

    ``docs`` needs doc_id and text; other columns, whatever their names, are not read.  A text
    without words (NULL, empty, blank) has n_shingles 0 and is linked with nothing: component_id is
    its own doc_id.  Rows that repeat a doc_id are documents of their own with that id.  A NULL doc_id
    keeps its row; it belongs to a component only beside documents with an id, and kept is then false,
    else component_id and kept are NULL.  No documents give no rows.
    """
    return _placed(docs).drop("text_hash")


def without_near_duplicates(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The kept rows of ``docs``, with all their columns: of each component that with the smallest doc_id.

    Two texts are linked from ``percent`` likeness on; the bands suit 80 and more.

    Texts without words stay, and so do rows without a doc_id in components without one.  Rows with equal
    doc_id and text count once.
    """
    names = [f"c{i}" for i in range(len(docs.columns))]  # columns may have any names
    doc_id, text = (F.col(names[docs.columns.index(c)]) for c in ("doc_id", "text"))
    keys = {"no_id": F.col("doc_id").isNull(), "id": F.coalesce("doc_id", F.lit(0))}
    rows = docs.toDF(*names).withColumns(
        {"doc_id": doc_id.cast("long"), "text_hash": F.xxhash64(text.cast("string"))}
    ).withColumns(keys)
    stay = _placed(docs, percent).where(F.coalesce("kept", F.lit(True))).withColumns(keys).select(*keys, "text_hash").distinct()
    first = F.row_number().over(Window.partitionBy(*keys, "text_hash").orderBy(F.lit(0)))
    return rows.join(stay, [*keys, "text_hash"], "left_semi").withColumn("turn", first).where("turn = 1").select(*names).toDF(*docs.columns)
