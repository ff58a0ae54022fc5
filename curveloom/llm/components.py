"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from curveloom.llm.tables import discard, stored

#: edges that one task of ``contracted`` holds at once
HELD_EDGES = 1 << 16


def _minimum(edges: DataFrame, key: str, value: str) -> DataFrame:
    return edges.groupBy(key).agg(F.min(value).alias("m"))


def _spanning(edges: pa.Table) -> pa.Table:
    """One edge for each node but the smallest of its group: to that smallest one."""
    ends = pa.chunked_array([*edges["a"].chunks, *edges["b"].chunks]).combine_chunks().dictionary_encode()
    names = ends.dictionary.to_pylist()
    order = sorted(range(len(names)), key=names.__getitem__)
    rank = {i: r for r, i in enumerate(order)}
    ranks = [rank[i] for i in ends.indices.to_pylist()]
    low = list(range(len(names)))

    def lowest(x: int) -> int:
        while low[x] != x:
            low[x] = x = low[low[x]]
        return x

    for x, y in zip(ranks[: edges.num_rows], ranks[edges.num_rows :]):
        x, y = lowest(x), lowest(y)
        low[max(x, y)] = min(x, y)
    pairs = [(order[x], order[r]) for x in range(len(low)) if (r := lowest(x)) != x]
    places = [pa.array([p[side] for p in pairs], pa.int64()) for side in (0, 1)]
    return pa.table([ends.dictionary.take(p) for p in places], schema=edges.schema)


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, n = [], 0
    for batch in batches:
        held.append(batch)
        n += batch.num_rows
        if n >= HELD_EDGES:
            rest = _spanning(pa.Table.from_batches(held))
            if 2 * rest.num_rows > HELD_EDGES:  # too many to meet further edges
                yield from rest.to_batches()
                rest = rest.slice(0, 0)
            held, n = rest.to_batches(), rest.num_rows
    if n:
        yield from _spanning(pa.Table.from_batches(held)).to_batches()


def contracted(edges: DataFrame) -> DataFrame:
    """Fewer edges with the same components: of those that one task holds, a forest to the smallest nodes.

    ``edges(a, b)`` are read twice.  A task takes about ``HELD_EDGES``, so few edges are joined at once and the
    rounds of ``components``, each with shuffles over all partitions, have less to do or nothing.
    """
    tasks = max(1, -(-edges.count() // HELD_EDGES))
    linked = edges.select("a", "b").where(F.col("a") != F.col("b")).coalesce(tasks)
    return linked.mapInArrow(_contracted, linked.schema)


def _settled(edges: DataFrame) -> bool:
    """Whether distinct edges, each to a smaller node, are stars: no node has two smaller ones, or one and a larger one."""
    ends = edges.select(F.col("a").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up")).union(
        edges.select("b", F.lit(0), F.lit(1))
    )
    held = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up"))
    return not held.where("down > 0 AND down + up > 1").count()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges(a, b)``; root is the smallest node that can be reached.

    Alternating stars: each node hands the smallest neighbour it knows to its larger neighbours (large
    star), then to its smaller ones (small star), until all that is left are stars.  A round moves each edge a
    few times whatever the degree of its nodes; minima combine before the shuffle, and the joins'
    hot keys are left to Spark's skew handling.  Empty input gives an empty table.
    """
    edges = stored(
        edges.where(F.col("a") != F.col("b"))
        .select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(),
        "edges",
    )
    while not _settled(edges):
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = _minimum(both, "a", "b").select("a", F.least("a", "m").alias("m"))
        large = (
            both.where(F.col("b") > F.col("a")).join(low, "a")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b")).distinct()
        )
        # the large star leaves every edge pointing down, so a node's smallest neighbour is its minimum
        down = _minimum(large, "a", "b")
        small = (
            large.join(down, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(down.select("a", F.col("m").alias("b")))
            .where(F.col("a") != F.col("b")).distinct()
        )
        following = stored(small, "edges")
        discard(edges)
        edges = following
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    )
