"""Near-duplicate embeddings by navigable small-world graphs per shard.

Copies are one vector.  Distinct vectors are dealt to shards by hash, each shard gets a graph, and every
vector queries every shard.  Graphs lie in tables of one row a point.  A task holds some blocks of queries and one
graph at a time, so its memory does not grow with the input.  Beams widen while they are full of links, and while an
audit of each block of queries against the whole shard misses links.  Links near the bound are verified by cosine in
double precision; only counts and the edges of a spanning forest leave a task.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial
from itertools import groupby, pairwise
from operator import itemgetter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from curveloom.llm.components import components
from curveloom.llm.hnsw import BEAM, GATHERED, Graph
from curveloom.llm.tables import stored

COSINE = 0.9
#: similarities of 32 bits that are nearer than this to the bound are verified in double precision
MARGIN = 1e-3
SHARD_BYTES, LEAST_SHARDS = 64 << 20, 6
#: bytes that a point of a shard counts at least, for its neighbours
POINT_BYTES = 256
BLOCK_QUERIES, BLOCKS_A_COPY = 1_024, 64
#: bytes of query vectors that a task holds
HELD_BYTES = 64 << 20
#: queries of a block that are compared with the whole shard, and the share of links that must be found
AUDITED, RECALL = 16, 0.999
#: a beam costs about as much as the exact products with this many points for each place in it
BEAM_COST = 128
#: queries and points whose products are held at once
EXACT_QUERIES, EXACT_POINTS = 64, 1 << 14
#: points in a batch of an index
WRITTEN_POINTS = 4_096
SEED = 20_263


def _valid(batches: Iterator[pa.RecordBatch], kind: str) -> Iterator[pa.RecordBatch]:
    """vec_id, node (digest of the vector; NULL if it cannot have links), vector as floats of that kind, dims."""
    for batch in batches:
        nodes, vectors, dims = [], [], []
        column = batch.column("embedding")
        flat, null = column.values.to_numpy(zero_copy_only=False), column.is_null().to_numpy(zero_copy_only=False)
        for (begin, end), absent in zip(pairwise(column.offsets.to_numpy()), null):
            row = flat[begin:end]
            good = not absent and len(row) > 0 and bool(np.isfinite(row).all()) and bool(row.any())
            nodes.append(xxhash.xxh3_128_digest(row.astype("<f8").tobytes()) if good else None)
            vectors.append(row.astype(kind).tobytes() if good else None)
            dims.append(len(row) if good else 0)
        yield pa.RecordBatch.from_arrays(
            [batch.column("vec_id"), pa.array(nodes, pa.binary()), pa.array(vectors, pa.binary()), pa.array(dims, pa.int32())],
            ["vec_id", "node", "vector", "dims"],
        )


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1, in double precision; scaled first, so that neither tiny nor huge numbers are lost."""
    vectors = vectors.astype(np.float64)
    scaled = vectors / np.abs(vectors).max(axis=1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def _small(vectors: np.ndarray) -> np.ndarray:
    """Rows of length 1 in 32 bits, made some at a time."""
    out, step = np.empty(vectors.shape, np.float32), max(1, GATHERED // vectors.shape[1])
    for at in range(0, len(vectors), step):
        out[at : at + step] = _unit(vectors[at : at + step])
    return out


def _runs(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple[int, ...], Iterator[pa.RecordBatch]]]:
    """The pieces of rows that follow one another with equal keys."""

    def pieces() -> Iterator[tuple[tuple[int, ...], pa.RecordBatch]]:
        for batch in batches:
            held = np.stack([batch.column(k).to_numpy() for k in keys])
            changes = np.flatnonzero((held[:, 1:] != held[:, :-1]).any(axis=0)) + 1
            for begin, end in pairwise([0, *changes.tolist(), batch.num_rows]):
                if begin < end:
                    yield tuple(held[:, begin].tolist()), batch.slice(begin, end - begin)

    for key, found in groupby(pieces(), itemgetter(0)):
        yield key, (piece for _, piece in found)


def _bytes(column: pa.Array) -> np.ndarray:
    """All bytes of a column of binary values without NULLs."""
    _, offsets, data = column.cast(pa.binary()).buffers()
    ends = np.frombuffer(offsets, np.int32)[column.offset :][[0, len(column)]]
    return np.frombuffer(data, np.uint8)[slice(*ends)]


def _binary(data: np.ndarray, ends: np.ndarray) -> pa.Array:
    """Binary values from their bytes; ``ends``: 0 and the end of each."""
    return pa.Array.from_buffers(pa.binary(), len(ends) - 1, [None, pa.py_buffer(ends.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def _names(raw: np.ndarray) -> np.ndarray:
    """16-byte names as rows of two numbers."""
    return raw.view("<i8").reshape(-1, 2)


def _named(names: np.ndarray) -> pa.Array:
    return _binary(names, 16 * np.arange(len(names) + 1))


def _matrix(raw: np.ndarray, rows: int, dims: int) -> np.ndarray:
    """Vectors of 32 or 64 bits a number."""
    return raw.view(f"<f{len(raw) // (rows * dims)}").reshape(rows, dims)


def _gathered(pieces: Iterator[pa.RecordBatch], dims: int, *others: str) -> tuple[np.ndarray, ...]:
    """Names, vectors and further columns (numbers, or the bytes of binary values) of all pieces."""
    held = [
        [_bytes(c) if pa.types.is_binary(c.type) or pa.types.is_large_binary(c.type) else c.to_numpy() for c in map(p.column, ("node", "vector", *others))]
        for p in pieces
    ]
    names, vectors, *rest = (np.concatenate(parts) for parts in zip(*held))
    return _names(names), _matrix(vectors, len(names) // 16, dims), *rest


def _built(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The points of each shard in the order given, with their places and neighbours."""
    for (dims, _), pieces in _runs(batches, "dims", "shard"):
        held = pa.Table.from_batches(list(pieces))
        rows = np.concatenate([_bytes(chunk) for chunk in held["vector"].chunks])
        graph = Graph.build(_small(_matrix(rows, held.num_rows, dims)), SEED)
        flat, first = graph.lists()
        for name, column in (("place", np.arange(held.num_rows, dtype=np.int32)), ("level", graph.levels.astype(np.int32))):
            held = held.append_column(name, pa.array(column))
        yield from held.append_column("links", _binary(flat, 4 * first)).combine_chunks().to_batches(WRITTEN_POINTS)
        del held, rows, graph, flat
        pa.default_memory_pool().release_unused()


def _linked(points: np.ndarray, queries: np.ndarray, q: np.ndarray, p: np.ndarray, near: np.ndarray) -> np.ndarray:
    """Which pairs are links, by their similarities of 32 bits and, near the bound, in double precision."""
    good, step = near >= COSINE, max(1, GATHERED // points.shape[1])
    close = np.flatnonzero(np.abs(near - COSINE) <= MARGIN)
    for at in range(0, len(close), step):
        some = close[at : at + step]
        good[some] = np.einsum("ij,ij->i", _unit(queries[q[some]]), _unit(points[p[some]])) >= COSINE
    return good


def _exact(graph: Graph, points: np.ndarray, queries: np.ndarray, small: np.ndarray, asked: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of the ``asked`` queries with all points, some queries and points at a time."""
    for at in range(0, len(asked), EXACT_QUERIES):
        some = asked[at : at + EXACT_QUERIES]
        for first in range(0, len(points), EXACT_POINTS):
            near = small[some] @ graph.vectors[first : first + EXACT_POINTS].T
            q, p = np.nonzero(near >= COSINE - MARGIN)
            near, q, p = near[q, p], some[q], p + first
            good = _linked(points, queries, q, p, near)
            if good.any():
                yield q[good], p[good]


def _exhaustive(width: int, points: int) -> bool:
    """Whether a beam of that width is no better than all points; each search begins in the graph."""
    return width >= points or (width > BEAM and width * BEAM_COST >= points)


def _attempt(graph: Graph, points: np.ndarray, queries: np.ndarray, small: np.ndarray, beam: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pieces of the links that beams find; a beam full of links widens while that costs less than all points do."""
    open_, width = np.arange(len(queries)), beam
    while len(open_):
        if _exhaustive(width, len(points)):
            yield from _exact(graph, points, queries, small, open_)
            return
        nodes, near = graph.search(small[open_], width)
        near = np.where(nodes < 0, -2, near)
        done = near[:, -1] < COSINE - MARGIN  # else the beam is full of links
        row, place = np.nonzero((near >= COSINE - MARGIN) & done[:, None])
        q, p = open_[row], nodes[row, place]
        good = _linked(points, queries, q, p, near[row, place])
        yield q[good], p[good]
        open_, width = open_[~done], 2 * width


def link_pieces(graph: Graph, points: np.ndarray, queries: np.ndarray, beam: int = BEAM) -> Iterator[tuple[np.ndarray, np.ndarray] | None]:
    """Pieces (query, point) of the links between rows; ``graph`` has the points as unit rows of 32 bits.

    An audit compares a fixed number of queries with all points.  If it misses links, None takes back all pieces
    so far and the search begins again with a wider beam, at last with all points.
    """
    audit = np.unique(np.linspace(0, len(queries) - 1, min(AUDITED, len(queries))).astype(np.int64))
    small = _small(queries)
    true = sum(len(q) for q, _ in _exact(graph, points, queries, small, audit))
    while True:
        found = np.zeros(len(queries), np.int64)
        for q, p in _attempt(graph, points, queries, small, beam):
            found += np.bincount(q, minlength=len(queries))
            yield q, p
        if _exhaustive(beam, len(points)) or found[audit].sum() >= RECALL * true:
            return
        yield None
        beam *= 2


def linked(graph: Graph, points: np.ndarray, queries: np.ndarray, beam: int = BEAM) -> tuple[np.ndarray, np.ndarray]:
    """(query, point) of all links found."""
    pieces = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
    for piece in link_pieces(graph, points, queries, beam):
        pieces = pieces[:1] if piece is None else [*pieces, piece]
    return np.concatenate([q for q, _ in pieces]), np.concatenate([p for _, p in pieces])


def _spanning(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the edges (a, b) connect, fewer than their ends."""
    ends, place = np.unique(np.concatenate([a, b]), return_inverse=True)
    joined, root = _forest(place[: len(a)], place[len(a) :], len(ends))
    return ends[joined], ends[root]


def _forest(q: np.ndarray, p: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what the edges (q, p) among ``n`` nodes connect, at most one a node."""
    label = np.arange(n)
    while len(q):
        low = np.minimum(label[q], label[p])
        before = label.copy()
        np.minimum.at(label, q, low)
        np.minimum.at(label, p, low)
        np.minimum.at(label, before[q], low)
        np.minimum.at(label, before[p], low)
        label = label[label]
        if (label == before).all():
            break
    joined = np.flatnonzero(label != np.arange(len(label)))
    return joined, label[joined]


def _block(graph: Graph, points: np.ndarray, names: np.ndarray, weights: np.ndarray, queries: np.ndarray, asked: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Copies that each query has links with, and edges that connect what the links connect: points count on from the queries."""
    links, edges, held = np.zeros(len(queries), np.int64), [], 0
    for piece in link_pieces(graph, points, queries):
        if piece is None:
            links[:] = 0  # the edges are links all the same
            continue
        q, p = piece
        other = (asked[q] != names[p]).any(axis=1)
        q, p = q[other], p[other]
        np.add.at(links, q, weights[p])
        # only a spanning forest is kept
        edges.append(_spanning(q, p + len(queries)))
        held += len(edges[-1][0])
        if held > 2 * (len(queries) + len(points)):
            edges = [_spanning(*(np.concatenate(e) for e in zip(*edges)))]
            held = len(edges[0][0])
    return links, *(_spanning(*(np.concatenate(e) for e in zip(*edges))) if edges else (np.zeros(0, np.int64),) * 2)


FOUND = ["node", "other", "links"]


def _searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, other, links): how many copies each asked vector has links with in a shard; rows with ``other`` are edges.

    The queries of a task and of a length come before the points of the shards, and are held.
    """
    held, asked, queries, cuts = None, None, None, None
    for (task, dims, shard), pieces in _runs(batches, "task", "dims", "shard"):
        if shard < 0:
            asked, queries, blocks = _gathered(pieces, dims, "place")
            held, cuts = (task, dims), [0, *(np.flatnonzero(np.diff(blocks)) + 1).tolist(), len(blocks)]
        elif held == (task, dims):  # else nobody asks
            names, points, weights, levels, lists = _gathered(pieces, dims, "weight", "level", "links")
            graph = Graph.from_lists(_small(points), levels, lists.view("<i4"))
            for begin, end in pairwise(cuts):
                own = asked[begin:end]
                links, a, b = _block(graph, points, names, weights, queries[begin:end], own)
                some = np.flatnonzero(links)
                yield pa.RecordBatch.from_arrays([_named(own[some]), pa.nulls(len(some), pa.binary()), pa.array(links[some])], FOUND)
                rows = np.concatenate([own, names]) if len(a) else own
                yield pa.RecordBatch.from_arrays([_named(rows[a]), _named(rows[b]), pa.array(np.zeros(len(a), np.int64))], FOUND)
            del names, points, weights, lists, graph
        pa.default_memory_pool().release_unused()


def near_vectors(embeddings: DataFrame) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    ``embeddings`` needs vec_id and embedding (an array of numbers).  A vector that is NULL, empty, zero or
    holds a NULL or non-finite number has no links and is its own component.  Vectors of different lengths
    have none with each other.  Rows that repeat a vec_id are vectors of their own with that id.  A NULL
    vec_id keeps its row; its component_id is that of a component with an id, else it and kept are NULL.
    """
    kind = "float" if dict(embeddings.dtypes)["embedding"] == "array<float>" else "double"
    rows = stored(
        embeddings.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(f"array<{kind}>").alias("embedding"))
        .mapInArrow(partial(_valid, kind="<f4" if kind == "float" else "<f8"), "vec_id long, node binary, vector binary, dims int"),
        "vectors",
    )
    distinct = stored(
        rows.where("node IS NOT NULL").groupBy("node", "vector", "dims").agg(F.count("*").alias("weight")), "distinct"
    )
    nothing = F.lit(0).cast("long")
    count, size, raw = distinct.agg(
        F.count("*"), F.coalesce(F.sum(F.greatest(8 * F.col("dims"), F.lit(POINT_BYTES))), nothing),
        F.coalesce(F.sum(F.length("vector")), nothing),
    ).first()
    shards, blocks = max(LEAST_SHARDS, -(-size // SHARD_BYTES)), max(1, -(-count // BLOCK_QUERIES))
    part = lambda salt, n: F.pmod(F.xxhash64(F.lit(salt), "node"), F.lit(n)).cast("int")
    index = stored(
        distinct.select("dims", part(SEED, shards).alias("shard"), "node", "vector", "weight")
        .repartitionById(shards, F.col("shard")).sortWithinPartitions("dims", "shard", "node")
        .mapInArrow(_built, "dims int, shard int, node binary, vector binary, weight long, place int, level int, links binary"),
        "index",
    )
    # every block of queries meets every shard: the queries are dealt to ``copies`` of the index, each in ``groups`` of shards
    tasks = embeddings.sparkSession.sparkContext.defaultParallelism
    copies = max(1, -(-raw // HELD_BYTES), min(-(-tasks // shards), -(-blocks // BLOCKS_A_COPY)))
    groups = min(shards, -(-tasks // copies))
    each = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    block = part(SEED + 1, blocks)
    asked = distinct.withColumn("group", each(groups)).select(
        (block % copies * groups + F.col("group")).alias("task"), "dims", F.lit(-1).alias("shard"), block.alias("place"),
        "node", "vector", F.lit(0).cast("long").alias("weight"), F.lit(0).alias("level"), F.lit(None).cast("binary").alias("links"),
    )
    shared = index.withColumn("copy", each(copies)).select(
        (F.col("copy") * groups + F.col("shard") % groups).alias("task"), "dims", "shard", "place", "node", "vector", "weight", "level", "links"
    )
    met = (
        asked.union(shared).repartitionById(copies * groups, F.col("task"))
        .sortWithinPartitions("task", "dims", "shard", "place", "node")
    )
    found = stored(met.mapInArrow(_searched, "node binary, other binary, links long"), "links")
    links = found.where("other IS NULL").groupBy("node").agg(F.sum("links").alias("links"))
    roots = components(found.where("other IS NOT NULL").select(F.col("node").alias("a"), F.col("other").alias("b")))
    placed = (
        rows.select("vec_id", "node")
        .join(distinct.select("node", "weight"), "node", "left")
        .join(links, "node", "left").join(roots, "node", "left")
        .withColumn("root", F.coalesce("root", "node"))
    )
    lowest = placed.where("root IS NOT NULL").groupBy("root").agg(F.min("vec_id").alias("lowest"))
    component = F.coalesce("lowest", "vec_id")
    return placed.join(lowest, "root", "left").select(
        "vec_id",
        (F.coalesce("links", F.lit(0)) + F.coalesce("weight", F.lit(1)) - 1).alias("n_links"),
        component.alias("component_id"),
        F.when(component.isNotNull(), F.col("vec_id").eqNullSafe(component)).alias("kept"),
    )
