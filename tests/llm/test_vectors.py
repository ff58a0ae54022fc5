"""Links between vectors against brute force, and the graph's recall."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from curveloom.llm import hnsw, vectors
from curveloom.llm.hnsw import Graph


def clustered(seed: int, n: int, dims: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 40, dims))
    rows = np.concatenate([rng.normal(size=(n // 2, dims)), *(c + rng.normal(scale=0.2, size=(20, dims)) for c in centres)])
    return rows[rng.permutation(len(rows))].astype(np.float32)


def unit(rows: np.ndarray) -> np.ndarray:
    rows = rows.astype(np.float64)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def test_graph_finds_the_nearest():
    points = unit(clustered(1, 1_600, 32))
    graph = Graph.from_bytes(Graph.build(points.astype(np.float32), 1).to_bytes())
    asked = unit(clustered(2, 200, 32))
    nodes, near = graph.search(asked.astype(np.float32), 64)
    true = np.argsort(-(asked @ points.T), axis=1)[:, :10]
    assert np.mean([len(set(t) & set(n[:10])) / 10 for t, n in zip(true.tolist(), nodes.tolist())]) > 0.95
    assert (np.diff(near, axis=1) <= 1e-6).all()


@pytest.mark.parametrize("n", [1, 2, 5, 40])
def test_small_graphs(n):
    points = unit(np.random.default_rng(n).normal(size=(n, 8)))
    q, p = vectors.linked(Graph.build(points.astype(np.float32), 1), points, points)
    assert sorted(zip(q.tolist(), p.tolist())) == sorted(map(tuple, np.argwhere(points @ points.T >= 0.9).tolist()))


def test_links_equal_brute_force(spark):
    rows = clustered(3, 800, 16)
    values = [(i, r.tolist(), 0) for i, r in enumerate(rows)]
    values += [(1_000 + i, rows[5].tolist(), 0) for i in range(50)]  # copies
    values += [(2_000, None, 0), (2_001, [], 0), (2_002, [0.0] * 16, 0), (2_003, [float("nan")] * 16, 0), (2_004, [None, *[1.0] * 15], 0)]
    values += [(2_005, rows[5].tolist()[:8], 0), (3, rows[7].tolist(), 0), (None, rows[5].tolist(), 0), (2_006, [float("inf")] * 16, 0)]
    table = spark.createDataFrame(values, "vec_id long, embedding array<float>, node int").repartition(4)
    got = sorted((tuple(r) for r in vectors.near_vectors(table).collect()), key=repr)
    good = [i for i, (_, v, _) in enumerate(values) if v and None not in v and np.isfinite(v).all() and any(v)]
    linked = np.zeros((len(values), len(values)), bool)
    for dims in (8, 16):
        some = [i for i in good if len(values[i][1]) == dims]
        points = unit(np.array([values[i][1] for i in some]))
        linked[np.ix_(some, some)] = points @ points.T >= 0.9
    np.fill_diagonal(linked, False)
    label = np.arange(len(values))
    for _ in range(len(values)):
        after = np.minimum(label, np.where(linked, label[None, :], len(values)).min(axis=1))
        if (after == label).all():
            break
        label = after
    want = []
    for i, (vec_id, _, _) in enumerate(values):
        ids = [values[j][0] for j in np.flatnonzero(label == label[i]) if values[j][0] is not None]
        want.append((vec_id, int(linked[i].sum()), min(ids), vec_id == min(ids)))
    assert got == sorted(want, key=repr)


def test_no_vectors(spark):
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).collect() == []


def test_graph_from_lists():
    points = unit(clustered(4, 1_600, 16)).astype(np.float32)
    graph = Graph.build(points, 1)
    again = Graph.from_lists(points, graph.levels, graph.lists()[0])
    assert len(again.links) == len(graph.links)
    assert all((a == b).all() for a, b in zip(again.links, graph.links))


def test_steps_of_long_vectors():
    rng = np.random.default_rng(5)
    points = unit(rng.normal(size=(300, 3_000))).astype(np.float32)
    nodes = rng.integers(-1, 300, size=(100, 20))
    want = np.where(nodes < 0, -2, np.einsum("bmd,bd->bm", points[nodes], points[:100]))
    assert np.allclose(hnsw._similarities(points, points[:100], nodes), want, atol=1e-5)
    near = -np.sort(-want, axis=1)
    nodes = np.take_along_axis(nodes, np.argsort(-want, axis=1), axis=1)
    assert (hnsw._diverse(points, nodes, near, 8) == hnsw._chosen(points, nodes, near, 8)).all()


def test_rows_do_not_grow_with_the_table(spark, monkeypatch):
    """No task gets a shard, its graph or a block of queries as one row."""
    longest, held = {}, vectors.stored

    def watched(df, what):
        out = held(df, what)
        sizes = [F.coalesce(F.length(c), F.lit(0)) for c, kind in out.dtypes if kind == "binary"]
        longest[what] = max(longest.get(what, 0), out.agg(F.max(sum(sizes[1:], sizes[0]))).first()[0] or 0)
        return out

    monkeypatch.setattr(vectors, "stored", watched)
    rows = clustered(6, 1_600, 8)
    table = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(rows)], "vec_id long, embedding array<float>")
    assert vectors.near_vectors(table).count() == len(rows)
    assert set(longest) == {"vectors", "distinct", "index", "links"}
    assert max(longest.values()) < 1_000


@pytest.mark.parametrize("kind", ["float", "double"])
def test_many_copies_and_groups(spark, monkeypatch, kind):
    """Queries over several copies of the index, shards in several groups, and lengths that not all of them have."""
    monkeypatch.setattr(vectors, "BLOCK_QUERIES", 16)
    monkeypatch.setattr(vectors, "HELD_BYTES", 8_000)
    rows = clustered(7, 800, 16).astype(np.float64)
    values = [(i, r.tolist()) for i, r in enumerate(rows)]
    values += [(10_000 + i, r.tolist()) for i, r in enumerate(rows[:20])]  # copies
    values += [(20_000 + i, r[:3].tolist()) for i, r in enumerate(rows[:4])]  # fewer than shards
    table = spark.createDataFrame(values, f"vec_id long, embedding array<{kind}>").repartition(4)
    got = {r.vec_id: (r.n_links, r.component_id) for r in vectors.near_vectors(table).collect()}
    for dims in (3, 16):
        some = [(i, v) for i, v in values if len(v) == dims]
        ids = [i for i, _ in some]
        points = unit(np.array([v for _, v in some]).astype(np.float32 if kind == "float" else np.float64))
        linked = points @ points.T >= 0.9
        assert [got[i][0] for i in ids] == (linked.sum(axis=1) - 1).tolist()
        at = {i: k for k, i in enumerate(ids)}
        component = np.array([at[got[i][1]] for i in ids])
        assert (component[:, None] == component[None, :])[linked].all()  # links join
        label = np.arange(len(ids))
        while True:
            after = np.minimum(label, np.where(linked, label[None, :], len(ids)).min(axis=1))
            if (after == label).all():
                break
            label = after
        assert component.tolist() == label.tolist()
