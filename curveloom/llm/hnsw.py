"""A hierarchical navigable small-world graph over unit vectors, in numpy.

Many points are inserted, and many queries searched, in step with one another, so every step is a few
array operations.  Level 0 holds all points; each further level a random part of the one below.
"""

from __future__ import annotations

import io
from dataclasses import dataclass, field

import numpy as np

LINKS = 12
BEAM = 48
INSERTED_AT_ONCE = 256
EXPANDED_AT_ONCE = 3
MOST_CELLS = 1 << 24
#: numbers of vectors that are gathered at once, whatever their length
GATHERED = 1 << 18


def _similarities(vectors: np.ndarray, queries: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    """Of each query with its own row of nodes; -2 where there is no node."""
    row, place = np.nonzero(nodes >= 0)
    found = np.full(nodes.shape, -2, np.float32)
    found[row, place] = _products(vectors, queries, nodes[row, place], row)
    return found


def _products(vectors: np.ndarray, queries: np.ndarray, nodes: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Of each node with the query of that row."""
    found, step = np.empty(len(nodes), np.float32), max(1, GATHERED // vectors.shape[1])
    for at in range(0, len(nodes), step):
        some = slice(at, at + step)
        found[some] = np.einsum("kd,kd->k", vectors[nodes[some]], queries[rows[some]])
    return found


def _diverse(vectors: np.ndarray, nodes: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
    """``_chosen`` for some rows at a time."""
    step = max(1, GATHERED // (nodes.shape[1] * vectors.shape[1]))
    parts = [_chosen(vectors, nodes[at : at + step], near[at : at + step], most) for at in range(0, len(nodes), step)]
    return np.concatenate(parts)


def _chosen(vectors: np.ndarray, nodes: np.ndarray, near: np.ndarray, most: int) -> np.ndarray:
    """Up to ``most`` neighbours per row, nearest first, each nearer to the row's point than to those before it.

    Places that stay free then go to the nearest of the others.  ``nodes`` comes by falling ``near``.
    """
    rows, width = nodes.shape
    held = vectors[nodes]
    between = np.einsum("bid,bjd->bij", held, held)
    chosen = np.zeros((rows, width), bool)
    closest = np.full((rows, width), -3, np.float32)  # similarity of each node to the nearest chosen one
    for j in range(width):
        take = (near[:, j] > closest[:, j]) & (nodes[:, j] >= 0) & (chosen.sum(axis=1) < most)
        chosen[:, j] = take
        closest = np.where(take[:, None], np.maximum(closest, between[:, j]), closest)
    rank = np.argsort(np.where(chosen, 0, np.where(nodes >= 0, 1, 2)), axis=1, kind="stable")[:, :most]
    out = np.take_along_axis(nodes, rank, axis=1)
    return np.pad(out, ((0, 0), (0, most - out.shape[1])), constant_values=-1)


@dataclass
class Graph:
    """``links[l]``: neighbours of each point at level l (-1: none); ``levels``: the highest level of each point."""

    vectors: np.ndarray
    levels: np.ndarray
    links: list[np.ndarray]
    entry: int
    #: which points each row of a search has met: the cells that hold the number of the search
    met: np.ndarray = field(default_factory=lambda: np.zeros((0, 0), np.uint8), init=False, repr=False)
    searches: int = field(default=0, init=False)

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int) -> Graph:
        """``vectors``: unit rows of 32-bit floats, at least one."""
        n = len(vectors)
        rng = np.random.default_rng(seed)
        levels = np.minimum((-np.log(rng.uniform(1e-12, 1, n)) / np.log(LINKS)).astype(np.int64), 8)
        # the first point reaches the highest level, so that every search can begin there
        levels[0] = levels.max()
        links = [np.full((n, LINKS * (2 if level == 0 else 1)), -1, np.int32) for level in range(levels[0] + 1)]
        graph = cls(vectors, levels, links, 0)
        done = 1
        while done < n:
            batch = np.arange(done, min(n, done + min(INSERTED_AT_ONCE, done)))
            graph._insert(batch)
            done = batch[-1] + 1
        return graph

    def _insert(self, batch: np.ndarray) -> None:
        points = self.vectors[batch]
        mates = points @ points.T
        start = np.full((len(batch), 1), self.entry)
        for level in range(len(self.links) - 1, -1, -1):
            start, near = self._beam(points, start, level, BEAM)
            inside = np.flatnonzero(self.levels[batch] >= level)
            if not len(inside):
                continue
            # points that come together may be neighbours as well
            among = np.where(self.levels[batch] >= level, mates[inside], np.float32(-2))
            among[np.arange(len(inside)), inside] = -2
            nodes = np.concatenate([start[inside], np.where(among > -2, batch[None, :], -1)], axis=1)
            order = np.argsort(-np.concatenate([near[inside], among], axis=1), axis=1, kind="stable")[:, :BEAM]
            nodes = np.take_along_axis(nodes, order, axis=1)
            sims = _similarities(self.vectors, points[inside], nodes)
            self.links[level][batch[inside], :LINKS] = _diverse(self.vectors, nodes, sims, LINKS)
            self._link_back(batch[inside], level)

    def _link_back(self, added: np.ndarray, level: int) -> None:
        links = self.links[level]
        target = links[added, :LINKS]
        source = np.repeat(added, LINKS)[target.ravel() >= 0]
        target = target.ravel()[target.ravel() >= 0]
        order = np.argsort(target, kind="stable")
        target, source = target[order], source[order]
        nodes, first, count = np.unique(target, return_index=True, return_counts=True)
        place = np.arange(len(target)) - np.repeat(first, count)
        new = np.full((len(nodes), count.max()), -1, np.int64)
        new[np.repeat(np.arange(len(nodes)), count), place] = source
        both = np.concatenate([links[nodes], new], axis=1)
        for at in range(0, len(nodes), 512):
            rows, some = nodes[at : at + 512], both[at : at + 512]
            sims = _similarities(self.vectors, self.vectors[rows], some)
            # a point may be named from both ends
            some = np.where(np.array([np.bincount(np.unique(r, return_index=True)[1], minlength=len(r)) for r in some]) > 0, some, -1)
            order = np.argsort(np.where(some < 0, 2, -sims), axis=1, kind="stable")[:, : 3 * links.shape[1]]
            some, sims = np.take_along_axis(some, order, axis=1), np.take_along_axis(sims, order, axis=1)
            links[rows] = _diverse(self.vectors, some, sims, links.shape[1])

    def _beam(self, queries: np.ndarray, start: np.ndarray, level: int, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Nodes and similarities of the ``beam`` nearest found, nearest first (-1: none), from ``start`` on."""
        rows, links = len(queries), self.links[level]
        seen, mark = self._unmet(rows)  # the last column stands for no node
        seen[np.arange(rows)[:, None], start] = mark
        seen[:, -1] = mark
        near = _similarities(self.vectors, queries, start)
        order = np.argsort(-near, axis=1, kind="stable")[:, :beam]
        nodes, near = np.take_along_axis(start, order, axis=1), np.take_along_axis(near, order, axis=1)
        pad = ((0, 0), (0, beam - nodes.shape[1]))
        nodes, near = np.pad(nodes, pad, constant_values=-1), np.pad(near, pad, constant_values=-2)
        spent = nodes < 0
        active = np.arange(rows)
        while len(active):
            # the beam falls, so the first nodes that are not spent are the nearest
            flags = spent[active]
            pick = np.argsort(flags, axis=1, kind="stable")[:, :EXPANDED_AT_ONCE]
            good = ~np.take_along_axis(flags, pick, axis=1)
            going = good[:, 0]
            active, pick, good, flags = active[going], pick[going], good[going], flags[going]
            if not len(active):
                break
            held, held_near = nodes[active], near[active]
            np.put_along_axis(flags, pick, True, axis=1)
            reached = np.where(good[:, :, None], links[np.take_along_axis(held, pick, axis=1)], -1).reshape(len(active), -1)
            reached.sort(axis=1)
            reached[:, 1:][reached[:, 1:] == reached[:, :-1]] = -1
            row, place = np.nonzero(reached >= 0)
            node = reached[row, place]
            new = seen[active[row], node] != mark
            row, node = row[new], node[new]
            seen[active[row], node] = mark
            found = _products(self.vectors, queries, node, active[row])
            # only what is nearer than the last place of its beam comes in
            better = found > held_near[row, -1]
            row, node, found = row[better], node[better], found[better]
            count = np.bincount(row, minlength=len(active))
            place = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
            more = (len(active), count.max())
            more_nodes, more_near = np.full(more, -1, nodes.dtype), np.full(more, -2, np.float32)
            more_nodes[row, place], more_near[row, place] = node, found
            all_nodes = np.concatenate([held, more_nodes], axis=1)
            all_near = np.concatenate([held_near, more_near], axis=1)
            all_spent = np.concatenate([flags, more_nodes < 0], axis=1)
            order = np.argsort(-all_near, axis=1, kind="stable")[:, :beam]
            nodes[active] = np.take_along_axis(all_nodes, order, axis=1)
            near[active] = np.take_along_axis(all_near, order, axis=1)
            spent[active] = np.take_along_axis(all_spent, order, axis=1)
        return nodes, near

    def _unmet(self, rows: int) -> tuple[np.ndarray, int]:
        """Cells for so many rows, and a number that none of them holds."""
        if len(self.met) < rows:
            self.met, self.searches = np.zeros((rows, len(self.vectors) + 1), np.uint8), 0
        if self.searches == 255:
            self.met[:] = 0
            self.searches = 0
        self.searches += 1
        return self.met[:rows], self.searches

    def search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """The ``beam`` nearest found of each query, and their similarities."""
        most = max(1, MOST_CELLS // (len(self.vectors) + 1))
        parts = []
        for at in range(0, len(queries), most):
            some = queries[at : at + most]
            start = np.full((len(some), 1), self.entry)
            for level in range(len(self.links) - 1, 0, -1):
                start, _ = self._beam(some, start, level, BEAM // 2)
            parts.append(self._beam(some, start, 0, beam))
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, vectors=self.vectors, levels=self.levels, entry=self.entry, **{f"l{i}": x.astype(np.int32) for i, x in enumerate(self.links)})
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Graph:
        held = np.load(io.BytesIO(data))
        links = [held[f"l{i}"] for i in range(len(held.files) - 3)]
        return cls(held["vectors"], held["levels"], links, int(held["entry"]))

    def lists(self) -> tuple[np.ndarray, np.ndarray]:
        """The neighbours of each point, level by level, one point after another; where each point begins, and the end."""
        first = np.concatenate([[0], np.cumsum((self.levels + 2) * LINKS)])
        flat = np.empty(first[-1], np.int32)
        for level, links in enumerate(self.links):
            some, places = self._listed(first, level)
            flat[places] = links[some]
        return flat, first

    @classmethod
    def from_lists(cls, vectors: np.ndarray, levels: np.ndarray, flat: np.ndarray) -> Graph:
        first = np.concatenate([[0], np.cumsum((levels.astype(np.int64) + 2) * LINKS)])
        graph = cls(vectors, levels, [], 0)
        for level in range(levels.max() + 1):
            some, places = graph._listed(first, level)
            links = np.full((len(vectors), places.shape[1]), -1, np.int32)
            links[some] = flat[places]
            graph.links.append(links)
        return graph

    def _listed(self, first: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """The points of a level, and the places of their neighbours in ``lists``."""
        some, begin, width = np.flatnonzero(self.levels >= level), (level + 1) * LINKS if level else 0, LINKS if level else 2 * LINKS
        return some, first[some][:, None] + begin + np.arange(width)
