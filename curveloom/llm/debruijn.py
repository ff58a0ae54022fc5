"""Exact removal of repeated word windows by compacting a de Bruijn graph.

Every window of 13 words is an edge of the graph, from its first twelve words to its last twelve.  Edges that
lie in one place only are left out: their short hashes are dealt to shards, and what repeats is joined back to
its texts.  An edge is cut from the next one where not all of its places go on with the same word, or
not all places of the next one come from the same word; so the paths that stay between cuts are nonbranching,
and any two places that share an edge of a path share the whole path.  Paths are compared by 128-bit digests
of their words, joined with the first document that has them, and removed by their source coordinates.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from curveloom.llm.tables import discard, stored
from curveloom.llm.wordlists import CHUNK_WORDS, Chunk

WINDOW = 13
SEED = 20_273
#: windows of a shard, on average; beside the shard's bits 32 more of a hash tell windows apart before they are verified
SHARD_WINDOWS = 1 << 21
SHORT_BITS = 32
#: stands for a NULL doc_id, which comes before all others
NO_ID = -(1 << 63)
_RNG = np.random.default_rng(SEED)
_FACTORS = [int(b) * 8 + 3 for b in _RNG.integers(1 << 50, 1 << 60, 3)]

LISTS = "docs array<long>, twins array<long>, starts array<int>, sizes array<int>"


def _spread(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


def window_hashes(words: np.ndarray) -> np.ndarray:
    """Hash of the ``WINDOW`` words from each place on, from the words' hashes."""
    n = len(words) - WINDOW + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(WINDOW):
        total = total * np.uint64(_FACTORS[0]) + words[i : i + n]
    return _spread(total)


def path_digests(words: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of each part of ``words``."""
    out = []
    for which in (1, 2):
        powers, inverse = (
            np.concatenate([np.ones(1, np.uint64), np.full(len(words), base, np.uint64)]).cumprod(dtype=np.uint64)
            for base in (_FACTORS[which], pow(_FACTORS[which], -1, 1 << 64))
        )
        letters = _spread(words + np.uint64(which))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(letters * powers[:-1], dtype=np.uint64)])
        out.append(_spread((sums[end] - sums[start]) * inverse[start] + (end - start).astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def _plain(docs: DataFrame) -> DataFrame:
    """doc (the doc_id as it compares), twin (tells rows of one doc_id apart), text."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("twin"), text.alias("text")
    )


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (chunk, docs, twins, sizes, hashes, ids): words as numbers into the chunk's list of word hashes."""
    task, made = TaskContext.get().partitionId(), 0
    chunk, rows = Chunk(), []

    def row() -> pa.RecordBatch:
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, chunk.numbers), "<u8", len(chunk.numbers))
        docs, twins, sizes = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array([(task << 33) + made], pa.int64()), pa.array([docs], pa.list_(pa.int64())), pa.array([twins], pa.list_(pa.int64())),
             pa.array([sizes], pa.list_(pa.int32())), pa.array([hashes.tobytes()], pa.binary()), pa.array([chunk.ids().tobytes()], pa.binary())],
            ["chunk", "docs", "twins", "sizes", "hashes", "ids"],
        )

    for batch in batches:
        for doc, twin, text in zip(batch.column("doc").to_pylist(), batch.column("twin").to_pylist(), batch.column("text")):
            words = text.as_py().encode().split()
            if len(words) >= WINDOW:
                chunk.add(words)
                rows.append((doc, twin, len(words)))
            if chunk.words >= CHUNK_WORDS:
                yield row()
                chunk, rows, made = Chunk(), [], made + 1
    if rows:
        yield row()


def _windows(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of a chunk's words and of its windows; text of each window, and whether it lies in one text."""
    sizes = np.array(row["sizes"])
    hashes = np.frombuffer(row["hashes"], "<u8")
    words = hashes[Chunk.read(row["ids"], len(hashes))]
    windows = window_hashes(words)
    text = np.repeat(np.arange(len(sizes)), sizes)[: len(windows)]
    inside = np.arange(len(windows)) + WINDOW <= np.cumsum(sizes)[text]
    return words, windows, text, inside


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    """Which values are in ``known``, which is sorted."""
    if not len(known):
        return np.zeros(len(values), bool)
    return known[np.minimum(np.searchsorted(known, values), len(known) - 1)] == values


def _short(windows: np.ndarray, shard_bits: int) -> np.ndarray:
    """The upper bits of hashes: the shard, then ``SHORT_BITS``."""
    return windows >> np.uint64(64 - shard_bits - SHORT_BITS)


def _by_shard(keys: np.ndarray, shard_bits: int, key_bits: int) -> list[tuple[int, slice]]:
    """Shard and place of its keys, for sorted keys of ``key_bits`` bits."""
    if not len(keys):
        return []
    shard = (keys >> np.uint64(key_bits - shard_bits)).astype(np.int64) if shard_bits else np.zeros(len(keys), np.int64)
    first = np.flatnonzero(np.concatenate([[True], shard[1:] != shard[:-1]]))
    return [(int(shard[a]), slice(a, b)) for a, b in zip(first, np.append(first[1:], len(keys)))]


def _keys(shard_bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(shard, chunk, keys) of all windows; a key that two texts of a chunk have comes twice."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, windows, text, inside = _windows(row)
                keys, text = _short(windows[inside], shard_bits), text[inside]
                order = np.lexsort((text, keys))
                keys, text = keys[order], text[order]
                new = np.concatenate([[True], keys[1:] != keys[:-1]])
                other = np.concatenate([[False], (keys[1:] == keys[:-1]) & (text[1:] != text[:-1])])
                keys, new = keys[new | other], new[new | other]
                second = np.concatenate([[False], new[:-1]])  # of more than two texts the first two say it all
                keys = keys[new | second]
                parts = _by_shard(keys, shard_bits, shard_bits + SHORT_BITS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s for s, _ in parts], pa.int64()), pa.array([row["chunk"]] * len(parts), pa.int64()),
                     pa.array([keys[at].astype("<u4").tobytes() for _, at in parts], pa.binary())],
                    ["shard", "chunk", "keys"],
                )

    return dealt


def _repeated(group: pa.Table) -> pa.Table:
    """(chunk, shard, keys): the keys of each chunk that come more than once in the shard."""
    held = [np.frombuffer(k, "<u4") for k in group["keys"].to_pylist()]
    every = np.sort(np.concatenate(held), kind="stable")
    again = np.unique(every[1:][every[1:] == every[:-1]])
    out = [np.unique(k[_among(k, again)]) for k in held]
    return pa.table({"chunk": group["chunk"], "shard": group["shard"], "keys": pa.array([k.tobytes() for k in out], pa.binary())})


def _runs(shard_bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(chunk, docs, twins, starts, sizes, words): runs of repeated edges with the word before and after each.

    ``starts`` is the place of a run's first edge in its text, ``sizes`` counts its edges.  ``words`` holds, run by
    run, the word before it (0: none), its words, and the word after it.
    """

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                words, windows, text, inside = _windows(row)
                known = [np.frombuffer(f["keys"], "<u4") + np.uint64(f["shard"] << SHORT_BITS) for f in row["found"]]
                hit = inside & _among(_short(windows, shard_bits), np.sort(np.concatenate(known)))
                if not hit.any():
                    continue
                same = hit[1:] & hit[:-1] & (text[1:] == text[:-1])
                first = np.flatnonzero(hit & ~np.concatenate([[False], same]))
                last = np.flatnonzero(hit & ~np.concatenate([same, [False]]))
                owner, bounds = text[first], np.concatenate([[0], np.cumsum(row["sizes"])])
                padded = np.concatenate([[0], words, [0]]).astype(np.uint64)  # shifted by one
                parts = []
                for a, b, t in zip(first.tolist(), (last + WINDOW).tolist(), owner.tolist()):
                    part = padded[a : b + 2].copy()
                    if a == bounds[t]:
                        part[0] = 0
                    if b == bounds[t + 1]:
                        part[-1] = 0
                    parts.append(part)
                docs, twins = np.array(row["docs"], np.int64), np.array(row["twins"], np.int64)
                each = [docs[owner], twins[owner], (first - bounds[owner]).astype(np.int32), (last - first + 1).astype(np.int32)]
                kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["chunk"]], pa.int64()), *(pa.array([x], pa.list_(k)) for x, k in zip(each, kinds)),
                     pa.array([np.concatenate(parts).astype("<u8").tobytes()], pa.binary())],
                    ["chunk", "docs", "twins", "starts", "sizes", "words"],
                )

    return found


def _edges(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words, place in them, hash, word before and word after of all edges of a chunk's runs."""
    words, sizes = np.frombuffer(row["words"], "<u8"), np.array(row["sizes"], np.int64)
    held = sizes + WINDOW + 1  # the run's words, one before and one after
    begin = np.cumsum(held) - held + 1
    at = np.repeat(begin - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
    return words, at, window_hashes(words)[at], words[at - 1], words[at + WINDOW]


def _neighbours(shard_bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(shard, chunk, edges, before, after): distinct edges of a chunk; a neighbour is 0 if there are several or none."""

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                _, _, edges, before, after = _edges(row)
                edges, (before, after) = _agreed(edges, [before, after])
                parts = _by_shard(edges, shard_bits, 64)
                columns = [pa.array([x[at].astype("<u8").tobytes() for _, at in parts], pa.binary()) for x in (edges, before, after)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([s for s, _ in parts], pa.int64()), pa.array([row["chunk"]] * len(parts), pa.int64()), *columns],
                    ["shard", "chunk", "edges", "before", "after"],
                )

    return dealt


def _agreed(edges: np.ndarray, neighbours: list[np.ndarray]) -> tuple[np.ndarray, list[np.ndarray]]:
    """Distinct edges in order, and each neighbour where all agree on it, else 0."""
    order = np.argsort(edges, kind="stable")
    edges = edges[order]
    first = np.flatnonzero(np.concatenate([[True], edges[1:] != edges[:-1]])) if len(edges) else np.zeros(0, np.int64)
    out = []
    for near in neighbours:
        near = near[order]
        low, high = (np.minimum.reduceat(near, first), np.maximum.reduceat(near, first)) if len(first) else (near, near)
        out.append(np.where(low == high, low, np.uint64(0)))
    return edges[first], out


def _cuts(group: pa.Table) -> pa.Table:
    """(chunk, before, after): the edges of each chunk that are cut from the one before, and from the one after."""
    held = [[np.frombuffer(x, "<u8") for x in group[c].to_pylist()] for c in ("edges", "before", "after")]
    edges, (before, after) = _agreed(*(lambda e, b, a: (e, [b, a]))(*(np.concatenate(h) for h in held)))
    cut = {"before": edges[before == 0], "after": edges[after == 0]}
    return pa.table({"chunk": group["chunk"]} | {
        name: pa.array([e[_among(e, many)].tobytes() for e in held[0]], pa.binary()) for name, many in cut.items()
    })


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, twin, start, n, h1, h2): the nonbranching paths of each run, of n edges, with their digests."""
    for batch in batches:
        for row in batch.to_pylist():
            words, at, edges, _, _ = _edges(row)
            before, after = (np.sort(np.concatenate([np.frombuffer(x, "<u8") for x in row[c]])) for c in ("before", "after"))
            sizes = np.array(row["sizes"], np.int64)
            run = np.repeat(np.arange(len(sizes)), sizes)
            begins = _among(edges, before)
            begins[1:] |= _among(edges[:-1], after) | (run[1:] != run[:-1])
            begins[0] = True
            first = np.flatnonzero(begins)
            n = np.diff(np.append(first, len(edges)))
            h1, h2 = path_digests(words, at[first], at[first] + n + WINDOW - 1)
            owner = run[first]
            start = np.array(row["starts"], np.int64)[owner] + first - (np.cumsum(sizes) - sizes)[owner]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.array(row["docs"], np.int64)[owner]), pa.array(np.array(row["twins"], np.int64)[owner]),
                 pa.array(start.astype(np.int32)), pa.array(n.astype(np.int32)), pa.array(h1), pa.array(h2)],
                ["doc", "twin", "start", "n", "h1", "h2"],
            )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc, twin, start, n): n windows from word ``start`` on lie in a document with a smaller doc_id, too."""
    chunks = stored(
        _plain(docs).mapInArrow(_chunks, "chunk long, docs array<long>, twins array<long>, sizes array<int>, hashes binary, ids binary"),
        "chunks",
    )
    words = chunks.agg(F.sum(F.aggregate("sizes", F.lit(0).cast("long"), lambda a, x: a + x))).first()[0] or 0
    shard_bits = min(max(0, -(-words // SHARD_WINDOWS) - 1).bit_length(), 64 - SHORT_BITS)
    repeated = chunks.mapInArrow(_keys(shard_bits), "shard long, chunk long, keys binary").groupBy("shard").applyInArrow(
        _repeated, "chunk long, shard long, keys binary"
    )
    of_chunk = stored(
        repeated.where(F.length("keys") > 0).groupBy("chunk").agg(F.collect_list(F.struct("shard", "keys")).alias("found")), "repeated"
    )
    runs = stored(
        chunks.join(of_chunk, "chunk").mapInArrow(_runs(shard_bits), f"chunk long, {LISTS}, words binary"), "runs"
    )
    discard(chunks)
    discard(of_chunk)
    cuts = runs.select("chunk", "sizes", "words").mapInArrow(
        _neighbours(shard_bits), "shard long, chunk long, edges binary, before binary, after binary"
    ).groupBy("shard").applyInArrow(_cuts, "chunk long, before binary, after binary")
    cuts = stored(cuts.groupBy("chunk").agg(F.collect_list("before").alias("before"), F.collect_list("after").alias("after")), "cuts")
    paths = stored(runs.join(cuts, "chunk").mapInArrow(_paths, "doc long, twin long, start int, n int, h1 long, h2 long"), "paths")
    discard(runs)
    discard(cuts)
    # a table of its own: both sides of the join are shuffled, so Spark can split a path with very many places
    firsts = stored(paths.groupBy("h1", "h2", "n").agg(F.min("doc").alias("first")), "firsts")
    return paths.join(firsts, ["h1", "h2", "n"]).where("doc > first").select("doc", "twin", "start", "n")


def kept_words(words: list[bytes], spans: list[dict] | None) -> list[bytes]:
    if not spans:
        return words
    change = np.zeros(len(words) + 1, np.int64)
    start, n = np.array([s["start"] for s in spans]), np.array([s["n"] for s in spans])
    np.add.at(change, start, 1)
    np.add.at(change, start + n + WINDOW - 1, -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(change[:-1]) == 0).tolist()]


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc, text, spans in zip(*(batch.column(c) for c in ("doc", "text", "spans"))):
            words = text.as_py().encode().split()
            kept = kept_words(words, spans.as_py())
            doc_id = None if doc.as_py() == NO_ID else doc.as_py()
            rows.append((doc_id, len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
        columns = zip(*rows) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(columns, [pa.int64()] * 3 + [pa.string()])], ["doc_id", "n_words", "n_removed", "kept_sha256"]
        )


def without_repeated_windows(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed, kept_sha256.

    A NULL doc_id is smaller than all others.  Rows that repeat a doc_id remove nothing from one another, and
    what repeats inside one document stays.  A NULL text is empty; texts under 13 words lose nothing.  Other
    columns are not read.
    """
    spans = repeated_spans(docs).distinct().groupBy("doc", "twin").agg(
        F.collect_list(F.struct("start", "n")).alias("spans")  # of one text
    )
    return _plain(docs).join(spans, ["doc", "twin"], "left").select("doc", "text", "spans").mapInArrow(
        _kept, "doc_id long, n_words long, n_removed long, kept_sha256 string"
    )
