"""Exact removal of repeated 100-byte strings by prefix-free parsing and suffix arrays.

Rolling-hash triggers cut every text into phrases (``phrases``).  Phrases with a trigger that occurs once
hold nothing repeated.  Of the others, the distinct ones are the dictionary and their occurrences the parse:
all of an occurrence but the first in corpus order is repeated.  First occurrences that share a trigger may
still share strings; suffix arrays of the dictionary, cut to depth 100, bring equal strings together, and the
parse gives their corpus order.  Equal strings always share a trigger, so nothing is missed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, functions as F

from curveloom.llm.phrases import LENGTH, Digests, chunks, runs
from curveloom.llm.tables import discard, stored

#: phrases of one trigger that are sorted together; more are sorted in blocks, whose results are then merged
BLOCK_PHRASES = 2_048
SORTED_BYTES = 1 << 20
#: stands for a NULL doc_id, which comes first in corpus order
NO_ID = -(1 << 63)

PLACE = "doc long, twin long, start int, n int"


def _plain(docs: DataFrame) -> DataFrame:
    """doc (the doc_id in corpus order), twin (tells rows of one doc_id apart) and text, one row per such pair."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    return docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(NO_ID)).alias("doc"), F.xxhash64(text).alias("twin"), text.alias("text")
    )


def _cut(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, ...]]:
    """(row, start in its text, number of starts, trigger, first start in the data, digests) of a batch's runs."""
    texts = [t.encode() for t in batch.column("text").to_pylist()]
    for first, data, bounds in chunks(texts):
        owner, start, n, key = runs(data, bounds)
        if len(owner):
            yield owner + first, start - bounds[owner], n, key, start, data


def _keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, _, _, key, _, _ in _cut(batch):
            yield pa.RecordBatch.from_arrays([pa.array(key)], ["key"])


def _phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row, start, n, key, at, data in _cut(batch):
            h1, h2 = Digests(data).of(at, at + n + LENGTH - 1)
            where = pa.array(row)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").take(where), batch.column("twin").take(where), pa.array(start.astype(np.int32)),
                 pa.array(n.astype(np.int32)), pa.array(key), pa.array(h1), pa.array(h2)],
                ["doc", "twin", "start", "n", "key", "h1", "h2"],
            )


def _lists(column: pa.ListArray, *fields: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """Where the list of each row begins (and the end), and the fields of all lists' structs one after another."""
    lists = column.fill_null([])
    held = lists.flatten()
    sizes = np.diff(lists.offsets.to_numpy())
    return np.concatenate([[0], np.cumsum(sizes)]), [held.field(f).to_numpy() for f in fields]


def _texts_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the listed phrases of each text."""
    for batch in batches:
        bounds, (start, n, key, block, blocks) = _lists(batch.column("phrases"), "start", "n", "key", "block", "blocks")
        for i, text in enumerate(batch.column("text").to_pylist()):
            data, held = text.encode(), slice(bounds[i], bounds[i + 1])
            spans = zip(start[held].tolist(), (start[held] + n[held] + LENGTH - 1).tolist())
            same = pa.array(np.full(held.stop - held.start, i))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc").take(same), batch.column("twin").take(same),
                 *(pa.array(c[held]) for c in (start, key, block, blocks)),
                 pa.array([data[a:b] for a, b in spans], pa.binary())],
                ["doc", "twin", "start", "key", "block", "blocks", "phrase"],
            )


def _suffix_classes(phrases: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """The suffix array, to depth 100, of phrases: phrase and offset of each suffix in order, its class, data position.

    Suffixes shorter than that are left out; equal neighbours are one class.
    """
    size = np.array([len(p) for p in phrases])
    data = np.frombuffer(b"".join(phrases), np.uint8)
    count = size - LENGTH + 1
    phrase = np.repeat(np.arange(len(phrases)), count)
    offset = np.arange(len(phrase)) - np.repeat(np.cumsum(count) - count, count)
    position = (np.cumsum(size) - size)[phrase] + offset
    strings = np.ascontiguousarray(sliding_window_view(data, LENGTH)[position]).view(f"S{LENGTH}")[:, 0]
    order = np.argsort(strings, kind="stable")
    ranked = strings[order]
    classes = np.concatenate([[0], np.cumsum(ranked[1:] != ranked[:-1])])
    return phrase[order], offset[order], classes, position[order]


def _sorted_phrases(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Strings of dictionary phrases that occur again later in corpus order, within each (key, block).

    Rows come sorted by key and block.  A row without h1 is a repeated string.  Where a trigger has several
    blocks, the first of each class goes on with its digest.
    """
    names = ["doc", "twin", "start", "h1", "h2"]

    def ranked(held: list[tuple]) -> pa.RecordBatch:
        doc, twin, start, key, block, blocks, phrases = zip(*held)
        phrase, offset, classes, position = _suffix_classes(list(phrases))
        data = np.frombuffer(b"".join(phrases), np.uint8)
        place = [np.array(doc, np.int64)[phrase], np.array(twin, np.int64)[phrase], np.array(start, np.int64)[phrase] + offset]
        group = np.unique(np.array([key, block], np.int64), axis=1, return_inverse=True)[1].reshape(-1)[phrase]
        order = np.lexsort((place[2], place[1], place[0], classes, group))
        first = np.ones(len(order), bool)
        first[1:] = (classes[order][1:] != classes[order][:-1]) | (group[order][1:] != group[order][:-1])
        going_on = first & (np.array(blocks)[phrase[order]] > 1)
        keep = ~first | going_on
        h1, h2 = Digests(data).of(position[order], position[order] + LENGTH)
        out = [pa.array(p[order][keep]) for p in place]
        return pa.RecordBatch.from_arrays(
            [out[0], out[1], out[2].cast(pa.int32()), *(pa.array(h[keep], mask=~going_on[keep]) for h in (h1, h2))], names
        )

    held, size = [], 0
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            # only whole groups are sorted; a group is bounded by its block
            if size >= SORTED_BYTES and row[3:5] != held[-1][3:5]:
                yield ranked(held)
                held, size = [], 0
            held.append(row)
            size += len(row[6])
    if held:
        yield ranked(held)


def _repeated_phrases(rows: DataFrame, firsts: DataFrame) -> DataFrame:
    """The occurrences in ``rows`` that are not their phrase's first."""
    return rows.join(firsts.select("h1", "h2", F.col("place").alias("first")), ["h1", "h2"]).where(
        F.struct("doc", "twin", "start") != F.col("first")
    ).select("doc", "twin", "start", "n")


def repeats(docs: DataFrame) -> DataFrame:
    """(doc, twin, start, n): n strings from byte ``start`` on have occurred before, in corpus order."""
    plain = _plain(docs)
    keys = plain.select("text").mapInArrow(_keys, "key long").groupBy("key").count().where("count > 1").select("key")
    keys = stored(keys, "triggers")
    rows = plain.mapInArrow(_phrases, f"{PLACE}, key long, h1 long, h2 long").join(keys, "key", "left_semi")
    rows = stored(rows, "phrases")
    discard(keys)
    firsts = rows.groupBy("h1", "h2").agg(
        F.min(F.struct("doc", "twin", "start")).alias("place"), F.min("n").alias("n"), F.min("key").alias("key")
    )
    firsts = stored(firsts, "dictionary")
    copies = stored(_repeated_phrases(rows, firsts), "copies")
    discard(rows)
    shared = firsts.groupBy("key").agg(F.count("*").alias("held")).where("held > 1").select(
        "key", F.ceil(F.col("held") / BLOCK_PHRASES).cast("int").alias("blocks")
    )
    listed = (
        firsts.join(shared, "key")
        .groupBy("place.doc", "place.twin")
        .agg(F.collect_list(F.struct(
            F.col("place.start").alias("start"), "n", "key", F.pmod("h1", "blocks").cast("int").alias("block"), "blocks"
        )).alias("phrases"))  # of one text
    )
    dictionary = (
        plain.dropDuplicates(["doc", "twin"]).join(listed, ["doc", "twin"])
        .mapInArrow(_texts_of, "doc long, twin long, start int, key long, block int, blocks int, phrase binary")
    )
    ranked = stored(
        dictionary.repartition("key", "block").sortWithinPartitions("key", "block")
        .mapInArrow(_sorted_phrases, "doc long, twin long, start int, h1 long, h2 long"),
        "suffixes",
    )
    discard(firsts)
    one = F.lit(1).alias("n")
    going_on = ranked.where("h1 IS NOT NULL").withColumn("n", one)
    lowest = going_on.groupBy("h1", "h2").agg(F.min(F.struct("doc", "twin", "start")).alias("place"))
    return copies.union(ranked.where("h1 IS NULL").select("doc", "twin", "start", one)).union(
        _repeated_phrases(going_on, lowest)
    )


def kept_parts(size: int, start: np.ndarray, n: np.ndarray) -> tuple[list[tuple[int, int]], int]:
    """(start, end) of what stays of ``size`` bytes without the strings found, and how many runs of bytes go."""
    order = np.argsort(start)
    begin = start[order].astype(np.int64)
    reached = np.maximum.accumulate(begin + n[order] + LENGTH - 1)
    apart = np.flatnonzero(begin[1:] > reached[:-1])
    gone = zip(begin[np.append(0, apart + 1)].tolist(), reached[np.append(apart, -1)].tolist()) if len(begin) else []
    edges = [e for run in gone for e in run]
    bounds = [0, *edges, size]
    return [(a, b) for a, b in zip(bounds[::2], bounds[1::2]) if a < b], len(edges) // 2


def _deduplicated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        bounds, (start, n) = _lists(batch.column("found"), "start", "n")
        for i, (doc, text) in enumerate(zip(batch.column("doc").to_pylist(), batch.column("text").to_pylist())):
            data, held = text.encode(), slice(bounds[i], bounds[i + 1])
            parts, spans = kept_parts(len(data), start[held], n[held])
            digest = hashlib.sha256()
            for a, b in parts:
                digest.update(data[a:b])
            removed = len(data) - sum(b - a for a, b in parts)
            rows.append((None if doc == NO_ID else doc, len(data), removed, spans, digest.hexdigest()))
        names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
        kinds = [pa.int64()] * 4 + [pa.string()]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)] if rows else
                                         [pa.array([], k) for k in kinds], names)


def without_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256.

    Corpus order is by doc_id (NULL first) and start; rows that repeat a doc_id follow one another by a
    hash of the text, and rows that repeat both count as one and get the same result.  A NULL text is
    empty.  Texts under 100 bytes lose nothing.
    """
    found = repeats(docs).groupBy("doc", "twin").agg(F.collect_list(F.struct("start", "n")).alias("found"))  # of one text
    return _plain(docs).join(found, ["doc", "twin"], "left").select("doc", "text", "found").mapInArrow(
        _deduplicated, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )
