"""Packing documents into token sequences: first-fit decreasing over a tournament tree of bin capacities.

A document is tokenized, ended by one separator id, and cut after every full sequence; full pieces
stand alone, and the rests are packed in groups of documents that a hash of the row makes up at random.
Token ids never leave the task that makes them: only lengths and checksums are packed.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from curveloom.llm.tables import HELD, slices

SEQUENCE = 2048
SEPARATOR = 1
GROUP_DOCS = 4096
SEED = 20_270
#: bytes that the caches of a worker may take, each (ids of words, ids of other parts)
CACHED_BYTES = 96 << 20
#: what an entry takes besides its part and ids
ENTRY_BYTES = 180
#: words up to this letter, and parts of these characters, are lower-cased and split here as the tokenizer's rules do it
_LAST = "ɏ"
_PLAIN = re.compile(r"[\x21-\x7EÀ-ɏ]*")
# fixed values: the split pattern of the vocabulary file, for lower-case letters of that range
_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ɏ]+|[0-9]|[^\sa-zß-öø-ɏ0-9]+")


def _byte_letters() -> dict[int, str]:
    """The letter that a byte-level vocabulary writes for each byte: itself if printable, else one from 256 on."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(others)}


class _Parts(dict):
    """Encoded ids of parts seen so far; emptied when full, so its bytes are bounded."""

    def __init__(self, encode: Callable) -> None:
        super().__init__()
        self.encode, self.held = encode, 0
        HELD.append(self)

    def clear(self) -> None:
        super().clear()
        self.held = 0

    def __missing__(self, part: str | bytes) -> bytes:
        ids = self.encode(part)
        size = ENTRY_BYTES + len(part) + len(ids)
        if size > CACHED_BYTES // 64:  # a long part, which will hardly come again
            return ids
        if self.held + size > CACHED_BYTES:
            self.clear()
        self.held += size
        self[part] = ids
        return ids


@lru_cache(1)
def encoder(vocabulary: str) -> Callable[[str | None], bytes]:
    """Text to the little-endian unsigned 32-bit ids of ``vocabulary``, exactly as its tokenizer gives them.

    White space is dropped and never joined across, so parts between ASCII blanks are encoded on their own.
    They repeat, so they are looked up before they are tokenized.
    """
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary)
    model, letters = tokenizer.model, _byte_letters()
    special = [token.content for token in tokenizer.get_added_tokens_decoder().values()]

    def word(part: str) -> bytes:
        ids = [t.id for t in model.tokenize(part.encode().decode("latin-1").translate(letters))]
        return np.array(ids, "<u4").tobytes()

    words = _Parts(word)

    def chunk(raw: bytes) -> bytes:
        part = raw.decode()
        if max(part) <= _LAST:
            lower = part.lower()
            if lower.isalpha():
                return words[lower]
            if _PLAIN.fullmatch(part) and not any(s in part for s in special):
                return b"".join(map(words.__getitem__, _SPLIT.findall(lower)))
        return np.array(tokenizer.encode(part, add_special_tokens=False).ids, "<u4").tobytes()

    chunks = _Parts(chunk)
    return lambda text: b"".join(map(chunks.__getitem__, text.encode().split())) if text else b""


class Tournament:
    """Capacities of bins in the leaves of a tree; an inner node holds the larger of its two."""

    def __init__(self, bins: int, capacity: int) -> None:
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.best = [capacity] * (2 * self.leaves)

    def take(self, size: int) -> int:
        """The first bin with room for ``size``, whose capacity is reduced by it."""
        node, best = 1, self.best
        while node < self.leaves:
            node *= 2
            if best[node] < size:
                node += 1
        found = node - self.leaves
        best[node] -= size
        while node > 1:
            node //= 2
            best[node] = max(best[2 * node], best[2 * node + 1])
        return found


def first_fit_decreasing(sizes: list[int], capacity: int) -> tuple[list[int], list[int]]:
    """Bin and offset in it for each size (1 to ``capacity``)."""
    tree, fill = Tournament(len(sizes), capacity), [0] * len(sizes)
    bins, offsets = [0] * len(sizes), [0] * len(sizes)
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        bins[i] = tree.take(sizes[i])
        offsets[i] = fill[bins[i]]
        fill[bins[i]] += sizes[i]
    return bins, offsets


def _pieces(vocabulary: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, end = encoder(vocabulary), np.array([SEPARATOR], "<u4").tobytes()
        for batch in slices(batches, keep=True):
            tokens, lengths, checks = [], [], []
            for text in batch.column("text"):
                ids = encode(text.as_py()) + end
                parts = [ids[s : s + 4 * SEQUENCE] for s in range(0, len(ids), 4 * SEQUENCE)]
                tokens.append(len(ids) // 4)
                lengths.append([len(p) // 4 for p in parts])
                checks.append([zlib.crc32(p) for p in parts])
            many = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(tokens, pa.int64()), pa.array(lengths, many), pa.array(checks, many)],
                ["doc_id", "doc_tokens", "lengths", "checks"],
            )

    return cut


def _packed(group: pa.Table) -> pa.Table:
    """Packs the pieces of one group; the order of ties follows the rows' values, not their arrival."""
    each = group["lengths"].to_pylist()
    start = [s for lengths in each for s in range(0, SEQUENCE * len(lengths), SEQUENCE)]
    rows = group.select(["doc_id", "doc_tokens"]).take(pa.array(np.repeat(np.arange(len(each)), [len(x) for x in each])))
    rows = pa.table({
        "doc_id": rows["doc_id"], "start": pa.array(start, pa.int64()),
        "length": pa.array([n for lengths in each for n in lengths], pa.int64()),
        "ids_crc32": pa.array([c for checks in group["checks"].to_pylist() for c in checks], pa.int64()),
        "doc_tokens": rows["doc_tokens"],
    }).sort_by([("length", "descending"), ("doc_id", "ascending"), ("start", "ascending"), ("ids_crc32", "ascending")])
    bins, offsets = first_fit_decreasing(rows["length"].to_pylist(), SEQUENCE)
    sequence = np.array(bins, np.int64) + (group["part"][0].as_py() << 32)
    return rows.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offsets, pa.int64()))


def pack(docs: DataFrame, vocabulary: str) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    ``vocabulary`` is a tokenizer file that each executor can read.  A NULL or empty text is one piece
    that holds the separator alone.  Each row of ``docs`` is packed whole, also when it repeats a
    doc_id or has none; other columns are not read.  No documents give no rows.
    """
    groups = max(1, -(-docs.count() // GROUP_DOCS))
    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _pieces(vocabulary), "doc_id long, doc_tokens long, lengths array<long>, checks array<long>"
    )
    part = F.pmod(F.xxhash64(F.lit(SEED), "doc_id", "checks"), F.lit(groups))
    return pieces.withColumn("part", part).groupBy("part").applyInArrow(
        _packed,
        "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long",
    )
