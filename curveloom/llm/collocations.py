"""Phrase collocations: two or three words that occur together more often than their parts explain.

Words that are frequent enough get dense ids, so an n-gram is one packed number.  Tasks count the n-grams of
their texts in counting quotient filters (``quotient``), cut by quotient into shards; the sorted filters of a
shard are merged, and what reaches the least count is unpacked into rows.  Everything is counted per language;
a word's id implies its language.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from curveloom.llm import quotient
from curveloom.llm.positions import positions
from curveloom.llm.tables import stored
from curveloom.llm.wordlists import Chunk
from curveloom.operators.skew import salted_join

LEAST_COUNT, MOST_WORDS = 10, 3
#: a phrase is dropped when a longer one has this percentage of its count or more
COVERED_PERCENT = 50
TOP = 2_000
SCALE = 1_000_000
#: n-grams of a shard, at most, on average
SHARD_GRAMS = 1 << 21
#: n-grams that a task sorts at once
SORTED_GRAMS = 1 << 21
RANK_PARTS = 64
#: words of a chunk; few chunks repeat fewer words
CHUNK_WORDS = 1 << 20
#: bits of a word's id beside its number in a chunk
ID_BITS = 33
#: A-Z are lower-cased, tabs are blanks, and what ends a piece is a line feed
_ENDS = b".,;:!?\n\x0b\x0c\r"
_LETTERS = bytes(ord("\n") if b in _ENDS else ord(" ") if b == 9 else b + 32 if 65 <= b <= 90 else b for b in range(256))
#: stands between pieces; no word has a capital
_END = b"A"


def words_of(text: str | None) -> list[bytes]:
    """The lower-cased words of a text with ``_END`` between its pieces."""
    return text.encode().translate(_LETTERS).replace(b"\n", b" A ").split(b" ") if text else []


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of (chunk, lang, words, counts, ids): numbers 0 and 1 are an empty word and the end of a piece."""
    task, made, held, size = TaskContext.get().partitionId(), 0, {}, 0

    def flush() -> Iterator[pa.RecordBatch]:
        nonlocal made, held, size
        for lang, chunk in held.items():
            ids, words = chunk.ids(), list(chunk.numbers)
            counts = np.bincount(ids, minlength=len(words))[2:]
            yield pa.RecordBatch.from_arrays(
                [pa.array([(task << 33) + made], pa.int64()), pa.array([lang]), pa.array([[w.decode() for w in words[2:]]], pa.list_(pa.string())),
                 pa.array([counts], pa.list_(pa.int64())), pa.array([ids.tobytes()], pa.binary())],
                ["chunk", "lang", "words", "counts", "ids"],
            )
            made += 1
        held, size = {}, 0

    for batch in batches:
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
            words = words_of(text.as_py())
            if words:
                chunk = held.get(lang)
                if chunk is None:
                    chunk = held[lang] = Chunk()
                    chunk.add([b"", _END])  # also the start of a text, which no n-gram crosses
                chunk.add(words)
                chunk.add([_END])
                size += len(words)
            if size >= CHUNK_WORDS:
                yield from flush()
    yield from flush()


def _filters(bits: int, shard_bits: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """(shard, filter) of the n-grams of chunks whose numbers are looked up in pairs of number and id."""

    def emit(held: list[tuple[np.ndarray, np.ndarray]], half: int) -> Iterator[pa.RecordBatch]:
        high, low, counts = quotient.counted(*(np.concatenate(h) for h in zip(*held)), half)
        parts = quotient.split(high, half, shard_bits)
        data = [quotient.encode(high[at], low[at], counts[at], half, shard_bits) for _, at in parts]
        yield pa.RecordBatch.from_arrays([pa.array([s for s, _ in parts], pa.int64()), pa.array(data, pa.binary())], ["shard", "filter"])

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, half = [], 0, 0
        for batch in batches:
            for i in range(batch.num_rows):
                numbers = Chunk.read(batch.column("ids")[i].as_py(), batch.column("size")[i].as_py())
                found = batch.column("found")[i].values.to_numpy()
                known = np.zeros(batch.column("size")[i].as_py(), np.int64)
                known[found >> ID_BITS] = found & ((1 << ID_BITS) - 1)
                ids = known[numbers[numbers > 0]]  # empty words lie between blanks; id 0 breaks n-grams
                for begin in range(0, len(ids), SORTED_GRAMS // 2):
                    part = np.append(ids[begin : begin + SORTED_GRAMS // 2 + 2], [0, 0])
                    a, b, c = part[:-2], part[1:-1], part[2:]
                    own = np.arange(len(a)) < SORTED_GRAMS // 2  # the two words after it belong to the next part
                    two = np.flatnonzero((a > 0) & (b > 0) & own)
                    three = two[c[two] > 0]
                    none = np.zeros(len(two), np.int64)
                    grams = [np.concatenate(x) for x in ((a[two], a[three]), (b[two], b[three]), (none, c[three]))]
                    high, low, half = quotient.pack(grams, bits)
                    held.append(quotient.permute(high, low, half))
                    size += len(high)
                    if size >= SORTED_GRAMS:
                        yield from emit(held, half)
                        held, size = [], 0
        if size:
            yield from emit(held, half)

    return made


def _frequent(bits: int, least: int) -> Callable[[pa.Table], pa.Table]:
    def merge(group: pa.Table) -> pa.Table:
        high, low, counts = quotient.decode(quotient.merged(group["filter"].to_pylist()))
        often = counts >= least
        half = (3 * bits + 1) // 2
        ids = quotient.unpack(*quotient.restore(high[often], low[often], half), bits)
        return pa.table({"w1": ids[0], "w2": ids[1], "w3": ids[2], "f": counts[often]})

    return merge


def _score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 a² / (left right)), exact below 10¹⁶ occurrences."""
    wide = lambda x: x.cast("decimal(16,0)")
    return F.call_function("div", wide(a) * wide(a) * F.lit(SCALE).cast("decimal(7,0)"), wide(left) * wide(right))


def phrase_counts(docs: DataFrame, least: int = LEAST_COUNT) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(lang, n), vocabulary (id, lang, word, f) and phrases (w1, w2, w3 or 0, f) of at least ``least`` occurrences."""
    chunks = stored(
        docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
        .mapInArrow(_chunks, "chunk long, lang string, words array<string>, counts array<long>, ids binary"),
        "chunks",
    )
    words = chunks.select("lang", F.explode(F.arrays_zip("words", "counts")).alias("w")).groupBy("lang", "w.words").agg(
        F.sum("w.counts").alias("f")
    )
    words = stored(words.withColumnRenamed("words", "word"), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    frequent = stored(
        positions(words.where(F.col("f") >= least).withColumn("all", F.lit("")), "all", ["lang", "word"])
        .select((F.col("idx") + 1).alias("id"), "lang", "word", "f"),
        "vocabulary",
    )
    total, size = words.agg(F.sum("f")).first()[0] or 0, frequent.count()
    bits = max(2, size.bit_length())
    shard_bits = max(0, -(-2 * total // SHARD_GRAMS) - 1).bit_length()
    shard_bits = min(shard_bits, (3 * bits + 1) // 2)
    listed = chunks.select("chunk", "lang", F.posexplode("words").alias("number", "word"))
    found = stored(
        listed.join(frequent.select("lang", "word", "id"), ["lang", "word"]).groupBy("chunk").agg(
            F.collect_list(F.shiftleft((F.col("number") + 2).cast("long"), ID_BITS) + F.col("id")).alias("found")  # of one chunk
        ),
        "found",
    )
    numbers = chunks.select("chunk", "ids", (F.size("words") + 2).alias("size"))
    filters = numbers.join(found, "chunk").select("ids", "size", "found").mapInArrow(
        _filters(bits, shard_bits), "shard long, filter binary"
    )
    grams = filters.groupBy("shard").applyInArrow(_frequent(bits, least), "w1 long, w2 long, w3 long, f long")
    return totals, frequent, stored(grams, "phrases")


def collocations(docs: DataFrame, least: int = LEAST_COUNT, top: int = TOP) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    ``docs`` needs text and lang.  A NULL text is empty; a NULL lang is ``und``.  Phrases never cross ``.,;:!?`` or
    a line's end.  Rows that repeat count again.  A language without frequent phrases has no rows.
    """
    totals, words, grams = phrase_counts(docs, least)
    word = words.select(F.col("id"), F.col("f").alias("fw"))
    pairs, triples = grams.where("w3 = 0").drop("w3"), grams.where("w3 > 0")
    # what a phrase of two words must beat: the largest count of one of three around it
    around = triples.select("w1", "w2", "f").union(triples.select("w2", "w3", "f")).groupBy("w1", "w2").agg(F.max("f").alias("over"))
    two = (
        pairs.join(around, ["w1", "w2"], "left").where(F.expr(f"over IS NULL OR 100 * over < {COVERED_PERCENT} * f")).drop("over")
        .withColumn("w3", F.lit(0).cast("long"))
    )
    head = pairs.select("w1", "w2", F.col("f").alias("f12"))
    tail = pairs.select(F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("f").alias("f23"))
    three = salted_join(salted_join(triples, head, ["w1", "w2"], ["w3"]), tail, ["w2", "w3"], ["w1"])
    every = three.unionByName(two.withColumns({"f12": F.lit(None).cast("long"), "f23": F.lit(None).cast("long")}))
    one = lambda at: words.select(F.col("id").alias(at), F.col("f").alias(f"f{at}"), F.col("word").alias(f"s{at}"))
    first = words.select(F.col("id").alias("w1"), "lang", F.col("f").alias("fw1"), F.col("word").alias("sw1"))
    every = salted_join(every, first, ["w1"], ["w2", "w3"], "inner")
    every = salted_join(every, one("w2"), ["w2"], ["w1", "w3"], "inner")
    every = salted_join(every, one("w3"), ["w3"], ["w1", "w2"])
    pair = F.col("w3") == 0
    after_one = F.when(pair, F.col("fw2")).otherwise(F.col("f23"))
    every = every.withColumns({"k1": _score(F.col("f"), F.col("fw1"), after_one), "k2": _score(F.col("f"), F.col("f12"), F.col("fw3"))})
    second = F.expr("k2 < k1")  # NULL for two words
    scored = every.select(
        "lang", F.concat_ws(" ", "sw1", "sw2", "sw3").alias("phrase"), F.col("f").alias("a"),
        F.when(second, F.col("f12")).otherwise(F.col("fw1")).alias("l"), F.when(second, F.col("fw3")).otherwise(after_one).alias("r"),
        F.when(second, F.col("k2")).otherwise(F.col("k1")).cast("long").alias("score"),
    )
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # a language's phrases are cut in parts first, so only some of them meet in one task
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANK_PARTS))
    cut = scored.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order)))
    cut = cut.where(F.col("rank") <= top).drop("part", "rank")
    ranked = cut.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    return ranked.where(F.col("rank") <= top).join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
