"""Counting quotient filters, and collocations against a plain count."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from curveloom.llm import collocations, quotient
from tests.llm.conftest import odd_texts


@pytest.mark.parametrize("bits", [2, 3, 5, 17, 21, 22, 30, 42])
def test_filters_lose_nothing(bits):
    rng = np.random.default_rng(bits)
    ids = [rng.integers(0, 1 << min(bits, 5 + 9 * i), 3_000) for i in range(3)]
    high, low, half = quotient.pack(ids, bits)
    assert all((a == b).all() for a, b in zip(quotient.unpack(high, low, bits), ids))
    mixed = quotient.permute(high, low, half)
    assert all((a == b).all() for a, b in zip(quotient.restore(*mixed, half), (high, low)))
    true = Counter(zip(*(i.tolist() for i in ids)))
    many = quotient.counted(*mixed, half, np.full(3_000, 200))
    for shard_bits in (0, 1, min(4, half)):
        found = {}
        for _, at in quotient.split(many[0], half, shard_bits):
            one = quotient.encode(*(x[at] for x in many), half, shard_bits)
            h, lo, counts = quotient.decode(quotient.merged([one, one, one]))
            for *key, n in zip(*quotient.unpack(*quotient.restore(h, lo, half), bits), counts):
                found[tuple(map(int, key))] = int(n)
        assert found == {k: 600 * n for k, n in true.items()}


def expected(rows, least: int, top: int) -> list[tuple]:
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                f[lang].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    out = []
    for lang, counts in f.items():
        often = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in often.items():
            if any(100 * b >= 50 * a and p in (q[:2], q[1:]) for q, b in often.items() if len(q) == 3 and len(p) == 2):
                continue
            score, _, left, right = min((1_000_000 * a * a // (counts[p[:k]] * counts[p[k:]]), k, counts[p[:k]], counts[p[k:]]) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), left, right))
        kept.sort()
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(kept[:top])]
    return sorted(out)


def test_odd_texts(spark, odd, no_docs):
    got = sorted(tuple(r) for r in collocations.collocations(odd, 3, 50).collect())
    assert got == expected([("en", t) for _, t in odd_texts()], 3, 50) and got
    assert collocations.collocations(no_docs).collect() == []


@pytest.mark.parametrize("of_shard", [1 << 21, 500])
def test_languages_pieces_and_ties(spark, monkeypatch, of_shard):
    monkeypatch.setattr(collocations, "SHARD_GRAMS", of_shard)
    rng = np.random.default_rng(5)
    words = ["A", "b", "É", "c\x00", "d'e", "...", "x y", " ", "B"]
    rows = []
    for i in range(300):
        text = "".join(rng.choice(words) + rng.choice([" ", "  ", "\t", ", ", "\n", "! ", " "]) for _ in range(40))
        rows.append(([None, "en", "und", "Ä"][i % 4], None if i % 50 == 0 else text, i))
    rows += [("hot", "new york city " * 400, -1), ("empty", "", -2), ("one", "lone", -3)]
    docs = spark.createDataFrame(rows, "lang string, text string, f long").repartition(4)
    plain = expected([r[:2] for r in rows], 10, 2_000)
    assert sorted(tuple(r) for r in collocations.collocations(docs).collect()) == plain
    totals, words_, grams = collocations.phrase_counts(docs)
    assert {r["lang"]: r["n"] for r in totals.collect()}["hot"] == 1_200 and grams.where("f < 10").count() == 0
    assert words_.select("id").distinct().count() == words_.count()


def test_cut_into_parts_and_shards():
    rng = np.random.default_rng(8)
    numbers = np.concatenate([[0, 1], rng.integers(1, 12, 40)]).astype("<u4")


    found = [(i << collocations.ID_BITS) + i - 1 for i in range(2, 12)]
    kind = pa.list_(pa.int64())
    batch = pa.RecordBatch.from_arrays(
        [pa.array([numbers.astype("<u2").tobytes()], pa.binary()), pa.array([12]), pa.array([found], kind)], ["ids", "size", "found"]
    )
    ids = [0 if i < 2 else int(i) - 1 for i in numbers if i > 0]
    true = Counter()
    for a, b, c in zip(ids, ids[1:] + [0], ids[2:] + [0, 0]):
        if a and b:
            true[(a, b, 0)] += 1
            if c:
                true[(a, b, c)] += 1
    whole = collocations.SORTED_GRAMS
    try:
        for size in (2, 6, whole):
            collocations.SORTED_GRAMS = size
            shards = defaultdict(list)
            for out in collocations._filters(4, 2)(iter([batch])):
                for shard, data in zip(*(c.to_pylist() for c in out.columns)):
                    shards[shard].append(data)
            got = {}
            for filters in shards.values():
                table = collocations._frequent(4, 1)(pa.table({"filter": filters}))
                got |= {tuple(r.values())[:3]: r["f"] for r in table.to_pylist()}
            assert got == dict(true)
    finally:
        collocations.SORTED_GRAMS = whole


def test_scores_are_exact(spark):
    a, left, right = 9_007_199_254_740_991, 9_007_199_254_740_993, 9_999_999_999_999_999
    row = spark.range(1).select(collocations._score(F.lit(a), F.lit(left), F.lit(right)).alias("s")).first()
    assert row["s"] == 1_000_000 * a * a // (left * right)


def test_long_lists_take_four_bytes():
    for n in (3, 1 << 16, (1 << 16) + 1):
        chunk = collocations.Chunk()
        chunk.add([b"%d" % i for i in range(n)])
        assert (collocations.Chunk.read(chunk.ids().tobytes(), n) == np.arange(n)).all()
