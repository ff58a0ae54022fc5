"""Removal of repeated word windows against brute force."""

from __future__ import annotations

import hashlib
import random
import re

import numpy as np
import pytest

from curveloom.llm import debruijn
from tests.llm.conftest import prose

SCHEMA = "doc_id long, text string, shard int, n long"


def expected(rows) -> list[tuple]:
    lowest: dict = {}
    split = [(i, re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t, *_ in rows]
    key = lambda i: -(1 << 63) if i is None else i
    for i, words in split:
        for at in range(len(words) - 12):
            window = tuple(words[at : at + 13])
            lowest[window] = min(lowest.get(window, key(i)), key(i))
    out = []
    for i, words in split:
        gone = set()
        for at in range(len(words) - 12):
            if lowest[tuple(words[at : at + 13])] < key(i):
                gone.update(range(at, at + 13))
        kept = " ".join(w for at, w in enumerate(words) if at not in gone)
        out.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def got(df) -> list[tuple]:
    return sorted((tuple(r) for r in debruijn.without_repeated_windows(df).collect()), key=repr)


def test_odd_texts(spark, odd, no_docs):
    assert got(odd) == expected(odd.select("doc_id", "text").collect())
    assert debruijn.without_repeated_windows(no_docs).collect() == []


@pytest.mark.parametrize("seed,of_shard", [(0, 1 << 21), (1, 64), (2, 1_000)])
def test_passages_copies_and_loops(spark, monkeypatch, seed, of_shard):
    monkeypatch.setattr(debruijn, "SHARD_WINDOWS", of_shard)
    rng = random.Random(seed)
    passages = [prose(seed * 100 + i, rng.randrange(10, 60)) for i in range(12)]
    few = ["a", "b", "B", "é", "a."]  # windows of few words meet by chance, and branch at every place
    rows = []
    for i in range(160):
        parts = [rng.choice([prose(rng.randrange(10**6), 15), rng.choice(passages), " ".join(rng.choices(few, k=rng.randrange(40)))]) for _ in range(5)]
        if i % 9 == 0:
            parts.append("same " * 30)
        text = rng.choice([" ", "\n", "\t ", "\x0b"]).join(parts)
        rows.append((rng.choice([i, i, i // 4, None]), text if i % 17 else None, i, i))
    rows += [rows[3], rows[3], rows[10], (500, rows[10][1], 0, 0), (501, "x " * 13, 0, 0), (502, "x " * 12, 0, 0), (-5, "x " * 14, 0, 0)]
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(5)) == expected(rows)


def test_hashes_tell_words_apart():
    rng = np.random.default_rng(4)
    words = rng.integers(1, 3, 300).astype(np.uint64)
    h = debruijn.window_hashes(words)
    true: dict = {}
    for at in range(len(h)):
        true.setdefault(tuple(words[at : at + 13].tolist()), set()).add(int(h[at]))
    assert all(len(x) == 1 for x in true.values()) and len({next(iter(x)) for x in true.values()}) == len(true)
    start = np.arange(0, 280)
    for n in (13, 20):
        one, two = debruijn.path_digests(words, start, start + n)
        same = {}
        for a, x, y in zip(start.tolist(), one.tolist(), two.tolist()):
            same.setdefault(tuple(words[a : a + n].tolist()), set()).add((x, y))
        assert all(len(x) == 1 for x in same.values()) and len({next(iter(x)) for x in same.values()}) == len(same)


def test_many_groups_of_copies(spark):
    """A third of all rows are copies, near copies with an edit each, or repeat one id."""
    base, rng = prose(77, 120).split(), random.Random(7)
    rows = []
    for i in range(240):
        words = list(base)
        if i % 2:
            words[rng.randrange(len(words))] = f"e{i}"
        rows.append((i if i % 3 else 9, " ".join(words), 0, i))
    rows += [(1_000 + i, prose(2_000 + i, 80), 0, i) for i in range(300)]
    assert got(spark.createDataFrame(rows, SCHEMA).repartition(7)) == expected(rows)
