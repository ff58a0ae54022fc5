"""Groups of similar SpotSigs sets against all pairs."""

from __future__ import annotations

import random
import re

import pytest
from pyspark.sql import functions as F

from curveloom.llm import spotsigs, spotsigs_groups
from tests.llm.conftest import edited, odd_texts, prose


def spotted(seed: int, n: int) -> str:
    rng = random.Random(seed)
    return " ".join(w if rng.random() < 0.7 else f"{w} the" for w in prose(seed, n).split())


def brute(rows: list[tuple], percent: int) -> list[tuple]:
    """(doc_id, number of signatures, group_id, kept) by comparing all sets."""
    sets = [frozenset(s) for _, s in rows]
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and label[i] != label[j] and 100 * len(a & b) >= percent * len(a | b):
                label = [label[j] if x == label[i] else x for x in label]
    out = []
    for (doc_id, spots), x in zip(rows, label):
        ids = [d for (d, _), y in zip(rows, label) if x == y and d is not None]
        group = min(ids) if ids else None
        out.append((doc_id, len(spots), group, None if group is None else doc_id == group))
    return sorted(out, key=repr)


def compare(docs, percent):
    sets = docs.select("doc_id", spotsigs.signatures(F.coalesce("text", F.lit("")))).collect()
    got = [tuple(r) for r in spotsigs_groups.similar_groups(docs, percent).collect()]
    assert sorted(got, key=repr) == brute([tuple(r) for r in sets], percent)
    return got


def test_planted_groups(spark, monkeypatch):
    """Several groups under a common signature, of which blocks of few sets must find all links."""
    monkeypatch.setattr("curveloom.llm.minhash.BLOCK_SETS", 7)
    rows, opening = [], "the same opening of every text the other opening "
    for g in range(12):
        base = spotted(g, 60 + 15 * g)
        rows += [(100 * g + k, opening * (g % 2) + edited(base, 100 * g + k, k % 9)) for k in range(12)]
    rows += [(5_000 + i, f"{opening} word{i % 30}") for i in range(90)]
    rows += [(6_000 + i, "the " + " the ".join(f"a{k} b{k}" for k in range(i, i + 4 + i % 3))) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = compare(docs, 80)
    assert 12 < len({g for _, _, g, _ in got}) < len(rows)
    compare(docs, 50)


def test_odd_rows(odd, no_docs):
    got = compare(odd, 80)
    assert len(got) == len(odd_texts())
    assert spotsigs_groups.similar_groups(no_docs).collect() == []


@pytest.mark.parametrize("n, m", [(4, 5), (8, 10), (16, 20), (80, 100)])
def test_sizes_at_the_bound(spark, n, m):
    spots = lambda k: [f"{i:08x}" for i in range(k)]
    row = spark.createDataFrame([(spots(n), spots(m), spots(m + 1))], "a array<string>, b array<string>, c array<string>")
    alike = lambda x, y: spotsigs_groups.alike(F.col(x), F.col(y), 80)
    assert tuple(row.select(alike("a", "b"), alike("b", "a"), alike("a", "c")).first()) == (True, True, False)
    sets = spark.createDataFrame([("x", spots(n)), ("y", spots(m))], "set_id string, spots array<string>")
    assert {r["root"] for r in spotsigs_groups._set_components(sets, 80).collect()} == {"x"}


def test_no_python_in_the_plan(spark, odd):
    plan = spotsigs_groups.similar_groups(odd)._jdf.queryExecution().executedPlan().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
