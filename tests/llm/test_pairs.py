"""MinHash groups and repeated substrings against brute force."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from curveloom.llm import components as stars, minhash, substrings
from curveloom.llm.components import components, contracted
from curveloom.llm.phrases import LENGTH, Digests, runs
from curveloom.llm.tables import stored
from tests.llm.conftest import edited, odd_texts, prose


def shingle_set(text: str | None) -> frozenset:
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ")
    words = [w for w in words if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute_groups(rows: list[tuple[int | None, str | None]]) -> list[tuple]:
    sets = [shingle_set(t) for _, t in rows]
    label = list(range(len(rows)))
    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 85 * len(a | b):
                old, new = label[i], label[j]
                label = [new if x == old else x for x in label]
    out = []
    for i, (doc_id, _) in enumerate(rows):
        ids = [rows[k][0] for k in range(len(rows)) if label[k] == label[i] and rows[k][0] is not None]
        low = min(ids) if ids else None
        out.append((doc_id, len(sets[i]), low, None if low is None else doc_id == low))
    return out


def test_groups_equal_brute_force(odd):
    got = minhash.near_duplicates(odd).collect()
    assert Counter(map(tuple, got)) == Counter(brute_groups(odd_texts()))


def test_stage_keeps_one_of_a_group(odd):
    kept = minhash.without_near_duplicates(odd)
    assert kept.columns == odd.columns
    ids = Counter(r["doc_id"] for r in kept.collect())
    groups = brute_groups(odd_texts())
    assert {i for i in ids if i is not None} == {i for i, n, low, kept in groups if i is not None and (kept or n == 0)}
    assert ids[1] == 1 and not {2, 3} & set(ids)
    assert ids[6] == ids[7] == ids[8] == 1  # without words
    assert ids[13] == 1 and ids[14] == 2  # one text twice; two texts
    assert ids[None] == 1  # the copy of document 1 went


def test_pipeline_drops_copies_from_80_percent(spark):
    rows, near = [], 0
    for k in range(40):
        base = prose(900 + k, 200)
        rows += [(3 * k, base), (3 * k + 1, edited(base, k, 1 + k % 9)), (3 * k + 2, edited(base, 100 + k, 3 + k % 5))]
    sets = [shingle_set(t) for _, t in rows]
    label = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            shared, all_ = len(sets[i] & sets[j]), len(sets[i] | sets[j])
            near += 80 * all_ <= 100 * shared < 85 * all_
            if 100 * shared >= 80 * all_:
                old, new = max(label[i], label[j]), min(label[i], label[j])
                label = [new if x == old else x for x in label]
    assert near > 10
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted(r["doc_id"] for r in corpus_pipeline.drop_near_duplicates(spark, docs, "").collect())
    assert kept == sorted(set(label)) and len(kept) < minhash.without_near_duplicates(docs).count()


def test_no_documents(no_docs):
    assert minhash.near_duplicates(no_docs).collect() == []
    assert substrings.without_repeats(no_docs).collect() == []


def test_forest_counts_shared_elements():
    rng = np.random.default_rng(1)
    base = np.unique(rng.integers(0, 1 << 60, 9_000, dtype=np.uint64))
    near = np.unique(np.concatenate([base[200:], rng.integers(0, 1 << 60, 100, dtype=np.uint64)]))
    far = np.unique(np.concatenate([base[:4_000], rng.integers(0, 1 << 60, 4_000, dtype=np.uint64)]))
    assert minhash._forest([base], [near, far]) == [(1, 0)]


def test_two_permutations_make_all_coordinates():
    found = minhash.shingles("a b c d e f g h")
    first, shifted = minhash.permutations()
    slots = first[found & np.uint64(minhash.UNIVERSE - 1)]
    second = shifted[:, 0]
    for k in (0, 1, minhash.BANDS * minhash.ROWS - 1):
        inside = slots[slots + k < len(second)] + k
        assert len(inside) < len(slots) or minhash.signature(found)[k] == second[inside].min()


def test_components_of_chains(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, 101), (102, 101), (7, 7)]
    got = dict(components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {i: 1 for i in range(1, 61)} | {100: 100, 101: 100, 102: 100}


def test_contracted_edges_have_the_same_components(spark, monkeypatch):
    rng = np.random.default_rng(5)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 900, (700, 2))] + [(None, 1), (2, None), (3, 3)] * 2
    few = spark.createDataFrame(edges, "a long, b long").repartition(3).cache()
    named = few.selectExpr("cast(cast(a as string) as binary) a", "cast(cast(b as string) as binary) b")
    for rows in (few, named, few.limit(0)):
        plain = dict(components(rows).collect())
        for most in (1 << 16, 50):
            monkeypatch.setattr(stars, "HELD_EDGES", most)
            fewer = contracted(rows)
            assert dict(components(fewer).collect()) == plain and fewer.where("b >= a OR a IS NULL OR b IS NULL").count() == 0


def test_few_links_take_no_rounds(spark, odd, monkeypatch):
    written = []
    monkeypatch.setattr(stars, "stored", lambda df, what: written.append(what) or stored(df, what))
    assert minhash.near_duplicates(odd).where("doc_id != component_id").count()
    assert written == ["edges", "edges"]  # those of both graphs, as they were found


def brute_repeats(rows: list[tuple[int, str | None]]) -> dict[int, tuple]:
    seen, out = set(), {}
    for doc_id, text in sorted(rows):
        data = (text or "").encode()
        gone = bytearray(len(data))
        for p in range(len(data) - LENGTH + 1):
            string = data[p : p + LENGTH]
            if string in seen:
                gone[p : p + LENGTH] = b"\1" * LENGTH
            seen.add(string)
        spans = sum(gone[p] and (p == 0 or not gone[p - 1]) for p in range(len(data)))
        kept = bytes(c for c, g in zip(data, gone) if not g)
        out[doc_id] = (len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest())
    return out


@pytest.fixture(params=[2_048, 3])
def blocks(request, monkeypatch):
    """Also with blocks so small that every trigger is hot."""
    monkeypatch.setattr(substrings, "BLOCK_PHRASES", request.param)


def test_repeats_equal_brute_force(spark, blocks):
    rows = {i: t for i, t in odd_texts() if i is not None and i not in (13, 14)}
    rows |= {100: "ab" * 400, 101: "x" + "ab" * 300 + "y", 102: rows[1][:250] + "-" + rows[1][200:700], 103: "z" * 99, 104: "z" * 99}
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows.items()], "doc_id long, text string, start int").repartition(4)
    got = {r[0]: tuple(r)[1:] for r in substrings.without_repeats(docs).collect()}
    assert got == brute_repeats(list(rows.items()))


def test_repeated_ids_are_told_apart(odd):
    rows = [tuple(r) for r in substrings.without_repeats(odd).collect()]
    assert len(rows) == len(odd_texts())
    both = [r for r in rows if r[0] == 14]
    assert len({r[4] for r in both}) == 2 and all(r[2] == 0 for r in both)
    first = next(r for r in rows if r[0] is None and r[1] > 700)  # NULL comes first in corpus order
    assert first[2] == 0 and next(r for r in rows if r[0] == 1)[2] == first[1]


def test_strings_have_one_phrase_each():
    text = ("The quick brown fox. " * 30 + "0123456789" * 20).encode()
    data = np.frombuffer(text * 2, np.uint8)
    owner, start, n, _ = runs(data, np.array([0, len(text), 2 * len(text)]))
    covered = np.concatenate([np.arange(s, s + k) for s, k in zip(start, n)])
    each = len(text) - LENGTH + 1
    assert covered.tolist() == [*range(each), *range(len(text), len(text) + each)]
    first, second = Digests(data).of(start, start + n + LENGTH - 1)
    half = len(start) // 2
    assert owner.tolist() == [0] * half + [1] * half
    assert (first[:half] == first[half:]).all() and (second[:half] == second[half:]).all()
