"""The Merkle manifest against a plain computation."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from curveloom.llm import merkle
from curveloom.llm.positions import positions

SCHEMA = "lang string, doc_id long, text string, source string, n_chars int, idx int, path string"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def field(value) -> str:
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text) -> str:
    return sha("".join(map(field, (row["doc_id"], row["source"], row["lang"], row["n_chars"], text))))


def climb(nodes: list[str], arity: int) -> tuple[str, list[list[tuple[str, str]]]]:
    """Root, and for each node its siblings (left, right) from the bottom up."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        runs = [nodes[i : i + arity] for i in range(0, len(nodes), arity)]
        for leaf_at, path in enumerate(paths):
            run, slot = runs[at[leaf_at] // arity], at[leaf_at] % arity
            path.append(("".join(run[:slot]), "".join(run[slot + 1 :])))
            at[leaf_at] //= arity
        nodes = [sha("".join(run)) for run in runs]
    return nodes[0], paths


def expected(rows, arity: int) -> list[tuple]:
    trees: dict = {}
    for row in rows:
        trees.setdefault(row["lang"], []).append(row)
    names = sorted(trees, key=lambda t: (t is not None, (t or "").encode()))
    built = {}
    for name in names:
        held = sorted(trees[name], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"])))
        built[name] = (held, *climb([leaf(r, r["text"]) for r in held], arity))
    root, upper = climb([built[name][1] for name in names], arity)
    out = []
    for name, above in zip(names, upper):
        held, subroot, paths = built[name]
        for row, path in zip(held, paths):
            text = row["text"]
            if row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0 and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            at = leaf(row, text)
            for left, right in path + above:
                at = sha(left + at + right)
            proof = sha("".join(left + right for left, right in path + above))
            out.append((row["doc_id"], leaf(row, row["text"]), subroot, root, proof, at, at == root))
    return sorted(out, key=repr)


def rows_of(n: int, langs: list) -> list[tuple]:
    texts = [None, "", "Ä Word", "lower", "MiXed É", "x" * 50_000]
    return [
        (langs[i * i % len(langs)], None if i % 29 == 0 else i // 2 * 3 - 20, texts[i % len(texts)],
         None if i % 5 == 0 else f"s{i % 3}", None if i % 7 == 0 else i, i, "p")
        for i in range(n)
    ]


@pytest.mark.parametrize("arity,n,langs", [
    (8, 1, ["en"]), (8, 2, ["en"]), (8, 9, ["en"]), (8, 65, ["en"]), (8, 150, ["en", None, "", "é", "Z", "+"]),
    (8, 40, [f"l{i}" for i in range(17)]), (2, 33, ["en", "de", None]), (3, 50, ["a", "b"]),
])
def test_equals_plain_computation(spark, arity, n, langs):
    rows = rows_of(n, langs)
    rows += rows[:3]  # repeated rows
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = sorted((tuple(r) for r in merkle.tamper_check(docs, arity).collect()), key=repr)
    assert got == expected(docs.collect(), arity)


def test_empty(spark):
    held = merkle.tamper_check(spark.createDataFrame([], SCHEMA))
    assert held.collect() == [] and held.columns[0] == "doc_id" and held.columns[-1] == "verified"


def test_every_change_is_noticed(spark):
    docs = spark.createDataFrame(rows_of(30, ["a", "b"]), SCHEMA)
    before = merkle.manifest(docs).root
    for column, value in {"doc_id": 7, "source": "-", "n_chars": 10_000, "text": "-", "lang": "c"}.items():
        other = docs.withColumn(column, F.when(F.col("idx") == 11, F.lit(value)).otherwise(F.col(column)).cast(docs.schema[column].dataType))
        assert merkle.manifest(other).root != before
    assert merkle.manifest(docs.repartition(7)).root == before


def test_positions_of_one_hot_group(spark):
    df = spark.range(5_000).select(F.when(F.col("id") % 100 == 0, F.concat(F.lit("g"), F.col("id") % 300)).otherwise("hot").alias("g"), (-F.col("id")).alias("v"))
    got = positions(df.repartition(9), "g", ["v"]).collect()
    for group in {r["g"] for r in got}:
        held = sorted((r for r in got if r["g"] == group), key=lambda r: r["v"])
        assert [r["idx"] for r in held] == list(range(len(held))) and {r["n"] for r in held} == {len(held)}
