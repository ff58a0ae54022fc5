"""The registered queries against their SQL, and the pipeline stage by stage."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
import corpus_pipeline
from curveloom.llm import secrets
from curveloom.llm.registry import QUERIES, SQL
from tests.oracle import TESTDATA, connect, differences

pytestmark = pytest.mark.skipif(not (TESTDATA / "sf0.001").exists(), reason="driver tables not present")


def test_all_are_registered():
    numbers = {int(n[2:].split("_")[0]) for n in QUERIES if n.startswith("op")}
    assert numbers == set(range(1, 14)) and "pipeline" in QUERIES
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    assert not differences(spark, connect("0.001"), name, "0.001")


def test_stages_take_effect(spark):
    folder = str(TESTDATA / "sf0.01")
    documents = spark.read.parquet(f"{folder}/documents.parquet")
    docs, seen = documents, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder).cache()
        assert docs.columns == documents.columns
        seen[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    all_ = {r["doc_id"]: r["text"] for r in documents.collect()}
    toxic = {r["doc_id"] for r in spark.read.parquet(f"{folder}/labels.parquet").where("toxic = 1").collect()}
    stay = seen["toxicity"]
    assert len(toxic & set(stay)) < 0.2 * len(toxic) and len(set(all_) - set(stay) - toxic) < 0.1 * len(all_)
    groups = {r["doc_id"]: r["component_id"] for r in QUERIES["op1_minhash_near_dedup"](spark, folder).collect()}
    unique = seen["minhash near-dedup"]
    assert len({groups[i] for i in unique}) == len(unique)
    clean = seen["secret scan"]
    assert set(clean) == set(unique) and not any(secrets.base_spans(t) for t in clean.values() if t)
    assert all(clean[i] == t for i, t in unique.items() if not secrets.base_spans(t or "") + secrets.confirmed_spans(t or ""))
    mixed = seen["mixing"]
    assert set(mixed) < set(clean) and 0.3 * len(clean) < len(mixed)
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, folder).toPandas()
    assert set(pieces["doc_id"]) == set(mixed)
    whole = pieces.groupby("doc_id").agg(n=("length", "sum"), tokens=("doc_tokens", "first"))
    assert (whole["n"] == whole["tokens"]).all()

