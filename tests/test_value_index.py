"""The inverted index of attribute values against a plain filter."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from curveloom.functions.literal import literal_frame
from curveloom.operators import filters as fl, value_index as vi

CASES = [("both", "Hawaii"), ("both", "CONUS"), ("island", "Hawaii"), ("main", "CONUS")]


@pytest.fixture(scope="module")
def library(spark, tmp_path_factory):
    """70,000 curves, so that blocks fill up, with one value that a third of them have."""
    path = tmp_path_factory.mktemp("index")
    curves = spark.range(70_000).select(F.format_string("c%06d", "id").alias("curve_id"), F.lit(1).alias("block"), "id")
    value = lambda key, c: curves.select("curve_id", F.lit(key).alias("key"), c.cast("string").alias("value"))
    attributes = (
        value("shape", F.when(F.col("id") % 3 == 0, "hip").when(F.col("id") % 7 == 0, None).otherwise("gable"))
        .unionByName(value("deck", F.col("id") % 11))
        .unionByName(value("geographic_case", F.element_at(F.array(*map(F.lit, ["both", "island", "main", "none"])), (F.col("id") % 4 + 1).cast("int"))))
    )
    attributes = attributes.unionByName(attributes.where("value = '3'")).unionByName(
        literal_frame(spark, [("unknown", "shape", "hip"), (None, "shape", "hip"), ("c000001", None, "hip")], "curve_id string, key string, value string"))
    attributes.write.parquet(str(path / "attributes"))
    attributes = spark.read.parquet(str(path / "attributes"))
    again = curves.unionByName(curves.where("id < 50")).unionByName(curves.limit(1).withColumn("curve_id", F.lit(None).cast("string")))
    numbers = vi.curve_numbers(again.repartition(5), str(path / "numbers"))
    return curves, attributes, numbers, vi.write_value_index(numbers, attributes, str(path / "bitmaps"))


def members(index, numbers, filters):
    return sorted(r["curve_id"] for r in vi.filter_members(index, numbers, filters).collect())


def test_numbers_are_distinct(library):
    curves, _, numbers, _ = library
    assert numbers.count() == numbers.select("block", "place").distinct().count() == curves.count()
    assert numbers.agg(F.max("place")).first()[0] < 8 * vi.BITMAP_BYTES


@pytest.mark.parametrize("pairs, territory", [
    ([("shape", "hip")], None), ([("shape", "hip"), ("deck", "3")], None), ([("deck", "3"), ("deck", "4")], None), ([("deck", "99")], None),
    ([("shape", "gable"), ("deck", "0")], "Hawaii"), ([], "Hawaii"), ([("shape", "hip")], "Mars"),
])
def test_same_as_the_filter(spark, library, pairs, territory):
    curves, attributes, numbers, index = library
    cases = literal_frame(spark, CASES, "case_name string, territory string")
    asked = vi.pair_filter(index, pairs, cases, territory)
    plain = fl.attribute_filter(curves, attributes, pairs, cases, territory)
    expected = sorted(r["curve_id"] for r in plain.collect())
    assert members(index, numbers, asked) == expected
    assert [r["n_curves"] for r in vi.filter_counts(index, asked).collect()] == [len(expected)]


def test_many_filters_with_repeats_and_nulls(spark, library):
    curves, attributes, numbers, index = library
    rng = random.Random(4)
    rows = []
    for i in range(300):
        rows += [(i, 0, "deck", str(rng.randrange(12))), (i, 0, "deck", str(rng.randrange(12))), (i, 1, "shape", rng.choice(["hip", "gable", None]))]
    asked = literal_frame(spark, rows + rows[:50], "filter_id int, condition int, key string, value string")
    held = {}
    for r in attributes.where("curve_id LIKE 'c%' AND key IN ('deck', 'shape')").collect():
        held.setdefault((r["key"], r["value"]), set()).add(r["curve_id"])
    expected = {}
    for i in range(300):
        any_deck = set().union(*(held.get((k, v), set()) for j, c, k, v in rows if j == i and c == 0))
        shape = rows[3 * i + 2][3]
        expected[i] = len(any_deck & held[("shape", shape)]) if shape else 0
    assert {r["filter_id"]: r["n_curves"] for r in vi.filter_counts(index, asked).collect()} == expected


def test_empty_tables(spark, library, tmp_path):
    curves, attributes, numbers, index = library
    none = vi.curve_numbers(curves.where("false"), str(tmp_path / "numbers"))
    empty = vi.write_value_index(none, attributes, str(tmp_path / "bitmaps"))
    asked = vi.pair_filter(index, [("shape", "hip")])
    assert members(empty, none, asked) == [] and vi.filter_counts(empty, asked).first()["n_curves"] == 0
    assert vi.filter_counts(index, asked.where("false")).collect() == []


def test_a_filter_reads_its_values_only(spark, library):
    """The index is ordered by key and value, and conditions on both reach the scan."""
    index = library[3]
    text = index.where("key = 'deck' AND value = '3'")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(key,deck)" in text and "EqualTo(value,3)" in text
