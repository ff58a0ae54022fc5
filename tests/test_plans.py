"""Physical plans keep the properties that matter on large data."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from curveloom.checks.registry import QUERIES
from curveloom.functions.literal import literal_frame
from curveloom.operators import audit, filters as fl, reshape
from tests.oracle import TESTDATA

SF = str(TESTDATA / "sf0.001")
pytestmark = pytest.mark.skipif(not (TESTDATA / "sf0.001").exists(), reason="driver tables not present")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


LAZY = [n for n in QUERIES if n not in {"read_wide_csv", "read_typed_csv", "read_manifest", "file_row_counts", "write_clustered", "write_tables",
                                                "rewrite_check", "export_rows", "append_batches", "melt_curves", "melt_source_attributes", "extract_code_table", "file_digests", "manifest_check",
                                                "indexed_counts", "indexed_members"}]  # these write first


@pytest.mark.parametrize("name", LAZY)
def test_no_cross_join_and_no_python(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "MapInPandas" not in text and "MapInArrow" not in text


def test_filters_and_columns_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "attributes")
    literal_frame(spark, [("a", "shape", "hip", "x")], "curve_id string, key string, value string, other string").write.parquet(path)
    curves = literal_frame(spark, [("a",)], "curve_id string")
    text = plan(fl.attribute_filter(curves, spark.read.parquet(path), [("shape", "hip"), ("deck", "6d")]))
    assert "PushedFilters: [Or(And(EqualTo(key,shape),EqualTo(value,hip)),And(EqualTo(key,deck),EqualTo(value,6d)))" in text
    assert "ReadSchema: struct<curve_id:string,key:string,value:string>" in text


def test_lookup_reads_only_its_columns(spark):
    text = plan(entry.queries()["average_curve"](spark, SF))
    assert "l_extendedprice" not in text and "l_shipdate" not in text


def test_first_of_a_hot_key_is_chosen_before_the_shuffle(spark):
    rows = spark.range(10).selectExpr("id % 2 AS k", "id AS v")
    text = plan(reshape.dedup_first(rows, ["k"], ["v"]))
    assert "row_number(), 1, Partial" in text and text.index("row_number(), 1, Final") < text.index("row_number(), 1, Partial")


def test_profile_shuffles_distinct_values_once(spark):
    df = audit.profile_table(spark.read.parquet(f"{SF}/orders.parquet"), ["o_orderstatus", "o_orderpriority"])
    df.collect()
    assert "ReusedExchange" in plan(df)


def test_widened_points_shuffle_once_and_combine_first(spark):
    points = spark.range(10).selectExpr("CAST(id AS string) AS curve_id", "CAST(id % 3 AS double) AS x", "1.0D AS y")
    text = plan(reshape.widen_points(points, [0.0, 1.0, 2.0]))
    assert text.count("Exchange") == 1 and "partial_max" in text and "ObjectHashAggregate" not in text


def test_literal_frames_are_broadcast(spark):
    lines = spark.read.parquet(f"{SF}/lineitem.parquet")
    assert "BroadcastHashJoin" in plan(fl.classify(lines, "l_linenumber"))


def test_bucketed_tables_join_without_a_shuffle(spark):
    from curveloom.operators.lookup import curve_points_join
    from curveloom.sources.writers import save_bucketed

    spark.sql("CREATE DATABASE IF NOT EXISTS bucketed")
    points = spark.range(40).selectExpr("CAST(id % 10 AS string) AS curve_id", "CAST(id DIV 10 AS double) AS x", "1.0D AS y")
    curves = spark.range(10).selectExpr("CAST(id AS string) AS curve_id", "'fl' AS peril", "'6.1' AS version", "'structure' AS damage_type",
                                        "'f' AS source_file", "'t' AS source_table", "CAST(id AS string) AS source_row_id")
    save_bucketed({"curve_points": points, "curves": curves}, "bucketed", 4)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = curve_points_join(spark.table("bucketed.curve_points"), spark.table("bucketed.curves"), ["damage_type"])
        assert "SortMergeJoin" in plan(joined) and "Exchange" not in plan(joined) and joined.count() == 40
        assert "Exchange" not in plan(reshape.widen_points(spark.table("bucketed.curve_points"), [0.0, 1.0]))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


SKEW = {
    "spark.sql.shuffle.partitions": "32",
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "64KB",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1KB",
}


@pytest.fixture
def tiny_partitions(spark):
    for key, value in SKEW.items():
        spark.conf.set(key, value)
    yield
    for key in SKEW:
        spark.conf.unset(key)
    spark.conf.set("spark.sql.shuffle.partitions", "8")


def hot(n: int) -> str:
    """A third of the rows share one key."""
    return f"IF(id % 3 = 0, 'c0', concat('c', CAST(id % {n} AS string)))"


def test_hot_curve_is_split_in_the_evaluation_join(spark, tiny_partitions):
    from curveloom.operators.evaluate import evaluate

    points = spark.range(3000).selectExpr("concat('c', CAST(id % 1000 AS string)) AS curve_id", "CAST(id DIV 1000 AS double) AS x", "CAST(id AS double) AS y")
    exposures = spark.range(0, 200000, 1, 8).selectExpr("id AS exposure_id", f"{hot(1000)} AS curve_id", "CAST(id % 5 AS double) / 2 AS x")
    for grid in ([0.0, 1.0, 2.0], None):
        out = evaluate(exposures, points, grid)
        assert out.count() == 200000
        by_status = {r["status"]: r["count"] for r in out.groupBy("status").count().collect()}
        assert by_status == {"ok": 200000}
    packed = evaluate(exposures, points, [0.0, 1.0, 2.0])
    packed.collect()
    assert "SortMergeJoin(skew=true)" in plan(packed)


def test_hot_sibling_key_is_spread(spark, tiny_partitions):
    from curveloom.operators.duplicates import sibling_compare
    from curveloom.operators.skew import spread

    packed = spark.range(0, 150000, 1, 8).selectExpr(
        "CAST(id AS string) AS curve_id", f"{hot(500)} AS k", "IF(id % 2 = 0, '1', '2') AS level", "array(CAST(id % 11 AS double)) AS ys")
    verdict = sibling_compare(packed, ["k"], "level", "1", ["2"])
    assert len(verdict.collect()) == 75000
    assert plan(verdict).count("_salt") > 2
    salts = [r["count"] for r in spread(packed.where("k = 'c0'"), ["curve_id"], 8).groupBy("_salt").count().collect()]
    assert len(salts) == 8 and max(salts) < sum(salts) / 6


def test_hot_key_groups_are_combined_before_the_shuffle(spark):
    """Aggregates over a hot curve id ship one row per task, not its points."""
    from curveloom.operators import contracts, diff

    points = spark.range(0, 90000, 1, 8).selectExpr(f"{hot(300)} AS curve_id", "CAST(id % 3 AS double) AS x", "CAST(id AS double) AS y")
    for df in (contracts.grid_completeness(points, [0.0, 1.0, 2.0]), reshape.widen_points(points, [0.0, 1.0, 2.0]),
               diff.diff_curves(points, points, [0.0, 1.0, 2.0])):
        text = plan(df)
        assert text.count("Exchange") == 1 and "HashAggregate" in text.split("Exchange")[1]
