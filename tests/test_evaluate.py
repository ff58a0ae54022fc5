from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from curveloom.functions.literal import literal_frame
from curveloom.operators.evaluate import evaluate, evaluate_strict, evaluate_wide, segment_join
from curveloom.operators.pages import curve_pages
from curveloom.operators.reshape import widen_points

BASE = [(0.0, 10.0), (5.0, 20.0), (10.0, 30.0)]
CURVES = {
    "base": BASE,
    "hole": [(0.0, 10.0), (5.0, None), (10.0, 30.0)],
    "left": [(0.0, None), (5.0, 20.0), (10.0, 30.0)],
    "ends": [(0.0, None), (5.0, 20.0), (10.0, None)],
}
CASES = [
    ("base", 0.0, 10.0, "ok"), ("base", 5.0, 20.0, "ok"), ("base", 10.0, 30.0, "ok"),
    ("base", 2.5, 15.0, "ok"), ("base", 1.25, 12.5, "ok"),
    ("base", -0.001, None, "outside_domain"), ("base", 10.001, None, "outside_domain"),
    ("base", -100.0, None, "outside_domain"), ("base", 1000.0, None, "outside_domain"),
    ("base", float("nan"), None, "outside_domain"), ("base", None, None, "outside_domain"),
    ("hole", 5.0, None, "no_published_value"), ("hole", 2.5, None, "gap"), ("hole", 7.5, None, "gap"),
    ("left", 2.5, None, "gap"), ("left", 0.0, None, "no_published_value"), ("left", 7.5, 25.0, "ok"),
    ("ends", 5.0, 20.0, "ok"), ("nobody", 3.0, None, "no_such_curve"),
]
FORMS = {
    "packed": dict(grid=[0.0, 5.0, 10.0]),
    "segments": dict(),
    "buckets": dict(bucket_width=1.5),
    "one bucket": dict(bucket_width=100.0),
}


def library(spark, curves=CURVES):
    return literal_frame(spark, [(c, x, y) for c, points in curves.items() for x, y in points], "curve_id string, x double, y double")


@pytest.mark.parametrize("form", list(FORMS))
def test_every_status(spark, form):
    exposures = literal_frame(spark, [(i, c, x) for i, (c, x, _, _) in enumerate(CASES)], "exposure_id int, curve_id string, x double")
    rows = evaluate(exposures, library(spark), **FORMS[form]).collect()
    assert len(rows) == len(CASES)
    got = {r["exposure_id"]: (r["y"], r["status"]) for r in rows}
    assert got == {i: (y, status) for i, (_, _, y, status) in enumerate(CASES)}


def test_wide_library(spark):
    wide = literal_frame(spark, [("a", 18.0, 22.0), ("b", None, 4.0)], "curve_id string, p0 double, p1 double")
    exposures = literal_frame(spark, [("a", 0.5), ("a", 1.0), ("b", 1.0), ("b", 0.5)], "curve_id string, x double")
    got = [(r["curve_id"], r["x"], r["y"], r["status"]) for r in evaluate_wide(exposures, wide).orderBy("curve_id", "x").collect()]
    assert got == [("a", 0.5, 20.0, "ok"), ("a", 1.0, 22.0, "ok"), ("b", 0.5, None, "gap"), ("b", 1.0, 4.0, "ok")]


def test_strict_stops(spark):
    exposures = literal_frame(spark, [("hole", 2.5)], "curve_id string, x double")
    with pytest.raises(Exception, match="cannot evaluate curve hole at x = 2.5 : gap"):
        evaluate_strict(exposures, library(spark)).collect()
    with pytest.raises(Exception, match="cannot evaluate"):
        evaluate_strict(exposures, library(spark), [0.0, 5.0, 10.0]).count()


def test_curve_off_the_grid_stops(spark):
    exposures = literal_frame(spark, [("base", 2.5)], "curve_id string, x double")
    with pytest.raises(Exception, match="not sampled once per grid value: base"):
        evaluate(exposures, library(spark), grid=[0.0, 5.0]).collect()


def test_irregular_curves_equal_brute_force(spark):
    """Random curves with uneven x values, a hot curve with most exposures, compared point by point."""
    rng = random.Random(7)
    curves = {}
    for c in range(12):
        xs = sorted(rng.sample(range(-40, 90), rng.randint(2, 25)))
        curves[f"c{c}"] = [(x / 4, None if rng.random() < 0.2 else rng.randint(0, 100) / 1.0) for x in xs]
    asked = [("c3" if rng.random() < 0.6 else f"c{rng.randint(0, 13)}", rng.randint(-180, 400) / 16) for _ in range(800)]

    def expected(curve, x):
        points = curves.get(curve)
        if points is None:
            return None, "no_such_curve"
        if not points[0][0] <= x <= points[-1][0]:
            return None, "outside_domain"
        for (x0, y0), (x1, y1) in zip(points, points[1:] + [(None, None)]):
            if x == x0:
                return (y0, "ok") if y0 is not None else (None, "no_published_value")
            if x1 is not None and x0 < x < x1:
                if y0 is None or y1 is None:
                    return None, "gap"
                return y0 + (y1 - y0) * (x - x0) / (x1 - x0), "ok"

    exposures = literal_frame(spark, [(i, c, x) for i, (c, x) in enumerate(asked)], "exposure_id int, curve_id string, x double")
    want = {i: expected(c, x) for i, (c, x) in enumerate(asked)}
    forms = [dict(bucket_width=w) for w in (None, 0.7, 3.0)]
    forms += [dict(pages=curve_pages(library(spark, curves), size)) for size in (2, 8)]
    for form in forms:
        rows = evaluate(exposures, library(spark, curves), **form).collect()
        assert {r["exposure_id"]: (r["y"], r["status"]) for r in rows} == want and len(rows) == len(asked)


def test_published_values_are_read_back(spark):
    points = library(spark).where("y IS NOT NULL")
    back = evaluate_strict(points.select("curve_id", "x", F.col("y").alias("published")), library(spark))
    assert back.where("y != published").count() == 0


def test_segments_cover_each_exposure_once(spark):
    exposures = literal_frame(spark, [("base", 5.0), ("base", 4.0)], "curve_id string, x double")
    assert segment_join(exposures, library(spark)).count() == 2


def test_widen_counts_points_off_the_grid(spark):
    row = widen_points(library(spark, {"a": BASE}), [0.0, 5.0]).first()
    assert (row["n_points"], row["n_off_grid"], row["y_0"], row["y_1"]) == (3, 1, 10.0, 20.0)


def test_a_curve_of_a_million_points(spark):
    """A hot curve far beyond a page beside short ones: three levels, one row per exposure, no segment is missed."""
    long = spark.range(1_000_000).select(
        F.lit("long").alias("curve_id"), (F.col("id") / 4 + F.when(F.col("id") % 3 == 0, 0.125).otherwise(0.0)).alias("x"),
        F.when(F.col("id") % 1_000 != 7, (F.col("id") % 97).cast("double")).alias("y"))
    points = long.unionByName(library(spark)).repartition(6)
    pages = curve_pages(points)
    assert len(pages.upper) == 1 and pages.leaves.where(F.size("xs") > 1_025).count() == 0
    assert pages.leaves.groupBy("curve_id").count().where("curve_id != 'long' AND count > 2").count() == 0
    exposures = spark.range(40_000).select(
        F.col("id").alias("exposure_id"), F.lit("long").alias("curve_id"), (F.col("id") * 25 % 1_000_003 / 4 + 0.0625).alias("x"))
    got = evaluate(exposures, points, pages=pages).collect()
    assert len(got) == 40_000

    def at(i):
        return i / 4 + (0.125 if i % 3 == 0 else 0.0), None if i % 1_000 == 7 else float(i % 97)

    for row in got:
        i = min(int(row["x"] * 4), 999_999)
        while i >= 0 and at(i)[0] > row["x"]:
            i -= 1
        if i < 0 or row["x"] > at(999_999)[0]:
            assert (row["y"], row["status"]) == (None, "outside_domain")
            continue
        (x0, y0), (x1, y1) = at(i), at(i + 1)
        if y0 is None or y1 is None:
            assert row["y"] is None and row["status"] in ("gap", "no_published_value")
        else:
            assert row["status"] == "ok" and row["y"] == y0 + (y1 - y0) * (row["x"] - x0) / (x1 - x0)


def test_pages_of_odd_libraries(spark):
    """An empty library, a curve of one NULL point, unknown and NULL curves."""
    empty = library(spark).where("false")
    exposures = literal_frame(
        spark, [("a", 1.0), ("a", 2.0), ("b", 1.0), (None, 1.0)], "curve_id string, x double")
    assert [r["status"] for r in evaluate(exposures, empty).collect()] == ["no_such_curve"] * 4
    one = library(spark, {"a": [(1.0, None)]})
    got = {(r["curve_id"], r["x"]): r["status"] for r in evaluate(exposures, one).collect()}
    assert got == {("a", 1.0): "no_published_value", ("a", 2.0): "outside_domain", ("b", 1.0): "no_such_curve", (None, 1.0): "no_such_curve"}
