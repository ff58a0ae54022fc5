"""A paged index of a curve library: the points of a curve in pages, and pages over pages for long curves.

A curve with any x values and any number of points is found by a few joins on equal keys, each of which
meets one row: the page that a level names is searched for x, and names the page of the next level.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from curveloom.operators.skew import salted_join
from curveloom.sources.writers import materialize

#: points of a page, and pages below an entry: a power of two
PAGE_POINTS = 1_024


@dataclass(frozen=True)
class CurvePages:
    """``leaves``: curve_id, page, xs, ys (with the first point of the next page at their ends), low, high of the curve.

    ``upper`` holds the levels above, the top one last: curve_id, page, firsts (the first x of each page below), low,
    high.  On the top level every curve is one page.
    """

    leaves: DataFrame
    upper: list[DataFrame]
    size: int


def curve_pages(points: DataFrame, size: int = PAGE_POINTS) -> CurvePages:
    """Pages of at most ``size`` points (curve_id, x, y), written once to the shared folder.

    A range sort by curve and x spreads a curve of any length over many tasks.  Only the first and last x of
    each page, not the points, are numbered per curve.  A curve holds one row per x; rows without x are left out.
    """
    bits = size.bit_length() - 1
    if size != 1 << bits or size < 2:
        raise ValueError("the page size must be a power of two")
    placed = (
        points.where("x IS NOT NULL").select("curve_id", "x", "y")
        .repartitionByRange("curve_id", "x").sortWithinPartitions("curve_id", "x")
        .withColumn("_block", F.shiftrightunsigned(F.monotonically_increasing_id(), bits))
    )
    held = placed.groupBy("curve_id", "_block").agg(F.sort_array(F.collect_list(F.struct("x", "y"))).alias("p"))  # size points at most
    held = materialize(held, "curve-pages")
    ordered = Window.partitionBy("curve_id").orderBy("_block")
    every = Window.partitionBy("curve_id")
    ends = held.select("curve_id", "_block", F.get("p", F.lit(0)).alias("_first"), F.element_at("p", -1)["x"].alias("_last"))
    numbered = materialize(
        ends.select(
            "curve_id", "_block", (F.row_number().over(ordered) - 1).cast("long").alias("page"), F.col("_first.x").alias("first"),
            F.lead("_first").over(ordered).alias("_next"), F.min("_first.x").over(every).alias("low"), F.max("_last").over(every).alias("high"),
        ),
        "page-ends",
    )
    whole = F.concat("p", F.when(F.col("_next").isNotNull(), F.array("_next")).otherwise(F.slice("p", 1, 0)))
    leaves = held.join(numbered, ["curve_id", "_block"]).withColumn("p", whole).select(
        "curve_id", "page", F.col("p.x").alias("xs"), F.col("p.y").alias("ys"), "low", "high"
    )
    leaves = materialize(leaves, "curve-leaves")
    upper, below, most = [], numbered, (numbered.agg(F.max("page")).first()[0] or 0) + 1
    while most > 1:
        above = below.groupBy("curve_id", F.shiftright("page", bits).alias("up")).agg(
            F.transform(F.sort_array(F.collect_list(F.struct("page", "first"))), lambda e: e["first"]).alias("firsts"),
            F.first("low").alias("low"), F.first("high").alias("high"),
        )
        above = materialize(above.withColumnRenamed("up", "page"), "page-level")
        upper.append(above)
        below, most = above.withColumn("first", F.get("firsts", F.lit(0))), -(-most // size)
    return CurvePages(leaves, upper, size)


def last_at_most(values: Column, x: Column, size: int) -> Column:
    """Position of the last of at most ``size`` ascending values that is not above x, by halving; the first must not be."""
    steps = F.array(*(F.lit(1 << b) for b in reversed(range(size.bit_length()))))
    return F.aggregate(steps, F.lit(0), lambda at, step: F.when(F.get(values, at + step) <= x, at + step).otherwise(at))


def locate(exposures: DataFrame, pages: CurvePages) -> DataFrame:
    """Every exposure with the segment that holds x: ``_exists``, ``_inside``, ``_x0``, ``_y0``, ``_x1``, ``_y1``.

    One row per exposure, whatever the number of points: each level is one join on equal keys.
    """
    by, x, at_top = exposures.columns, F.col("x"), True
    found = exposures
    shown = ["_exists", "_inside"]

    def enter(df: DataFrame) -> DataFrame:
        inside = F.coalesce(x.between(F.col("low"), F.col("high")), F.lit(False))  # a missing x is outside every domain
        return df.withColumns({"_exists": F.col("low").isNotNull(), "_inside": inside & ~F.isnan(x)})

    for level in reversed(pages.upper):
        if at_top:
            found = enter(salted_join(found, level.where("page = 0").drop("page"), ["curve_id"], by, salt=1)).withColumn("_page", F.lit(0).cast("long"))
        else:
            found = salted_join(found, level.select("curve_id", F.col("page").alias("_page"), "firsts"), ["curve_id", "_page"], by, salt=1)
        below = F.col("_page") * pages.size + last_at_most(F.col("firsts"), x, pages.size)
        found = found.select(*by, *shown, F.when(F.col("_inside"), below).alias("_page"))
        at_top = False
    if at_top:
        found = enter(salted_join(found, pages.leaves.drop("page"), ["curve_id"], by, salt=1))
    else:
        leaves = pages.leaves.select("curve_id", F.col("page").alias("_page"), "xs", "ys")
        found = salted_join(found, leaves, ["curve_id", "_page"], by, salt=1)
    found = found.withColumn("_at", F.when(F.col("_inside"), last_at_most(F.col("xs"), x, 2 * pages.size)))
    point = lambda values, step: F.get(values, F.col("_at") + step)
    return found.select(
        *by, *shown, point("xs", 0).alias("_x0"), point("ys", 0).alias("_y0"), point("xs", 1).alias("_x1"), point("ys", 1).alias("_y1")
    )
