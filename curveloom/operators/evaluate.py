"""Piecewise-linear evaluation of exposures (curve_id, x) against a curve library.

Nothing is extrapolated and no gap is bridged: ``y`` is NULL unless ``status`` is ``ok``.
Statuses, in checking order: no_such_curve, outside_domain, no_published_value (x is a grid value
whose y is NULL), gap (a neighbour is NULL), ok.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from curveloom.functions.axis import measure_columns
from curveloom.operators.pages import CurvePages, curve_pages, locate
from curveloom.operators.reshape import pack_curve
from curveloom.operators.skew import salted_join


LIBRARY_SALT = 1  # no copies of the library: its own shuffle lets Spark split a hot curve's exposures


def _status(exists: Column, inside: Column, x: Column, x0: Column, y0: Column, y1: Column) -> Column:
    exact = x == x0
    return (
        F.when(~exists, "no_such_curve")
        .when(~inside, "outside_domain")
        .when(exact & y0.isNull(), "no_published_value")
        .when(exact, "ok")
        .when(y0.isNull() | y1.isNull(), "gap")
        .otherwise("ok")
    )


def _value(status: Column, x: Column, x0: Column, y0: Column, x1: Column, y1: Column) -> Column:
    line = y0 + (y1 - y0) * (x - x0) / (x1 - x0)
    return F.when((status == "ok") & (x == x0), y0).when(status == "ok", line)


def evaluate_packed(
    exposures: DataFrame, packed: DataFrame, grid: list[float], salt: int | None = LIBRARY_SALT
) -> DataFrame:
    """Evaluate against (curve_id, ys) rows that share one grid.

    The join is one library row per exposure, so it neither fans out nor ships a row per point;
    the neighbours are picked by counting grid values at or below x, inside generated code.
    ``salt`` None joins without one, for a broadcast library.
    """
    grid = sorted(float(g) for g in grid)
    library = packed.select("curve_id", "ys")
    if salt is None:
        joined = exposures.join(library, "curve_id", "left")
    else:
        joined = salted_join(exposures, library, ["curve_id"], exposures.columns, salt=salt)
    below = reduce(lambda a, b: a + b, [(F.col("x") >= g).cast("int") for g in grid])
    xs = F.array(*[F.lit(g) for g in grid])
    located = joined.withColumn("_k", below).select(
        *exposures.columns,
        F.col("ys").isNotNull().alias("_exists"),
        F.coalesce((F.col("x") >= grid[0]) & (F.col("x") <= grid[-1]), F.lit(False)).alias("_inside"),
        F.get(xs, F.col("_k") - 1).alias("_x0"),
        F.get(xs, F.col("_k")).alias("_x1"),
        F.get("ys", F.col("_k") - 1).alias("_y0"),
        F.get("ys", F.col("_k")).alias("_y1"),
    )
    return _finish(located, exposures.columns)


def _finish(located: DataFrame, columns: list[str]) -> DataFrame:
    x, x0, x1, y0, y1 = (F.col(c) for c in ("x", "_x0", "_x1", "_y0", "_y1"))
    marked = located.withColumn("status", _status(F.col("_exists"), F.col("_inside"), x, x0, y0, y1))
    return marked.select(*columns, _value(F.col("status"), x, x0, y0, x1, y1).alias("y"), "status")


def evaluate_wide(exposures: DataFrame, wide: DataFrame) -> DataFrame:
    """Evaluate against a wide library (curve_id plus measure columns) without melting it."""
    measures = measure_columns(wide.columns)
    packed = wide.select("curve_id", F.array(*[F.col(c).cast("double") for c in measures]).alias("ys"))
    return evaluate_packed(exposures, packed, list(measures.values()))


def segments(points: DataFrame) -> DataFrame:
    """Each point with the next one of its curve; a curve holds one row per x."""
    nxt = Window.partitionBy("curve_id").orderBy("x")
    return points.select(
        "curve_id",
        F.col("x").alias("_x0"),
        F.col("y").alias("_y0"),
        F.lead("x").over(nxt).alias("_x1"),
        F.lead("y").over(nxt).alias("_y1"),
    )


def segment_join(
    exposures: DataFrame, points: DataFrame, bucket_width: float | None = None, pages: CurvePages | None = None
) -> DataFrame:
    """Every exposure with the segment that holds x (``_x0, _y0, _x1, _y1``; NULL outside the domain),
    ``_exists`` (the curve is known) and ``_inside`` (x is in its domain).

    The library is packed into pages (``curve_pages``), and an exposure meets one page a level; pass
    ``pages`` to use an index that was built before.  ``bucket_width`` needs no index: a bucket of x joins the
    key, a segment is repeated in the buckets it crosses, and the result is the same.
    """
    if bucket_width is None:
        return locate(exposures, pages or curve_pages(points))
    domain = points.groupBy("curve_id").agg(F.min("x").alias("_low"), F.max("x").alias("_high"))
    seg = segments(points)
    x, x0, x1 = F.col("x"), F.col("_x0"), F.col("_x1")
    by = exposures.columns
    located = salted_join(exposures, domain, ["curve_id"], by, salt=LIBRARY_SALT).withColumns({
        "_exists": F.col("_low").isNotNull(),
        "_inside": F.coalesce(x.between(F.col("_low"), F.col("_high")), F.lit(False)),
    })

    def bucket(c: Column) -> Column:
        return F.floor(c / F.lit(float(bucket_width)))

    # outside the domain there is no segment, and x may be too large for a bucket number
    located = located.withColumn("_bucket", bucket(F.when(F.col("_inside"), x)))
    crossed = seg.withColumn("_bucket", F.explode(F.sequence(bucket(x0), bucket(F.coalesce(x1, x0)))))
    holds = (x == x0) | ((x > x0) & (x < x1))
    joined = salted_join(located, crossed, ["curve_id", "_bucket"], by, salt=LIBRARY_SALT, condition=holds)
    return joined.select(*by, "_exists", "_inside", "_x0", "_y0", "_x1", "_y1")


def evaluate(
    exposures: DataFrame,
    points: DataFrame,
    grid: list[float] | None = None,
    bucket_width: float | None = None,
    pages: CurvePages | None = None,
) -> DataFrame:
    """Exposures with ``y`` and ``status``; every exposure keeps exactly one row.

    With ``grid`` the library is packed to one row per curve (a curve that breaks the grid stops
    the job).  Without it curves may have any x values and number of points, and the segment join is used,
    over ``pages`` if an index of the library is given.
    Spark broadcasts a packed library that it measures to be small.
    """
    if grid is not None:
        return evaluate_packed(exposures, pack_curve(points, grid), grid)
    return _finish(segment_join(exposures, points, bucket_width, pages), exposures.columns)


def strict(evaluated: DataFrame) -> DataFrame:
    """Fail the job on the first exposure whose status is not ok."""
    message = F.concat_ws(
        " ", F.lit("cannot evaluate curve"), F.col("curve_id"), F.lit("at x ="), F.col("x").cast("string"), F.lit(":"), F.col("status")
    )
    # a filter, so that the check runs whichever columns are read afterwards
    return evaluated.where(F.when(F.col("status") == "ok", True).otherwise(F.raise_error(message).cast("boolean")))


def evaluate_strict(exposures: DataFrame, points: DataFrame, grid: list[float] | None = None) -> DataFrame:
    return strict(evaluate(exposures, points, grid))
