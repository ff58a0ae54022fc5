"""Version comparison, round-trip check and id set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from curveloom.functions.axis import measure_columns
from curveloom.operators.reshape import widen_points


def _change(in_old: Column, in_new: Column, differs: Column) -> Column:
    return (
        F.when(in_old & ~in_new, "removed")
        .when(~in_old & in_new, "added")
        .when(differs, "changed")
        .otherwise("same")
    )


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def diff_join(old: DataFrame, new: DataFrame) -> DataFrame:
    """Two versions of points matched on (curve_id, x): which side has the point, and both values."""
    left = old.select("curve_id", "x", F.col("y").alias("y_old"), F.lit(True).alias("in_old"))
    right = new.select("curve_id", "x", F.col("y").alias("y_new"), F.lit(True).alias("in_new"))
    return left.join(right, ["curve_id", "x"], "full_outer").withColumns(
        {c: F.coalesce(c, F.lit(False)) for c in ("in_old", "in_new")}
    )


def _by_x(df: DataFrame) -> dict[float, str]:
    """Measure column of each grid value."""
    return {x: c for c, x in measure_columns(df.columns).items()}


def diff_wide(old: DataFrame, new: DataFrame) -> DataFrame:
    """(curve_id, change) of two wide libraries, null-safe at every grid value of either.

    A grid value that only one of them has is a point the other lacks.  One row per curve is shuffled
    on each side.
    """
    left_x, right_x = _by_x(old), _by_x(new)
    shared = sorted(left_x.keys() & right_x.keys())
    left = old.select("curve_id", F.lit(True).alias("in_old"), *[F.col(left_x[x]).alias(f"old_{i}") for i, x in enumerate(shared)])
    right = new.select("curve_id", F.lit(True).alias("in_new"), *[F.col(right_x[x]).alias(f"new_{i}") for i, x in enumerate(shared)])
    tests = [~F.col(f"old_{i}").eqNullSafe(F.col(f"new_{i}")) for i in range(len(shared))]
    differs = _any([F.lit(left_x.keys() != right_x.keys()), *tests])
    both = left.join(right, "curve_id", "full_outer")
    in_old, in_new = (F.coalesce(c, F.lit(False)) for c in ("in_old", "in_new"))
    return both.select("curve_id", _change(in_old, in_new, differs).alias("change"))


def diff_curves(old: DataFrame, new: DataFrame, grid: list[float] | None = None) -> DataFrame:
    """(curve_id, change) of two long libraries: added, removed, changed or same.

    A curve is the same when both sides have the same rows (x, y), each as often; a missing point is
    not a NULL one.  Rows of both sides are tagged and each curve is combined before its one shuffle:
    sums of two row hashes, with opposite signs, cancel exactly when the rows agree.  With a grid a curve
    that leaves it stops the job.
    """
    tagged = old.select("curve_id", "x", "y", F.lit(0).alias("side")).unionByName(
        new.select("curve_id", "x", "y", F.lit(1).alias("side"))
    )
    sign = F.when(F.col("side") == 0, 1).otherwise(-1)
    row = (F.col("x"), F.col("y"), F.col("y").isNull())
    rests = [F.sum(h.cast("decimal(38,0)") * sign).alias(n) for h, n in ((F.xxhash64(*row), "rest_1"), (F.hash(*row), "rest_2"))]
    off = F.lit(0) if grid is None else F.count_if(~F.col("x").isin([float(v) for v in grid]))
    per_curve = tagged.groupBy("curve_id").agg(
        *[F.bool_or(F.col("side") == s).alias(name) for s, name in ((0, "in_old"), (1, "in_new"))], *rests, off.alias("n_off")
    )
    message = F.concat(F.lit("curve leaves the grid: "), F.col("curve_id"))
    differs = (F.col("rest_1") != 0) | (F.col("rest_2") != 0)
    change = F.when(F.col("n_off") > 0, F.raise_error(message).cast("string")).otherwise(
        _change(F.col("in_old"), F.col("in_new"), differs)
    )
    return per_curve.select("curve_id", change.alias("change"))


def diff_summary(diff: DataFrame, by: str) -> DataFrame:
    """Per ``by``: curves of both versions and how many were added, removed or changed."""
    return diff.groupBy(by).agg(
        F.count_if(F.col("change") != "added").alias("n_old"),
        F.count_if(F.col("change") != "removed").alias("n_new"),
        *[F.count_if(F.col("change") == c).alias(f"n_{c}") for c in ("added", "removed", "changed")],
    )


def corroborate(old: DataFrame, new: DataFrame) -> DataFrame:
    """One row: are two wide copies of a library the same, and how much was compared."""
    measures = len(_by_x(old).keys() | _by_x(new).keys())
    diff = diff_wide(old, new)
    common = F.count_if(F.col("change").isin("same", "changed"))
    discrepancies = F.count_if(F.col("change") != "same")
    return diff.agg(
        common.alias("n_curves"),
        (common * measures).alias("n_values"),
        discrepancies.alias("n_discrepancies"),
        (discrepancies == 0).alias("corroborated"),
    )


def roundtrip_check(wide: DataFrame, points: DataFrame) -> DataFrame:
    """Per measure column: cells of the source, and cells the re-widened points differ in.

    Two more rows count the points that are beyond one per cell (off the grid, or repeated) and those
    that are missing.
    """
    measures = measure_columns(wide.columns)
    back = widen_points(points, list(measures.values())).withColumnRenamed("curve_id", "_id")
    both = wide.select("curve_id", *measures).join(back, F.col("curve_id") == F.col("_id"), "full_outer")
    missing = F.col("curve_id").isNull() | F.col("_id").isNull()
    place = {x: i for i, x in enumerate(sorted(measures.values()))}
    stats = []
    for c, x in measures.items():
        stats.append(F.count_if(F.col("curve_id").isNotNull()).alias(f"n_{c}"))
        stats.append(F.count_if(missing | ~F.col(c).cast("double").eqNullSafe(F.col(f"y_{place[x]}"))).alias(f"d_{c}"))
    n_points, n_off = (F.coalesce(c, F.lit(0)) for c in ("n_points", "n_off_grid"))
    expected = F.when(F.col("curve_id").isNotNull(), len(measures)).otherwise(0)
    beyond = n_points - n_off - expected
    stats += [
        F.coalesce(F.sum(n_points), F.lit(0)).alias("n_extra"),
        F.coalesce(F.sum(n_off + F.greatest(beyond, F.lit(0))), F.lit(0)).alias("d_extra"),
        F.coalesce(F.sum(expected), F.lit(0)).cast("long").alias("n_missing"),
        F.coalesce(F.sum(F.greatest(-beyond, F.lit(0))), F.lit(0)).alias("d_missing"),
    ]
    totals = both.agg(*stats)
    names = [(c, c) for c in measures] + [("(extra points)", "extra"), ("(missing points)", "missing")]
    rows = [F.struct(F.lit(n).alias("column_name"), F.col(f"n_{c}").alias("n_cells"), F.col(f"d_{c}").alias("n_different")) for n, c in names]
    return totals.select(F.inline(F.array(*rows)))


def ids_added(old: DataFrame, new: DataFrame) -> DataFrame:
    return new.select("curve_id").distinct().join(old.select("curve_id").distinct(), "curve_id", "left_anti")


def ids_removed(old: DataFrame, new: DataFrame) -> DataFrame:
    return ids_added(new, old)


def ids_common(old: DataFrame, new: DataFrame) -> DataFrame:
    return old.select("curve_id").distinct().join(new.select("curve_id").distinct(), "curve_id", "left_semi")


def code_union(a: DataFrame, b: DataFrame, column: str = "code") -> DataFrame:
    return a.select(column).union(b.select(column)).distinct()
