"""Checks that a table keeps its column, grid, key, range and reference contracts.

Column and grid contracts look at the schema only.  The data checks are single aggregates with
fixed-size buffers, so a key holding a large share of the rows is combined before the shuffle.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from curveloom.functions.axis import measure_columns
from curveloom.functions.literal import literal_frame

BITS = 62  # grid positions held by one long mask


def _roles(columns: list[str], roles: dict[str, str], ignored: dict[str, str] | None) -> list[tuple[str, str]]:
    ignored = ignored or {}
    measures = measure_columns(columns)
    rows, unknown = [], []
    for name in columns:
        if name in measures:
            rows.append((name, "measure"))
        elif name in roles:
            rows.append((name, roles[name]))
        elif name in ignored:
            rows.append((name, f"ignored: {ignored[name]}"))
        else:
            unknown.append(name)
    if unknown:
        raise ValueError(f"columns {unknown} are neither measures, nor mapped, nor ignored with a reason")
    return rows


def column_accounting(
    df: DataFrame, roles: dict[str, str], ignored: dict[str, str] | None = None
) -> DataFrame:
    """(column_name, role) for every source column; fails if one is not accounted for."""
    return literal_frame(df.sparkSession, _roles(df.columns, roles, ignored), "column_name string, role string")


def column_usage(df: DataFrame, roles: dict[str, str], ignored: dict[str, str] | None = None) -> DataFrame:
    """``column_accounting`` with n_rows and n_null of each column, counted in one pass without a row shuffle."""
    cells = [
        F.struct(
            F.lit(name).alias("column_name"), F.lit(role).alias("role"), F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col("`" + name.replace("`", "``") + "`").isNull()).alias("n_null"),
        )
        for name, role in _roles(df.columns, roles, ignored)
    ]
    return df.agg(F.array(*cells).alias("cells")).select(F.inline("cells"))


def grid_contract(columns: list[str], grid: list[float]) -> dict[str, float]:
    """Measure columns with their x; fails unless the x values are exactly the grid."""
    measures = measure_columns(columns)
    found = list(measures.values())
    if found != sorted(grid):
        raise ValueError(f"grid has {len(found)} points {found[:3]}..{found[-3:]}, expected {sorted(grid)}")
    return measures


def grid_bit(x: Column, grid: list[float]) -> list[Column]:
    """Bit of x inside each mask; NULL in a mask that does not hold it."""
    position = F.array_position(F.array(*[F.lit(float(g)) for g in grid]), x)
    masks = []
    for start in range(0, len(grid), BITS):
        inside = (position > start) & (position <= start + BITS)
        shift = (position - start - 1).cast("int")
        masks.append(F.when(inside, F.call_function("shiftleft", F.lit(1).cast("bigint"), shift)))
    return masks


def grid_completeness(points: DataFrame, grid: list[float]) -> DataFrame:
    """Curves whose points are not exactly one per grid value."""
    grid = sorted(float(g) for g in grid)
    bits = grid_bit(F.col("x"), grid)
    on_grid = F.coalesce(*bits).isNotNull()
    covered = reduce(
        lambda a, b: a + b,
        [F.bit_count(F.coalesce(F.bit_or(b), F.lit(0).cast("bigint"))).cast("bigint") for b in bits],
    )
    per_curve = points.groupBy("curve_id").agg(
        F.count(F.lit(1)).alias("n_points"),
        covered.alias("n_grid_values"),
        F.count_if(~on_grid).alias("n_off_grid"),
    )
    complete = (F.col("n_points") == len(grid)) & (F.col("n_grid_values") == len(grid))
    return per_curve.where(~complete)


def expected_points(points: DataFrame, curves: DataFrame, n_grid: int) -> DataFrame:
    """Total points against curves × grid size."""
    n_points = points.agg(F.count(F.lit(1)).alias("n_points"))
    n_curves = curves.agg(F.count(F.lit(1)).alias("n_curves")).select("n_curves").scalar()
    return n_points.select(
        "n_points", (n_curves * n_grid).alias("n_expected"), (F.col("n_points") == n_curves * n_grid).alias("ok")
    )


def dangling_refs(refs: DataFrame, curves: DataFrame, strict: bool = False) -> DataFrame:
    """References to curves that do not exist.  ``strict`` fails the job when there is one."""
    if strict:
        return require_known(refs, curves, keep=False)
    return refs.join(curves.select("curve_id"), "curve_id", "left_anti")


def require_known(refs: DataFrame, curves: DataFrame, keep: bool = True) -> DataFrame:
    """``refs`` unchanged (none of it without ``keep``), or a failed job when one names no curve.

    The test reads both sides of the join, so it cannot be moved below it to rows that are fine.
    """
    known = curves.select("curve_id", F.lit(True).alias("_known"))
    message = F.concat(F.lit("reference to a curve that does not exist: "), F.col("curve_id"))
    test = F.when(F.col("_known"), keep).otherwise(F.raise_error(message).cast("boolean"))
    return refs.join(known, "curve_id", "left").where(test).drop("_known")


def kind_coverage(curves: DataFrame, kinds: DataFrame) -> DataFrame:
    """(peril, damage_type) pairs in use that have no units row."""
    used = curves.select("peril", "damage_type").distinct()
    return used.join(kinds, ["peril", "damage_type"], "left_anti")


def out_of_range(points: DataFrame, curves: DataFrame, limits: DataFrame) -> DataFrame:
    """Per damage type, how many values leave [low, high] and how far; nothing is clamped.

    ``limits`` has one row per damage type (damage_type, low, high); a NULL bound is open.
    """
    typed = points.where("y IS NOT NULL").join(curves.select("curve_id", "damage_type"), "curve_id")
    return (
        typed.join(limits, "damage_type")
        .where("y < low OR y > high")
        .groupBy("damage_type")
        .agg(
            F.count_if(F.col("y") < F.col("low")).alias("n_below"),
            F.count_if(F.col("y") > F.col("high")).alias("n_above"),
            F.min("y").alias("min_y"),
            F.max("y").alias("max_y"),
        )
    )


def limits_frame(spark: SparkSession, limits: list[tuple[str, float | None, float | None]]) -> DataFrame:
    return literal_frame(spark, limits, "damage_type string, low double, high double")
