"""Assembled curves: points, attributes and units of a set of ids in one row each."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from curveloom.operators.reshape import attributes_map, pack_curve, pack_pairs, widen_points


def curve_points_join(points: DataFrame, curves: DataFrame, columns: list[str]) -> DataFrame:
    """Points with provenance columns of their curve."""
    return points.join(curves.select("curve_id", *columns), "curve_id")


def order_points(points: DataFrame) -> DataFrame:
    return points.orderBy("curve_id", "x")


def pack_mixed(points: DataFrame, curves: DataFrame, grids: dict[tuple[str, str], list[float]]) -> DataFrame:
    """(curve_id, points) of curves whose grid depends on peril and damage type.

    Points are combined on all grid values together, in buffers of that fixed size; a curve then keeps
    the values of its own grid.
    """
    every = sorted({float(g) for grid in grids.values() for g in grid})
    wide = widen_points(points, every).join(curves.select("curve_id", "peril", "damage_type"), "curve_id")
    message = F.concat(F.lit("curve is not sampled once per grid value: "), F.col("curve_id"))
    found = F.raise_error(message).cast("array<struct<x:double,y:double>>")
    for (peril, damage_type), grid in grids.items():
        own = sorted(float(g) for g in grid)
        pairs = F.array(*[F.struct(F.lit(g).alias("x"), F.col(f"y_{every.index(g)}").alias("y")) for g in own])
        seen = sum((F.when(F.col(f"has_{every.index(g)}"), 1).otherwise(0) for g in own), F.lit(0))
        whole = (F.col("n_off_grid") == 0) & (F.col("n_points") == len(own)) & (seen == len(own))
        found = F.when((F.col("peril") == peril) & (F.col("damage_type") == damage_type) & whole, pairs).otherwise(found)
    return wide.select("curve_id", found.alias("points"))


def get_curve(
    curves: DataFrame,
    points: DataFrame,
    attributes: DataFrame,
    kinds: DataFrame,
    ids: DataFrame,
    grid: list[float] | dict[tuple[str, str], list[float]],
    strict: bool = False,
) -> DataFrame:
    """One row per requested id: metadata, ``points`` array, ``attributes`` map and ``kind`` struct.

    ``grid`` is that of all curves, or one per (peril, damage_type), so that one call takes curves of any
    mix of them.  A curve that is not sampled once per value of its grid stops the job.

    ``found`` is false for an id that does not exist; ``strict`` fails the job instead.
    """
    wanted = ids.select("curve_id").distinct()
    kind = kinds.select("peril", "damage_type", F.struct(*[c for c in kinds.columns if c not in ("peril", "damage_type")]).alias("kind"))
    asked = points.join(wanted, "curve_id", "left_semi")
    if isinstance(grid, dict):
        packed = pack_mixed(asked, curves, grid)
    else:
        packed = pack_pairs(pack_curve(asked, grid), grid)
    keyed = attributes_map(attributes.join(wanted, "curve_id", "left_semi"))
    out = (
        wanted.join(curves.withColumn("found", F.lit(True)), "curve_id", "left")
        .join(packed, "curve_id", "left")
        .join(keyed, "curve_id", "left")
        .join(kind, ["peril", "damage_type"], "left")
        .withColumn("found", F.coalesce("found", F.lit(False)))
    )
    if strict:
        message = F.concat(F.lit("no such curve: "), F.col("curve_id"))
        out = out.where(F.when(F.col("found"), True).otherwise(F.raise_error(message).cast("boolean")))
    return out
