"""Detection of curves that equal their base-level sibling (for example the 1-storey curve)."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from curveloom.fixed_values import DIFFERS, IDENTICAL
from curveloom.operators.skew import salted_join


def sibling_compare(
    packed: DataFrame, keys: list[str], level: str, base: str, others: list[str]
) -> DataFrame:
    """(curve_id, is_duplicate, had_counterpart) for every curve of the other levels.

    ``packed`` has curve_id, the key columns, the level column and ``ys``.  A curve is a duplicate
    when some base curve with equal keys has equal values, NULLs included.  The base side is
    reduced to distinct (keys, ys) and distinct keys, so both joins match at most one row however
    many base curves share a key.  A key or a group of copies with very many curves is spread by a
    salt.  A NULL key never matches.
    """
    base_rows = packed.where(F.col(level) == base).select(*keys, "ys").distinct()
    base_keys = base_rows.select(*keys).distinct().withColumn("_has", F.lit(True))
    multi = packed.where(F.col(level).isin(*others)).select("curve_id", *keys, "ys")
    keyed = salted_join(multi, base_keys, keys, ["curve_id"])
    same = base_rows.withColumn("_same", F.lit(True))
    return salted_join(keyed, same, [*keys, "ys"], ["curve_id"]).select(
        "curve_id",
        F.coalesce("_same", F.lit(False)).alias("is_duplicate"),
        F.coalesce("_has", F.lit(False)).alias("had_counterpart"),
    )


def apply_verdict(curves: DataFrame, verdict: DataFrame) -> DataFrame:
    """Curves with ``defect_verified`` set where a verdict exists."""
    marked = verdict.select("curve_id", "is_duplicate")
    label = F.when(F.col("is_duplicate"), IDENTICAL).when(~F.col("is_duplicate"), DIFFERS)
    return (
        curves.drop("defect_verified")
        .join(marked, "curve_id", "left")
        .withColumn("defect_verified", label)
        .drop("is_duplicate")
    )


def duplicate_summary(verdict: DataFrame, curves: DataFrame, by: str) -> DataFrame:
    """Per type: compared curves, duplicates, curves without counterpart, and the duplicate share."""
    typed = verdict.join(curves.select("curve_id", by), "curve_id")
    return typed.groupBy(by).agg(
        F.count(F.lit(1)).alias("n_curves"),
        F.count_if("is_duplicate").alias("n_duplicate"),
        F.count_if(~F.col("had_counterpart")).alias("n_no_counterpart"),
        (F.count_if("is_duplicate") * 100.0 / F.count(F.lit(1))).alias("share_pct"),
    )
