"""Counts, guards and averages over selected curves."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from curveloom.fixed_values import IDENTICAL

PAGE_IDS = 1_000  # ids of a group that share a cell of constituent_lists


def inventory_counts(curves: DataFrame) -> DataFrame:
    return curves.groupBy("peril", "version", "damage_type").agg(F.count(F.lit(1)).alias("n"))


def totals(curves: DataFrame, points: DataFrame) -> DataFrame:
    """One row: curves, points, flagged curves."""
    n_points = points.agg(F.count(F.lit(1)).alias("n")).scalar()
    return curves.agg(
        F.count(F.lit(1)).alias("n_curves"), F.count("defect_flag").alias("n_flagged")
    ).select("n_curves", n_points.alias("n_points"), "n_flagged")


def count_matches(curves: DataFrame) -> DataFrame:
    """Matched curves; filters are semi joins, so a curve is never counted twice."""
    return curves.agg(F.count("curve_id").alias("n"))


def unit_guard(curves: DataFrame, kinds: DataFrame | None = None) -> DataFrame:
    """One row saying whether the curves may be averaged: ok, empty or heterogeneous.

    With ``kinds`` the units must agree too.
    """
    # curves are combined per (peril, damage type) first: a handful of rows meets the units
    few = curves.groupBy("peril", "damage_type").agg(F.count(F.lit(1)).alias("n"))
    if kinds is None:
        few = few.withColumn("y_units", F.lit("not checked"))
    else:
        few = few.join(kinds.select("peril", "damage_type", "y_units"), ["peril", "damage_type"], "left")
    counts = few.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_curves"),
        F.count_distinct("damage_type").alias("n_damage_types"),
        F.count_distinct(F.coalesce("y_units", F.lit("mixed"))).alias("n_units"),
    )
    status = (
        F.when(F.col("n_curves") == 0, "empty")
        .when((F.col("n_damage_types") > 1) | (F.col("n_units") > 1), "heterogeneous")
        .otherwise("ok")
    )
    return counts.withColumn("status", status)


def require_ok(guard: DataFrame) -> DataFrame:
    """The guard row, or a failed job when it refuses."""
    message = F.concat(
        F.lit("cannot average: the filters match "), F.col("n_damage_types").cast("string"), F.lit(" damage types")
    )
    refused = F.col("status") == "heterogeneous"
    return guard.withColumn("status", F.when(refused, F.raise_error(message).cast("string")).otherwise(F.col("status")))


def statistics() -> list[Column]:
    """Mean, population deviation, range and count of the non-NULL y."""
    return [
        F.avg("y").alias("y_mean"),
        F.stddev_pop("y").alias("y_std"),
        F.min("y").alias("y_min"),
        F.max("y").alias("y_max"),
        F.count("y").alias("n_at_x"),
    ]


def average_curve(points: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Mean, population deviation, range and count of the non-NULL y at every x.

    An x without values stays, with n_at_x 0 and NULL statistics.
    """
    return points.groupBy(*(by or []), "x").agg(*statistics())


def derived_id(by: list[str]) -> Column:
    """Name of a group of curves: its values joined with '/', a NULL as an empty part."""
    return F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by])


def constituents(curves: DataFrame, by: list[str]) -> DataFrame:
    """The curves behind each average, one row each, under the derived_id of ``derived_rows``."""
    return curves.select(derived_id(by).alias("derived_id"), *by, "curve_id")


def constituent_lists(curves: DataFrame, by: list[str], page_ids: int = PAGE_IDS) -> DataFrame:
    """Per group the number of constituents and all their ids, joined with '|', in pages.

    A hash of the id picks its page, so a page holds about ``page_ids`` ids however large the group.
    """
    ids = constituents(curves, by).drop("derived_id")
    sizes = ids.groupBy(*by).agg(F.count(F.lit(1)).alias("n_constituents"))
    key = F.conv(F.substring(F.md5("curve_id"), 1, 8), 16, 10).cast("long")
    paged = _same_group(ids, sizes, by).withColumn("page", key % F.ceil(F.col("n_constituents") / page_ids))
    return paged.groupBy(*by, "n_constituents", "page").agg(
        F.array_join(F.array_sort(F.collect_list("curve_id")), "|").alias("constituent_curve_ids")
    )


def _same_group(left: DataFrame, right: DataFrame, by: list[str]) -> DataFrame:
    """Inner join on ``by`` in which NULL equals NULL."""
    renamed = right.select(*[F.col(c).alias(f"_{c}") for c in by], *[c for c in right.columns if c not in by])
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in by]
    return left.join(renamed, same).drop(*[f"_{c}" for c in by])


def derived_rows(curves: DataFrame, points: DataFrame, by: list[str]) -> DataFrame:
    """Average rows labelled as derived, with the number of constituents, first source and a defect hint.

    ``derived_id`` finds the constituents of a row in ``constituents``.
    """
    typed = points.join(curves.select("curve_id", *by), "curve_id")
    facts = curves.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_constituents"),
        F.min_by("version", "curve_id").alias("version"),
        F.min_by("source_table", "curve_id").alias("source_table"),
        F.min_by("damage_type", "curve_id").alias("first_damage_type"),
        F.bool_or(F.col("defect_flag").isNotNull()).alias("any_defect"),
    )
    return _same_group(average_curve(typed, by), facts, by).select(
        F.lit("DERIVED").alias("curve_id"),
        F.lit("DERIVED — not a published curve").alias("label"),
        derived_id(by).alias("derived_id"),
        *by,
        "n_constituents",
        "x", "y_mean", "y_std", "y_min", "y_max", "n_at_x",
        "version",
        "source_table",
        *([] if "damage_type" in by else [F.col("first_damage_type").alias("damage_type")]),
        F.lit("multiple — see constituents").alias("source_agency"),
        F.when(F.col("any_defect"), "see constituent curves").otherwise("").alias("defect_flag"),
    )


def cases_per_territory(cases: DataFrame) -> DataFrame:
    return cases.groupBy("territory").agg(F.count(F.lit(1)).alias("n_cases"))


def multi_value_groups(df: DataFrame, keys: list[str]) -> DataFrame:
    """Groups with more than one row."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def defect_banner(curves: DataFrame) -> DataFrame:
    """How many matched curves are flagged, and how many of those are verified duplicates."""
    return curves.agg(
        F.count("defect_flag").alias("n_flagged"),
        F.count_if(F.col("defect_flag").isNotNull() & (F.col("defect_verified") == IDENTICAL)).alias("n_verified"),
    )


def any_true(df: DataFrame, keys: list[str], test: str, counted: str) -> DataFrame:
    """Per key: does ``test`` hold for some row, and is ``counted`` ever non-NULL."""
    return df.groupBy(*keys).agg(
        F.coalesce(F.bool_or(F.expr(test)), F.lit(False)).alias("any_match"),
        (F.count(counted) > 0).alias("has_counterpart"),
    )


def lut_census(lut: DataFrame, table_column: str, id_column: str, flags: dict[str, str]) -> DataFrame:
    """Per lookup table: rows, distinct curve ids, and rows per zone flag."""
    return lut.groupBy(table_column).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_distinct(id_column).alias("n_curve_ids"),
        *[F.count_if(F.col(c) == 1).alias(f"n_{zone.lower()}") for zone, c in flags.items()],
    )
