"""Default-assignment rules and zone applicability from flag tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, functions as F

from curveloom.fixed_values import FINAL_ZONE_FLAGS, LOOKUP_ZONE_FLAGS
from curveloom.functions.text import clean_text, make_curve_id, normalise_id
from curveloom.operators.contracts import require_known
from curveloom.operators.filters import annotate_coastal
from curveloom.operators.reshape import dedup_first, flags_to_zones


def rules_crosswalk(assignments: DataFrame, crosswalk: DataFrame, key: str = "SOccupId") -> DataFrame:
    """Assignments with the occupancy facts of their class; unmatched ones stay."""
    return assignments.join(crosswalk, key, "left")


def _source_text(df: DataFrame, column: str):
    return clean_text(F.col(column).cast("string"), ("",)) if column in df.columns else F.lit(None).cast("string")


def rules_from_flags(
    assignments: DataFrame,
    crosswalk: DataFrame,
    *,
    version: str,
    damage_type: str,
    id_column: str,
    note: str,
    peril: str = "fl",
    flags: dict[str, str] = FINAL_ZONE_FLAGS,
    key: str = "SOccupId",
) -> DataFrame:
    """Rules of a vintage whose table has one row per occupancy class and one flag per zone."""
    joined = rules_crosswalk(assignments, crosswalk, key)
    rows = joined.select(
        normalise_id(F.col(key)).alias("class_id"),
        _source_text(joined, "Occupancy").alias("occupancy"),
        _source_text(joined, "NumStories").alias("stories"),
        _source_text(joined, "Basement").alias("basement"),
        normalise_id(F.col(id_column)).alias("fn_id"),
        "source_file",
        "source_table",
        *flags.values(),
    ).where("fn_id IS NOT NULL")
    ids = ["class_id", "occupancy", "stories", "basement", "fn_id", "source_file", "source_table"]
    return flags_to_zones(rows, flags, ids).select(
        make_curve_id(F.lit(peril), F.lit(version), F.lit(damage_type), "class_id", "flood_zone").alias("rule_id"),
        F.lit(peril).alias("peril"),
        F.lit(version).alias("version"),
        F.lit(damage_type).alias("damage_type"),
        "occupancy", "flood_zone", "stories", "basement",
        make_curve_id(F.lit(peril), F.lit(version), F.lit(damage_type), "fn_id").alias("curve_id"),
        "source_file", "source_table",
        annotate_coastal(F.col("flood_zone"), note).alias("notes"),
    )


def rules_from_lookup(
    lut: DataFrame, *, version: str, damage_type: str, zone: str, row_key: str, note: str, peril: str = "fl"
) -> DataFrame:
    """Rules of a vintage with one lookup file per zone; ``row_key`` numbers the rows of the file."""
    rows = lut.select(
        F.col(row_key).cast("string").alias("row_key"),
        _source_text(lut, "Occupancy").alias("occupancy"),
        _source_text(lut, "Stories").alias("stories"),
        _source_text(lut, "Basement").alias("basement"),
        normalise_id(F.col("DDF_ID")).alias("fn_id"),
        "source_file",
        "source_table",
    ).where("fn_id IS NOT NULL")
    return rows.select(
        make_curve_id(F.lit(peril), F.lit(version), F.lit(damage_type), F.lit(zone), "row_key").alias("rule_id"),
        F.lit(peril).alias("peril"),
        F.lit(version).alias("version"),
        F.lit(damage_type).alias("damage_type"),
        "occupancy",
        F.lit(zone).alias("flood_zone"),
        "stories", "basement",
        make_curve_id(F.lit(peril), F.lit(version), F.lit(damage_type), "fn_id").alias("curve_id"),
        "source_file", "source_table",
        annotate_coastal(F.lit(zone), note).alias("notes"),
    )


def assignment_rules(parts: list[DataFrame]) -> DataFrame:
    """Rules of all vintages, the first of each rule_id kept."""
    stacked = reduce(lambda a, b: a.unionByName(b), [p.withColumn("_part", F.lit(i)) for i, p in enumerate(parts)])
    return dedup_first(stacked, ["rule_id"], ["_part", "source_file", "curve_id", "occupancy", "stories", "basement"]).drop("_part")


def zone_rows(
    df: DataFrame, *, version: str, damage_type: str, id_column: str, flags: dict[str, str] = LOOKUP_ZONE_FLAGS, peril: str = "fl"
) -> DataFrame:
    """(curve_id, flood_zone) rows of one flag table."""
    rows = df.select(normalise_id(F.col(id_column)).alias("fn_id"), "source_file", "source_table", *flags.values())
    rows = rows.where("fn_id IS NOT NULL").withColumn(
        "curve_id", make_curve_id(F.lit(peril), F.lit(version), F.lit(damage_type), "fn_id")
    )
    zones = flags_to_zones(rows, flags, ["curve_id", "source_file", "source_table"])
    return zones.select("curve_id", "flood_zone", "source_file", "source_table")


def zone_applicability(parts: list[DataFrame], curves: DataFrame | None = None) -> DataFrame:
    """Zones each curve is flagged for, one row per (curve, zone).

    With ``curves`` the job fails when a row names a curve that does not exist.
    """
    stacked = reduce(lambda a, b: a.unionByName(b), [p.withColumn("_part", F.lit(i)) for i, p in enumerate(parts)])
    rows = dedup_first(stacked, ["curve_id", "flood_zone"], ["_part", "source_file", "source_table"]).drop("_part")
    return rows if curves is None else require_known(rows, curves)


def restrict_kinds(kinds: DataFrame, curves: DataFrame) -> DataFrame:
    """Unit rows of the perils present.

    The peril is taken through an aggregate: a column that is constant in all curves would be folded
    out of the join keys and leave a nested loop.
    """
    present = curves.groupBy("peril").agg(F.max("peril").alias("_present")).select("_present")
    return kinds.join(present, F.col("peril") == F.col("_present"), "left_semi")
