"""End-to-end builds: a tidy library from wide sources, and duplicate verification."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from curveloom.fixed_values import DEFECT_FAMILIES
from curveloom.functions.text import clean_text, family_of, make_curve_id, normalise_id, stories_of, terrain_of
from curveloom.operators.contracts import column_accounting, grid_contract
from curveloom.operators.duplicates import apply_verdict, duplicate_summary, sibling_compare
from curveloom.operators.filters import classify, defect_flag
from curveloom.operators.reshape import decode_codes, melt_attributes, melt_curves, melt_points, pack_curve


def melt_wide_table(
    wide: DataFrame,
    roles: dict[str, str],
    grid: list[float],
    *,
    peril: str,
    version: str,
    damage_type: str,
    source_file: str,
    source_table: str,
    ignored: dict[str, str] | None = None,
) -> dict[str, DataFrame]:
    """curves, curve_points and curve_attributes of one wide text table.

    The column and grid contracts are checked on the schema before anything is read.
    """
    column_accounting(wide, roles, ignored)
    measures = grid_contract(wide.columns, grid)
    id_column = next(c for c, role in roles.items() if role == "source_row_id" and c in wide.columns)
    keyed = wide.withColumn(id_column, normalise_id(F.col(id_column))).where(
        F.col(id_column).isNotNull() & (F.col(id_column) != "NULL")
    )
    keyed = keyed.withColumn("curve_id", make_curve_id(F.lit(peril), F.lit(version), F.lit(damage_type), id_column))
    literals = {"peril": peril, "version": version, "damage_type": damage_type,
                "source_file": source_file, "source_table": source_table}
    keys = {c: role[5:] for c, role in roles.items() if role.startswith("attr:") and c in wide.columns}
    cleaned = keyed.select("curve_id", *[clean_text(F.col(c)).alias(c) for c in keys])
    return {
        "curves": melt_curves(keyed, roles, literals),
        "curve_points": melt_points(keyed, list(measures), text=True),
        "curve_attributes": melt_attributes(cleaned, keys),
    }


def melt_wind_table(
    wide: DataFrame,
    building_types: DataFrame,
    terrain: DataFrame,
    dictionary: DataFrame,
    grid: list[float],
    *,
    version: str,
    source_agency: str,
    source_file: str,
    source_table: str,
    defect_note: str,
    ignored: dict[str, str] | None = None,
) -> dict[str, DataFrame]:
    """curves, curve_points and curve_attributes of the wind table and its dictionaries.

    ``wide`` has wbID, TERRAINID, DamLossDescID and the speeds; ``building_types`` has wbID, sbt,
    chars, case_name; ``terrain`` has TERRAINID, terrain, roughness; ``dictionary`` has code,
    char_type, name.  Rows of unknown building types or classes are skipped.  Codes are decoded
    once per building type and then joined to its curves.  The column and grid contracts are checked on
    the schema before anything is read.
    """
    column_accounting(wide, {"wbID": "building type", "TERRAINID": "terrain", "DamLossDescID": "class"}, ignored)
    measures = grid_contract(wide.columns, grid)
    facts = classify(wide, "DamLossDescID").join(building_types, "wbID").join(terrain, "TERRAINID", "left")
    facts = facts.withColumn(
        "curve_id",
        F.concat(make_curve_id(F.lit("hu"), F.lit(version), "damage_type", "wbID", F.lit("t")), F.col("TERRAINID").cast("string")),
    )
    curves = facts.select(
        "curve_id",
        F.lit("hu").alias("peril"),
        F.lit(version).alias("version"),
        "damage_type",
        F.col("sbt").alias("building_type"),
        F.lit(source_agency).alias("source_agency"),
        F.col("chars").alias("description"),
        defect_flag(F.col("sbt"), defect_note).alias("defect_flag"),
        F.lit(source_file).alias("source_file"),
        F.lit(source_table).alias("source_table"),
        make_curve_id("wbID", "TERRAINID", "DamLossDescID", sep="/").alias("source_row_id"),
    )
    own = melt_attributes(
        facts,
        {"wbID": "wind_building_type_id", "sbt": "specific_building_type", "TERRAINID": "terrain_id",
         "terrain": "terrain", "roughness": "surface_roughness_m", "case_name": "geographic_case",
         "chars": "characteristic_code"},
    )
    decoded = facts.select("curve_id", "wbID").join(decode_codes(building_types, "wbID", "chars", dictionary), "wbID")
    return {
        "curves": curves,
        "curve_points": melt_points(facts, list(measures)),
        "curve_attributes": own.unionByName(decoded.select("curve_id", "key", "value")),
    }


def verify_duplicates(
    curves: DataFrame, points: DataFrame, grid: list[float], families: tuple[str, ...] = DEFECT_FAMILIES
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(verdict, curves with defect_verified, summary) for multi-storey curves of the families."""
    affected = curves.where(family_of(F.col("building_type")).isin(*families))
    packed = pack_curve(points.join(affected.select("curve_id"), "curve_id", "left_semi"), grid)
    signature = affected.join(packed, "curve_id").select(
        "curve_id",
        family_of(F.col("building_type")).alias("family"),
        stories_of(F.col("building_type")).alias("stories"),
        F.col("description").alias("chars"),
        terrain_of(F.col("curve_id")).alias("terrain"),
        "damage_type",
        "ys",
    )
    verdict = sibling_compare(signature, ["family", "chars", "terrain", "damage_type"], "stories", "1", ["2", "3"])
    return verdict, apply_verdict(curves, verdict), duplicate_summary(verdict, curves, "building_type")
