"""The ten published tables, declared once as Spark types plus key and layout."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType
    pk: tuple[str, ...]
    cluster_by: tuple[str, ...]
    doc: str

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema if not f.nullable]


def _table(name: str, pk: str, doc: str, fields: str, cluster_by: str | None = None) -> TableSpec:
    """``fields`` lists ``name[!][:double|:bigint]``; ``!`` means NOT NULL, default type is string."""
    types = {"double": T.DoubleType(), "bigint": T.LongType(), "": T.StringType()}
    struct = T.StructType()
    for token in fields.split():
        column, _, type_name = token.partition(":")
        struct.add(column.rstrip("!"), types[type_name], not column.endswith("!"))
    keys = tuple(pk.split())
    return TableSpec(name, struct, keys, tuple(cluster_by.split()) if cluster_by else keys, doc)


TABLES: dict[str, TableSpec] = {
    t.name: t
    for t in (
        _table("curves", "curve_id", "One row per curve, with where it came from.",
               "curve_id! peril! version! damage_type! occupancy building_type source_agency "
               "description defect_flag defect_verified source_file! source_table! source_row_id!"),
        _table("curve_points", "curve_id x", "Long points; a NULL y is a gap of the source.",
               "curve_id! x!:double y:double"),
        _table("curve_attributes", "curve_id key", "Key/value dimensions that only some perils have.",
               "curve_id! key! value"),
        _table("curve_kind", "peril damage_type", "What x and y mean and how to read between points.",
               "peril! damage_type! x_name! x_units! y_name! y_units! interpolation! notes"),
        _table("assignment_rules", "rule_id", "Default curve of each occupancy, zone, stories and basement.",
               "rule_id! peril! version! damage_type! occupancy flood_zone stories basement curve_id "
               "source_file! source_table! notes"),
        _table("curve_zone_applicability", "curve_id flood_zone",
               "Zones a curve is flagged for; a missing row means no zone was stated.",
               "curve_id! flood_zone! source_file! source_table!", cluster_by="flood_zone curve_id"),
        _table("dim_geographic_case", "case_name territory", "Territories each set-valued case covers.",
               "case_name! territory! case_description"),
        _table("dim_occupancy", "occupancy", "Occupancy classes.", "occupancy! category description"),
        _table("dim_building_type", "building_type", "Building types.", "building_type! description"),
        _table("provenance", "source_file", "Integrity record of every source file.",
               "source_file! url! sha256! bytes!:bigint retrieved_at! version! note"),
    )
}


def conform(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Project onto the declared columns and types; a column the input lacks becomes NULL."""
    present = set(df.columns)

    def column(field: T.StructField) -> Column:
        source = F.col(field.name) if field.name in present else F.lit(None)
        return source.cast(field.dataType).alias(field.name)

    return df.select([column(field) for field in spec.schema])


def undeclared_columns(df: DataFrame, spec: TableSpec) -> None:
    """Fail when ``df`` carries a column that ``conform`` would silently drop."""
    extra = [c for c in df.columns if c not in spec.columns]
    if extra:
        raise ValueError(f"{spec.name}: columns {extra} are produced but not declared")


def pk_violations(df: DataFrame, pk: tuple[str, ...] | list[str]) -> DataFrame:
    """Keys that occur more than once, with their row count."""
    return df.groupBy(*pk).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def not_null_violations(df: DataFrame, required: list[str]) -> DataFrame:
    """(column_name, n_null) for every required column, from one aggregate."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required])
    return counts.unpivot([], required, "column_name", "n_null")
