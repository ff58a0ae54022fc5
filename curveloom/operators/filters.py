"""Filters that select curves, and the labels and domains a search form shows."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from curveloom.fixed_values import (
    ATTRIBUTE_ORDER,
    COASTAL_ZONES,
    DEFAULT_FILTERS,
    DEFECT_BUILDING_TYPES,
    INTERNAL_KEYS,
    LOSS_CLASSES,
    X_LABELS,
    Y_LABELS,
)
from curveloom.functions.literal import literal_frame
from curveloom.operators.reshape import dedup_first

BITS = 62


def filter_curves(curves: DataFrame, limit: int | None = None, **equals: str | None) -> DataFrame:
    """Curves matching every given column, ordered by id.  None is no filter; limit 0 or None is no limit."""
    kept = curves
    for column, value in equals.items():
        if value is not None:
            kept = kept.where(F.col(column) == value)
    ordered = kept.orderBy("curve_id")
    return ordered.limit(limit) if limit else ordered


def flagged(curves: DataFrame) -> DataFrame:
    return curves.where("defect_flag IS NOT NULL")


def unflagged(curves: DataFrame) -> DataFrame:
    return curves.where("defect_flag IS NULL")


def verified_as(curves: DataFrame, verdict: str) -> DataFrame:
    return curves.where(F.col("defect_verified") == verdict)


def like_filter(curves: DataFrame, column: str, patterns: list[str]) -> DataFrame:
    """Rows where ``column`` matches any of the LIKE patterns."""
    return curves.where(reduce(lambda a, b: a | b, [F.col(column).like(p) for p in patterns]))


def attribute_filter(
    curves: DataFrame,
    attributes: DataFrame,
    pairs: list[tuple[str, str]],
    cases: DataFrame | None = None,
    territory: str | None = None,
) -> DataFrame:
    """Curves that have all (key, value) pairs, and whose set-valued case covers the territory.

    One pushed-down scan of the attributes: each condition sets a bit, and a curve qualifies when
    all bits are set.  The buffer is one long per 62 conditions, whatever the number of rows.
    """
    tests = [(F.col("key") == k) & (F.col("value") == v) for k, v in pairs]
    if territory is not None:
        tests.append(F.col("key") == "geographic_case")
    if not tests:
        return curves
    scanned = attributes.where(reduce(lambda a, b: a | b, tests))
    if territory is not None:
        covering = cases.where(F.col("territory") == territory).select(
            F.col("case_name").alias("value"), F.lit(True).alias("covers")
        )
        scanned = scanned.join(covering.distinct(), "value", "left")
        tests[-1] = tests[-1] & F.col("covers")
    masks, full = [], []
    for start in range(0, len(tests), BITS):
        chunk = tests[start : start + BITS]
        bit = reduce(
            lambda a, b: a.bitwiseOR(b),
            [F.when(t, F.lit(1 << i).cast("bigint")).otherwise(F.lit(0).cast("bigint")) for i, t in enumerate(chunk)],
        )
        masks.append(F.bit_or(bit).alias(f"mask_{start}"))
        full.append(F.col(f"mask_{start}") == F.lit((1 << len(chunk)) - 1).cast("bigint"))
    matching = scanned.groupBy("curve_id").agg(*masks).where(reduce(lambda a, b: a & b, full))
    return curves.join(matching.select("curve_id"), "curve_id", "left_semi")


def territory_filter(curves: DataFrame, attributes: DataFrame, cases: DataFrame, territory: str) -> DataFrame:
    """Curves whose set-valued case covers the territory (membership, never equality)."""
    covering = cases.where(F.col("territory") == territory).select(F.col("case_name").alias("value"))
    hits = attributes.where("key = 'geographic_case'").join(covering, "value", "left_semi")
    return curves.join(hits.select("curve_id"), "curve_id", "left_semi")


def zone_filter(curves: DataFrame, applicability: DataFrame, zone: str) -> DataFrame:
    """Curves flagged for the zone."""
    hits = applicability.where(F.col("flood_zone") == zone).select("curve_id")
    return curves.join(hits, "curve_id", "left_semi")


def classify(df: DataFrame, class_column: str) -> DataFrame:
    """Add damage_type and y_units of a small integer class; rows of unknown classes are dropped."""
    classes = literal_frame(df.sparkSession, LOSS_CLASSES, "_class int, damage_type string, y_units string")
    return df.join(classes, F.col(class_column).cast("int") == F.col("_class")).drop("_class")


def defect_flag(building_type: Column, note: str, affected: tuple[str, ...] = DEFECT_BUILDING_TYPES) -> Column:
    return F.when(building_type.isin(*affected), F.lit(note))


def annotate_coastal(zone: Column, note: str) -> Column:
    return F.when(zone.isin(*COASTAL_ZONES), F.lit(note))


def display_label(df: DataFrame, labels: DataFrame) -> DataFrame:
    """Add ``label``: the readable form of (key, value), else the value itself."""
    named = labels.select("key", "value", F.col("label").alias("_label"))
    joined = df.join(named, ["key", "value"], "left")
    return joined.withColumn("label", F.coalesce("_label", "value")).drop("_label")


def plain_label(c: Column) -> Column:
    return F.regexp_replace(c, "_", " ")


def code_label(code: Column, description: Column) -> Column:
    """``code — description``, or the code alone when it has no description."""
    return F.when(description.isNotNull() & (description != ""), F.concat(code, F.lit(" — "), description)).otherwise(code)


def axis_labels(
    damage_types: DataFrame, kinds: DataFrame, labels: dict[str, str] = Y_LABELS, x_labels: dict[str, str] = X_LABELS
) -> DataFrame:
    """Units and labels of both axes of each (peril, damage_type); 'mixed' when no single unit applies.

    ``labels`` has the y axis per damage type, ``x_labels`` the x axis per peril; without one the x
    axis is called by its units.
    """
    kind = kinds.select("peril", "damage_type", "x_units", "y_units")

    def chosen(column: str, texts: dict[str, str]) -> list[Column]:
        return [F.when(F.col(column) == k, F.lit(v)) for k, v in texts.items()]

    label = F.coalesce(*chosen("damage_type", labels), F.lit(None).cast("string"))
    x_label = F.coalesce(*chosen("peril", x_labels), plain_label(F.col("x_units")))
    return damage_types.join(kind, ["peril", "damage_type"], "left").select(
        "peril",
        "damage_type",
        "x_units",
        F.coalesce("y_units", F.lit("mixed")).alias("y_units"),
        x_label.alias("x_label"),
        F.coalesce(label, F.lit("Value (units vary by damage type)")).alias("y_label"),
    )


def default_filters(domain: DataFrame, defaults: DataFrame | str) -> DataFrame:
    """The defaults (key, value) whose value occurs in the data (``domain`` has the same columns).

    A peril stands for its published defaults.
    """
    if isinstance(defaults, str):
        defaults = literal_frame(domain.sparkSession, list(DEFAULT_FILTERS[defaults].items()), "key string, value string")
    return defaults.join(domain.select("key", "value"), ["key", "value"], "left_semi")


def domain_values(df: DataFrame, columns: list[str]) -> DataFrame:
    """Distinct non-NULL values of several columns in one pass: (key, value)."""
    long = df.select([F.col(c).cast("string").alias(c) for c in columns]).unpivot([], columns, "key", "value")
    return long.where("value IS NOT NULL").distinct()


def attribute_domain(attributes: DataFrame) -> DataFrame:
    """Distinct non-NULL values of every attribute key, in one pass."""
    return attributes.where("value IS NOT NULL").select("key", "value").distinct()


def describe_dimension(codes: DataFrame, dimension: DataFrame, column: str) -> DataFrame:
    """Codes in use with their description; a code without one stays, last."""
    used = codes.where(F.col(column).isNotNull()).select(column).distinct()
    named = used.join(dimension.select(column, "description"), column, "left")
    return named.orderBy(F.col("description").asc_nulls_last(), column)


def present_dimension(dimension: DataFrame, curves: DataFrame, column: str) -> DataFrame:
    """Dimension rows that some curve uses; the few codes in use are collected before the join."""
    return dimension.join(curves.select(column).distinct(), column, "left_semi").orderBy(column)


def priority_order(keys: DataFrame, order: list[str] = ATTRIBUTE_ORDER, hidden: list[str] = INTERNAL_KEYS) -> DataFrame:
    """Distinct attribute keys in display order, the rest alphabetical, internal ones removed."""
    rank = F.coalesce(*[F.when(F.col("key") == k, F.lit(i)) for i, k in enumerate(order)], F.lit(len(order)))
    shown = keys.where(F.col("key").isNotNull() & ~F.col("key").isin(hidden)).select("key").distinct()
    return shown.withColumn("rank", rank).orderBy("rank", "key")


def default_curve(rules: DataFrame, requests: DataFrame) -> DataFrame:
    """Curve each request selects by default; a missing or blank story or basement means none.

    ``requests`` has request_id, version, damage_type, occupancy, flood_zone, stories, basement.
    Every request keeps one row; curve_id is NULL when no rule applies, and of rules with equal keys
    the first by rule_id counts.
    """

    def keyed(df: DataFrame) -> DataFrame:
        blank = {c: F.coalesce(F.trim(c), F.lit("")) for c in ("stories", "basement")}
        return df.withColumns(blank)

    keys = ["version", "damage_type", "occupancy", "flood_zone", "stories", "basement"]
    chosen = dedup_first(keyed(rules).select(*keys, "rule_id", "curve_id"), keys, ["rule_id", "curve_id"])
    return keyed(requests).join(chosen, keys, "left")
