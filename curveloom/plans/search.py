"""Search: filters, guard, then one curve as published or several averaged."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from curveloom.operators.aggregate import require_ok, statistics, unit_guard
from curveloom.operators.filters import attribute_filter, zone_filter
from curveloom.sources.writers import materialize


@dataclass(frozen=True)
class SearchResult:
    """Lazy results of one search; ``curves`` is the matched set every other part builds on."""

    curves: DataFrame
    points: DataFrame
    guard: DataFrame
    all_points: DataFrame
    kinds: DataFrame | None

    def rows(self, strict: bool = False) -> DataFrame:
        """One match as published, several as one average, nothing when the guard refuses.

        The filters run once: what guard and average need of the matched curves, three short columns, is
        written to the shared folder when this is called, and stays there.  The rest is one lazy plan: the guard is a
        scalar subquery, and one or several curves differ in expressions only.  ``strict`` fails the job when
        the guard refuses.
        """
        matched = materialize(self.curves.select("curve_id", "peril", "damage_type"), "matched-ids")
        guard = unit_guard(matched, self.kinds)
        verdict = (require_ok(guard) if strict else guard).select(F.struct("status", "n_curves")).scalar()
        rows = self.all_points.join(matched.select("curve_id", "damage_type"), "curve_id").groupBy("damage_type", "x").agg(*statistics(), F.min("curve_id").alias("only_curve"))
        one = F.col("verdict.n_curves") == 1
        return rows.withColumn("verdict", verdict).where(F.col("verdict.status") == "ok").select(
            F.when(one, F.col("only_curve")).otherwise("DERIVED").alias("curve_id"),
            "damage_type", "x",
            F.when(one, F.col("y_min")).otherwise(F.col("y_mean")).alias("y"),
            F.when(~one, F.col("y_std")).alias("y_std"),
            "y_min", "y_max", "n_at_x",
        )


def match_curves(
    curves: DataFrame,
    attributes: DataFrame | None = None,
    cases: DataFrame | None = None,
    applicability: DataFrame | None = None,
    *,
    equals: dict[str, str | None] | None = None,
    pairs: list[tuple[str, str]] | None = None,
    territory: str | None = None,
    zone: str | None = None,
) -> DataFrame:
    """Curves passing every filter given; column filters are applied first so they reach the scan."""
    kept = curves
    for column, value in (equals or {}).items():
        if value is not None:
            kept = kept.where(F.col(column) == value)
    if zone is not None:
        kept = zone_filter(kept, applicability, zone)
    if territory is not None or pairs:
        kept = attribute_filter(kept, attributes, pairs or [], cases, territory)
    return kept


def search(
    curves: DataFrame,
    points: DataFrame,
    kinds: DataFrame | None = None,
    attributes: DataFrame | None = None,
    cases: DataFrame | None = None,
    applicability: DataFrame | None = None,
    reuse: bool = False,
    **filters,
) -> SearchResult:
    """Match curves and prepare guard and points; see ``match_curves`` for the filters.

    Nothing runs before a result is read.  With ``reuse`` the matched curves are first written to the
    shared folder, where they stay: worth it when several parts of a costly match are read.
    """
    matched = match_curves(curves, attributes, cases, applicability, **filters)
    if reuse:
        matched = materialize(matched, "matched-curves")
    typed = points.join(matched.select("curve_id", "damage_type"), "curve_id")
    return SearchResult(matched, typed, unit_guard(matched, kinds), points, kinds)
