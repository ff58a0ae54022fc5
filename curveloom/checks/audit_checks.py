"""Checks of evaluation, version comparison, duplicates, rules, profiles and text jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from curveloom.checks.registry import check
from curveloom.checks.sample import COASTAL_NOTE, FLAGS, GRID3, GRID7, LOOKUPS, Sample, with_ctes
from curveloom.checks.select_checks import zones_of
from curveloom.operators import audit, contracts, diff, evidence, rules as ru
from curveloom.operators.aggregate import defect_banner
from curveloom.operators.duplicates import apply_verdict, duplicate_summary, sibling_compare
from curveloom.operators.evaluate import evaluate, evaluate_wide, segment_join
from curveloom.operators.filters import verified_as
from curveloom.operators.lookup import get_curve
from curveloom.operators.reshape import melt_points, pack_curve, split_codes
from curveloom.functions.literal import literal_frame
from curveloom.fixed_values import IDENTICAL, PAGE_LABEL_PATTERN
from curveloom.functions.text import printed_label
from curveloom.plans.library import verify_duplicates

# --- evaluation ---------------------------------------------------------------------------------
EVALUATED = with_ctes("points7", "exposures") + """
, domain AS (SELECT curve_id, min(x) AS low, max(x) AS high FROM points7 GROUP BY curve_id),
seg AS (SELECT curve_id, x AS x0, y AS y0, lead(x) OVER w AS x1, lead(y) OVER w AS y1 FROM points7 WINDOW w AS (PARTITION BY curve_id ORDER BY x)),
located AS (SELECT e.exposure_id, e.curve_id, e.x, d.low, d.high, s.x0, s.y0, s.x1, s.y1 FROM exposures e LEFT JOIN domain d ON d.curve_id = e.curve_id
LEFT JOIN seg s ON s.curve_id = e.curve_id AND (e.x = s.x0 OR (e.x > s.x0 AND e.x < s.x1))),
evaluated AS (SELECT *, CASE WHEN low IS NULL THEN 'no_such_curve' WHEN x < low OR x > high THEN 'outside_domain' WHEN x = x0 AND y0 IS NULL THEN 'no_published_value'
WHEN x = x0 THEN 'ok' WHEN y0 IS NULL OR y1 IS NULL THEN 'gap' ELSE 'ok' END AS status FROM located)
"""
EVALUATE_SQL = EVALUATED + """
SELECT exposure_id, curve_id, x, CASE WHEN status = 'ok' AND x = x0 THEN y0 WHEN status = 'ok' THEN y0 + (y1 - y0) * (x - x0) / (x1 - x0) END AS y, status FROM evaluated"""


@check("evaluate", EVALUATE_SQL)
def evaluate_check(s: Sample) -> DataFrame:
    return evaluate_wide(s.exposures(), s.wide7())


@check("evaluate_points", EVALUATE_SQL)
def evaluate_points(s: Sample) -> DataFrame:
    return evaluate(s.exposures(), s.points7(), GRID7)


@check("evaluate_any_grid", EVALUATE_SQL)
def evaluate_any_grid(s: Sample) -> DataFrame:
    return evaluate(s.exposures(), s.points7())


@check("segment_join", EVALUATED + "SELECT exposure_id, curve_id, x0, y0, x1, y1 FROM located")
def segment_join_check(s: Sample) -> DataFrame:
    joined = segment_join(s.exposures(), s.points7())
    return joined.select("exposure_id", "curve_id", *[F.col(f"_{c}").alias(c) for c in ("x0", "y0", "x1", "y1")])


@check("evaluate_strict", with_ctes("points7") + "SELECT curve_id, x, y, 'ok' AS status FROM points7 WHERE y IS NOT NULL")
def evaluate_strict_check(s: Sample) -> DataFrame:
    """Every published value is read back by evaluating at its own x; none may fail."""
    from curveloom.operators.evaluate import strict

    published = s.points7().where("y IS NOT NULL").select("curve_id", "x")
    return strict(evaluate_wide(published, s.wide7()))


@check("get_curve", with_ctes("wide7", "curves", "attributes", "kinds", "exposures") + """
SELECT q.curve_id, c.curve_id IS NOT NULL AS found, c.occupancy, p1 AS first_y, p7 AS last_y, CASE WHEN w.curve_id IS NOT NULL THEN 7 END AS n_points,
a.value AS size, k.y_units FROM (SELECT DISTINCT curve_id FROM exposures) q LEFT JOIN curves c ON c.curve_id = q.curve_id LEFT JOIN wide7 w ON w.curve_id = q.curve_id
LEFT JOIN attributes a ON a.curve_id = q.curve_id AND a.key = 'size' LEFT JOIN kinds k ON k.peril = c.peril AND k.damage_type = c.damage_type""")
def get_curve_check(s: Sample) -> DataFrame:
    got = get_curve(s.curves(), s.points7(), s.attributes(), s.kinds(), s.exposures(), GRID7)
    return got.select(
        "curve_id", "found", "occupancy", F.col("points")[0]["y"].alias("first_y"), F.col("points")[6]["y"].alias("last_y"),
        F.when(F.col("points").isNotNull(), F.size("points")).alias("n_points"), F.col("attributes")["size"].alias("size"),
        F.col("kind.y_units").alias("y_units"))


@check("get_curve_mixed", with_ctes("points7", "points3") + """
SELECT curve_id, 'found' AS state, count(*) AS n_points, min(x) AS low, max(x) AS high, round(sum(y), 6) AS total FROM points7 GROUP BY curve_id
UNION ALL SELECT 'small-' || curve_id, 'found', count(*), min(x), max(x), round(sum(y), 6) FROM points3 GROUP BY curve_id""")
def get_curve_mixed(s: Sample) -> DataFrame:
    """All curves of both libraries, on their two grids, in one call."""
    def small(df: DataFrame) -> DataFrame:
        return df.withColumn("curve_id", F.concat(F.lit("small-"), "curve_id"))

    kinds = ("A", "N", "R")
    few = s.points3().select("curve_id").distinct().join(s.curves(), "curve_id")
    curves = s.curves().unionByName(small(few).withColumn("peril", F.lit("sm")))
    points = s.points7().unionByName(small(s.points3()))
    grids = {("li", k): GRID7 for k in kinds} | {("sm", k): GRID3 for k in kinds}
    got = get_curve(curves, points, s.attributes(), s.kinds(), points.select("curve_id"), grids)
    xs = F.transform("points", lambda p: p["x"])
    total = F.aggregate("points", F.lit(0.0), lambda a, p: a + F.coalesce(p["y"], F.lit(0.0)))
    some = F.exists("points", lambda p: p["y"].isNotNull())
    return got.select(
        "curve_id", F.when(F.col("found"), "found").alias("state"), F.size("points").cast("long").alias("n_points"),
        F.array_min(xs).alias("low"), F.array_max(xs).alias("high"), F.when(some, F.round(total, 6)).alias("total"))


# --- version comparison -------------------------------------------------------------------------
def _versions(s: Sample, wide: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Old and new vintage under ids without the version."""
    keyed = wide.withColumn("curve_id", F.concat("damage_type", F.lit("-"), F.col("partkey").cast("string")))
    return keyed.where("version = 'F'"), keyed.where("version = 'O'")


OLD_NEW = with_ctes("wide3") + """
, o AS (SELECT damage_type || '-' || CAST(partkey AS VARCHAR) AS curve_id, damage_type, p1, p2, p3 FROM wide3 WHERE version = 'F'),
n AS (SELECT damage_type || '-' || CAST(partkey AS VARCHAR) AS curve_id, damage_type, p1, p2, p3 FROM wide3 WHERE version = 'O'),
d AS (SELECT coalesce(o.curve_id, n.curve_id) AS curve_id, CASE WHEN n.curve_id IS NULL THEN 'removed' WHEN o.curve_id IS NULL THEN 'added'
WHEN o.p1 IS DISTINCT FROM n.p1 OR o.p2 IS DISTINCT FROM n.p2 OR o.p3 IS DISTINCT FROM n.p3 THEN 'changed' ELSE 'same' END AS change
FROM o FULL JOIN n ON n.curve_id = o.curve_id)
"""


@check("diff_curves", OLD_NEW + "SELECT curve_id, change FROM d")
def diff_curves_check(s: Sample) -> DataFrame:
    return diff.diff_wide(*_versions(s, s.wide3()))


def _long(wide: DataFrame) -> DataFrame:
    from curveloom.operators.reshape import melt_points

    return melt_points(wide, ["p1", "p2", "p3"])


@check("diff_points_on_grid", OLD_NEW + "SELECT curve_id, change FROM d")
def diff_points_on_grid(s: Sample) -> DataFrame:
    old, new = _versions(s, s.wide3())
    return diff.diff_curves(_long(old), _long(new), GRID3)


@check("diff_points_any_grid", OLD_NEW + "SELECT curve_id, change FROM d")
def diff_points_any_grid(s: Sample) -> DataFrame:
    old, new = _versions(s, s.wide3())
    return diff.diff_curves(_long(old), _long(new))


@check("diff_join", OLD_NEW + " UNION ALL ".join(
    f"SELECT coalesce(o.curve_id, n.curve_id) AS curve_id, CAST({k} AS DOUBLE) AS x, o.p{k} AS y_old, n.p{k} AS y_new, "
    "o.curve_id IS NOT NULL AS in_old, n.curve_id IS NOT NULL AS in_new FROM o FULL JOIN n ON n.curve_id = o.curve_id"
    for k in (1, 2, 3)))
def diff_join_check(s: Sample) -> DataFrame:
    old, new = _versions(s, s.wide3())
    return diff.diff_join(_long(old), _long(new))


@check("diff_summary", OLD_NEW + """
SELECT substr(curve_id, 1, 1) AS damage_type, count(CASE WHEN change <> 'added' THEN 1 END) AS n_old, count(CASE WHEN change <> 'removed' THEN 1 END) AS n_new,
count(CASE WHEN change = 'added' THEN 1 END) AS n_added, count(CASE WHEN change = 'removed' THEN 1 END) AS n_removed, count(CASE WHEN change = 'changed' THEN 1 END) AS n_changed
FROM d GROUP BY 1""")
def diff_summary_check(s: Sample) -> DataFrame:
    changes = diff.diff_wide(*_versions(s, s.wide3()))
    return diff.diff_summary(changes.withColumn("damage_type", F.substr("curve_id", F.lit(1), F.lit(1))), "damage_type")


@check("corroborate", OLD_NEW + """
SELECT count(CASE WHEN change IN ('same', 'changed') THEN 1 END) AS n_curves, count(CASE WHEN change IN ('same', 'changed') THEN 1 END) * 3 AS n_values,
count(CASE WHEN change <> 'same' THEN 1 END) AS n_discrepancies, count(CASE WHEN change <> 'same' THEN 1 END) = 0 AS corroborated FROM d""")
def corroborate_check(s: Sample) -> DataFrame:
    return diff.corroborate(*_versions(s, s.wide3()))


@check("ids_added", OLD_NEW + "SELECT curve_id FROM n EXCEPT SELECT curve_id FROM o")
def ids_added_check(s: Sample) -> DataFrame:
    return diff.ids_added(*_versions(s, s.wide3()))


@check("ids_removed", OLD_NEW + "SELECT curve_id FROM o EXCEPT SELECT curve_id FROM n")
def ids_removed_check(s: Sample) -> DataFrame:
    return diff.ids_removed(*_versions(s, s.wide3()))


@check("ids_common", OLD_NEW + "SELECT curve_id FROM o INTERSECT SELECT curve_id FROM n")
def ids_common_check(s: Sample) -> DataFrame:
    return diff.ids_common(*_versions(s, s.wide3()))


@check("roundtrip_check", with_ctes("wide7", "points7") + " UNION ALL ".join([
    *(f"SELECT 'p{k}' AS column_name, count(*) AS n_cells, CAST(0 AS BIGINT) AS n_different FROM wide7" for k in (1, 3, 4, 5, 6, 7)),
    "SELECT 'p2', count(*), count(CASE WHEN partkey % 10 = 0 AND p2 IS NOT NULL THEN 1 END) FROM wide7",
    "SELECT '(extra points)', (SELECT count(*) FROM points7) + CAST(sum(CASE partkey % 10 WHEN 0 THEN -1 WHEN 1 THEN 1 WHEN 2 THEN 1 ELSE 0 END) AS BIGINT), count(CASE WHEN partkey % 10 IN (1, 2) THEN 1 END) FROM wide7",
    "SELECT '(missing points)', count(*) * 7, count(CASE WHEN partkey % 10 = 0 THEN 1 END) FROM wide7",
]))
def roundtrip_check(s: Sample) -> DataFrame:
    """Points with planted faults: some missing, some off the grid, some twice."""
    wide, points = s.wide7(), s.points7()
    last = F.regexp_extract("curve_id", "([0-9])$", 1)
    kept = points.where((last != "0") | (F.col("x") != 2))
    off = points.where((last == "1") & (F.col("x") == 1)).withColumn("x", F.lit(99.0))
    twice = points.where((last == "2") & (F.col("x") == 5))
    return diff.roundtrip_check(wide, kept.unionByName(off).unionByName(twice))


@check("diff_planted", OLD_NEW + """
SELECT coalesce(o.curve_id, n.curve_id) AS curve_id, CASE WHEN n.curve_id IS NULL THEN 'removed' WHEN o.curve_id IS NULL THEN 'added' WHEN right(n.curve_id, 1) IN ('1', '2', '3')
OR o.p1 IS DISTINCT FROM n.p1 OR o.p2 IS DISTINCT FROM n.p2 OR o.p3 IS DISTINCT FROM n.p3 THEN 'changed' ELSE 'same' END AS change FROM o FULL JOIN n ON n.curve_id = o.curve_id""")
def diff_planted(s: Sample) -> DataFrame:
    """The new version also lacks a point, repeats one with another value, or has one more, by the last digit."""
    old, new = (_long(w) for w in _versions(s, s.wide3()))
    last = F.right("curve_id", F.lit(1))
    less = new.where((last != "1") | (F.col("x") != 2))
    more = new.where((last == "2") & (F.col("x") == 1)).withColumn("y", F.lit(-5.0))
    wider = new.where((last == "3") & (F.col("x") == 1)).withColumn("x", F.lit(4.0))
    return diff.diff_curves(old, less.unionByName(more).unionByName(wider))


@check("corroborate_other_grid", OLD_NEW + """
SELECT count(CASE WHEN change IN ('same', 'changed') THEN 1 END) AS n_curves, count(CASE WHEN change IN ('same', 'changed') THEN 1 END) * 4 AS n_values,
count(*) AS n_discrepancies, count(*) = 0 AS corroborated FROM d""")
def corroborate_other_grid(s: Sample) -> DataFrame:
    """A grid value that only the new version has makes every common curve a changed one."""
    old, new = _versions(s, s.wide3())
    return diff.corroborate(old, new.withColumn("p4", F.col("p1")))


# --- duplicates ---------------------------------------------------------------------------------
def _siblings(s: Sample, wide: DataFrame) -> DataFrame:
    packed = wide.select("curve_id", "version", "partkey", "damage_type", F.array("p1", "p2", "p3").alias("ys"))
    return sibling_compare(packed, ["version", "partkey"], "damage_type", "A", ["N", "R"])


SIBLINGS = with_ctes("wide3", "curves") + """
, verdict AS (SELECT m.curve_id, coalesce(bool_or(m.p1 IS NOT DISTINCT FROM b.p1 AND m.p2 IS NOT DISTINCT FROM b.p2 AND m.p3 IS NOT DISTINCT FROM b.p3) FILTER (WHERE b.curve_id IS NOT NULL), false) AS is_duplicate,
count(b.curve_id) > 0 AS had_counterpart FROM wide3 m LEFT JOIN wide3 b ON b.version = m.version AND b.partkey = m.partkey AND b.damage_type = 'A'
WHERE m.damage_type IN ('N', 'R') GROUP BY m.curve_id),
checked AS (SELECT c.*, CASE WHEN is_duplicate THEN 'identical_to_1_story' WHEN v.curve_id IS NOT NULL THEN 'differs_from_1_story' END AS verdict
FROM curves c LEFT JOIN verdict v ON v.curve_id = c.curve_id)
"""


@check("sibling_compare", SIBLINGS + "SELECT curve_id, is_duplicate, had_counterpart FROM verdict")
def sibling_compare_check(s: Sample) -> DataFrame:
    return _siblings(s, s.wide3())


@check("apply_verdict", SIBLINGS + "SELECT curve_id, damage_type, defect_flag, verdict AS defect_verified FROM checked")
def apply_verdict_check(s: Sample) -> DataFrame:
    return apply_verdict(s.curves(), _siblings(s, s.wide3())).select("curve_id", "damage_type", "defect_flag", "defect_verified")


@check("duplicate_summary", SIBLINGS + """
SELECT c.building_type, count(*) AS n_curves, count(CASE WHEN is_duplicate THEN 1 END) AS n_duplicate, count(CASE WHEN NOT had_counterpart THEN 1 END) AS n_no_counterpart,
round(count(CASE WHEN is_duplicate THEN 1 END) * CAST(100 AS DOUBLE) / count(*), 6) AS share_pct FROM verdict v JOIN curves c ON c.curve_id = v.curve_id GROUP BY c.building_type""")
def duplicate_summary_check(s: Sample) -> DataFrame:
    out = duplicate_summary(_siblings(s, s.wide3()), s.curves(), "building_type")
    return out.withColumn("share_pct", F.round(F.col("share_pct").cast("double"), 6))


STOREYED = with_ctes("wide3") + """
, st AS (SELECT 'li-' || damage_type || '-' || CAST(partkey AS VARCHAR) || '-' || CASE version WHEN 'F' THEN 't1' ELSE 't2' END AS curve_id,
CASE p_type WHEN 'SMALL' THEN 'WMUH' WHEN 'LARGE' THEN 'MMUH' ELSE 'SERB' END AS family, CAST(p_size % 3 + 1 AS VARCHAR) AS stories,
p_brand, version, damage_type, p1, p2, p3 FROM wide3 JOIN part ON p_partkey = partkey),
base AS (SELECT *, coalesce(p1, -1) || '/' || coalesce(p2, -1) || '/' || coalesce(p3, -1) AS ys FROM st),
one AS (SELECT family, p_brand, version, damage_type, list(DISTINCT ys) AS known FROM base WHERE stories = '1' GROUP BY ALL),
verdict AS (SELECT m.curve_id, m.family || m.stories AS building_type, coalesce(list_contains(known, ys), false) AS is_duplicate, known IS NOT NULL AS had_counterpart
FROM base m LEFT JOIN one o ON o.family = m.family AND o.p_brand = m.p_brand AND o.version = m.version AND o.damage_type = m.damage_type
WHERE m.family IN ('WMUH', 'MMUH') AND m.stories <> '1')
"""


def _verified(s: Sample) -> tuple[DataFrame, DataFrame, DataFrame]:
    wide = s.storeyed3()
    return verify_duplicates(wide.drop("p1", "p2", "p3"), melt_points(wide, ["p1", "p2", "p3"]), GRID3)


@check("verify_duplicates", STOREYED + """
SELECT st.curve_id, family || stories AS building_type,
CASE WHEN is_duplicate THEN 'identical_to_1_story' WHEN v.curve_id IS NOT NULL THEN 'differs_from_1_story' END AS defect_verified
FROM st LEFT JOIN verdict v ON v.curve_id = st.curve_id""")
def verify_duplicates_check(s: Sample) -> DataFrame:
    """The whole verification: families and storeys from the types, packed points, siblings, verdict."""
    return _verified(s)[1].select("curve_id", "building_type", "defect_verified")


@check("verify_summary", STOREYED + """
SELECT building_type, count(*) AS n_curves, count(CASE WHEN is_duplicate THEN 1 END) AS n_duplicate, count(CASE WHEN NOT had_counterpart THEN 1 END) AS n_no_counterpart,
round(count(CASE WHEN is_duplicate THEN 1 END) * CAST(100 AS DOUBLE) / count(*), 6) AS share_pct FROM verdict GROUP BY building_type""")
def verify_summary_check(s: Sample) -> DataFrame:
    return _verified(s)[2].withColumn("share_pct", F.round(F.col("share_pct").cast("double"), 6))


@check("verified_filter", SIBLINGS + "SELECT curve_id, occupancy FROM checked WHERE verdict = 'identical_to_1_story'")
def verified_filter(s: Sample) -> DataFrame:
    return verified_as(apply_verdict(s.curves(), _siblings(s, s.wide3())), IDENTICAL).select("curve_id", "occupancy")


@check("defect_banner", SIBLINGS + """
SELECT count(defect_flag) AS n_flagged, count(CASE WHEN defect_flag IS NOT NULL AND verdict = 'identical_to_1_story' THEN 1 END) AS n_verified FROM checked""")
def defect_banner_check(s: Sample) -> DataFrame:
    return defect_banner(apply_verdict(s.curves(), _siblings(s, s.wide3())))


# --- contracts over references and ranges -------------------------------------------------------
@check("dangling_refs", with_ctes("exposures", "curves") + """
SELECT e.curve_id, exposure_id FROM exposures e WHERE NOT EXISTS (SELECT 1 FROM curves c WHERE c.curve_id = e.curve_id)""")
def dangling_refs_check(s: Sample) -> DataFrame:
    return contracts.dangling_refs(s.exposures().select("curve_id", "exposure_id"), s.curves())


@check("kind_coverage", with_ctes("curves", "kinds") + "SELECT DISTINCT peril, damage_type FROM curves EXCEPT SELECT peril, damage_type FROM kinds")
def kind_coverage_check(s: Sample) -> DataFrame:
    return contracts.kind_coverage(s.curves(), s.kinds())


@check("out_of_range", with_ctes("points7", "curves") + """
SELECT damage_type, count(CASE WHEN y < low THEN 1 END) AS n_below, count(CASE WHEN y > high THEN 1 END) AS n_above, min(y) AS min_y, max(y) AS max_y
FROM points7 p JOIN curves c ON c.curve_id = p.curve_id JOIN (VALUES ('A', CAST(5 AS DOUBLE), CAST(45 AS DOUBLE)), ('N', NULL, CAST(49 AS DOUBLE)), ('R', CAST(0 AS DOUBLE), NULL)) AS l(dt, low, high) ON dt = damage_type
WHERE y < low OR y > high GROUP BY damage_type""")
def out_of_range_check(s: Sample) -> DataFrame:
    limits = contracts.limits_frame(s.spark, [("A", 5.0, 45.0), ("N", None, 49.0), ("R", 0.0, None)])
    return contracts.out_of_range(s.points7(), s.curves(), limits)


# --- profiles and claims ------------------------------------------------------------------------
PROFILED = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double",
            "o_orderdate": "timestamp_ntz", "o_orderpriority": "string", "note": "string"}


SOURCE = "WITH src AS (SELECT *, CASE WHEN o_totalprice > 250000 THEN o_orderpriority END AS note FROM orders)\n"


@check("profile_table", SOURCE + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{t}' AS type, count(*) AS n_rows, count(*) - count({c}) AS n_null, count(DISTINCT {c}) AS n_distinct, "
    + ", ".join(
        f"(SELECT DISTINCT CAST({c} AS VARCHAR) AS v FROM src WHERE {c} IS NOT NULL ORDER BY v LIMIT 1 OFFSET {i}) AS sample_{i + 1}"
        for i in range(3))
    + " FROM src" for c, t in PROFILED.items()))
def profile_table_check(s: Sample) -> DataFrame:
    orders = s.table("orders").withColumn("note", F.when(F.col("o_totalprice") > 250000, F.col("o_orderpriority")))
    return audit.profile_table(orders)


@check("stated_vs_measured", with_ctes("points7", "curves") + """
SELECT key, stated, measured, CASE WHEN measured IS NULL THEN 'not measured' WHEN stated = measured THEN 'match' ELSE 'differs' END AS verdict FROM (
SELECT 'n_types' AS key, CAST(3 AS BIGINT) AS stated, (SELECT count(DISTINCT damage_type) FROM curves) AS measured
UNION ALL SELECT 'n_flagged', 1, (SELECT count(defect_flag) FROM curves)
UNION ALL SELECT 'max_y', 50, (SELECT CAST(max(y) AS BIGINT) FROM points7)
UNION ALL SELECT 'n_zones', 3, NULL) t""")
def stated_vs_measured_check(s: Sample) -> DataFrame:
    claims = literal_frame(s.spark, [("n_types", 3), ("n_flagged", 1), ("max_y", 50), ("n_zones", 3)], "key string, stated bigint")
    curves = s.curves().agg(F.count_distinct("damage_type").alias("n_types"), F.count("defect_flag").alias("n_flagged"))
    points = s.points7().agg(F.max("y").cast("bigint").alias("max_y"))
    measures = curves.unpivot([], ["n_types", "n_flagged"], "key", "measured").unionByName(points.unpivot([], ["max_y"], "key", "measured"))
    return audit.stated_vs_measured(claims, measures)


@check("code_census", with_ctes("codes", "dictionary") + """
SELECT (SELECT count(DISTINCT code) FROM dictionary) AS n_documented, (SELECT count(DISTINCT code) FROM codes) AS n_used,
(SELECT count(DISTINCT code) FROM codes WHERE code NOT IN (SELECT code FROM dictionary)) AS n_undocumented,
(SELECT count(*) FROM (SELECT code FROM codes UNION SELECT code FROM dictionary) u) AS n_union""")
def code_census_check(s: Sample) -> DataFrame:
    return audit.code_census(split_codes(s.typed_codes(), "chars", 6), s.dictionary())


@check("code_union", with_ctes("codes", "dictionary") + "SELECT code FROM codes UNION SELECT code FROM dictionary")
def code_union_check(s: Sample) -> DataFrame:
    return diff.code_union(split_codes(s.typed_codes(), "chars", 6), s.dictionary())


@check("frequency_order", with_ctes("codes") + "SELECT code, count(*) AS n FROM codes GROUP BY code ORDER BY n DESC, code")
def frequency_order_check(s: Sample) -> DataFrame:
    counts = split_codes(s.typed_codes(), "chars", 6).groupBy("code").agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "code")


@check("dimension_gaps", with_ctes("codes", "dictionary") + """
SELECT code, 'missing' AS gap FROM (SELECT code FROM codes EXCEPT SELECT code FROM dictionary) a
UNION ALL SELECT code, 'unused' FROM (SELECT code FROM dictionary EXCEPT SELECT code FROM codes) b""")
def dimension_gaps_check(s: Sample) -> DataFrame:
    used = split_codes(s.typed_codes(), "chars", 6)
    return audit.dimension_gaps(used, s.dictionary(), "code")


# --- rules --------------------------------------------------------------------------------------
def rules_of(s: Sample) -> DataFrame:
    lookup = s.lookup()
    parts = [
        ru.rules_from_lookup(lookup.where(F.col("lut") == lut), version="F", damage_type=kind, zone=zone,
                             row_key="row_no", note=COASTAL_NOTE, peril="li")
        for kind, zone, lut in LOOKUPS
    ]
    parts.append(ru.rules_from_flags(s.final(), s.crosswalk(), version="O", damage_type="A", id_column="BldgDmgFnId",
                                     note=COASTAL_NOTE, peril="li", flags=FLAGS))
    return ru.assignment_rules(parts)


@check("assignment_rules", with_ctes("rules") + "SELECT * FROM rules")
def assignment_rules_check(s: Sample) -> DataFrame:
    return rules_of(s)


@check("rules_crosswalk", with_ctes("final", "crosswalk") + """
SELECT f.class_id AS SOccupId, fn_id, c.occupancy AS Occupancy, c.stories AS NumStories, c.basement AS Basement FROM final f LEFT JOIN crosswalk c ON c.class_id = f.class_id""")
def rules_crosswalk_check(s: Sample) -> DataFrame:
    joined = ru.rules_crosswalk(s.final(), s.crosswalk())
    return joined.select("SOccupId", F.col("BldgDmgFnId").cast("bigint").cast("string").alias("fn_id"), "Occupancy", "NumStories", "Basement")


@check("zone_applicability", with_ctes("zones") + "SELECT curve_id, flood_zone, source_file, source_table FROM zones")
def zone_applicability_check(s: Sample) -> DataFrame:
    return zones_of(s)


@check("restrict_kinds", with_ctes("kinds", "curves") + "SELECT * FROM kinds WHERE peril IN (SELECT peril FROM curves)")
def restrict_kinds_check(s: Sample) -> DataFrame:
    return ru.restrict_kinds(s.kinds(), s.curves())


# --- text ---------------------------------------------------------------------------------------
# Statements looked for, (key, document, pattern).
CLAIMS = [
    ("license", "src0", r"licensed\s+under"),
    ("mail", "src1", r"[a-z0-9.]+@[a-z0-9]+"),
    ("phrase", "src2", r"the\s+of"),
    ("phrase_de", "src5", r"nicht\s+\w+"),
    ("absent", "src3", r"no such sentence anywhere"),
]


def page_text(s: Sample) -> DataFrame:
    """Documents as pages of their source, below a printed page header."""
    header = F.concat(F.lit("Page "), F.upper(F.substr("lang", F.lit(1), F.lit(1))), F.lit("-"), F.col("doc_id").cast("string"), F.lit("\n"))
    return s.table("documents").select(F.col("source").alias("doc"), F.col("doc_id").alias("page"), F.concat(header, "text").alias("text"))


FLAT = r"trim(regexp_replace(text, '[\s\x{b}\x{1c}-\x{1f}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+', ' ', 'g'))"
PAGES = "WITH pages_text AS (SELECT source AS doc, doc_id AS page, 'Page ' || upper(substr(lang, 1, 1)) || '-' || CAST(doc_id AS VARCHAR) || chr(10) || text AS text FROM documents), flat AS (SELECT doc, page, " + FLAT + " AS flat FROM pages_text)\n"


@check("find_evidence", PAGES + "SELECT key, doc, page IS NOT NULL AS found, page, CASE WHEN page IS NOT NULL THEN "
       "(SELECT upper(substr(lang, 1, 1)) || '-' || CAST(doc_id AS VARCHAR) FROM documents WHERE doc_id = page) END AS printed_page, "
       "quote FROM (" + " UNION ALL ".join(
    f"SELECT '{k}' AS key, '{d}' AS doc, (SELECT min(page) FROM flat WHERE doc = '{d}' AND regexp_matches(flat, '{p}', 'is')) AS page, "
    f"(SELECT trim(regexp_extract(flat, '([^.]*?(?:{p})(?:[^.]*\\.)?)', 1, 'is')) FROM flat WHERE doc = '{d}' AND regexp_matches(flat, '{p}', 'is') ORDER BY page LIMIT 1) AS quote"
    for k, d, p in CLAIMS) + ") t")
def find_evidence_check(s: Sample) -> DataFrame:
    return evidence.find_evidence(page_text(s), CLAIMS)


@check("printed_label", "SELECT doc_id AS page, upper(substr(lang, 1, 1)) || '-' || CAST(doc_id AS VARCHAR) AS label FROM documents")
def printed_label_check(s: Sample) -> DataFrame:
    return page_text(s).select("page", printed_label(F.col("text"), PAGE_LABEL_PATTERN).alias("label"))


LINK = '<a href="/([^"]*)">([^<]*)</a>'


def code_pages(s: Sample) -> DataFrame:
    """The navigation links of a page as the lines of a code table, ten pages a document.

    Every tenth page of a document opens the table; the last ones show rows of the next table.
    """
    links = F.arrays_zip(
        F.regexp_extract_all("html", F.lit(LINK), F.lit(1)).alias("code"),
        F.regexp_extract_all("html", F.lit(LINK), F.lit(2)).alias("label"))
    lines = F.transform(links, lambda link, i: F.concat(
        F.format_string("%02d", (i + 1).cast("int")), F.lit("_"), link["code"], F.lit("  "),
        F.when((F.col("page_id") % 10 == 7) & (i == 3), F.lit("01-")).otherwise(F.lit("")), F.upper(link["label"]), F.lit("  x ")))
    head = F.when(F.col("page_id") % 10 == 2, F.lit("List of codes\n")).otherwise(F.lit("\n"))
    return s.table("pages").select(
        F.concat(F.lit("doc"), (F.col("page_id") / 10).cast("int").cast("string")).alias("doc"),
        F.col("page_id").alias("page"),
        F.concat(head, F.array_join(lines, "\n")).alias("text"))


@check("extract_code_table", r"""
WITH link AS (SELECT page_id, unnest(regexp_extract_all(html, '<a href="/([^"]*)">([^<]*)</a>', 1)) AS code, unnest(regexp_extract_all(html, '<a href="/([^"]*)">([^<]*)</a>', 2)) AS label,
unnest(range(len(regexp_extract_all(html, '<a href="/([^"]*)">([^<]*)</a>', 1)))) AS i FROM pages),
rows_ AS (SELECT 'doc' || CAST(page_id // 10 AS VARCHAR) AS doc, page_id AS page, i AS pos, code, CASE WHEN page_id % 10 = 7 AND i = 3 THEN '01-' ELSE '' END || upper(label) || ' x' AS description
FROM link WHERE regexp_full_match(code, '[A-Za-z0-9]+') AND page_id % 10 >= 2 AND i < 99),
next_table AS (SELECT doc, min(page * 1000 + pos) AS stop FROM rows_ WHERE regexp_matches(description, '^\d{1,2}-') GROUP BY doc),
first_page AS (SELECT doc, min(page) AS page FROM rows_ WHERE NOT regexp_matches(description, '^\d{1,2}-') GROUP BY doc),
blank AS (SELECT f.doc, min(p.page_id) AS page FROM first_page f JOIN pages p ON 'doc' || CAST(p.page_id // 10 AS VARCHAR) = f.doc AND p.page_id > f.page
WHERE p.page_id NOT IN (SELECT page FROM rows_) GROUP BY f.doc)
SELECT r.doc, r.code, min(description) AS description, count(DISTINCT description) AS n_descriptions FROM rows_ r LEFT JOIN next_table n ON n.doc = r.doc LEFT JOIN blank b ON b.doc = r.doc
WHERE (stop IS NULL OR r.page * 1000 + pos < stop) AND (b.page IS NULL OR r.page < b.page) GROUP BY r.doc, r.code""")
def extract_code_table_check(s: Sample) -> DataFrame:
    return evidence.extract_code_table(code_pages(s), header="List of codes")
