"""Checks of filters, joins, labels, aggregates and orderings."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from curveloom.checks.registry import check
from curveloom.checks.sample import (
    COASTAL_NOTE, DEFECT_NOTE, DEFECT_TYPES, FLAGS, Sample, with_ctes,
)
from curveloom.functions.literal import literal_frame
from curveloom.operators import aggregate as ag, filters as fl, value_index as vi
from curveloom.operators.lookup import curve_points_join, order_points
from curveloom.operators.reshape import decompose_cases
from curveloom.operators.rules import zone_applicability, zone_rows
from curveloom.plans.search import search
from curveloom.sources.writers import fresh_path


def r9(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 9) for c in columns})


def zones_of(s: Sample) -> DataFrame:
    return zone_applicability([
        zone_rows(s.lookup(), version="F", damage_type="A", id_column="DDF_ID", flags=FLAGS, peril="li"),
        zone_rows(s.final(), version="O", damage_type="A", id_column="BldgDmgFnId", flags=FLAGS, peril="li"),
    ])


# --- filters ------------------------------------------------------------------------------------
@check("filter_curves", with_ctes("curves") + """
SELECT * FROM curves WHERE peril = 'li' AND damage_type = 'A' AND occupancy = 'Brand#4' ORDER BY curve_id""")
def filter_curves_check(s: Sample) -> DataFrame:
    return fl.filter_curves(s.curves(), peril="li", damage_type="A", occupancy="Brand#4", version=None, limit=0)


@check("flag_filters", with_ctes("curves") + """
SELECT curve_id, CASE WHEN defect_flag IS NULL THEN 'clear' ELSE 'flagged' END AS flag FROM curves""")
def flag_filters_check(s: Sample) -> DataFrame:
    curves = s.curves().select("curve_id", "defect_flag")
    tagged = [fl.flagged(curves).withColumn("flag", F.lit("flagged")), fl.unflagged(curves).withColumn("flag", F.lit("clear"))]
    return tagged[0].unionByName(tagged[1]).drop("defect_flag")


@check("like_filter", with_ctes("curves") + """
SELECT curve_id, description FROM curves WHERE description LIKE 'red%' OR description LIKE '%gear'""")
def like_filter_check(s: Sample) -> DataFrame:
    return fl.like_filter(s.curves(), "description", ["red%", "%gear"]).select("curve_id", "description")


@check("attribute_filter", with_ctes("curves", "attributes") + """
SELECT c.curve_id, c.version, c.damage_type FROM curves c
WHERE EXISTS (SELECT 1 FROM attributes a WHERE a.curve_id = c.curve_id AND a.key = 'brand' AND a.value = 'Brand#4')
AND EXISTS (SELECT 1 FROM attributes a WHERE a.curve_id = c.curve_id AND a.key = 'type' AND a.value = 'SMALL')""")
def attribute_filter_check(s: Sample) -> DataFrame:
    kept = fl.attribute_filter(s.curves(), s.attributes(), [("brand", "Brand#4"), ("type", "SMALL")])
    return kept.select("curve_id", "version", "damage_type")


@check("territory_filter", with_ctes("curves", "attributes", "cases") + """
SELECT c.curve_id, c.building_type FROM curves c WHERE EXISTS (SELECT 1 FROM attributes a JOIN cases t ON t.case_name = a.value
WHERE a.curve_id = c.curve_id AND a.key = 'geographic_case' AND t.territory = 'Hawaii')""")
def territory_filter_check(s: Sample) -> DataFrame:
    cases = decompose_cases(s.case_rows())
    return fl.territory_filter(s.curves(), s.attributes(), cases, "Hawaii").select("curve_id", "building_type")


def value_index(s: Sample) -> tuple[DataFrame, DataFrame]:
    """Index of the attributes, and the curve numbers, written to the shared folder."""
    numbers = vi.curve_numbers(s.curve_keys(), fresh_path(s.spark, "numbers"))
    return vi.write_value_index(numbers, s.attributes(), fresh_path(s.spark, "index")), numbers


def every_filter(s: Sample) -> DataFrame:
    """One filter for each brand and part type of the table, and for each brand in Hawaii."""
    parts = s.table("part").select("p_brand", "p_type").distinct()
    typed = F.concat_ws("/", "p_brand", "p_type").alias("filter_id")
    hawaii = F.concat(F.col("p_brand"), F.lit("/Hawaii")).alias("filter_id")
    row = lambda filter_id, n, key, value: (filter_id, F.lit(n).alias("condition"), F.lit(key).alias("key"), value.alias("value"))
    cases = decompose_cases(s.case_rows()).where("territory = 'Hawaii'").agg(F.collect_set("case_name")).scalar()
    covered = parts.select("p_brand").distinct().select("p_brand", F.explode(cases).alias("case_name"))
    return (
        parts.select(*row(typed, 0, "brand", F.col("p_brand")))
        .unionByName(parts.select(*row(typed, 1, "type", F.col("p_type"))))
        .unionByName(parts.select(*row(hawaii, 0, "brand", F.col("p_brand"))))
        .unionByName(covered.select(*row(hawaii, 1, "geographic_case", F.col("case_name"))))
    )


FILTERED = with_ctes("attributes", "cases") + """
, brands AS (SELECT curve_id, value AS brand FROM attributes WHERE key = 'brand'),
hits AS (SELECT brand || '/' || a.value AS filter_id, b.curve_id FROM brands b JOIN attributes a ON a.curve_id = b.curve_id AND a.key = 'type'
UNION SELECT brand || '/Hawaii', b.curve_id FROM brands b JOIN attributes a ON a.curve_id = b.curve_id AND a.key = 'geographic_case'
JOIN cases t ON t.case_name = a.value AND t.territory = 'Hawaii')
"""


@check("indexed_counts", FILTERED + """
SELECT f.filter_id, count(h.curve_id) AS n_curves FROM (SELECT p_brand || '/' || p_type AS filter_id FROM part UNION SELECT p_brand || '/Hawaii' FROM part) f
LEFT JOIN hits h ON h.filter_id = f.filter_id GROUP BY f.filter_id""")
def indexed_counts_check(s: Sample) -> DataFrame:
    return vi.filter_counts(value_index(s)[0], every_filter(s))


@check("indexed_members", FILTERED + "SELECT filter_id, curve_id FROM hits")
def indexed_members_check(s: Sample) -> DataFrame:
    index, numbers = value_index(s)
    return vi.filter_members(index, numbers, every_filter(s))


@check("zone_filter", with_ctes("curves", "zones") + """
SELECT c.curve_id, c.occupancy FROM curves c JOIN (SELECT DISTINCT curve_id FROM zones WHERE flood_zone = 'CoastalA') z ON z.curve_id = c.curve_id""")
def zone_filter_check(s: Sample) -> DataFrame:
    return fl.zone_filter(s.curves(), zones_of(s), "CoastalA").select("curve_id", "occupancy")


@check("defect_flag", f"""
SELECT p_partkey, p_type, CASE WHEN p_type IN ('SMALL', 'MEDIUM') THEN '{DEFECT_NOTE}' END AS defect_flag FROM part""")
def defect_flag_check(s: Sample) -> DataFrame:
    return s.table("part").select("p_partkey", "p_type", fl.defect_flag(F.col("p_type"), DEFECT_NOTE, DEFECT_TYPES).alias("defect_flag"))


@check("annotate_coastal", with_ctes("zones") + f"""
SELECT curve_id, flood_zone, CASE WHEN flood_zone IN ('CoastalA', 'CoastalV') THEN '{COASTAL_NOTE}' END AS notes FROM zones""")
def annotate_coastal_check(s: Sample) -> DataFrame:
    return zones_of(s).select("curve_id", "flood_zone", fl.annotate_coastal(F.col("flood_zone"), COASTAL_NOTE).alias("notes"))


# --- labels and domains -------------------------------------------------------------------------
@check("display_label", with_ctes("attributes") + """
SELECT curve_id, key, value, CASE WHEN key = 'type' AND value = 'PROMO' THEN 'Promotional' WHEN key = 'brand' AND value = 'Brand#4' THEN 'Fourth brand' ELSE value END AS label FROM attributes""")
def display_label_check(s: Sample) -> DataFrame:
    labels = literal_frame(s.spark,
        [("type", "PROMO", "Promotional"), ("brand", "Brand#4", "Fourth brand"), ("type", "Brand#4", "never")],
        "key string, value string, label string")
    return fl.display_label(s.attributes(), labels).select("curve_id", "key", "value", "label")


@check("plain_label", """
SELECT p_partkey, replace(rpad(p_brand, 10, '_'), '_', ' ') AS plain, p_brand || CASE WHEN p_size > 10 THEN ' — ' || p_name ELSE '' END AS described FROM part""")
def plain_label_check(s: Sample) -> DataFrame:
    description = F.when(F.col("p_size") > 10, F.col("p_name"))
    return s.table("part").select(
        "p_partkey", fl.plain_label(F.rpad("p_brand", 10, "_")).alias("plain"), fl.code_label(F.col("p_brand"), description).alias("described"))


@check("axis_labels", with_ctes("ckeys", "kinds") + """
SELECT DISTINCT 'li' AS peril, c.damage_type, x_units, coalesce(y_units, 'mixed') AS y_units, 'Bin' AS x_label,
CASE c.damage_type WHEN 'A' THEN 'Average quantity' ELSE 'Value (units vary by damage type)' END AS y_label
FROM ckeys c LEFT JOIN kinds k ON k.peril = 'li' AND k.damage_type = c.damage_type""")
def axis_labels_check(s: Sample) -> DataFrame:
    types = s.curves().select("peril", "damage_type").distinct()
    return fl.axis_labels(types, s.kinds(), {"A": "Average quantity"}, {"li": "Bin"})


@check("default_filters", with_ctes("curves") + """
SELECT key, value FROM (VALUES ('occupancy', 'Brand#4'), ('building_type', 'HUGE'), ('version', 'F')) AS d(key, value)
WHERE (key = 'occupancy' AND value IN (SELECT occupancy FROM curves)) OR (key = 'building_type' AND value IN (SELECT building_type FROM curves))
OR (key = 'version' AND value IN (SELECT version FROM curves))""")
def default_filters_check(s: Sample) -> DataFrame:
    defaults = literal_frame(s.spark,
        [("occupancy", "Brand#4"), ("building_type", "HUGE"), ("version", "F")], "key string, value string")
    return fl.default_filters(fl.domain_values(s.curves(), ["occupancy", "building_type", "version"]), defaults)


@check("domain_values", with_ctes("curves") + """
SELECT DISTINCT 'occupancy' AS key, occupancy AS value FROM curves UNION SELECT DISTINCT 'source_agency', source_agency FROM curves
UNION SELECT 'defect_flag', defect_flag FROM curves WHERE defect_flag IS NOT NULL""")
def domain_values_check(s: Sample) -> DataFrame:
    return fl.domain_values(s.curves(), ["occupancy", "source_agency", "defect_flag"])


@check("attribute_domain", with_ctes("attributes") + "SELECT DISTINCT key, value FROM attributes WHERE value IS NOT NULL")
def attribute_domain_check(s: Sample) -> DataFrame:
    return fl.attribute_domain(s.attributes())


@check("describe_dimension", with_ctes("curves") + """
SELECT DISTINCT c.occupancy, d.description FROM curves c LEFT JOIN (SELECT p_brand AS occupancy, min(p_name) AS description FROM part
WHERE p_brand <> 'Brand#9' GROUP BY p_brand) d ON d.occupancy = c.occupancy ORDER BY d.description NULLS LAST, c.occupancy""")
def describe_dimension_check(s: Sample) -> DataFrame:
    dim = s.table("part").where("p_brand <> 'Brand#9'").groupBy(F.col("p_brand").alias("occupancy")).agg(F.min("p_name").alias("description"))
    return fl.describe_dimension(s.curves(), dim, "occupancy")


@check("present_dimension", with_ctes("curves") + """
SELECT occupancy, n FROM (SELECT CASE WHEN p_size = 1 THEN 'None' ELSE p_brand END AS occupancy, count(*) AS n FROM part GROUP BY 1) d
WHERE EXISTS (SELECT 1 FROM curves c WHERE c.occupancy = d.occupancy) ORDER BY occupancy""")
def present_dimension_check(s: Sample) -> DataFrame:
    brand = F.when(F.col("p_size") == 1, "None").otherwise(F.col("p_brand")).alias("occupancy")
    dim = s.table("part").groupBy(brand).agg(F.count(F.lit(1)).alias("n"))
    return fl.present_dimension(dim, s.curves(), "occupancy")


@check("priority_order", with_ctes("attributes") + """
SELECT DISTINCT key, CASE key WHEN 'type' THEN 0 WHEN 'brand' THEN 1 ELSE 2 END AS rank FROM attributes WHERE key <> 'geographic_case' ORDER BY rank, key""")
def priority_order_check(s: Sample) -> DataFrame:
    return fl.priority_order(s.attributes(), ["type", "brand"], ["geographic_case"])


# --- joins and orderings ------------------------------------------------------------------------
@check("curve_points_join", with_ctes("points7", "curves") + """
SELECT p.curve_id, x, y, version, source_table, damage_type FROM points7 p JOIN curves c ON c.curve_id = p.curve_id ORDER BY p.curve_id, x""")
def curve_points_join_check(s: Sample) -> DataFrame:
    return order_points(curve_points_join(s.points7(), s.curves(), ["version", "source_table", "damage_type"]))


@check("order_points", with_ctes("points3") + "SELECT curve_id, x, y FROM points3 ORDER BY curve_id, x")
def order_points_check(s: Sample) -> DataFrame:
    return order_points(s.points3())


@check("limit_rows", with_ctes("curves") + "SELECT curve_id, occupancy FROM curves ORDER BY curve_id LIMIT 5")
def limit_rows_check(s: Sample) -> DataFrame:
    return fl.filter_curves(s.curves().select("curve_id", "occupancy"), limit=5)


@check("default_curve", with_ctes("rules", "exposures") + """
SELECT exposure_id AS request_id, r.rule_id, r.curve_id FROM (SELECT exposure_id, 'Brand#' || CAST(exposure_id % 25 + 1 AS VARCHAR) AS occupancy,
CAST(exposure_id % 3 + 1 AS VARCHAR) AS stories FROM exposures) q LEFT JOIN (
SELECT *, coalesce(trim(stories), '') AS floors, row_number() OVER (PARTITION BY version, damage_type, occupancy, flood_zone,
coalesce(trim(stories), ''), coalesce(trim(basement), '') ORDER BY rule_id, curve_id) AS rn FROM rules) r ON r.rn = 1 AND r.version = 'O' AND r.damage_type = 'A'
AND r.occupancy = q.occupancy AND r.flood_zone = 'Riverine' AND r.floors = q.stories AND coalesce(trim(r.basement), '') = ''""")
def default_curve_check(s: Sample) -> DataFrame:
    from curveloom.checks.audit_checks import rules_of

    requests = s.exposures().select(
        F.col("exposure_id").alias("request_id"), F.lit("O").alias("version"), F.lit("A").alias("damage_type"),
        F.concat(F.lit("Brand#"), (F.col("exposure_id") % 25 + 1).cast("string")).alias("occupancy"),
        F.lit("Riverine").alias("flood_zone"), (F.col("exposure_id") % 3 + 1).cast("string").alias("stories"),
        F.lit(None).cast("string").alias("basement"))
    return fl.default_curve(rules_of(s), requests).select("request_id", "rule_id", "curve_id")


# --- aggregates ---------------------------------------------------------------------------------
@check("inventory_counts", with_ctes("curves") + "SELECT peril, version, damage_type, count(*) AS n FROM curves GROUP BY peril, version, damage_type")
def inventory_counts_check(s: Sample) -> DataFrame:
    return ag.inventory_counts(s.curves())


@check("totals", with_ctes("points7", "curves") + """
SELECT count(*) AS n_curves, (SELECT count(*) FROM points7) AS n_points, count(defect_flag) AS n_flagged FROM curves""")
def totals_check(s: Sample) -> DataFrame:
    return ag.totals(s.curves(), s.points7())


@check("count_matches", with_ctes("curves") + "SELECT count(DISTINCT curve_id) AS n FROM curves WHERE damage_type = 'R' AND occupancy = 'Brand#2'")
def count_matches_check(s: Sample) -> DataFrame:
    return ag.count_matches(s.curves().where("damage_type = 'R' AND occupancy = 'Brand#2'"))


@check("unit_guard", with_ctes("curves", "kinds") + """
SELECT count(*) AS n_curves, count(DISTINCT c.damage_type) AS n_damage_types, count(DISTINCT coalesce(y_units, 'mixed')) AS n_units, 'heterogeneous' AS status
FROM curves c LEFT JOIN kinds k ON k.peril = c.peril AND k.damage_type = c.damage_type""")
def unit_guard_check(s: Sample) -> DataFrame:
    return ag.unit_guard(s.curves(), s.kinds())


AVERAGE = """round(sum(y) / nullif(count(y), 0), 9) AS y_mean, round(stddev_pop(y), 9) AS y_std, min(y) AS y_min, max(y) AS y_max, count(y) AS n_at_x"""


@check("average_curve", with_ctes("points7", "curves") + f"""
SELECT damage_type, x, {AVERAGE} FROM points7 p JOIN curves c ON c.curve_id = p.curve_id GROUP BY damage_type, x""")
def average_curve_check(s: Sample) -> DataFrame:
    typed = curve_points_join(s.points7(), s.curves(), ["damage_type"])
    return r9(ag.average_curve(typed, ["damage_type"]), "y_mean", "y_std")


@check("constituents", with_ctes("curves") + """
SELECT coalesce(damage_type, '') || '/' || coalesce(occupancy, '') AS derived_id, damage_type, occupancy, curve_id FROM curves""")
def constituents_check(s: Sample) -> DataFrame:
    return ag.constituents(s.curves(), ["damage_type", "occupancy"])


@check("constituent_lists", with_ctes("curves") + """
SELECT damage_type, occupancy, n_constituents, page, string_agg(curve_id, '|' ORDER BY curve_id) AS constituent_curve_ids
FROM (SELECT *, ('0x' || substr(md5(curve_id), 1, 8))::BIGINT % CAST(ceil(n_constituents / 20) AS BIGINT) AS page
FROM (SELECT damage_type, occupancy, curve_id, count(*) OVER (PARTITION BY damage_type, occupancy) AS n_constituents FROM curves))
GROUP BY damage_type, occupancy, n_constituents, page""")
def constituent_lists_check(s: Sample) -> DataFrame:
    return ag.constituent_lists(s.curves(), ["damage_type", "occupancy"], page_ids=20)


@check("derived_rows", with_ctes("points7", "curves") + f"""
SELECT 'DERIVED' AS curve_id, 'DERIVED — not a published curve' AS label, coalesce(dt, '') || '/' || coalesce(a.occupancy, '') AS derived_id, a.occupancy, n_constituents, x, y_mean, y_std, y_min, y_max, n_at_x,
version, source_table, damage_type, 'multiple — see constituents' AS source_agency, CASE WHEN any_defect THEN 'see constituent curves' ELSE '' END AS defect_flag
FROM (SELECT damage_type, occupancy, x, {AVERAGE} FROM points7 p JOIN curves c ON c.curve_id = p.curve_id GROUP BY damage_type, occupancy, x) a
JOIN (SELECT damage_type AS dt, occupancy, count(*) AS n_constituents,
arg_min(version, curve_id) AS version, arg_min(source_table, curve_id) AS source_table,
bool_or(defect_flag IS NOT NULL) AS any_defect FROM curves GROUP BY damage_type, occupancy) f ON f.occupancy = a.occupancy AND f.dt = a.damage_type""")
def derived_rows_check(s: Sample) -> DataFrame:
    return r9(ag.derived_rows(s.curves(), s.points7(), ["damage_type", "occupancy"]), "y_mean", "y_std")


@check("search", with_ctes("points7", "curves", "attributes", "cases") + """
SELECT 'DERIVED' AS curve_id, 'A' AS damage_type, x, round(sum(y) / nullif(count(y), 0), 9) AS y, round(stddev_pop(y), 9) AS y_std, min(y) AS y_min, max(y) AS y_max, count(y) AS n_at_x
FROM points7 p JOIN curves c ON c.curve_id = p.curve_id WHERE c.damage_type = 'A' AND c.version = 'F'
AND EXISTS (SELECT 1 FROM attributes a JOIN cases t ON t.case_name = a.value WHERE a.curve_id = c.curve_id AND a.key = 'geographic_case' AND t.territory = 'CONUS')
AND EXISTS (SELECT 1 FROM attributes a WHERE a.curve_id = c.curve_id AND a.key = 'brand' AND a.value = 'Brand#4') GROUP BY x""")
def search_check(s: Sample) -> DataFrame:
    result = search(
        s.curves(), s.points7(), s.kinds(), s.attributes(), decompose_cases(s.case_rows()),
        equals={"damage_type": "A", "version": "F", "occupancy": None}, territory="CONUS", pairs=[("brand", "Brand#4")])
    return r9(result.rows(), "y", "y_std")


@check("search_zone", with_ctes("points7", "curves", "zones") + """
SELECT 'DERIVED' AS curve_id, 'A' AS damage_type, x, round(sum(y) / nullif(count(y), 0), 9) AS y, round(stddev_pop(y), 9) AS y_std, min(y) AS y_min, max(y) AS y_max, count(y) AS n_at_x
FROM points7 p JOIN curves c ON c.curve_id = p.curve_id WHERE c.damage_type = 'A' AND c.curve_id IN (SELECT curve_id FROM zones WHERE flood_zone = 'Riverine') GROUP BY x""")
def search_zone(s: Sample) -> DataFrame:
    result = search(s.curves(), s.points7(), s.kinds(), applicability=zones_of(s), equals={"damage_type": "A"}, zone="Riverine")
    return r9(result.rows(), "y", "y_std")


@check("search_single", with_ctes("points7") + """
SELECT curve_id, 'A' AS damage_type, x, y, CAST(NULL AS DOUBLE) AS y_std, y AS y_min, y AS y_max, count(y) AS n_at_x FROM points7
WHERE curve_id = 'li-F-A-7' GROUP BY curve_id, x, y""")
def search_single(s: Sample) -> DataFrame:
    return search(s.curves(), s.points7(), s.kinds(), equals={"curve_id": "li-F-A-7"}).rows()


@check("cases_per_territory", with_ctes("cases") + "SELECT territory, count(*) AS n_cases FROM cases GROUP BY territory")
def cases_per_territory_check(s: Sample) -> DataFrame:
    return ag.cases_per_territory(decompose_cases(s.case_rows()))


@check("multi_value_groups", with_ctes("cases") + "SELECT case_name, count(*) AS n FROM cases GROUP BY case_name HAVING count(*) > 1")
def multi_value_groups_check(s: Sample) -> DataFrame:
    return ag.multi_value_groups(decompose_cases(s.case_rows()), ["case_name"])


@check("lut_census", with_ctes("lookup") + """
SELECT lut, count(*) AS n_rows, count(DISTINCT fn_id) AS n_curve_ids, """ + ", ".join(
    f"count(CASE WHEN {c} = '1' THEN 1 END) AS n_{z.lower()}" for z, c in FLAGS.items()) + " FROM lookup GROUP BY lut")
def lut_census_check(s: Sample) -> DataFrame:
    lut = s.lookup()
    numbers = lut.withColumns({c: F.expr(f"try_cast({c} AS int)") for c in FLAGS.values()})
    return ag.lut_census(numbers, "lut", "DDF_ID", FLAGS)


@check("any_true", """
SELECT l_partkey, bool_or(l_quantity > 49) AS any_match, count(CASE WHEN l_returnflag = 'R' THEN 1 END) > 0 AS has_counterpart FROM lineitem GROUP BY l_partkey""")
def any_true_check(s: Sample) -> DataFrame:
    rows = s.table("lineitem").withColumn("returned", F.when(F.col("l_returnflag") == "R", F.col("l_orderkey")))
    return ag.any_true(rows, ["l_partkey"], "l_quantity > 49", "returned")
