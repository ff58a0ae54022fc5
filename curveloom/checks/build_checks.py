"""Checks of sources, schema contracts, cleaning functions and reshaping."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from curveloom.checks.registry import check
from curveloom.checks.sample import DEFECT_NOTE, FLAGS, GRID7, UNDOCUMENTED_WORDS, Sample, with_ctes
from curveloom.fixed_values import BLANKS
from curveloom.functions import text as tx
from curveloom.functions.axis import axis_value
from curveloom.operators import contracts, reshape
from curveloom.operators.filters import classify
from curveloom.plans.library import melt_wide_table, melt_wind_table
from curveloom.schema import TABLES, conform, not_null_violations, pk_violations
from curveloom.sources import readers, writers
from curveloom.sources.catalog import read_tables
from curveloom.sources.manifest import by_name, manifest_check, sources_for
from curveloom.streaming.append import append_batches

MEASURES7 = [f"p{k}" for k in range(1, 8)]
SQL_BLANKS = "".join(f"\\x{{{ord(c):x}}}" for c in BLANKS)


# --- sources and sinks --------------------------------------------------------------------------
def _wide_text(s: Sample, missing: str = "NULL") -> DataFrame:
    """lib7 as a text source table with an id column and NULL tokens."""
    return s.wide7().select(
        F.concat_ws("-", "version", "damage_type", F.col("partkey").cast("string")).alias("BldgDmgFnID"),
        F.lit("agency ").alias("Source"),
        F.concat(F.lit("Curve of part, "), F.col("partkey").cast("string")).alias("Description"),
        F.when(F.col("partkey") % 2 == 0, "even").otherwise(missing).alias("Comment"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(missing)).alias(c) for c in MEASURES7],
    )


SOURCE_KEY = "'li-4.0-lines-' || substr(curve_id, 4) AS curve_id"


ROLES = {
    "BldgDmgFnID": "source_row_id",
    "Source": "source_agency",
    "Description": "description",
    "Comment": "attr:comment",
}


def _melted(s: Sample) -> dict[str, DataFrame]:
    path = writers.fresh_path(s.spark, "wide-csv")
    writers.export_rows(_wide_text(s), path, "csv")
    wide = readers.read_wide_csv(s.spark, path)
    return melt_wide_table(wide, ROLES, GRID7, peril="li", version="4.0", damage_type="lines",
                           source_file="lines.csv", source_table="lines")


@check("read_wide_csv", with_ctes("points7") + f"SELECT {SOURCE_KEY}, x, y FROM points7")
def read_wide_csv(s: Sample) -> DataFrame:
    return _melted(s)["curve_points"]


@check("read_typed_csv", with_ctes("points7") + "SELECT curve_id, x, y FROM points7")
def read_typed_csv(s: Sample) -> DataFrame:
    path = writers.fresh_path(s.spark, "points-csv")
    writers.export_rows(s.points7(), path, "csv")
    return readers.read_typed_csv(s.spark, path, "curve_points")


@check("read_tables", "SELECT n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def read_tables_check(s: Sample) -> DataFrame:
    read_tables(s.spark, {f"lib_{n}": f"{s.sf_dir}/{n}.parquet" for n in ("nation", "region")})
    return s.spark.sql("SELECT n_name, r_name FROM lib_nation JOIN lib_region ON n_regionkey = r_regionkey")


@check("read_manifest", """
SELECT s_name AS source_file, 'supplier/' || CAST(s_suppkey AS VARCHAR) AS url, sha256(s_name) AS sha256,
s_suppkey * 10 AS bytes, CAST(s_nationkey AS VARCHAR) AS version FROM supplier""")
def read_manifest(s: Sample) -> DataFrame:
    """The supplier table as manifests of a thousand entries, each a JSON object keyed by file name."""
    entry = F.to_json(F.struct(
        F.concat(F.lit("supplier/"), F.col("s_suppkey").cast("string")).alias("url"),
        F.sha2("s_name", 256).alias("sha256"),
        (F.col("s_suppkey") * 10).alias("bytes"),
        F.col("s_nationkey").cast("string").alias("version"),
    ))
    member = F.concat(F.lit('"'), F.col("s_name"), F.lit('": '), entry)
    objects = s.table("supplier").groupBy(F.floor(F.col("s_suppkey") / 1000)).agg(
        F.concat(F.lit("{"), F.array_join(F.collect_list(member), ", "), F.lit("}")).alias("value")
    )
    path = writers.fresh_path(s.spark, "manifest")
    objects.select("value").write.option("lineSep", "\n").option("maxRecordsPerFile", 1).text(path)
    return readers.read_manifest(s.spark, path).select("source_file", "url", "sha256", "bytes", "version")


#: customers of one ledger file, so that the number of files grows with the table
BUNDLE = 16
BUNDLES_SQL = f"""
SELECT c_custkey // {BUNDLE} AS bundle, string_agg(c_custkey || ',' || c_name || chr(10), '' ORDER BY c_custkey) AS body
FROM customer GROUP BY 1"""


def _bundles(s: Sample) -> DataFrame:
    """(bundle, value): the lines of each run of customers, without the last line's end."""
    line = F.struct("c_custkey", F.concat_ws(",", "c_custkey", "c_name").alias("line"))
    lines = F.sort_array(F.collect_list(line))  # of at most BUNDLE customers
    bundle = F.floor(F.col("c_custkey") / BUNDLE).alias("bundle")
    return s.table("customer").groupBy(bundle).agg(F.concat_ws("\n", F.transform(lines, lambda x: x["line"])).alias("value"))


def _bundle_digests(s: Sample) -> DataFrame:
    """Digests of one text file per bundle of customers."""
    path = writers.fresh_path(s.spark, "bundles")
    _bundles(s).write.partitionBy("bundle").text(path)
    files = readers.file_digests(s.spark, path).where(F.col("source_file").startswith("bundle="))
    return files.withColumn("source_file", F.regexp_extract("source_file", "^(bundle=[0-9]+)/", 1))


@check("file_digests", f"""
SELECT 'bundle=' || bundle AS source_file, strlen(body) AS bytes, sha256(body) AS sha256 FROM ({BUNDLES_SQL})""")
def file_digests(s: Sample) -> DataFrame:
    return _bundle_digests(s)


@check("file_row_counts", "SELECT c_mktsegment AS segment, count(*) AS n_rows FROM customer GROUP BY c_mktsegment")
def file_row_counts(s: Sample) -> DataFrame:
    path = writers.fresh_path(s.spark, "segments")
    rows = s.table("customer").select("c_mktsegment", F.concat_ws(",", "c_custkey", "c_name").alias("value"))
    rows.write.partitionBy("c_mktsegment").text(path)
    lines = readers.file_row_counts(s.spark, path)
    # a segment may be written as several files: add them up by the partition in their path
    segment = F.url_decode(F.regexp_extract("path", "c_mktsegment=([^/]*)/", 1)).alias("segment")
    return lines.groupBy(segment).agg(F.sum("n_rows").alias("n_rows"))


@check("write_clustered", with_ctes("points7") + "SELECT curve_id, x, y FROM points7")
def write_clustered(s: Sample) -> DataFrame:
    path = writers.fresh_path(s.spark, "clustered")
    writers.write_clustered(s.points7(), path, ["curve_id", "x"])
    return s.spark.read.parquet(path)


@check("write_tables", with_ctes("curves") + "SELECT * FROM curves")
def write_tables(s: Sample) -> DataFrame:
    root = writers.fresh_path(s.spark, "tables")
    writers.write_tables({"curves": s.curves(), "curve_kind": s.kinds()}, root)
    return s.spark.read.parquet(f"{root}/curves")


@check("rewrite_check", with_ctes("points7") + "SELECT count(*) AS n_before, count(*) AS n_after, true AS same FROM points7")
def rewrite_check(s: Sample) -> DataFrame:
    path = writers.fresh_path(s.spark, "rewrite")
    points = s.points7()
    writers.write_clustered(points, path, ["curve_id", "x"])
    return writers.rewrite_check(points, s.spark.read.parquet(path))


@check("export_rows", with_ctes("points7", "curves") + """
SELECT p.curve_id, x, y, version, source_table, source_agency, damage_type, defect_flag
FROM points7 p JOIN curves c ON c.curve_id = p.curve_id""")
def export_rows(s: Sample) -> DataFrame:
    path = writers.fresh_path(s.spark, "export")
    writers.export_rows(writers.point_rows(s.points7(), s.curves()), path, "csv")
    back = readers.read_wide_csv(s.spark, path)
    return back.select("curve_id", F.col("x").cast("double").alias("x"), F.col("y").cast("double").alias("y"),
                       "version", "source_table", "source_agency", "damage_type", "defect_flag")


@check("append_batches", with_ctes("points7") + f"SELECT {SOURCE_KEY}, x, y FROM points7")
def append_batches_check(s: Sample) -> DataFrame:
    source, target, state = (writers.fresh_path(s.spark, n) for n in ("batches-in", "batches-out", "batches-state"))
    wide = _wide_text(s)
    wide.repartition(4, "BldgDmgFnID").write.csv(source, header=True)
    query = append_batches(s.spark, source, target, state, wide.columns, "BldgDmgFnID", ["li", "4.0", "lines"], files_per_batch=2)
    query.awaitTermination()
    return s.spark.read.parquet(target)


@check("manifest_check", f"""
SELECT 'bundle=' || bundle AS source_file, strlen(body) AS bytes,
CASE bundle % 5 WHEN 0 THEN 'not in manifest' WHEN 1 THEN 'differs' ELSE 'ok' END AS status FROM ({BUNDLES_SQL})
UNION ALL SELECT 'gone/' || s_suppkey, NULL, 'missing' FROM supplier""")
def manifest_check_query(s: Sample) -> DataFrame:
    """A manifest of the bundles' files with some unlisted, some recorded otherwise, and suppliers that have no file."""
    recorded = F.when(F.col("bundle") % 5 == 1, F.lit("?")).otherwise(F.concat("value", F.lit("\n")))
    listed = _bundles(s).where("bundle % 5 != 0").select(
        F.concat(F.lit("bundle="), F.col("bundle").cast("string")).alias("source_file"), F.sha2(recorded, 256).alias("sha256")
    )
    gone = s.table("supplier").select(F.concat(F.lit("gone/"), F.col("s_suppkey").cast("string")).alias("source_file"), F.lit("").alias("sha256"))
    return manifest_check(listed.union(gone), _bundle_digests(s))


@check("sources_for", """
SELECT DISTINCT source AS source_file, CASE WHEN lang = 'en' THEN 'all' ELSE lang END AS peril
FROM documents WHERE lang IN ('en', 'fr')""")
def sources_for_check(s: Sample) -> DataFrame:
    declared = s.table("documents").select(
        F.col("source").alias("source_file"), F.when(F.col("lang") == "en", "all").otherwise(F.col("lang")).alias("peril")
    ).distinct()
    return sources_for(declared, ["fr"], known=["fr", "de", "es"])


@check("source_by_name", "SELECT DISTINCT source AS source_file, lang AS peril FROM documents WHERE source = 'src7'")
def source_by_name(s: Sample) -> DataFrame:
    declared = s.table("documents").select(F.col("source").alias("source_file"), F.col("lang").alias("peril")).distinct()
    return by_name(declared, "src7")


# --- schema contracts ---------------------------------------------------------------------------
@check("conform", with_ctes("ckeys") + """
SELECT curve_id, CAST(NULL AS VARCHAR) AS peril, version, damage_type, CAST(NULL AS VARCHAR) AS occupancy,
CAST(NULL AS VARCHAR) AS building_type, CAST(NULL AS VARCHAR) AS source_agency, CAST(NULL AS VARCHAR) AS description,
CAST(NULL AS VARCHAR) AS defect_flag, CAST(NULL AS VARCHAR) AS defect_verified, CAST(NULL AS VARCHAR) AS source_file,
CAST(NULL AS VARCHAR) AS source_table, CAST(NULL AS VARCHAR) AS source_row_id FROM ckeys""")
def conform_check(s: Sample) -> DataFrame:
    return conform(s.curve_keys(), TABLES["curves"])


@check("pk_violations", """
SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""")
def pk_violations_check(s: Sample) -> DataFrame:
    return pk_violations(s.table("lineitem"), ["l_orderkey", "l_linenumber"])


@check("not_null_violations", with_ctes("wide7") + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, count(*) - count({c}) AS n_null FROM wide7" for c in ["curve_id", *MEASURES7]))
def not_null_check(s: Sample) -> DataFrame:
    return not_null_violations(s.wide7(), ["curve_id", *MEASURES7])


ROLES7 = {"curve_id": "source_row_id", "version": "version", "damage_type": "damage_type"}
IGNORED7 = {"partkey": "part of curve_id"}


@check("column_accounting", with_ctes("wide7") + " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, '{role}' AS role, count(*) AS n_rows, count(*) - count({c}) AS n_null FROM wide7"
    for c, role in ({c: "measure" for c in MEASURES7} | ROLES7 | {c: f"ignored: {why}" for c, why in IGNORED7.items()}).items()))
def column_accounting_check(s: Sample) -> DataFrame:
    return contracts.column_usage(s.wide7(), ROLES7, IGNORED7)


@check("grid_completeness", with_ctes("points7") + """
SELECT curve_id, count(*) AS n_points, count(DISTINCT x) AS n_grid_values, CAST(0 AS BIGINT) AS n_off_grid
FROM points7 WHERE y IS NOT NULL GROUP BY curve_id HAVING count(*) <> 7""")
def grid_completeness_check(s: Sample) -> DataFrame:
    return contracts.grid_completeness(s.points7().where("y IS NOT NULL"), GRID7)


@check("expected_points", with_ctes("points7", "ckeys") + """
SELECT (SELECT count(*) FROM points7) AS n_points, count(*) * 7 AS n_expected, (SELECT count(*) FROM points7) = count(*) * 7 AS ok FROM ckeys""")
def expected_points_check(s: Sample) -> DataFrame:
    return contracts.expected_points(s.points7(), s.curve_keys(), 7)


# --- cleaning and parsing -----------------------------------------------------------------------
@check("clean_text", """
SELECT c_custkey, nullif(nullif(trim(CASE WHEN c_custkey % 5 = 0 THEN ' NULL ' WHEN c_custkey % 7 = 0 THEN '   ' ELSE ' ' || c_mktsegment || '  ' END), ''), 'NULL') AS segment
FROM customer""")
def clean_text_check(s: Sample) -> DataFrame:
    padded = F.when(F.col("c_custkey") % 5 == 0, " NULL ").when(F.col("c_custkey") % 7 == 0, "\t  ").otherwise(
        F.concat(F.lit(" \n"), "c_mktsegment", F.lit("\t ")))
    return s.table("customer").select("c_custkey", tx.clean_text(padded).alias("segment"))


@check("parse_measure", """
SELECT l_orderkey, l_linenumber, l_suppkey, l_partkey, CASE WHEN l_linenumber < 6 THEN l_quantity END AS y FROM lineitem""")
def parse_measure_check(s: Sample) -> DataFrame:
    text = F.when(F.col("l_linenumber") == 7, "NULL").when(F.col("l_linenumber") == 6, " ").otherwise(
        F.concat(F.lit(" "), F.col("l_quantity").cast("string"), F.lit(" ")))
    return s.table("lineitem").select(
        "l_orderkey", "l_linenumber", "l_suppkey", "l_partkey", tx.parse_measure(text, strict=True).alias("y"))


@check("numeric_coerce", """
SELECT event_id, CASE WHEN event_type = 'error' THEN NULL ELSE try_cast(regexp_extract(props, '([0-9]+)', 1) AS DOUBLE) END AS number
FROM events""")
def numeric_coerce_check(s: Sample) -> DataFrame:
    text = F.when(F.col("event_type") == "error", F.col("props")).otherwise(F.regexp_extract("props", "([0-9]+)", 1))
    return s.table("events").select("event_id", tx.numeric_coerce(text).alias("number"))


@check("axis_value", with_ctes("wide7") + " UNION ALL ".join(
    f"SELECT '{n}' AS column_name, CAST({v} AS DOUBLE) AS x, count(*) AS n FROM wide7"
    for n, v in (("m4", -4), ("p24", 24), ("ft04m", -4), ("ft01", 1), ("WS50", 50), ("Comment", "NULL"))))
def axis_value_check(s: Sample) -> DataFrame:
    """The name forms beside each curve, decoded as data."""
    names = F.array(*[F.lit(n) for n in ("m4", "p24", "ft04m", "ft01", "WS50", "Comment")])
    named = s.curve_keys().select(F.explode(names).alias("column_name"))
    return named.groupBy("column_name", axis_value(F.col("column_name")).alias("x")).agg(F.count(F.lit(1)).alias("n"))


@check("normalise_id", """SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS from_double, CAST(p_partkey AS VARCHAR) AS from_text, p_brand AS from_code,
'00' || p_partkey AS from_padded, p_partkey || 'e3' AS from_exponent, '9007199254740993' || p_partkey AS from_long FROM part""")
def normalise_id_check(s: Sample) -> DataFrame:
    return s.table("part").select(
        "p_partkey",
        tx.normalise_id(F.col("p_partkey").cast("double")).alias("from_double"),
        tx.normalise_id(F.concat(F.lit(" "), F.col("p_partkey").cast("string"), F.lit(".0 "))).alias("from_text"),
        tx.normalise_id(F.concat("p_brand", F.lit(" "))).alias("from_code"),
        tx.normalise_id(F.concat(F.lit("00"), F.col("p_partkey").cast("string"), F.lit(".0"))).alias("from_padded"),
        tx.normalise_id(F.concat(F.col("p_partkey").cast("string"), F.lit("e3"))).alias("from_exponent"),
        tx.normalise_id(F.concat(F.lit("9007199254740993"), F.col("p_partkey").cast("string"))).alias("from_long"),
    )


@check("make_curve_id", """
SELECT l_orderkey, l_linenumber, 'fl-4.0-' || l_returnflag || '-' || CAST(l_partkey AS VARCHAR) AS curve_id,
CAST(l_partkey AS VARCHAR) || '/' || CAST(l_suppkey AS VARCHAR) AS source_row_id FROM lineitem""")
def make_curve_id_check(s: Sample) -> DataFrame:
    return s.table("lineitem").select(
        "l_orderkey", "l_linenumber",
        tx.make_curve_id(F.lit("fl"), F.lit("4.0"), "l_returnflag", "l_partkey").alias("curve_id"),
        tx.make_curve_id("l_partkey", "l_suppkey", sep="/").alias("source_row_id"),
    )


@check("split_curve_id", with_ctes("curves") + """
SELECT curve_id, substr(building_type, 1, 4) AS family, right(building_type, 1) AS stories, regexp_extract(curve_id, '-([0-9]+)$', 1) AS terrain FROM curves""")
def split_curve_id_check(s: Sample) -> DataFrame:
    return s.curves().select(
        "curve_id", tx.family_of(F.col("building_type")).alias("family"), tx.stories_of(F.col("building_type")).alias("stories"),
        tx.terrain_of(F.col("curve_id"), "-([0-9]+)$").alias("terrain"))


@check("classify", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CASE l_linenumber * 2 WHEN 2 THEN 'damage_moderate' WHEN 4 THEN 'damage_total' WHEN 6 THEN 'content_loss' WHEN 8 THEN 'debris_brick_wood' END AS damage_type,
CASE l_linenumber * 2 WHEN 2 THEN 'probability_0_1' WHEN 4 THEN 'probability_0_1' WHEN 6 THEN 'loss_ratio_0_1' WHEN 8 THEN 'lbs_per_sqft' END AS y_units
FROM lineitem WHERE l_linenumber <= 4""")
def classify_check(s: Sample) -> DataFrame:
    classed = s.table("lineitem").withColumn("class_id", F.col("l_linenumber") * 2)
    return classify(classed, "class_id").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "damage_type", "y_units")


# --- reshape ------------------------------------------------------------------------------------
@check("melt_points", with_ctes("points7") + "SELECT curve_id, x, y FROM points7")
def melt_points_check(s: Sample) -> DataFrame:
    return s.points7()


@check("melt_curves", with_ctes("ckeys") + f"""
SELECT {SOURCE_KEY}, substr(curve_id, 4) AS source_row_id, 'agency' AS source_agency, 'Curve of part, ' || CAST(partkey AS VARCHAR) AS description,
'li' AS peril, '4.0' AS version, 'lines' AS damage_type, 'lines.csv' AS source_file, 'lines' AS source_table FROM ckeys""")
def melt_curves_check(s: Sample) -> DataFrame:
    return _melted(s)["curves"]


@check("melt_attributes", with_ctes("attributes") + "SELECT curve_id, key, value FROM attributes")
def melt_attributes_check(s: Sample) -> DataFrame:
    return s.attributes()


@check("melt_source_attributes", with_ctes("ckeys") + f"SELECT {SOURCE_KEY}, 'comment' AS key, 'even' AS value FROM ckeys WHERE partkey % 2 = 0")
def melt_source_attributes(s: Sample) -> DataFrame:
    return _melted(s)["curve_attributes"]


@check("split_codes", with_ctes("codes") + "SELECT partkey, CAST(pos AS INTEGER) AS pos, code FROM codes")
def split_codes_check(s: Sample) -> DataFrame:
    return reshape.split_codes(s.typed_codes(), "chars", 6).select("partkey", "pos", "code")


@check("decode_codes", with_ctes("codes", "dictionary") + """
SELECT partkey, char_type AS key, name AS value FROM codes JOIN dictionary USING (code)
UNION ALL SELECT partkey, 'characteristic_unmapped_code', string_agg(code, ',' ORDER BY pos) FROM codes
WHERE code NOT IN (SELECT code FROM dictionary) GROUP BY partkey""")
def decode_codes_check(s: Sample) -> DataFrame:
    return reshape.decode_codes(s.typed_codes(), "partkey", "chars", s.dictionary(), 6)


@check("unmapped_histogram", with_ctes("codes", "dictionary") + """
SELECT code, count(*) AS n FROM codes WHERE code NOT IN (SELECT code FROM dictionary) GROUP BY code""")
def unmapped_histogram_check(s: Sample) -> DataFrame:
    return reshape.unmapped_histogram(s.typed_codes(), "chars", s.dictionary(), 6)


@check("code_totals", with_ctes("codes", "dictionary") + """
SELECT count(CASE WHEN code IN (SELECT code FROM dictionary) THEN 1 END) AS n_decoded,
count(CASE WHEN code NOT IN (SELECT code FROM dictionary) THEN 1 END) AS n_undecoded FROM codes""")
def code_totals_check(s: Sample) -> DataFrame:
    return reshape.code_totals(s.typed_codes(), "chars", s.dictionary(), 6)


@check("attributes_map", with_ctes("attributes") + """
SELECT curve_id, max(CASE WHEN key = 'brand' THEN value END) AS brand, max(CASE WHEN key = 'size' THEN value END) AS size, count(*) AS n_keys
FROM attributes GROUP BY curve_id""")
def attributes_map_check(s: Sample) -> DataFrame:
    packed = reshape.attributes_map(s.attributes())
    return packed.select("curve_id", F.col("attributes")["brand"].alias("brand"), F.col("attributes")["size"].alias("size"),
                         F.size("attributes").cast("bigint").alias("n_keys"))


@check("pack_curve", with_ctes("wide7") + "SELECT curve_id, CAST(7 AS BIGINT) AS n_points, " + " || ',' || ".join(
    f"coalesce(CAST(CAST(round({c} * 1000) AS BIGINT) AS VARCHAR), '-')" for c in MEASURES7) + " AS ys FROM wide7")
def pack_curve_check(s: Sample) -> DataFrame:
    packed = reshape.pack_curve(s.points7(), GRID7)
    text = F.transform("ys", lambda y: F.coalesce(F.round(y * 1000).cast("bigint").cast("string"), F.lit("-")))
    return packed.select("curve_id", "n_points", F.array_join(text, ",").alias("ys"))


@check("union_vintages", with_ctes("ckeys") + """
SELECT curve_id, version, CASE WHEN version = 'O' THEN damage_type END AS damage_type FROM ckeys""")
def union_vintages_check(s: Sample) -> DataFrame:
    keys = s.curve_keys().select("curve_id", "version", "damage_type")
    return reshape.union_vintages(keys.where("version = 'F'").drop("damage_type"), keys.where("version = 'O'"))


@check("dedup_first", """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity FROM (
SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem) t WHERE rn = 1""")
def dedup_first_check(s: Sample) -> DataFrame:
    rows = s.table("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    first = reshape.dedup_first(rows, ["l_orderkey", "l_linenumber"], ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"])
    return first.drop("l_extendedprice")


@check("flags_to_zones", with_ctes("lookup") + " UNION ALL ".join(
    f"SELECT row_no, '{z}' AS flood_zone FROM lookup WHERE {c} = '1'" for z, c in FLAGS.items()))
def flags_to_zones_check(s: Sample) -> DataFrame:
    return reshape.flags_to_zones(s.lookup(), FLAGS, ["row_no"])


@check("decompose_cases", with_ctes("cases") + "SELECT case_name, territory, case_description FROM cases")
def decompose_cases_check(s: Sample) -> DataFrame:
    return reshape.decompose_cases(s.case_rows())


@check("slice_tables", with_ctes("points7", "curves") + """
SELECT p.curve_id, x, y FROM points7 p WHERE EXISTS (SELECT 1 FROM curves c WHERE c.curve_id = p.curve_id AND c.occupancy = 'Brand#7')""")
def slice_tables_check(s: Sample) -> DataFrame:
    curves = s.curves().withColumn("peril", F.when(F.col("occupancy") == "Brand#7", "b7").otherwise(F.col("peril")))
    return reshape.slice_tables({"curves": curves, "curve_points": s.points7()}, "b7")["curve_points"]


# --- the wind build -----------------------------------------------------------------------------
def _wind(s: Sample) -> dict[str, DataFrame]:
    return melt_wind_table(
        s.wind_table(), s.building_types(), s.terrain(), s.dictionary(5), GRID7, version="6.1", source_agency="model",
        source_file="wind.csv", source_table="wind", defect_note=DEFECT_NOTE)


@check("wind_curves", with_ctes("wind") + """
SELECT curve_id, 'hu' AS peril, '6.1' AS version, damage_type, p_type AS building_type, 'model' AS source_agency,
substr(rpad(split_part(p_name, ' ', 1), 5, '_'), 1, 5) || substr(rpad(split_part(p_name, ' ', 2), 5, '_'), 1, 5) AS description,
CAST(NULL AS VARCHAR) AS defect_flag, 'wind.csv' AS source_file, 'wind' AS source_table,
CAST(partkey AS VARCHAR) || '/' || CAST(terrain AS VARCHAR) || '/' || CAST(class_id AS VARCHAR) AS source_row_id FROM wind""")
def wind_curves(s: Sample) -> DataFrame:
    return _wind(s)["curves"]


@check("wind_points", with_ctes("wind") + " UNION ALL ".join(
    f"SELECT curve_id, CAST({k} AS DOUBLE) AS x, p{k} AS y FROM wind" for k in range(1, 8)))
def wind_points(s: Sample) -> DataFrame:
    return _wind(s)["curve_points"]


_UNKNOWN = ", ".join(f"'{w}'" for w in UNDOCUMENTED_WORDS)
_WORD1, _WORD2 = "split_part(p_name, ' ', 1)", "split_part(p_name, ' ', 2)"
_CODE1, _CODE2 = (f"substr(rpad({w}, 5, '_'), 1, 5)" for w in (_WORD1, _WORD2))


@check("lookup_dims", with_ctes("wind") + " UNION ALL ".join(
    f"SELECT curve_id, '{k}' AS key, {v} AS value FROM wind WHERE {c}" for k, v, c in (
        ("wind_building_type_id", "CAST(partkey AS VARCHAR)", "true"),
        ("specific_building_type", "p_type", "true"),
        ("terrain_id", "CAST(terrain AS VARCHAR)", "true"),
        ("terrain", "'Open'", "terrain = 1"),
        ("surface_roughness_m", "CAST((SELECT count(*) FROM lineitem WHERE l_linestatus = 'F') AS VARCHAR)", "terrain = 1"),
        ("geographic_case", "case_name", "true"),
        ("characteristic_code", f"{_CODE1} || {_CODE2}", "true"),
        ("Look", f"upper({_WORD1})", f"{_WORD1} NOT IN ({_UNKNOWN})"),
        ("Thing", f"upper({_WORD2})", f"{_WORD2} NOT IN ({_UNKNOWN})"),
        ("characteristic_unmapped_code",
         f"concat_ws(',', CASE WHEN {_WORD1} IN ({_UNKNOWN}) THEN {_CODE1} END, CASE WHEN {_WORD2} IN ({_UNKNOWN}) THEN {_CODE2} END)",
         f"{_WORD1} IN ({_UNKNOWN}) OR {_WORD2} IN ({_UNKNOWN})"),
    )))
def lookup_dims(s: Sample) -> DataFrame:
    return _wind(s)["curve_attributes"]
