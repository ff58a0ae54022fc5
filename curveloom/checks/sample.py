"""A curve library derived from the order and part tables, in Spark and as SQL.

``lib7`` has one curve per (line status, return flag, part) with the average quantity of line
numbers 1..7 as y; ``lib3`` groups the line numbers in three and keeps only whether the average is
high, so equal curves occur.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from curveloom.functions.literal import literal_frame
from curveloom.functions.text import make_curve_id
from curveloom.operators.reshape import melt_attributes, melt_points

GRID7 = [1.0, 2.0, 3.0, 4.0, 5.0, 6.0, 7.0]
GRID3 = [1.0, 2.0, 3.0]
BINS3 = {"p1": (1, 2), "p2": (3, 4), "p3": (5, 7)}
ZONES = {"Riverine": ("HazardRiverine", 2), "CoastalA": ("HazardCA", 3), "CoastalV": ("HazardCV", 5)}
FLAGS = {zone: column for zone, (column, _) in ZONES.items()}
COASTAL_NOTE = "coastal curves depend on the water depth in later releases"
DEFECT_NOTE = "known defect of this type"
DEFECT_TYPES = ("SMALL", "MEDIUM")
# part type -> building family
FAMILIES = {"SMALL": "WMUH", "LARGE": "MMUH"}
# part type -> (case name, case description)
CASES = {
    "ECONOMY": ("ContinentalUS", "Used in Continental US"),
    "LARGE": ("Caribbean", "Used in Caribbean"),
    "MEDIUM": ("ContUS+Caribbean", "Used in Continental and Caribbean"),
    "PROMO": ("ContUS+Hawaii", "Used in Continental and Hawaii"),
    "SMALL": ("ContUS+Hawaii", "Used in Continental and Hawaii"),
    "STANDARD": ("Hawaii", "Used in Hawaii"),
}
KINDS = [
    ("li", "A", "line", "number", "quantity", "pieces", "piecewise_linear", None),
    ("li", "N", "line", "number", "quantity", "boxes", "piecewise_linear", None),
    ("ot", "A", "line", "number", "quantity", "pieces", "piecewise_linear", None),
]
UNDOCUMENTED_WORDS = ("hot", "old", "rod", "anvil")


def _case(column: str, index: int) -> Column:
    return F.coalesce(*[F.when(F.col(column) == k, F.lit(v[index])) for k, v in CASES.items()])

# lookup files of the first vintage: damage type, zone and the part type that stands for the file
LOOKUPS = (
    ("A", "Riverine", "SMALL"), ("A", "CoastalA", "LARGE"), ("A", "CoastalV", "PROMO"),
    ("N", "Riverine", "ECONOMY"), ("N", "CoastalA", "MEDIUM"), ("N", "CoastalV", "STANDARD"),
)


class Sample:
    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """One relation per table, so its footer is read once and equal shuffles are shared."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    # --- libraries -----------------------------------------------------------------------------
    def _keys(self, df: DataFrame) -> DataFrame:
        key = make_curve_id(F.lit("li"), "version", "damage_type", "partkey")
        return df.withColumn("curve_id", key)

    def _lines(self) -> DataFrame:
        return self.table("lineitem").select(
            F.col("l_linestatus").alias("version"),
            F.col("l_returnflag").alias("damage_type"),
            F.col("l_partkey").alias("partkey"),
            "l_linenumber",
            "l_quantity",
        )

    def wide7(self) -> DataFrame:
        cells = [F.avg(F.when(F.col("l_linenumber") == k, F.col("l_quantity"))).alias(f"p{k}") for k in range(1, 8)]
        return self._keys(self._lines().groupBy("version", "damage_type", "partkey").agg(*cells))

    def wide3(self) -> DataFrame:
        cells = []
        for name, (low, high) in BINS3.items():
            mean = F.avg(F.when(F.col("l_linenumber").between(low, high), F.col("l_quantity")))
            cells.append(F.when(mean > 25, 1.0).when(mean <= 25, 0.0).alias(name))
        return self._keys(self._lines().groupBy("version", "damage_type", "partkey").agg(*cells))

    def points7(self) -> DataFrame:
        return melt_points(self.wide7(), [f"p{k}" for k in range(1, 8)])

    def points3(self) -> DataFrame:
        return melt_points(self.wide3(), list(BINS3))

    def curve_keys(self) -> DataFrame:
        return self._keys(self._lines().select("version", "damage_type", "partkey").distinct())

    def curves(self) -> DataFrame:
        joined = self.curve_keys().join(self.table("part"), F.col("partkey") == F.col("p_partkey"))
        return joined.select(
            "curve_id",
            F.lit("li").alias("peril"),
            "version",
            "damage_type",
            F.col("p_brand").alias("occupancy"),
            F.col("p_type").alias("building_type"),
            F.concat(F.lit("agency_"), (F.col("partkey") % 5).cast("string")).alias("source_agency"),
            F.col("p_name").alias("description"),
            F.when(F.col("p_type").isin(*DEFECT_TYPES), DEFECT_NOTE).alias("defect_flag"),
            F.lit(None).cast("string").alias("defect_verified"),
            F.lit("lineitem").alias("source_file"),
            F.concat(F.lit("lines_"), "damage_type").alias("source_table"),
            F.col("partkey").cast("string").alias("source_row_id"),
        )

    def storeyed3(self) -> DataFrame:
        """lib3 as curves of building families with one to three storeys (part size), line status as terrain."""
        family = F.coalesce(*[F.when(F.col("p_type") == k, v) for k, v in FAMILIES.items()], F.lit("SERB"))
        joined = self.wide3().join(self.table("part"), F.col("partkey") == F.col("p_partkey"))
        terrain = F.when(F.col("version") == "F", "t1").otherwise("t2")
        return joined.select(
            make_curve_id(F.lit("li"), "damage_type", "partkey", terrain).alias("curve_id"), "damage_type",
            F.concat(family, (F.col("p_size") % 3 + 1).cast("string")).alias("building_type"),
            F.col("p_brand").alias("description"), F.lit(None).cast("string").alias("defect_verified"), *BINS3,
        )

    def part_facts(self) -> DataFrame:
        """One row per part with the attributes every curve of it has."""
        return self.table("part").select(
            F.col("p_partkey").alias("partkey"),
            F.col("p_brand").alias("brand"),
            F.col("p_type").alias("type"),
            F.col("p_size").cast("string").alias("size"),
            _case("p_type", 0).alias("geographic_case"),
        )

    def attributes(self) -> DataFrame:
        keys = ["brand", "type", "size", "geographic_case"]
        facts = self.curve_keys().select("curve_id", "partkey").join(self.part_facts(), "partkey")
        return melt_attributes(facts, {k: k for k in keys})

    def kinds(self) -> DataFrame:
        columns = "peril string, damage_type string, x_name string, x_units string, y_name string, y_units string, interpolation string, notes string"
        return literal_frame(self.spark, KINDS, columns)

    def case_rows(self) -> DataFrame:
        """Set-valued cases in use, with their description."""
        used = self.table("part").select("p_type").distinct()
        return used.select(_case("p_type", 0).alias("case_name"), _case("p_type", 1).alias("case_description")).distinct()

    # --- assignments ---------------------------------------------------------------------------
    def flag_columns(self) -> list[Column]:
        return [F.when(F.col("p_size") % n == 0, "1").otherwise("").alias(c) for c, n in ZONES.values()]

    def lookup(self) -> DataFrame:
        """Assignment lookup with a spaced occupancy, blank flags and ids read as decimals."""
        return self.table("part").select(
            F.col("p_partkey").alias("row_no"),
            F.concat("p_brand", F.lit("  ")).alias("Occupancy"),
            F.concat((F.col("p_size") % 3 + 1).cast("string"), F.lit(" Story")).alias("Stories"),
            F.when(F.col("p_size") % 4 == 0, "1").otherwise(" ").alias("Basement"),
            F.when(F.col("p_size") != 50, F.concat(F.col("p_partkey").cast("string"), F.lit(".0"))).alias("DDF_ID"),
            *self.flag_columns(),
            F.lit("part.csv").alias("source_file"),
            F.lit("part").alias("source_table"),
            F.col("p_type").alias("lut"),
        )

    def final(self) -> DataFrame:
        """Assignments by occupancy class (the part size), to be joined to the crosswalk."""
        return self.table("part").select(
            F.col("p_size").alias("SOccupId"),
            F.when(F.col("p_brand") != "Brand#1", F.col("p_partkey").cast("double")).alias("BldgDmgFnId"),
            *self.flag_columns(),
            F.lit("final.csv").alias("source_file"),
            F.lit("final").alias("source_table"),
        )

    def crosswalk(self) -> DataFrame:
        """Facts of the occupancy classes; classes above 45 have none."""
        return (
            self.table("part")
            .where("p_size <= 45")
            .groupBy(F.col("p_size").alias("SOccupId"))
            .agg(F.min("p_brand").alias("Occupancy"))
            .withColumn("NumStories", (F.col("SOccupId") % 3 + 1).cast("string"))
            .withColumn("Basement", F.when(F.col("SOccupId") % 4 == 0, "1"))
        )

    # --- codes ---------------------------------------------------------------------------------
    def typed_codes(self, width: int = 6) -> DataFrame:
        words = F.split("p_name", " ")
        return self.table("part").select(
            F.col("p_partkey").alias("partkey"),
            F.concat(F.rpad(words[0], width, "_"), F.rpad(words[1], width, "_")).alias("chars"),
        )

    def dictionary(self, width: int = 6) -> DataFrame:
        words = F.split("p_name", " ")
        rows = self.table("part").select(F.explode(F.array(
            F.struct(words[0].alias("word"), F.lit("Look").alias("char_type")),
            F.struct(words[1].alias("word"), F.lit("Thing").alias("char_type")),
        )).alias("w")).select("w.*").distinct()
        known = rows.where(~F.col("word").isin(*UNDOCUMENTED_WORDS))
        return known.select(F.rpad("word", width, "_").alias("code"), "char_type", F.upper("word").alias("name"))

    # --- a wind table and its dictionaries -----------------------------------------------------
    def wind_table(self) -> DataFrame:
        """lib7 as a wind source table: part, line status as terrain, return flag as class (R is unknown)."""
        return self.wide7().select(
            F.col("partkey").alias("wbID"),
            F.when(F.col("version") == "F", 1).otherwise(2).alias("TERRAINID"),
            F.when(F.col("damage_type") == "A", 1).when(F.col("damage_type") == "N", 5).otherwise(99).alias("DamLossDescID"),
            *[F.col(f"p{k}").alias(f"WS{k}") for k in range(1, 8)],
        )

    def building_types(self) -> DataFrame:
        """Building type of every part but the largest ones."""
        facts = self.table("part").where("p_size < 50").select(
            F.col("p_partkey").alias("partkey"), F.col("p_type").alias("sbt"), _case("p_type", 0).alias("case_name"))
        return facts.join(self.typed_codes(5), "partkey").withColumnRenamed("partkey", "wbID")

    def terrain(self) -> DataFrame:
        """Terrains 1 and 3 with their number of lines as roughness; terrain 2 is not described."""
        is_open = F.col("l_linestatus") == "F"
        return self.table("lineitem").groupBy(
            F.when(is_open, 1).otherwise(3).alias("TERRAINID"), F.when(is_open, "Open").otherwise("Unused").alias("terrain")
        ).agg(F.count(F.lit(1)).alias("roughness"))

    # --- exposures -----------------------------------------------------------------------------
    def exposures(self) -> DataFrame:
        n_parts = self.table("part").agg(F.count(F.lit(1))).scalar()
        flag = (
            F.when(F.col("event_type").isin("click", "error"), "A")
            .when(F.col("event_type") == "view", "N")
            .when(F.col("event_type") == "purchase", "R")
            .otherwise("Z")
        )
        version = F.when(F.col("event_id") % 2 == 0, "F").otherwise("O")
        step = (F.col("event_id") * 7 % 701).cast("double") / F.lit(100.0)
        return self.table("events").select(
            F.col("event_id").alias("exposure_id"),
            make_curve_id(F.lit("li"), version, flag, F.col("event_id") % n_parts).alias("curve_id"),
            (F.lit(0.5) + step).alias("x"),
        )


# --- the same tables as SQL ---------------------------------------------------------------------
def _case_sql(index: int) -> str:
    return "CASE p_type " + " ".join(f"WHEN '{k}' THEN '{v[index]}'" for k, v in CASES.items()) + " END"


def _flags_sql() -> str:
    return ", ".join(f"CASE WHEN p_size % {n} = 0 THEN '1' ELSE '' END AS {c}" for c, n in ZONES.values())


def _mean_sql(condition: str) -> str:
    return (
        f"sum(CASE WHEN {condition} THEN l_quantity END) / "
        f"nullif(count(CASE WHEN {condition} THEN 1 END), 0)"
    )


_KEY = "'li-' || l_linestatus || '-' || l_returnflag || '-' || CAST(l_partkey AS VARCHAR) AS curve_id"
_LIB = f"SELECT {_KEY}, l_linestatus AS version, l_returnflag AS damage_type, l_partkey AS partkey"
_UNDOC = ", ".join(f"'{w}'" for w in UNDOCUMENTED_WORDS)

CTES: dict[str, tuple[tuple[str, ...], str]] = {
    "wide7": (
        (),
        _LIB + ", " + ", ".join(f"{_mean_sql(f'l_linenumber = {k}')} AS p{k}" for k in range(1, 8))
        + " FROM lineitem GROUP BY l_linestatus, l_returnflag, l_partkey",
    ),
    "mean3": (
        (),
        _LIB + ", " + ", ".join(f"{_mean_sql(f'l_linenumber BETWEEN {a} AND {b}')} AS {c}" for c, (a, b) in BINS3.items())
        + " FROM lineitem GROUP BY l_linestatus, l_returnflag, l_partkey",
    ),
    "wide3": (
        ("mean3",),
        "SELECT curve_id, version, damage_type, partkey, "
        + ", ".join(f"CAST(CASE WHEN {c} > 25 THEN 1 WHEN {c} <= 25 THEN 0 END AS DOUBLE) AS {c}" for c in BINS3)
        + " FROM mean3",
    ),
    "points7": (
        ("wide7",),
        " UNION ALL ".join(f"SELECT curve_id, CAST({k} AS DOUBLE) AS x, p{k} AS y FROM wide7" for k in range(1, 8)),
    ),
    "points3": (
        ("wide3",),
        " UNION ALL ".join(f"SELECT curve_id, CAST({k} AS DOUBLE) AS x, p{k} AS y FROM wide3" for k in range(1, 4)),
    ),
    "ckeys": ((), f"SELECT DISTINCT {_KEY}, l_linestatus AS version, l_returnflag AS damage_type, l_partkey AS partkey FROM lineitem"),
    "curves": (
        ("ckeys",),
        "SELECT curve_id, 'li' AS peril, version, damage_type, p_brand AS occupancy, p_type AS building_type, "
        "'agency_' || CAST(partkey % 5 AS VARCHAR) AS source_agency, p_name AS description, "
        f"CASE WHEN p_type IN ('SMALL', 'MEDIUM') THEN '{DEFECT_NOTE}' END AS defect_flag, "
        "CAST(NULL AS VARCHAR) AS defect_verified, 'lineitem' AS source_file, "
        "'lines_' || damage_type AS source_table, CAST(partkey AS VARCHAR) AS source_row_id "
        "FROM ckeys JOIN part ON partkey = p_partkey",
    ),
    "attributes": (
        ("ckeys",),
        " UNION ALL ".join(
            f"SELECT curve_id, '{k}' AS key, {v} AS value FROM ckeys JOIN part ON partkey = p_partkey"
            for k, v in (("brand", "p_brand"), ("type", "p_type"), ("size", "CAST(p_size AS VARCHAR)"), ("geographic_case", _case_sql(0)))
        ),
    ),
    "kinds": (
        (),
        "SELECT * FROM (VALUES " + ", ".join(
            "(" + ", ".join("CAST(NULL AS VARCHAR)" if v is None else f"'{v}'" for v in row) + ")" for row in KINDS
        ) + ") AS k(peril, damage_type, x_name, x_units, y_name, y_units, interpolation, notes)",
    ),
    "case_rows": ((), f"SELECT DISTINCT {_case_sql(0)} AS case_name, {_case_sql(1)} AS case_description FROM part"),
    "cases": (
        ("case_rows",),
        " UNION ALL ".join(
            f"SELECT case_name, '{t}' AS territory, case_description FROM case_rows WHERE lower(case_description) LIKE '%{w}%'"
            for w, t in (("continental", "CONUS"), ("hawaii", "Hawaii"), ("caribbean", "Caribbean"))
        ),
    ),
    "lookup": (
        (),
        "SELECT p_partkey AS row_no, p_brand AS occupancy, CAST(p_size % 3 + 1 AS VARCHAR) || ' Story' AS stories, "
        "CASE WHEN p_size % 4 = 0 THEN '1' END AS basement, CASE WHEN p_size <> 50 THEN CAST(p_partkey AS VARCHAR) END AS fn_id, "
        f"{_flags_sql()}, 'part.csv' AS source_file, 'part' AS source_table, p_type AS lut FROM part",
    ),
    "final": (
        (),
        "SELECT p_size AS class_id, CASE WHEN p_brand <> 'Brand#1' THEN CAST(p_partkey AS VARCHAR) END AS fn_id, "
        f"{_flags_sql()}, 'final.csv' AS source_file, 'final' AS source_table FROM part",
    ),
    "crosswalk": (
        (),
        "SELECT p_size AS class_id, min(p_brand) AS occupancy, CAST(p_size % 3 + 1 AS VARCHAR) AS stories, "
        "CASE WHEN p_size % 4 = 0 THEN '1' END AS basement FROM part WHERE p_size <= 45 GROUP BY p_size",
    ),
    "lookup_rules": (
        ("lookup",),
        " UNION ALL ".join(
            f"SELECT 'li-F-{k}-{z}-' || CAST(row_no AS VARCHAR) AS rule_id, 'li' AS peril, 'F' AS version, '{k}' AS damage_type, "
            f"occupancy, '{z}' AS flood_zone, stories, basement, 'li-F-{k}-' || fn_id AS curve_id, source_file, source_table, "
            f"{'CAST(NULL AS VARCHAR)' if z == 'Riverine' else chr(39) + COASTAL_NOTE + chr(39)} AS notes, {i} AS part_no "
            f"FROM lookup WHERE fn_id IS NOT NULL AND lut = '{lut}'"
            for i, (k, z, lut) in enumerate(LOOKUPS)
        ),
    ),
    "final_rules": (
        ("final", "crosswalk"),
        " UNION ALL ".join(
            f"SELECT 'li-O-A-' || CAST(f.class_id AS VARCHAR) || '-{z}' AS rule_id, 'li' AS peril, 'O' AS version, 'A' AS damage_type, "
            f"occupancy, '{z}' AS flood_zone, stories, basement, 'li-O-A-' || fn_id AS curve_id, source_file, source_table, "
            f"{'CAST(NULL AS VARCHAR)' if z == 'Riverine' else chr(39) + COASTAL_NOTE + chr(39)} AS notes, {len(LOOKUPS)} AS part_no "
            f"FROM final f LEFT JOIN crosswalk c ON c.class_id = f.class_id WHERE fn_id IS NOT NULL AND {c} = '1'"
            for z, c in FLAGS.items()
        ),
    ),
    "rules": (
        ("lookup_rules", "final_rules"),
        "SELECT rule_id, peril, version, damage_type, occupancy, flood_zone, stories, basement, curve_id, source_file, source_table, notes FROM ("
        "SELECT *, row_number() OVER (PARTITION BY rule_id ORDER BY part_no, source_file, curve_id, occupancy NULLS FIRST, "
        "stories NULLS FIRST, basement NULLS FIRST) AS rn FROM (SELECT * FROM lookup_rules UNION ALL SELECT * FROM final_rules) u) r WHERE rn = 1",
    ),
    "zones": (
        ("lookup", "final"),
        "SELECT DISTINCT curve_id, flood_zone, first_value(source_file) OVER w AS source_file, first_value(source_table) OVER w AS source_table FROM ("
        + " UNION ALL ".join(
            f"SELECT 'li-F-A-' || fn_id AS curve_id, '{z}' AS flood_zone, source_file, source_table, 0 AS part_no FROM lookup "
            f"WHERE fn_id IS NOT NULL AND {c} = '1' UNION ALL "
            f"SELECT 'li-O-A-' || fn_id, '{z}', source_file, source_table, 1 FROM final WHERE fn_id IS NOT NULL AND {c} = '1'"
            for z, c in FLAGS.items()
        )
        + ") z WINDOW w AS (PARTITION BY curve_id, flood_zone ORDER BY part_no, source_file, source_table)",
    ),
    "typed": (
        (),
        "SELECT p_partkey AS partkey, rpad(split_part(p_name, ' ', 1), 6, '_') AS code0, rpad(split_part(p_name, ' ', 2), 6, '_') AS code1 FROM part",
    ),
    "dictionary": (
        (),
        "SELECT DISTINCT rpad(word, 6, '_') AS code, char_type, upper(word) AS name FROM ("
        "SELECT split_part(p_name, ' ', 1) AS word, 'Look' AS char_type FROM part UNION ALL "
        f"SELECT split_part(p_name, ' ', 2), 'Thing' FROM part) w WHERE word NOT IN ({_UNDOC})",
    ),
    "codes": (
        ("typed",),
        "SELECT partkey, 0 AS pos, code0 AS code FROM typed UNION ALL SELECT partkey, 1, code1 FROM typed",
    ),
    "wind": (
        ("wide7",),
        "SELECT 'hu-6.1-' || t.damage_type || '-' || CAST(partkey AS VARCHAR) || '-t' || CAST(terrain AS VARCHAR) AS curve_id, partkey, "
        "t.damage_type, class_id, terrain, p_type, p_name, " + ", ".join(f"p{k}" for k in range(1, 8))
        + f", {_case_sql(0)} AS case_name FROM (SELECT *, CASE WHEN version = 'F' THEN 1 ELSE 2 END AS terrain FROM wide7) w "
        "JOIN (VALUES ('A', 1, 'damage_slight'), ('N', 5, 'building_loss')) AS t(flag, class_id, damage_type) ON flag = w.damage_type "
        "JOIN part ON p_partkey = partkey AND p_size < 50",
    ),
    "exposures": (
        (),
        "SELECT event_id AS exposure_id, 'li-' || CASE WHEN event_id % 2 = 0 THEN 'F' ELSE 'O' END || '-' || "
        "CASE WHEN event_type IN ('click', 'error') THEN 'A' WHEN event_type = 'view' THEN 'N' WHEN event_type = 'purchase' THEN 'R' ELSE 'Z' END "
        "|| '-' || CAST(event_id % (SELECT count(*) FROM part) AS VARCHAR) AS curve_id, "
        "CAST(0.5 AS DOUBLE) + CAST(event_id * 7 % 701 AS DOUBLE) / CAST(100 AS DOUBLE) AS x FROM events",
    ),
}


def with_ctes(*names: str) -> str:
    """``WITH`` clause holding the named tables and what they need."""
    ordered: list[str] = []

    def visit(name: str) -> None:
        if name in ordered:
            return
        for needed in CTES[name][0]:
            visit(needed)
        ordered.append(name)

    for name in names:
        visit(name)
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n][1]})" for n in ordered) + "\n"
