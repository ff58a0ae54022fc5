from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from curveloom.fixed_values import CURVE_KINDS, FLOOD_COLUMN_ROLES, FLOOD_DEPTHS, UNMAPPED_KEY, WIND_SPEEDS
from curveloom.functions.literal import literal_frame
from curveloom.operators import contracts, reshape
from curveloom.operators.diff import roundtrip_check
from curveloom.plans.library import melt_wide_table, melt_wind_table
from curveloom.schema import TABLES, conform, not_null_violations, pk_violations, undeclared_columns
from curveloom.sources.readers import read_typed_csv, read_wide_csv

DEPTH_NAMES = [f"m{d}" for d in range(4, 0, -1)] + [f"p{d}" for d in range(25)]
HEADER = "InvDmgFnId,Occupancy,Source,Description," + ",".join(DEPTH_NAMES) + ",Comment"
RETAIL = '1,COM1,USACE - Galveston,"Average Retail Trade, Inventory",0,0,0,0,4,31,49,65,76,85,90,92,93,94,95,95,96,97,97,97,98,98,98,98,98,98,98,98,98,NULL'
CAUSTIC = '105,IND3,USACE - Galveston,"Caustic Material Refinery, Inventory",0,0,0,0,0,0,0,10,20,30,30,40,40,50,50,60,60,70,70,80,80,90,90,100,100,100,100,100,100,NULL'
GAPPED = "7.0,COM2 ,Agency,Gapped," + ",".join(["NULL", ""] + ["5"] * 27) + ",kept"
NO_ID = "NULL,COM2,Agency,No id," + ",".join(["1"] * 29) + ","


@pytest.fixture(scope="module")
def wide(spark, tmp_path_factory):
    path = tmp_path_factory.mktemp("wide") / "table.csv"
    path.write_text("\n".join([HEADER, RETAIL, CAUSTIC, GAPPED, NO_ID]) + "\n")
    return read_wide_csv(spark, str(path))


@pytest.fixture(scope="module")
def melted(wide):
    return melt_wide_table(wide, FLOOD_COLUMN_ROLES, FLOOD_DEPTHS, peril="fl", version="4.0", damage_type="inventory",
                           source_file="table.csv", source_table="table")


def test_points_of_a_wide_table(melted):
    rows = melted["curve_points"].where("curve_id = 'fl-4.0-inventory-1'").orderBy("x").collect()
    assert [r["x"] for r in rows] == FLOOD_DEPTHS
    assert [r["y"] for r in rows] == [float(v) for v in RETAIL.split(",")[5:-1]]
    gaps = melted["curve_points"].where("curve_id = 'fl-4.0-inventory-7'").orderBy("x").collect()
    assert [r["y"] for r in gaps] == [None, None] + [5.0] * 27
    assert melted["curve_points"].count() == 3 * 29


def test_curves_and_attributes_of_a_wide_table(melted):
    curves = {r["curve_id"]: r for r in melted["curves"].collect()}
    assert set(curves) == {"fl-4.0-inventory-1", "fl-4.0-inventory-105", "fl-4.0-inventory-7"}
    assert curves["fl-4.0-inventory-7"]["occupancy"] == "COM2"
    assert curves["fl-4.0-inventory-1"]["description"] == "Average Retail Trade, Inventory"
    assert curves["fl-4.0-inventory-7"]["source_row_id"] == "7"
    assert [tuple(r) for r in melted["curve_attributes"].collect()] == [("fl-4.0-inventory-7", "comment", "kept")]


def test_melted_tables_fit_the_schema(melted):
    for name, df in melted.items():
        undeclared_columns(df, TABLES[name])
        shaped = conform(df, TABLES[name])
        assert shaped.columns == TABLES[name].columns
        assert pk_violations(shaped, TABLES[name].pk).count() == 0
        assert all(r["n_null"] == 0 for r in not_null_violations(shaped, TABLES[name].required).collect())


def test_undeclared_column_fails(melted):
    with pytest.raises(ValueError, match="not declared"):
        undeclared_columns(melted["curves"].selectExpr("*", "1 AS extra"), TABLES["curves"])


def test_column_contract(wide, spark):
    roles = {r["column_name"]: r["role"] for r in contracts.column_accounting(wide, FLOOD_COLUMN_ROLES).collect()}
    assert roles["m4"] == "measure" and roles["Comment"] == "attr:comment" and len(roles) == 34
    with pytest.raises(ValueError, match="Surprise"):
        contracts.column_accounting(wide.selectExpr("*", "1 AS Surprise"), FLOOD_COLUMN_ROLES)
    assert contracts.column_accounting(wide.selectExpr("*", "1 AS Extra"), FLOOD_COLUMN_ROLES, {"Extra": "row number"}).count() == 35


def test_column_usage_counts_rows_and_nulls(spark):
    df = literal_frame(spark, [("a", None, 1), ("b", None, None)], "`odd``name` string, m4 double, id int")
    got = {tuple(r) for r in contracts.column_usage(df, {"odd`name": "key"}, {"id": "row number"}).collect()}
    assert got == {("odd`name", "key", 2, 0), ("m4", "measure", 2, 2), ("id", "ignored: row number", 2, 1)}
    empty = df.where("false")
    assert {r["n_rows"] for r in contracts.column_usage(empty, {"odd`name": "key"}, {"id": "row number"}).collect()} == {0}


def test_grid_contract():
    assert list(contracts.grid_contract(DEPTH_NAMES, FLOOD_DEPTHS).values()) == FLOOD_DEPTHS
    both = [f"ft{d:02d}m" for d in range(4, 0, -1)] + [f"ft{d:02d}" for d in range(25)]
    assert list(contracts.grid_contract(both, FLOOD_DEPTHS).values()) == FLOOD_DEPTHS
    with pytest.raises(ValueError, match="11 points"):
        contracts.grid_contract([f"ft{d:02d}" for d in range(11)], FLOOD_DEPTHS)


def test_grid_completeness(spark):
    grid = [float(i) for i in range(130)]  # spans several masks
    rows = [("full", x, 1.0) for x in grid] + [("short", x, 1.0) for x in grid[:-1]]
    rows += [("twice", x, 1.0) for x in grid[:-1]] + [("twice", 0.0, 2.0)]
    rows += [("off", x, 1.0) for x in grid[:-1]] + [("off", 0.5, 1.0)]
    bad = contracts.grid_completeness(literal_frame(spark, rows, "curve_id string, x double, y double"), grid)
    got = {r["curve_id"]: (r["n_points"], r["n_grid_values"], r["n_off_grid"]) for r in bad.collect()}
    assert got == {"short": (129, 129, 0), "twice": (130, 129, 0), "off": (130, 129, 1)}


def test_roundtrip(spark):
    wide = literal_frame(spark, [("a", 1.0, None), ("b", 2.0, 3.0)], "curve_id string, p0 double, p1 double")
    points = reshape.melt_points(wide)
    assert [tuple(r) for r in roundtrip_check(wide, points).collect()] == [
        ("p0", 2, 0), ("p1", 2, 0), ("(extra points)", 4, 0), ("(missing points)", 4, 0)]
    altered = points.selectExpr("curve_id", "x", "CASE WHEN curve_id = 'b' AND x = 1 THEN 9.0 ELSE y END AS y")
    assert [r["n_different"] for r in roundtrip_check(wide, altered).collect()] == [0, 1, 0, 0]
    more = points.unionByName(points.where("curve_id = 'a'")).unionByName(points.limit(1).withColumn("x", F.lit(7.0)))
    assert [r["n_different"] for r in roundtrip_check(wide, more).collect()] == [0, 0, 3, 0]
    assert [r["n_different"] for r in roundtrip_check(wide, points.where("curve_id = 'a'")).collect()] == [1, 1, 0, 2]


def test_read_typed_csv_keeps_versions_as_text(spark, tmp_path):
    (tmp_path / "kind.csv").write_text("curve_id,x,y\na,1,\nb,2.5,3\n")
    rows = read_typed_csv(spark, str(tmp_path / "kind.csv"), "curve_points").orderBy("curve_id").collect()
    assert [tuple(r) for r in rows] == [("a", 1.0, None), ("b", 2.5, 3.0)]
    (tmp_path / "curves.csv").write_text("version,curve_id\n4.0,a\n")
    assert read_typed_csv(spark, str(tmp_path / "curves.csv"), "curves").first().asDict() == {"curve_id": "a", "version": "4.0"}


DICTIONARY = [("aaaaa", "Shape", "Hip"), ("bbbbb", "Shutters", "Yes")]


def test_decode_codes(spark):
    typed = literal_frame(
        spark, [(1, "aaaaabbbbb"), (2, " aaaaazzzzzyyyyy "), (3, ""), (4, None), (5, "bbbbbqq")], "id int, chars string")
    dictionary = literal_frame(spark, DICTIONARY, "code string, char_type string, name string")
    got = {(r["id"], r["key"], r["value"]) for r in reshape.decode_codes(typed, "id", "chars", dictionary).collect()}
    assert got == {(1, "Shape", "Hip"), (1, "Shutters", "Yes"), (2, "Shape", "Hip"), (2, UNMAPPED_KEY, "zzzzz,yyyyy"),
                   (5, "Shutters", "Yes"), (5, UNMAPPED_KEY, "qq")}
    histogram = reshape.unmapped_histogram(typed, "chars", dictionary).collect()
    assert [tuple(r) for r in histogram] == [("qq", 1), ("yyyyy", 1), ("zzzzz", 1)]
    assert tuple(reshape.code_totals(typed, "chars", dictionary).first()) == (4, 3)


def test_decompose_cases(spark):
    rows = [("ContinentalUS", "Used in Continental US"), ("Hawaii ", "Used in Hawaii"), ("ContUS+Hawaii", "Used in Continental and Hawaii"),
            ("ContUS+Caribbean", "Used in Continental and Caribbean"), (" ", "Used in Guam")]
    cases = literal_frame(spark, rows, "case_name string, case_description string")
    got = {(r["case_name"], r["territory"]) for r in reshape.decompose_cases(cases).collect()}
    assert got == {("ContinentalUS", "CONUS"), ("Hawaii", "Hawaii"), ("ContUS+Hawaii", "CONUS"), ("ContUS+Hawaii", "Hawaii"),
                   ("ContUS+Caribbean", "CONUS"), ("ContUS+Caribbean", "Caribbean")}
    with pytest.raises(Exception, match="no territory named for case G: Used in Guam"):
        reshape.decompose_cases(literal_frame(spark, [("G", "Used in Guam")], "case_name string, case_description string")).collect()


def test_wind_table(spark):
    measures = [f"WS{int(s)}" for s in WIND_SPEEDS]
    rows = [(11, 2, 1, *[s / 250 for s in WIND_SPEEDS]), (11, 2, 7, *[None] * 41), (11, 2, 99, *[1.0] * 41), (12, 2, 1, *[1.0] * 41)]
    wide = literal_frame(spark, rows, "wbID int, TERRAINID int, DamLossDescID int, " + ", ".join(f"{m} double" for m in measures))
    types = literal_frame(spark, [(11, "WMUH2", "aaaaazzzzz", "Hawaii")], "wbID int, sbt string, chars string, case_name string")
    terrain = literal_frame(spark, [(2, "Light", 0.15)], "TERRAINID int, terrain string, roughness double")
    out = melt_wind_table(wide, types, terrain, literal_frame(spark, DICTIONARY, "code string, char_type string, name string"), WIND_SPEEDS,
                          version="6.1", source_agency="model", source_file="wind.csv", source_table="wind", defect_note="copied")
    curves = {r["curve_id"]: r for r in out["curves"].collect()}
    assert set(curves) == {"hu-6.1-damage_slight-11-t2", "hu-6.1-loss_of_use-11-t2"}
    slight = curves["hu-6.1-damage_slight-11-t2"]
    assert (slight["source_row_id"], slight["defect_flag"], slight["building_type"]) == ("11/2/1", "copied", "WMUH2")
    assert out["curve_points"].count() == 2 * 41
    keys = {r["key"]: r["value"] for r in out["curve_attributes"].where("curve_id LIKE '%slight%'").collect()}
    assert keys == {"wind_building_type_id": "11", "specific_building_type": "WMUH2", "terrain_id": "2", "terrain": "Light",
                    "surface_roughness_m": "0.15", "geographic_case": "Hawaii", "characteristic_code": "aaaaazzzzz",
                    "Shape": "Hip", UNMAPPED_KEY: "zzzzz"}


def test_attributes_map_refuses_two_values(spark):
    rows = [("a", "k", "1"), ("a", "k", "1"), ("a", "m", None)]
    packed = reshape.attributes_map(literal_frame(spark, rows, "curve_id string, key string, value string")).first()
    assert packed["attributes"] == {"k": "1", "m": None}
    with pytest.raises(Exception, match="(?i)duplicate"):
        reshape.attributes_map(literal_frame(spark, [("a", "k", "1"), ("a", "k", "2")], "curve_id string, key string, value string")).collect()


def test_flags_count_only_ones(spark):
    lut = literal_frame(spark, [("a", "1", " 1.0 ", ""), ("b", None, "0", "NULL")], "id string, r string, ca string, cv string")
    rows = reshape.flags_to_zones(lut, {"Riverine": "r", "CoastalA": "ca", "CoastalV": "cv"}, ["id"]).collect()
    assert {tuple(r) for r in rows} == {("a", "Riverine"), ("a", "CoastalA")}


def test_kinds_cover_the_loss_classes(spark):
    from curveloom.fixed_values import LOSS_CLASSES

    units = {(peril, kind): y for peril, kind, _, _, _, y, _ in CURVE_KINDS}
    assert len(units) == 12 and all(units["hu", name] == unit for _, name, unit in LOSS_CLASSES)


def test_peril_slice(spark):
    curves = literal_frame(spark, [("a", "fl"), ("b", "hu")], "curve_id string, peril string")
    points = literal_frame(spark, [("a", 1.0), ("b", 2.0)], "curve_id string, x double")
    dims = literal_frame(spark, [("RES1",)], "occupancy string")
    out = reshape.slice_tables({"curves": curves, "curve_points": points, "dim_occupancy": dims}, "hu")
    assert [r["x"] for r in out["curve_points"].collect()] == [2.0] and out["dim_occupancy"].count() == 1
