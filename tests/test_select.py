from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from curveloom.fixed_values import ATTRIBUTE_LABELS, CURVE_KINDS
from curveloom.functions.literal import literal_frame
from curveloom.operators import aggregate as ag, filters as fl
from curveloom.operators.lookup import get_curve
from curveloom.plans.search import match_curves, search
from curveloom.schema import TABLES

CURVE_DDL = ("curve_id string, peril string, version string, damage_type string, occupancy string, building_type string, "
             "source_agency string, description string, defect_flag string, defect_verified string, source_table string")
KIND_DDL = "peril string, damage_type string, x_name string, x_units string, y_name string, y_units string, interpolation string"


def curve(curve_id, damage_type="structure", defect=None, peril="fl", occupancy="RES1"):
    return (curve_id, peril, "6.1", damage_type, occupancy, None, "agency", "d", defect, None, "t")


@pytest.fixture(scope="module")
def kinds(spark):
    return literal_frame(spark, CURVE_KINDS, KIND_DDL)


@pytest.fixture(scope="module")
def curves(spark):
    return literal_frame(spark, [curve("c1"), curve("c2", defect="bad"), curve("c3", "contents")], CURVE_DDL)


@pytest.fixture(scope="module")
def points(spark):
    rows = [("c1", 0.0, 1.0), ("c1", 1.0, None), ("c1", 2.0, None), ("c2", 0.0, 3.0), ("c2", 1.0, 5.0), ("c2", 2.0, None),
            ("c3", 0.0, 9.0), ("c3", 1.0, 9.0), ("c3", 2.0, 9.0)]
    return literal_frame(spark, rows, "curve_id string, x double, y double")


AVERAGE = [(0.0, 2.0, 1.0, 1.0, 3.0, 2), (1.0, 5.0, 0.0, 5.0, 5.0, 1), (2.0, None, None, None, None, 0)]


def test_average_keeps_empty_x(points):
    rows = ag.average_curve(points.where("curve_id != 'c3'")).orderBy("x").collect()
    assert [tuple(r) for r in rows] == AVERAGE


def test_search_averages(curves, points, kinds):
    found = search(curves, points, kinds, equals={"damage_type": "structure"})
    assert found.guard.first()["status"] == "ok"
    rows = found.rows().orderBy("x").collect()
    assert [(r["x"], r["y"], r["y_std"], r["y_min"], r["y_max"], r["n_at_x"]) for r in rows] == AVERAGE
    assert {r["curve_id"] for r in rows} == {"DERIVED"}


def test_search_refuses_mixed_types(curves, points, kinds):
    found = search(curves, points, kinds)
    guard = found.guard.first()
    assert (guard["status"], guard["n_curves"], guard["n_damage_types"]) == ("heterogeneous", 3, 2)
    assert found.rows().count() == 0
    with pytest.raises(Exception, match="2 damage types"):
        found.rows(strict=True).collect()


def test_search_single_and_empty(curves, points, kinds):
    one = search(curves, points, kinds, reuse=False, equals={"curve_id": "c1"}).rows().orderBy("x").collect()
    assert [(r["curve_id"], r["y"], r["n_at_x"]) for r in one] == [("c1", 1.0, 1), ("c1", None, 0), ("c1", None, 0)]
    nothing = search(curves, points, kinds, equals={"occupancy": "AGR1"})
    assert nothing.guard.first()["status"] == "empty" and nothing.rows().count() == 0


def test_units_must_agree(spark, kinds):
    mixed = literal_frame(spark, [curve("a", "building_loss", peril="hu"), curve("b", "loss_of_use", peril="hu")], CURVE_DDL)
    assert ag.unit_guard(mixed, kinds).first()["n_units"] == 2
    assert ag.unit_guard(mixed).first()["status"] == "heterogeneous"


def test_derived_rows(curves, points):
    rows = ag.derived_rows(curves.where("damage_type = 'structure'"), points, ["damage_type"]).orderBy("x").collect()
    assert [(r["derived_id"], r["n_constituents"]) for r in rows] == [("structure", 2)] * 3
    assert {(r["curve_id"], r["version"], r["defect_flag"]) for r in rows} == {("DERIVED", "6.1", "see constituent curves")}


def test_no_constituent_is_lost(spark, curves):
    assert ag.constituents(curves, ["damage_type"]).count() == 3
    many = spark.range(12_000).select(F.format_string("m%05d", "id").alias("curve_id"), F.lit("t").alias("damage_type"))
    lists = ag.constituent_lists(many, ["damage_type"]).collect()
    found = [i for r in lists for i in r["constituent_curve_ids"].split("|")]
    assert sorted(found) == [f"m{i:05d}" for i in range(12_000)] and len(lists) == 12
    assert {r["n_constituents"] for r in lists} == {12_000} and max(len(r["constituent_curve_ids"]) for r in lists) < 10_000
    assert ag.constituents(many, ["damage_type"]).count() == 12_000


ATTRIBUTES = [("c1", "shape", "hip"), ("c1", "deck", "8d"), ("c2", "shape", "hip"), ("c2", "deck", "6d"), ("c3", "shape", "gable"),
              ("c1", "geographic_case", "A+B"), ("c2", "geographic_case", "B"), ("c3", "geographic_case", "A"), ("c1", "deck", "6d")]
CASES = [("A+B", "A"), ("A+B", "B"), ("A", "A"), ("B", "B")]


def ids(df):
    return sorted(r["curve_id"] for r in df.select("curve_id").collect())


def test_attribute_and_territory_filters(spark, curves):
    attributes = literal_frame(spark, ATTRIBUTES, "curve_id string, key string, value string")
    cases = literal_frame(spark, CASES, "case_name string, territory string")
    assert ids(fl.attribute_filter(curves, attributes, [])) == ["c1", "c2", "c3"]
    assert ids(fl.attribute_filter(curves, attributes, [("shape", "hip")])) == ["c1", "c2"]
    assert ids(fl.attribute_filter(curves, attributes, [("shape", "hip"), ("deck", "6d")])) == ["c1", "c2"]
    assert ids(fl.attribute_filter(curves, attributes, [("deck", "8d"), ("deck", "6d")])) == ["c1"]
    many = [("shape", "hip")] * 70 + [("deck", "8d")]
    assert ids(fl.attribute_filter(curves, attributes, many)) == ["c1"]
    assert ids(fl.territory_filter(curves, attributes, cases, "A")) == ["c1", "c3"]
    assert ids(match_curves(curves, attributes, cases, pairs=[("shape", "hip")], territory="B")) == ["c1", "c2"]
    assert ids(match_curves(curves, attributes, cases, pairs=[("deck", "8d")], territory="A")) == ["c1"]
    assert ids(match_curves(curves, attributes, cases, territory="A")) == ["c1", "c3"]


def test_zone_filter_reads_applicability(spark, curves):
    zones = literal_frame(spark, [("c1", "Riverine"), ("c1", "CoastalA"), ("c9", "Riverine")], "curve_id string, flood_zone string")
    assert ids(match_curves(curves, applicability=zones, zone="Riverine")) == ["c1"]


def test_filter_curves_limit_zero_is_no_limit(curves):
    assert ids(fl.filter_curves(curves, limit=0, damage_type=None)) == ["c1", "c2", "c3"]
    assert [r["curve_id"] for r in fl.filter_curves(curves, limit=2, occupancy="RES1").collect()] == ["c1", "c2"]


def test_labels(spark, kinds):
    rows = literal_frame(spark, [("Roof Frame Type", "OWSJ"), ("Shutters", "Yes")], "key string, value string")
    labels = literal_frame(spark, ATTRIBUTE_LABELS, "key string, value string, label string")
    assert {r["label"] for r in fl.display_label(rows, labels).collect()} == {"Open-web steel joist (OWSJ)", "Yes"}
    types = literal_frame(spark, [("hu", "loss_of_use"), ("hu", "new_class")], "peril string, damage_type string")
    got = {r["damage_type"]: (r["y_units"], r["y_label"]) for r in fl.axis_labels(types, kinds).collect()}
    assert {r["x_label"] for r in fl.axis_labels(types, kinds).collect()} == {"3-second peak gust (mph)"}
    assert {r["value"] for r in fl.default_filters(literal_frame(spark, [("terrain", "Open"), ("terrain", "Suburban")], "key string, value string"), "hu").collect()} == {"Open"}
    assert got["loss_of_use"] == ("days", "Loss of use (days)") and got["new_class"][0] == "mixed"
    keys = literal_frame(spark, [("Zeta",), ("Shutters",), ("Alpha",), ("Roof Shape",), ("terrain",), (None,)], "key string")
    assert [r["key"] for r in fl.priority_order(keys).collect()] == ["Roof Shape", "Shutters", "Alpha", "Zeta"]


def test_default_curve_matches_missing_and_blank(spark):
    ddl = "rule_id string, version string, damage_type string, occupancy string, flood_zone string, stories string, basement string, curve_id string"
    rules = literal_frame(spark, [("r1", "6.1", "structure", "RES1", "Riverine", "1 Story", "", "c129"), ("r2", "6.1", "structure", "RES1", "Riverine", "1 Story", "1", "c130"), ("r9", "6.1", "structure", "RES1", "Riverine", "1 Story", None, "c999")], ddl)
    asked = literal_frame(spark, [(1, "6.1", "structure", "RES1", "Riverine", "1 Story", None), (2, "6.1", "structure", "RES1", "Riverine", "1 Story", "1"), (3, "6.1", "structure", "RES9", "Riverine", None, None)],
                          "request_id int, version string, damage_type string, occupancy string, flood_zone string, stories string, basement string")
    assert fl.default_curve(rules, asked).count() == 3
    assert {r["request_id"]: r["curve_id"] for r in fl.default_curve(rules, asked).collect()} == {1: "c129", 2: "c130", 3: None}


def test_get_curve(spark, curves, points, kinds):
    attributes = literal_frame(spark, [("c1", "basement", "1")], "curve_id string, key string, value string")
    wanted = literal_frame(spark, [("c1",), ("zz",)], "curve_id string")
    got = {r["curve_id"]: r for r in get_curve(curves, points, attributes, kinds, wanted, [0.0, 1.0, 2.0]).collect()}
    assert [tuple(p) for p in got["c1"]["points"]] == [(0.0, 1.0), (1.0, None), (2.0, None)]
    assert got["c1"]["attributes"] == {"basement": "1"} and got["c1"]["kind"]["y_units"] == "percent"
    assert got["zz"]["found"] is False and got["zz"]["points"] is None
    with pytest.raises(Exception, match="no such curve: zz"):
        get_curve(curves, points, attributes, kinds, wanted, [0.0, 1.0, 2.0], strict=True).collect()


def test_registry():
    assert len(TABLES) == 10 and len(TABLES["curves"].columns) == 13
    assert all(set(t.pk) <= set(t.required) for t in TABLES.values())
