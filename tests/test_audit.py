from __future__ import annotations

import pytest

from curveloom.fixed_values import DIFFERS, IDENTICAL
from curveloom.functions.literal import literal_frame
from curveloom.operators import audit, contracts, diff, evidence, rules as ru
from curveloom.plans.library import verify_duplicates

POINTS = "curve_id string, x double, y double"
OLD = {"1": (0, 5, None), "2": (0, 5, 9), "3": (0, 5, 9)}
NEW = {"1": (0, 5, None), "2": (0, 5, None), "4": (0, 5, 9)}
CHANGES = {"1": "same", "2": "changed", "3": "removed", "4": "added"}


def long(spark, curves):
    rows = [(c, float(i), None if y is None else float(y)) for c, ys in curves.items() for i, y in enumerate(ys)]
    return literal_frame(spark, rows, POINTS)


def wide(spark, curves):
    rows = [(c, *[None if y is None else float(y) for y in ys]) for c, ys in curves.items()]
    return literal_frame(spark, rows, "curve_id string, p0 double, p1 double, p2 double")


def changes(df):
    return {r["curve_id"]: r["change"] for r in df.collect()}


def test_diff_forms_agree(spark):
    assert changes(diff.diff_wide(wide(spark, OLD), wide(spark, NEW))) == CHANGES
    assert changes(diff.diff_curves(long(spark, OLD), long(spark, NEW))) == CHANGES
    assert changes(diff.diff_curves(long(spark, OLD), long(spark, NEW), [0, 1, 2])) == CHANGES
    with pytest.raises(Exception, match="curve leaves the grid"):
        diff.diff_curves(long(spark, OLD), long(spark, NEW), [0, 1]).collect()


def test_a_library_does_not_differ_from_itself(spark):
    assert set(changes(diff.diff_curves(long(spark, OLD), long(spark, OLD), [0, 1, 2])).values()) == {"same"}
    row = diff.corroborate(wide(spark, OLD), wide(spark, OLD)).first()
    assert tuple(row) == (3, 9, 0, True)
    assert tuple(diff.corroborate(wide(spark, OLD), wide(spark, NEW)).first()) == (2, 6, 3, False)


def test_diff_join_and_sets(spark):
    old, new = long(spark, OLD), long(spark, NEW)
    assert diff.diff_join(old, new).where("NOT (y_old <=> y_new)").count() == 1 + 3 + 3
    got = [sorted(r["curve_id"] for r in f(old, new).collect()) for f in (diff.ids_added, diff.ids_removed, diff.ids_common)]
    assert got == [["4"], ["3"], ["1", "2"]]


def test_verify_duplicates(spark):
    # id, building type, characteristics, terrain, y values
    rows = [
        ("hu-a-t1", "WMUH1", "hip", (0, 1, None)), ("hu-b-t1", "WMUH2", "hip", (0, 1, None)), ("hu-c-t1", "WMUH3", "hip", (0, 2, None)),
        ("hu-d-t1", "WMUH2", "gable", (0, 1, None)), ("hu-e-t2", "WMUH2", "hip", (0, 1, None)), ("hu-f-t1", "MMUH2", "hip", (0, 1, None)),
        ("hu-g-t1", "WMUH1", "hip", (0, 2, None)), ("hu-h-t1", "WMUH2", None, (0, 1, None)), ("hu-i-t1", "WMUH1", None, (0, 1, None)),
        ("hu-j-t1", "OTHER2", "hip", (0, 1, None)), ("hu-k-t1", "WMUH2", "hip", (0, 1, 1)),
    ]
    curves = literal_frame(spark, [(i, b, c, "damage_slight", None) for i, b, c, _ in rows],
                           "curve_id string, building_type string, description string, damage_type string, defect_verified string")
    verdict, checked, summary = verify_duplicates(curves, long(spark, {i: ys for i, _, _, ys in rows}), [0, 1, 2])
    got = {r["curve_id"][3]: (r["is_duplicate"], r["had_counterpart"]) for r in verdict.collect()}
    assert got == {"b": (True, True), "c": (True, True), "d": (False, False), "e": (False, False), "f": (False, False),
                   "h": (False, False), "k": (False, True)}
    marks = {r["curve_id"][3]: r["defect_verified"] for r in checked.collect()}
    assert marks == {**{c: None for c in "agij"}, **{c: IDENTICAL for c in "bc"}, **{c: DIFFERS for c in "defhk"}}
    assert {r["building_type"]: (r["n_curves"], r["n_duplicate"], r["n_no_counterpart"]) for r in summary.collect()} == {
        "WMUH2": (5, 1, 3), "WMUH3": (1, 1, 0), "MMUH2": (1, 0, 1)}


def test_hot_sibling_group_does_not_multiply(spark):
    """A thousand base curves and a thousand others under one key stay a thousand verdicts."""
    from curveloom.operators.duplicates import sibling_compare

    packed = spark.range(2000).selectExpr(
        "CAST(id AS string) AS curve_id", "'k' AS k", "IF(id < 1000, '1', '2') AS level", "array(CAST(id % 1000 % 7 AS double)) AS ys")
    verdict = sibling_compare(packed, ["k"], "level", "1", ["2"])
    assert verdict.count() == 1000 and verdict.where("is_duplicate AND had_counterpart").count() == 1000


def test_profile(spark):
    df = literal_frame(spark, [("b", 1), ("a", 2), (None, 2), ("c", 2), ("d", None), ("a", 3)], "t string, n bigint")
    rows = {r["column_name"]: tuple(r)[1:] for r in audit.profile_table(df).collect()}
    assert rows == {"t": ("string", 6, 1, 4, "a", "b", "c"), "n": ("bigint", 6, 1, 3, "1", "2", "3")}
    quick = {r["column_name"]: tuple(r)[1:] for r in audit.profile_table(df, exact=False).collect()}
    assert quick == {"t": ("string", 6, 1, 4, "a", None, None), "n": ("bigint", 6, 1, 3, "1", None, None)}


def test_code_lists(spark):
    used = literal_frame(spark, [("a",), ("b",), ("b",), (None,)], "code string")
    listed = literal_frame(spark, [("b",), ("c",)], "code string")
    assert {tuple(r) for r in audit.dimension_gaps(used, listed, "code").collect()} == {("a", "missing"), ("c", "unused")}
    with pytest.raises(Exception, match="no description found for: a"):
        audit.dimension_gaps(used, listed, "code", strict=True).collect()


def test_dangling_references(spark):
    refs = literal_frame(spark, [("a",), ("x",)], "curve_id string")
    curves = literal_frame(spark, [("a",), ("b",)], "curve_id string")
    assert [r["curve_id"] for r in contracts.dangling_refs(refs, curves).collect()] == ["x"]
    assert contracts.require_known(refs.where("curve_id = 'a'"), curves).count() == 1
    for broken in (contracts.dangling_refs(refs, curves, strict=True), contracts.require_known(refs, curves)):
        with pytest.raises(Exception, match="does not exist: x"):
            broken.collect()


LUT = "row_no int, Occupancy string, Stories string, DDF_ID string, Basement string, HazardRiverine string, HazardCV string, HazardCA string, source_file string, source_table string"
LUT_ROWS = [
    (0, "RES1", "1 Story", "658", "", "", "1", "1", "lut.csv", "lut"), (1, "RES1", "1 Story", "114", "1", "", "1", "1", "lut.csv", "lut"),
    (2, "RES1", "2 Story", "107", "", "1", "", "1", "lut.csv", "lut"), (3, "RES1", "2 Story", None, "", "1", "", "1", "lut.csv", "lut"),
]


def test_rules_of_both_vintages(spark):
    lut = literal_frame(spark, LUT_ROWS, LUT)
    final = literal_frame(spark, [(7, 129.0, 1.0, None, 1.0, "final.xlsx", "final"), (7, 130.0, 1.0, None, None, "final.xlsx", "final"), (8, None, 1.0, 1.0, 1.0, "final.xlsx", "final")],
                          "SOccupId int, BldgDmgFnId double, HazardR double, HazardCA double, HazardCV double, source_file string, source_table string")
    xref = literal_frame(spark, [(7, "RES1 ", "1 Story", None)], "SOccupId int, Occupancy string, NumStories string, Basement string")
    rules = ru.assignment_rules([
        ru.rules_from_flags(final, xref, version="6.1", damage_type="structure", id_column="BldgDmgFnId", note="rule"),
        ru.rules_from_lookup(lut, version="4.0", damage_type="structure", zone="CoastalA", row_key="row_no", note="rule"),
    ])
    got = {r["rule_id"]: (r["curve_id"], r["occupancy"], r["stories"], r["basement"], r["notes"]) for r in rules.collect()}
    assert got == {
        "fl-6.1-structure-7-Riverine": ("fl-6.1-structure-129", "RES1", "1 Story", None, None),
        "fl-6.1-structure-7-CoastalV": ("fl-6.1-structure-129", "RES1", "1 Story", None, "rule"),
        "fl-4.0-structure-CoastalA-0": ("fl-4.0-structure-658", "RES1", "1 Story", None, "rule"),
        "fl-4.0-structure-CoastalA-1": ("fl-4.0-structure-114", "RES1", "1 Story", "1", "rule"),
        "fl-4.0-structure-CoastalA-2": ("fl-4.0-structure-107", "RES1", "2 Story", None, "rule"),
    }


def test_zone_applicability(spark):
    from curveloom.fixed_values import LOOKUP_ZONE_FLAGS

    rows = ru.zone_rows(literal_frame(spark, LUT_ROWS, LUT), version="4.0", damage_type="structure", id_column="DDF_ID", flags=LOOKUP_ZONE_FLAGS)
    got = {(r["curve_id"][-3:], r["flood_zone"]) for r in ru.zone_applicability([rows, rows]).collect()}
    assert got == {("658", "CoastalA"), ("658", "CoastalV"), ("114", "CoastalA"), ("114", "CoastalV"), ("107", "Riverine"), ("107", "CoastalA")}
    assert ru.zone_applicability([rows, rows]).count() == 6
    known = literal_frame(spark, [("fl-4.0-structure-658",), ("fl-4.0-structure-114",)], "curve_id string")
    with pytest.raises(Exception, match="fl-4.0-structure-107"):
        ru.zone_applicability([rows], known).collect()


PAGES = "doc string, page int, text string"


def test_evidence(spark):
    pages = literal_frame(spark, [
        ("m", 1, "Page 9-1\nContents. Nothing here."),
        ("m", 2, "Page 9-2\nSome text. In total, there are  62\nindividual WBCs that were included in the updates, shown in Table 9-9. More."),
        ("m", 3, "Page 9-3\nThere are 62 individual WBCs again."),
        ("n", 1, "no stop after this STATEMENT of fact"),
    ], PAGES)
    claims = [("count", "m", r"there are\s+62\s+individual\s+WBCs"), ("open", "n", "statement"), ("absent", "m", "statement"), ("nodoc", "z", "x")]
    got = {r["key"]: (r["found"], r["page"], r["printed_page"], r["quote"]) for r in evidence.find_evidence(pages, claims).collect()}
    assert got["count"] == (True, 2, "9-2", "In total, there are 62 individual WBCs that were included in the updates, shown in Table 9-9.")
    assert got["open"] == (True, 1, None, "no stop after this STATEMENT")
    assert got["absent"] == got["nodoc"] == (False, None, None, None)


def test_code_table(spark):
    head = "SBT # and Name\n"
    pages = literal_frame(spark, [
        ("m", 1, "01_EARLY not in the table"),
        ("m", 2, head + " 01_WSF1   Single Family Homes,  1 Story - Wood \nnoise\n02_WSF2 Two Story"),
        ("m", 3, head + "03_WMUH1 Multi Unit\n01_WSF1 01-Roof Shape Hip 13 26.9 34\n04_LATE Never"),
        ("m", 4, "05_LATER Never"),
        ("n", 1, head), ("n", 2, "01_A One"), ("n", 3, "nothing"), ("n", 4, "02_B After the gap"),
        ("o", 1, "01_A No header"),
    ], PAGES)
    got = {(r["doc"], r["code"]): (r["description"], r["n_descriptions"]) for r in evidence.extract_code_table(pages).collect()}
    assert got == {("m", "WSF1"): ("Single Family Homes, 1 Story - Wood", 1), ("m", "WSF2"): ("Two Story", 1), ("m", "WMUH1"): ("Multi Unit", 1), ("n", "A"): ("One", 1)}
    clash = literal_frame(spark, [("m", 1, head + "01_A One\n02_A Two")], PAGES)
    assert evidence.extract_code_table(clash).first()["n_descriptions"] == 2
    with pytest.raises(Exception, match="different descriptions: A"):
        evidence.extract_code_table(clash, strict=True).collect()


def test_range_report(spark):
    points = long(spark, {"a": (-1, 0, 101), "b": (0, 1.001, None)})
    curves = literal_frame(spark, [("a", "structure"), ("b", "damage_slight")], "curve_id string, damage_type string")
    limits = contracts.limits_frame(spark, [("structure", 0.0, 100.0), ("damage_slight", 0.0, 1.0), ("loss_of_use", 0.0, None)])
    got = {r["damage_type"]: tuple(r)[1:] for r in contracts.out_of_range(points, curves, limits).collect()}
    assert got == {"structure": (1, 1, -1.0, 101.0), "damage_slight": (0, 1, 1.001, 1.001)}
