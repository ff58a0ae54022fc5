from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from curveloom.fixed_values import PAGE_LABEL_PATTERN, WIND_NULL_TOKENS
from curveloom.functions import text as tx
from curveloom.functions.axis import axis_of, axis_value, measure_columns
from curveloom.functions.literal import literal_frame

AXES = {
    "m4": -4.0, "m1": -1.0, "p0": 0.0, "p24": 24.0, "ft04m": -4.0, "ft03m": -3.0, "ft02m": -2.0, "ft01m": -1.0,
    "ft00": 0.0, "ft01": 1.0, "ft24": 24.0, "WS50": 50.0, "WS250": 250.0,
    "Occupancy": None, "Source": None, "Comment": None, "Default": None, "Description": None, "m": None, "ftm": None,
}


def one(spark, column, value, ddl="v string"):
    return literal_frame(spark, [(value,)], ddl).select(column.alias("r")).first()["r"]


def test_axis_of_names_and_values(spark):
    assert {n: axis_of(n) for n in AXES} == AXES
    rows = literal_frame(spark, [(n,) for n in AXES], "n string").select("n", axis_value(F.col("n")).alias("x")).collect()
    assert {r["n"]: r["x"] for r in rows} == AXES
    assert list(measure_columns(["p1", "Comment", "m2", "p0"])) == ["m2", "p0", "p1"]


@pytest.mark.parametrize("raw, flood, wind", [
    (" AGR1 ", "AGR1", "AGR1"), ("\t \n", None, None), ("", None, None), (" NULL ", None, "NULL"), (None, None, None),
    (" x ", "x", "x"), ("a  b", "a  b", "a  b"),
])
def test_clean_text(spark, raw, flood, wind):
    assert one(spark, tx.clean_text(F.col("v")), raw) == flood
    assert one(spark, tx.clean_text(F.col("v"), WIND_NULL_TOKENS), raw) == wind


def test_parse_measure(spark):
    for raw, y in ((" 12.5 ", 12.5), ("NULL", None), ("", None), (None, None), ("0", 0.0)):
        assert one(spark, tx.parse_measure(F.col("v"), strict=True), raw) == y
    assert one(spark, tx.parse_measure(F.col("v")), "abc") is None
    assert one(spark, tx.unparsable(F.col("v")), "abc") is True
    assert one(spark, tx.numeric_coerce(F.col("v")), "abc") is None
    with pytest.raises(Exception, match="not a number: abc"):
        one(spark, tx.parse_measure(F.col("v"), strict=True), "abc")


@pytest.mark.parametrize("raw, expected", [("105.0", "105"), (" 105 ", "105"), ("105", "105"), ("A7 ", "A7"), ("10.5", "10.5"), (" ", None), (None, None)])
def test_normalise_id(spark, raw, expected):
    assert one(spark, tx.normalise_id(F.col("v")), raw) == expected


def test_normalise_id_of_double(spark):
    assert one(spark, tx.normalise_id(F.col("v")), 105.0, "v double") == "105"


def test_keys(spark):
    assert one(spark, tx.make_curve_id(F.lit("fl"), F.lit("4.0"), F.lit("structure"), "v"), "105") == "fl-4.0-structure-105"
    assert one(spark, tx.make_curve_id(F.lit("fl"), "v"), None) is None
    assert one(spark, tx.family_of(F.col("v")), "WMUH3") == "WMUH"
    assert one(spark, tx.stories_of(F.col("v")), "WMUH3") == "3"
    assert one(spark, tx.terrain_of(F.col("v")), "hu-6.1-damage_slight-12-t5") == "5"


def test_fold_blanks(spark):
    for raw, expected in ((" a \n b\t\tc ", "a b c"), ("a  b", "a b"), ("a — b", "a — b"), ("x\x1c\x1fy", "x y")):
        assert one(spark, tx.fold_blanks(F.col("v")), raw) == expected == " ".join(raw.split())


def test_printed_label(spark):
    label = tx.printed_label(F.col("v"), PAGE_LABEL_PATTERN)
    assert one(spark, label, "Manual\nPage C-3\ntext") == "C-3"
    assert one(spark, label, "Page 9-12") == "9-12"
    assert one(spark, label, "x" * 600 + "Page 7") is None
