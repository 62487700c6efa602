"""Scalar expressions: F1-F17 and the hazards H1, H4, H5, H11."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from icuflow.functions import columns as C
from icuflow.functions import dictionary as D
from icuflow.sources.csv import infer_table_name


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr).collect()]


def test_dictionary_is_complete():
    ids = [i for items in D.ITEM_GROUPS.values() for i in items]
    assert len(ids) == len(set(ids)) == 119
    assert set(ids) == set(D.CHART_ITEMS) | set(D.LAB_ITEMS)
    assert len(D.FEATURES_SET_A) == 17 and len(D.FEATURES_SET_B) == 20
    assert D.IMPUTE_SET_A["FIO"] == 52.0


def test_categorical_code(spark):
    got = one(spark, C.categorical_code("v"), [("Obeys Commands",), ("No Response-ETT",), ("4 Spontaneously",),
                                                (" ",), ("abc def",), ("Spontaneously",)], "v string")
    assert got == ["6", "1", "4", None, "abc", "4"]


def test_parse_double_unparsable_and_nan(spark):
    got = one(spark, C.parse_double("v"), [("abc",), ("12.5",), ("NaN",), ("",)], "v string")
    assert got == [None, 12.5, None, None]


def test_unit_conversion(spark):
    rows = [("226707", 70.0), ("678", 98.6), ("3581", 100.0), ("3582", 100.0), ("211", 80.0), ("211", None)]
    got = one(spark, C.unit_convert("i", "v"), rows, "i string, v double")
    assert got[0] == pytest.approx(177.8)
    assert got[1] == pytest.approx(37.0)
    assert got[2] == pytest.approx(45.0)
    assert got[3] == pytest.approx(2.835)
    assert got[4] == 80.0 and got[5] is None


def test_item_group(spark):
    got = one(spark, C.item_group("i"), [("50931",), ("211",), ("99999",)], "i string")
    assert got == ["GLU", "HR", "99999"]


def test_outlier_flags(spark):
    rows = [("HR", 10001.0), ("TEMP", 19.0), ("DBP", -1.0), ("TEMP", 20.0), ("TEMP", 50.0), ("GLU", 5000.0),
            ("HR", None), ("FIO", 1e9)]
    r13 = one(spark, C.outlier_flag("g", "v", D.OUTLIER_RULES_13), rows, "g string, v double")
    r15 = one(spark, C.outlier_flag("g", "v", D.OUTLIER_RULES_15), rows, "g string, v double")
    assert r13 == [True, True, False, False, False, False, False, False]
    assert r15 == [True, True, True, False, False, False, False, False]


def test_age_and_hours(spark):
    rows = [(dt.datetime(2100, 1, 1, 0, 0), dt.datetime(2060, 1, 11, 0, 0),
             dt.datetime(2100, 1, 1, 10, 0), dt.datetime(2100, 1, 2, 10, 0))]
    df = spark.createDataFrame(rows, "admit timestamp, dob timestamp, intime timestamp, t timestamp")
    r = df.select(C.age_years("admit", "dob").alias("a"), C.hours_between("t", "intime").alias("h")).first()
    assert r.a == 40.0 and r.h == 24.0


def test_sex_codes(spark):
    rows = [("F",), ("M",), (None,)]
    assert one(spark, C.sex_code("g", D.SEX_ZERO_FEATURE_TABLE), rows, "g string") == [0, 1, 1]
    assert one(spark, C.sex_code("g", D.SEX_ZERO_SEQUENCE), rows, "g string") == [1, 0, 1]


def test_minmax_constant_and_null(spark):
    got = one(spark, C.minmax_scale("x", 7.0, 7.0), [(7.0,)], "x double")
    assert got == [None]
    got = one(spark, C.minmax_scale("x", 0.0, 10.0), [(5.0,), (None,)], "x double")
    assert got == [0.5, None]


def test_pad_array(spark):
    df = spark.createDataFrame([([[1.0, 2.0], [3.0, 4.0]],)], "s array<array<double>>")
    got = df.select(C.pad_array("s", 4, 2)).first()[0]
    assert got == [[1.0, 2.0], [3.0, 4.0], [-1.0, -1.0], [-1.0, -1.0]]


def test_hour_key(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 1, 1, 13, 59, 59),)], "t timestamp_ntz")
    assert df.select(C.hour_key("t")).first()[0] == "2024-01-01 13"


def test_infer_table_name():
    assert infer_table_name("data/PATIENTS.csv") == "PATIENTS"
    assert infer_table_name("out/chart24Hr.csv") == "chart24Hr"
    assert infer_table_name("x/") == "x/"
