"""Reading loosely typed attributes and the issues they raise."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from layerlint.config import Bounds, Limits
from layerlint.functions.attributes import attributes_of
from layerlint.functions.parsing import attribute_date, attribute_number, flexible_date, parse_csv_list, text_number
from layerlint.functions.text import format_issues
from layerlint.operators.schema import feature_shape_issues, metadata_issues

GOOD = {
    "id": "a", "sourceId": None, "updateDate": "2024-01-01", "sensors": "s", "desc": None, "sourceRes": "1", "ep90": "5",
    "cities": "", "countries": None, "publishRes": "2", "classify": "c", "sourceName": "n", "scale": None,
}


def single(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize("text, items", [
    (None, []), ("", []), (" , ,", []), ("a", ["a"]), (" a\t,b ,, c\n", ["a", "b", "c"]),
])
def test_csv_list(spark, text, items):
    assert single(spark, parse_csv_list, text) == items


@pytest.mark.parametrize("text, moment", [
    ("05/03/2024", dt.datetime(2024, 3, 5)), ("2024-03-05", dt.datetime(2024, 3, 5)), ("2024-03", dt.datetime(2024, 3, 1)),
    ("2024-03-05T10:20:30.5Z", dt.datetime(2024, 3, 5, 10, 20, 30, 500000)),
    ("2024-03-05T10:20:30+02:00", dt.datetime(2024, 3, 5, 8, 20, 30)),
    ("31/02/2024", None), ("12:00:00", None), ("not a date", None), ("", None), ("5/3/2024", None),
])
def test_flexible_date(spark, text, moment):
    got = single(spark, lambda c: F.date_format(flexible_date(c), "yyyy-MM-dd HH:mm:ss.SSS"), text)
    assert got == (moment and moment.strftime("%Y-%m-%d %H:%M:%S.%f")[:-3])


@pytest.mark.parametrize("text, number", [
    ("12", 12.0), (" 1.5 ", 1.5), ("", 0.0), ("  ", 0.0), (".5", 0.5), ("5.", 5.0), ("-1e3", -1000.0), ("1d", None), ("inf", None),
    ("NaN", None), ("0x10", None), ("1,5", None), ("Infinity", float("inf")), ("-Infinity", float("-inf")), ("abc", None),
])
def test_text_number(spark, text, number):
    assert single(spark, text_number, text) == number


def test_null_and_missing_differ(spark):
    row = spark.createDataFrame([({"ep90": None, "updateDate": None},)], "properties map<string,string>")
    a = attributes_of(row)
    got = row.select(
        attribute_number(a["ep90"]).alias("null_number"), attribute_number(a["sourceRes"]).alias("missing_number"),
        F.unix_micros(attribute_date(a["updateDate"])).alias("null_date"),
    ).first()
    assert (got.null_number, got.missing_number, got.null_date) == (0.0, None, 0)


def issues(spark, changes=None, drop=(), limits=Limits()):
    properties = {k: v for k, v in {**GOOD, **(changes or {})}.items() if k not in drop}
    frame = spark.createDataFrame([(1, properties)], "vertices int, properties map<string,string>")
    return metadata_issues(frame, limits).select(format_issues(F.col("issues")).alias("t")).first().t


@pytest.mark.parametrize("changes, drop, text", [
    ({}, (), ""),
    ({"id": None}, (), "properties.id: Expected string, received null (code: invalid_type)"),
    ({}, ("id",), "properties.id: Required (code: invalid_type)"),
    ({}, ("sourceId", "desc", "scale"), ""),
    ({}, ("sensors",), "properties.sensors: Required (code: invalid_type)"),
    ({"ep90": "4001"}, (), "properties.ep90: Horizontal accuracy CE90 should not be larger than 4000 (code: too_big)"),
    ({"ep90": ""}, (), "properties.ep90: Horizontal accuracy CE90 should not be less than 0.01 (code: too_small)"),
    ({}, ("ep90",), "properties.ep90: Horizontal accuracy CE90 should be a number (code: invalid_type)"),
    ({"scale": "0.5"}, (), "properties.scale: Scale must be a positive number (code: too_small)"),
    ({"scale": "x"}, (), "properties.scale: Expected number, received nan (code: invalid_type)"),
    ({"updateDate": None}, (), ""),
    ({"updateDate": "x", "classify": None}, (),
     "properties.updateDate: Expected a valid date format (ISO 8601 or DD/MM/YYYY) (code: invalid_date); "
     "properties.classify: Expected string, received null (code: invalid_type)"),
    ({}, ("updateDate",), "properties.updateDate: Expected a valid date format (ISO 8601 or DD/MM/YYYY) (code: invalid_date)"),
])
def test_issues(spark, changes, drop, text):
    assert issues(spark, changes, drop) == text


def test_bounds_are_inclusive_and_configurable(spark):
    limits = Limits(bounds=Bounds(ce90_min=1, ce90_max=2))
    assert issues(spark, {"ep90": "1"}, limits=limits) == "" == issues(spark, {"ep90": "2"}, limits=limits)
    assert issues(spark, {"ep90": "2.5"}, limits=limits).endswith("should not be larger than 2 (code: too_big)")


def test_variant_keeps_types(spark):
    json = '{"id": 7, "updateDate": 0, "sensors": null, "sourceRes": 1, "ep90": true, "cities": "a", "countries": "b", "publishRes": "3", "classify": "c", "sourceName": ["n"]}'
    frame = spark.createDataFrame([(1, json)], "vertices int, j string").select("vertices", F.parse_json("j").alias("properties"))
    text = metadata_issues(frame).select(format_issues(F.col("issues")).alias("t")).first().t
    assert text == ("properties.id: Expected string, received number (code: invalid_type); "
                    "properties.sourceName: Expected string, received array (code: invalid_type)")


def test_shape_issues(spark):
    schema = "type string, bbox array<double>, geometry struct<type:string,coordinates:array<array<array<array<double>>>>>"
    ring = [[0.0, 0.0], [1.0, 0.0], [1.0, 1.0], [0.0, 0.0]]
    rows = [
        ("Feature", None, ("Polygon", [[ring]])), ("Feature", [0.0, 0.0, 1.0, 1.0], ("MultiPolygon", [[ring], [ring]])),
        ("X", None, ("Polygon", [[ring]])), ("Feature", [1.0], ("Polygon", [[ring], [ring]])), (None, None, None),
        ("Feature", None, ("Polygon", [[[[0.0]]]])), ("Feature", None, ("Point", [[ring]])), ("Feature", None, ("Polygon", None)),
        ("Feature", None, ("Polygon", [[[[0.0, None]]]])),
    ]
    got = feature_shape_issues(spark.createDataFrame(rows, schema)).select(F.transform("issues", lambda i: i["path"]).alias("p")).collect()
    assert [r.p for r in got] == [[], [], ["type"], ["bbox", "geometry"], ["type", "geometry"], ["geometry"], ["geometry"], ["geometry"], ["geometry"]]
