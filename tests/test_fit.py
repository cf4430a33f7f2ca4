"""Conformance, value by value: every case is a row, judged by the column expression."""

from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.functions.fit import conforms
from lakeferry.operators.conform import (
    ConformanceError,
    split_by_fit,
    type_fit_report,
    with_fit,
)

INF = float("inf")


def judge(spark, source: str, values: list, target: str, **options) -> list[bool]:
    stype, ttype = T.DataType.fromDDL(source), T.DataType.fromDDL(target)
    schema = T.StructType([T.StructField("i", T.IntegerType()), T.StructField("v", stype)])
    df = spark.createDataFrame(list(enumerate(values)), schema).coalesce(1)
    fit = conforms(F.col("v"), stype, ttype, **options)
    return [r[0] for r in df.orderBy("i").select(fit).collect()]


BIG = "DECIMAL(38,0)"
CASES = [
    ("BIGINT", "TINYINT", [127, -128, 0], [128, -129, 1000, None]),
    ("BIGINT", "SMALLINT", [32767, -32768], [32768, -32769, 100000, None]),
    ("BIGINT", "INT", [2**31 - 1, -(2**31)], [2**31, -(2**31) - 1, 10**10, None]),
    (BIG, "BIGINT", [Decimal(2**63 - 1), Decimal(-(2**63))], [Decimal(2**63), Decimal(-(10**20))]),
    ("DECIMAL(10,2)", "INT", [Decimal("3.00")], [Decimal("3.10")]),
    ("DOUBLE", "INT", [], [1.0, 1.1]),
    ("STRING", "INT", ["12", "-3", " 7 "], ["a", "1.1", "", "1e3", "99999999999", None]),
    ("BOOLEAN", "TINYINT", [True, False], [None]),
    ("DOUBLE", "DECIMAL(10,0)", [1.1, -1.0, 0.0], [INF, float("nan"), 1e12, None]),
    ("STRING", "DECIMAL(5,2)", ["1.25", "999.99"], ["a", "1000.00", None]),
    (
        "DOUBLE",
        "FLOAT",
        [INF, -INF, 0.0, 1.1, -1.175e-37, 1.175e-37, 3.402e38, -3.402e38, float("nan")],
        [3.5e38, 1.0e-37, -1.0e-40, 1.7e308, None],
    ),
    ("DOUBLE", "DOUBLE", [INF, 0.0, 2.225e-307, -1.79769e308], [1.0e-307, None]),
    ("BIGINT", "FLOAT", [1, 0, -1, 2**63 - 1], [None]),
    ("STRING", "FLOAT", ["1.5", "1e10", "NaN", "-inf"], ["a", "1F", "1e39", None]),
    (
        "STRING",
        "DATE",
        ["2014-1-1", "2014-01-01", "0001-01-01", "9999-12-31"],
        ["a", "2014-01-01T00:00:00", "2014-13-01", "0000-01-01", "2014-02-30", None],
    ),
    ("DATE", "DATE", [dt.date(2014, 1, 1)], [None]),
    ("TIMESTAMP", "DATE", [], [dt.datetime(2014, 1, 1), None]),
    (
        "STRING",
        "TIMESTAMP",
        ["2014-01-01 00:01:01", "2014-01-01T00:00:00", "2014-01-01"],
        ["a", "2014-13-01 00:00:00", None],
    ),
    ("DATE", "TIMESTAMP", [dt.date(2014, 1, 1)], [None]),
    ("TIMESTAMP_NTZ", "TIMESTAMP", [dt.datetime(1, 1, 1), dt.datetime(9999, 12, 31)], [None]),
    ("STRING", "BINARY", ["a"], [None]),
    ("BINARY", "BINARY", [b"a"], [None]),
    ("INT", "BINARY", [], [1]),
    ("BOOLEAN", "BOOLEAN", [True, False], [None]),
    ("STRING", "BOOLEAN", ["true", "False"], ["a", "1", None]),
    ("INT", "BOOLEAN", [], [1, 0]),
    ("STRING", "STRING", ["a", '"abc\\"def', ""], [None]),
    ("INT", "STRING", [], [1, None]),
    ("STRING", "VOID", [None], ["a"]),
    ("INT", "VOID", [None], [1]),
    ("TIMESTAMP", "VARIANT", [dt.datetime(2014, 1, 1), None], []),
    ("INT", "INTERVAL DAY TO SECOND", [1, None], []),
    ("ARRAY<INT>", "ARRAY<TINYINT>", [[1, 2, 3], []], [[1, 1000], [1, None], None]),
    ("ARRAY<STRING>", "ARRAY<INT>", [["1", "2"]], [["1", "a"]]),
    ("ARRAY<DOUBLE>", "ARRAY<INT>", [[]], [[1.0, 2.1]]),
    ("ARRAY<INT>", "ARRAY<VARIANT>", [[1, None]], [None]),
    ("MAP<STRING, BIGINT>", "MAP<STRING, INT>", [{"a": 1}, {}], [{"a": 2**40}, {"a": None}]),
    ("MAP<STRING, INT>", "STRUCT<a: INT>", [{"a": 1}], [{"b": 1}, {"a": 1, "b": 2}, {"a": None}]),
    ("STRUCT<a: INT, b: STRING>", "STRUCT<b: STRING, a: INT>", [(1, "2")], [(1, None), None]),
    ("STRUCT<a: INT>", "STRUCT<a: INT, b: STRING>", [], [(1,)]),
    ("STRUCT<a: INT, b: INT>", "MAP<STRING, INT>", [(1, 2)], [(1, None)]),
]


@pytest.mark.parametrize(("source", "target", "good", "bad"), CASES)
def test_fit(spark, source, target, good, bad):
    assert judge(spark, source, good + bad, target) == [True] * len(good) + [False] * len(bad)


def test_nested_structs(spark):
    source = "ARRAY<STRUCT<name: STRING, col: STRUCT<a: BIGINT, b: ARRAY<STRING>>>>"
    target = "ARRAY<STRUCT<name: STRING, col: STRUCT<a: INT, b: ARRAY<STRING>>>>"
    good = [[("a", (1, ["b", "b"])), ("aa", (2, ["bb"]))]]
    bad = [[("a", (1, ["b"])), ("aa", (2**40, ["bb"]))], [("a", (1, ["b", None]))]]
    assert judge(spark, source, good + bad, target) == [True, False, False]


def test_text_is_not_parsed_when_told_so(spark):
    assert judge(spark, "STRING", ["1"], "INT", parse_text=False) == [False]
    assert judge(spark, "STRING", ["1"], "FLOAT", parse_text=False) == [False]
    assert judge(spark, "STRING", ["true"], "BOOLEAN", parse_text=False) == [False]
    assert judge(spark, "STRING", ["2014-1-1"], "DATE", parse_text=False) == [True]


def test_extra_timestamp_patterns(spark):
    text = ["31.12.2014 10:00"]
    assert judge(spark, "STRING", text, "TIMESTAMP") == [False]
    formats = ("dd.MM.yyyy HH:mm",)
    assert judge(spark, "STRING", text, "TIMESTAMP", timestamp_formats=formats) == [True]


def test_json(spark):
    good = ['{"a": 1}', "[1, 2, 3]", "1", '"a"', "null", " {} ", None]
    bad = ["a", '"k": 1}', "1]", "1}", "1,2", "1]}", "", '{"a": 1} x', '1,"w":2']
    assert judge(spark, "STRING", good + bad, "STRING", json=True) == [True] * 7 + [False] * 9
    assert judge(spark, "TIMESTAMP", [dt.datetime(2014, 1, 1)], "STRING", json=True) == [False]
    assert judge(spark, "MAP<STRING, INT>", [{"a": 1}], "STRING", json=True) == [True]
    assert judge(spark, "ARRAY<DATE>", [[dt.date(2014, 1, 1)]], "STRING", json=True) == [False]


def test_report_counts_in_one_pass(spark):
    df = spark.createDataFrame([(1, "1"), (300, "x"), (None, None)], "a int, b string")
    report = type_fit_report(df, {"a": "TINYINT", "b": "INT"})
    assert [tuple(r) for r in report.collect()] == [
        ("a", "TINYINT", 3, 1, 1, 1),
        ("b", "INT", 3, 1, 1, 1),
    ]
    with pytest.raises(ValueError, match="zz"):
        type_fit_report(df, {"zz": "INT"})


def test_split_and_strict(spark):
    df = spark.createDataFrame([("1",), ("x",), (None,)], "a string")
    accepted, rejected = split_by_fit(df, {"a": "INT"})
    assert {r.a for r in accepted.collect()} == {"1", None}
    assert [r.a for r in rejected.collect()] == ["x"]
    with pytest.raises(ConformanceError):
        split_by_fit(df, {"a": "INT"}, strict=True)
    split_by_fit(accepted, {"a": "INT"}, strict=True)
    assert with_fit(df, {"a": "INT"}, "ok").columns == ["a", "ok"]
