"""Literals: rendered text, its meaning to Spark SQL, and the way back."""

from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.functions.literals import parse_literal, quote_text, render_literal
from lakeferry.functions.typed import apply_schema
from lakeferry.functions.types import build_schema

INF = float("inf")
# How SQL spells literals of each type.
CASES = [
    ("TINYINT", 127, "127Y"),
    ("TINYINT", -128, "-128Y"),
    ("SMALLINT", -32768, "-32768S"),
    ("INT", 2147483647, "2147483647"),
    ("BIGINT", -(2**63), "-9223372036854775808L"),
    ("DECIMAL(5,2)", Decimal("-1.10"), "-1.10BD"),
    ("FLOAT", 1.5, "1.5F"),
    ("FLOAT", INF, "float('inf')"),
    ("DOUBLE", 1.1, "1.1D"),
    ("DOUBLE", -INF, "double('-inf')"),
    ("DOUBLE", -1.79769e308, "-1.79769E308D"),
    ("DATE", dt.date(1, 1, 1), "DATE'0001-01-01'"),
    ("TIMESTAMP_NTZ", dt.datetime(2014, 1, 1), "TIMESTAMP_NTZ'2014-01-01T00:00:00'"),
    ("TIMESTAMP", dt.datetime(2014, 1, 1, 0, 0, 0, 120), "TIMESTAMP'2014-01-01T00:00:00.000120'"),
    ("BINARY", b"a", "X'61'"),
    ("BOOLEAN", True, "true"),
    ("STRING", "a", '"a"'),
    ("STRING", 'abc"', '"abc\\""'),
    ("STRING", "NULL", '"NULL"'),
    ("ARRAY<INT>", [1, 2, 3], "ARRAY(1, 2, 3)"),
    ("ARRAY<TINYINT>", [42], "ARRAY(42Y)"),
    ("ARRAY<STRING>", [], "ARRAY()"),
    ("ARRAY<STRING>", ["a, b", 'c")', None], 'ARRAY("a, b", "c\\")", NULL)'),
    ("ARRAY<DATE>", [dt.date(2023, 1, 1)], "ARRAY(DATE'2023-01-01')"),
    ("ARRAY<ARRAY<INT>>", [[1, 2], [], [3]], "ARRAY(ARRAY(1, 2), ARRAY(), ARRAY(3))"),
    ("MAP<STRING, BIGINT>", {"a": 1, "b": 2}, 'MAP("a", 1L, "b", 2L)'),
    ("MAP<STRING, ARRAY<INT>>", {"a": [1]}, 'MAP("a", ARRAY(1))'),
    ("STRUCT<a: INT, b: STRING>", (1, "2"), 'named_struct("a",1,"b","2")'),
    (
        "MAP<STRING, ARRAY<STRUCT<day: DATE, open: BOOLEAN>>>",
        {"shop": [(dt.date(2020, 2, 29), True), (dt.date(2021, 3, 1), None)], "store": []},
        'MAP("shop", ARRAY(named_struct("day",DATE\'2020-02-29\',"open",true), '
        'named_struct("day",DATE\'2021-03-01\',"open",NULL)), "store", ARRAY())',
    ),
    ("STRUCT<`é`: INT, `q\"x`: STRING>", (7, "v"), 'named_struct("\\u00e9",7,"q\\"x","v")'),
]


def one(spark, dtype, value):
    schema = T.StructType([T.StructField("v", dtype)])
    return spark.createDataFrame([(value,)], schema)


@pytest.mark.parametrize(("kind", "value", "text"), CASES)
def test_render_parse_and_meaning(spark, kind, value, text):
    dtype = T.DataType.fromDDL(kind)
    df = one(spark, dtype, value)
    shown = df.select(render_literal(F.col("v"), dtype).alias("t"), "v")
    row = shown.select("t", parse_literal(F.col("t"), dtype).alias("back"), "v").first()
    assert row["t"] == text
    assert row["back"] == row["v"]
    if text != "ARRAY()":
        meant = spark.sql(f"SELECT {text} AS v").first()["v"]
        assert meant == row["v"] or repr(meant) == repr(row["v"])


@pytest.mark.parametrize("kind", ["INT", "FLOAT", "ARRAY<STRING>", "STRING", "STRUCT<a: INT>", "DATE"])
def test_null(spark, kind):
    dtype = T.DataType.fromDDL(kind)
    df = one(spark, dtype, None).select(render_literal(F.col("v"), dtype).alias("t"))
    assert df.first()["t"] == "NULL"
    assert df.select(parse_literal(F.col("t"), dtype)).first()[0] is None


def test_nan(spark):
    df = one(spark, T.DoubleType(), float("nan"))
    text = df.select(render_literal(F.col("v"), T.DoubleType()).alias("t"))
    assert text.first()["t"] == "double('NaN')"
    back = text.select(parse_literal(F.col("t"), T.DoubleType())).first()[0]
    assert back != back


def test_plain_text_and_rubbish(spark):
    df = one(spark, T.StringType(), "17")
    assert df.select(parse_literal(F.col("v"), T.IntegerType())).first()[0] == 17
    df = one(spark, T.StringType(), "2014-01-01")
    assert df.select(parse_literal(F.col("v"), T.DateType())).first()[0] == dt.date(2014, 1, 1)
    for bad in ("ARRAY(1, x)", "ARRAY(1, 2", "MAP(1)", "x"):
        df = one(spark, T.StringType(), bad)
        array = T.ArrayType(T.IntegerType())
        assert df.select(parse_literal(F.col("v"), array)).first()[0] is None


def test_long_text_does_not_overflow_the_matcher(spark):
    value = ['say "x", ' * 50_000]
    dtype = T.ArrayType(T.StringType())
    text = one(spark, dtype, value).select(render_literal(F.col("v"), dtype).alias("t"))
    assert text.select(parse_literal(F.col("t"), dtype)).first()[0] == value


def test_variant_literal(spark):
    df = spark.sql("SELECT parse_json('{\"a\": [1, \"x\"]}') AS v")
    text = df.select(render_literal(F.col("v"), T.VariantType()).alias("t"))
    assert text.first()["t"] == 'PARSE_JSON("{\\"a\\":[1,\\"x\\"]}")'
    back = text.select(parse_literal(F.col("t"), T.VariantType()).alias("v"))
    assert back.selectExpr("variant_get(v, '$.a[1]', 'string')").first()[0] == "x"


def test_interval_literal(spark):
    df = spark.sql("SELECT INTERVAL '1 02:03:04' DAY TO SECOND AS v")
    dtype = df.schema["v"].dataType
    text = df.select(render_literal(F.col("v"), dtype).alias("t"))
    assert text.first()["t"].startswith("INTERVAL '1 02:03:04")
    assert text.select(parse_literal(F.col("t"), dtype)).first()[0] == df.first()[0]


@settings(
    max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture]
)
@given(st.lists(st.text(max_size=30), min_size=1, max_size=20))
def test_quoting_is_json_in_ascii(spark, values):
    values = [v.encode("utf-8", "ignore").decode() for v in values]
    df = spark.createDataFrame(list(enumerate(values)), "i int, v string")
    got = df.orderBy("i").select(
        quote_text(F.col("v")).alias("t"),
        parse_literal(quote_text(F.col("v")), T.StringType()).alias("back"),
    )
    for row, value in zip(got.collect(), values, strict=True):
        assert row["t"] == json.dumps(value)
        assert row["back"] == value


def test_apply_schema(spark):
    df = spark.createDataFrame(
        [("1", "2.50", "true", "[1, 2]", '{"a": 1}')],
        "a string, b string, c string, d string, e string",
    )
    schema = build_schema(
        {"a": "INT", "b": "DECIMAL(4,2)", "c": "BOOLEAN", "d": "ARRAY<INT>", "e": "JSON", "z": "INT"}
    )
    out = apply_schema(df, schema)
    row = out.selectExpr("a", "b", "c", "d", "variant_get(e, '$.a', 'int') AS e").first()
    assert tuple(row) == (1, Decimal("2.50"), True, [1, 2], 1)
    assert out.columns == ["a", "b", "c", "d", "e"]


def test_apply_schema_refuses(spark):
    df = spark.createDataFrame([("x",)], "a string")
    with pytest.raises(ValueError, match="not in the schema"):
        apply_schema(df, build_schema("b INT"))
    with pytest.raises(Exception, match="not a INT"):
        apply_schema(df, build_schema("a INT")).collect()
    assert apply_schema(df, build_schema("a INT"), on_error="null").first()[0] is None
    with pytest.raises(Exception, match="not a JSON"):
        apply_schema(df, build_schema({"a": "JSON"})).collect()
