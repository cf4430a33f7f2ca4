from __future__ import annotations

import datetime as dt
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.functions.fit import json_document
from lakeferry.functions.types import schema_ddl, sql_type
from lakeferry.operators.infer import infer_json, infer_schema


def text_type(spark, values, **options):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    return sql_type(infer_schema(df, parse_text=True, **options)["v"].dataType)


@pytest.mark.parametrize(
    ("values", "kind"),
    [
        (["1", "-2"], "INT"),
        (["1", str(2**31)], "BIGINT"),
        (["1", str(-(2**63))], "BIGINT"),
        (["1", str(2**63)], "DECIMAL(38,0)"),
        (["1", "2.5"], "FLOAT"),
        (["1", "1e300"], "DOUBLE"),
        (["1", "NaN"], "FLOAT"),
        (["1F"], "STRING"),
        (["true", "False", None], "BOOLEAN"),
        (["true", "1"], "STRING"),
        (["2014-01-01", "2014-1-2"], "DATE"),
        (["2014-01-01", "2014-01-01T10:00:00"], "TIMESTAMP"),
        (["2014-01-01", "x"], "STRING"),
        (["", "1"], "STRING"),
        ([None, None], "VOID"),
        ([], "VOID"),
    ],
)
def test_text_ladder(spark, values, kind):
    assert text_type(spark, values) == kind


def test_float_option_and_timestamp_patterns(spark):
    assert text_type(spark, ["1.5"], float_type="double") == "DOUBLE"
    assert text_type(spark, ["31.12.2014"]) == "STRING"
    assert text_type(spark, ["31.12.2014"], timestamp_formats=("dd.MM.yyyy",)) == "TIMESTAMP"
    with pytest.raises(ValueError):
        text_type(spark, ["1"], float_type="half")


def test_the_last_row_decides_too(spark):
    """One row out of many widens the type: inference is over the dataset, not its head."""
    df = spark.range(0, 20_000).selectExpr(
        "CASE WHEN id = 19999 THEN 3000000000 ELSE id END AS wide",
        "CASE WHEN id = 19999 THEN 1e300D ELSE 0.5D END AS floating",
        "CASE WHEN id = 19999 THEN 'x' ELSE CAST(id AS STRING) END AS text",
    )
    assert schema_ddl(infer_schema(df, parse_text=True)) == (
        "`wide` BIGINT, `floating` DOUBLE, `text` STRING"
    )


def test_typed_columns(spark):
    schema = (
        "tiny tinyint, big bigint, f double, b boolean, bin binary, d date, t timestamp_ntz,"
        " s string, x decimal(5,2), v void"
    )
    row = (1, 2, 1.5, True, b"a", dt.date(2014, 1, 1), dt.datetime(2014, 1, 1), "1", Decimal("1.1"), None)
    out = infer_schema(spark.createDataFrame([row], schema))
    assert schema_ddl(out) == (
        "`tiny` INT, `big` INT, `f` FLOAT, `b` BOOLEAN, `bin` BINARY, `d` DATE, `t` TIMESTAMP,"
        " `s` STRING, `x` DECIMAL(5,2), `v` VOID"
    )


def test_nested_columns(spark):
    schema = "a array<bigint>, m map<string,bigint>, s struct<x: double, y: array<struct<z: bigint>>>, e array<int>"
    rows = [
        ([1, None], {"k": 2**40}, (1e300, [(1,), None]), []),
        (None, None, None, None),
    ]
    out = infer_schema(spark.createDataFrame(rows, schema))
    assert schema_ddl(out) == (
        "`a` ARRAY<INT>, `m` MAP<STRING, BIGINT>,"
        " `s` STRUCT<x DOUBLE, y ARRAY<STRUCT<z INT>>>, `e` ARRAY<VOID>"
    )


def json_type(spark, documents):
    texts = [(d if isinstance(d, str) or d is None else json.dumps(d),) for d in documents]
    return sql_type(infer_json(spark.createDataFrame(texts, "v string"), "v"))


@pytest.mark.parametrize(
    ("documents", "kind"),
    [
        ([{"a": 1, "b": 2}], "MAP<STRING, INT>"),
        ([{"a": 1}, {"b": 2**40}], "MAP<STRING, BIGINT>"),
        ([{"a": 1.5, "b": 2.25}], "MAP<STRING, FLOAT>"),
        ([{"a": "x"}, {}, None], "MAP<STRING, STRING>"),
        (
            [{"k1": "v1", "k2": True, "k3": 1.1, "k4": 42}],
            "STRUCT<k1 STRING, k2 BOOLEAN, k3 FLOAT, k4 INT>",
        ),
        ([{"a": 1}, {"a": 1, "b": [1, 2]}], "STRUCT<a INT, b ARRAY<INT>>"),
        ([{"a": {"x": 1}, "b": 1}], "STRUCT<a STRUCT<x INT>, b INT>"),
        ([[1, 2], [3]], "ARRAY<INT>"),
        (["1", "2"], "INT"),
        (["1", '"x"'], "VARIANT"),
        (['{"a": 1}', "[1]"], "VARIANT"),
        ([{}], "MAP<STRING, VOID>"),
        (["null", None, "not json", '"k": 1}'], "VOID"),
    ],
)
def test_json_shapes(spark, documents, kind):
    assert json_type(spark, documents) == kind


def test_json_with_very_many_keys(spark):
    many = spark.range(0, 12_000).selectExpr("concat('{\"k', id, '\": ', id, '}') AS v")
    assert sql_type(infer_json(many, "v")) == "MAP<STRING, INT>"
    mixed = many.selectExpr("IF(v LIKE '%7}', replace(replace(v, ': ', ': \"'), '}', '\"}'), v) AS v")
    kind = infer_json(mixed.where("cast(regexp_extract(v, 'k([0-9]+)', 1) AS int) < 1000"), "v")
    assert isinstance(kind, T.StructType) and len(kind) == 1_000
    assert kind["k16"].dataType == T.IntegerType() and kind["k17"].dataType == T.StringType()
    assert isinstance(infer_json(mixed, "v", mixed="variant"), T.VariantType)


def test_keys_of_a_map_stay_off_the_driver(spark, monkeypatch):
    """However many keys there are, the driver gets one row of facts."""
    collected = []
    real = type(spark.range(1)).collect
    monkeypatch.setattr(type(spark.range(1)), "collect", lambda df: collected.append(real(df)) or collected[-1])
    for n in (10, 20_000):
        many = spark.range(n).selectExpr("concat('{\"k', id, '\": \"x\"}') AS v")
        assert sql_type(infer_json(many, "v", mixed="variant")) == "MAP<STRING, STRING>"
    assert all(len(rows) <= 1 for rows in collected)


@pytest.mark.parametrize(
    ("text", "kind"),
    [
        ("1] , [2", None), ("1,2", None), ('1, "w":2', None), ("[1,2]", "ARRAY<INT>"), ("[1],[2]", None), ("[]]", None),
        ('"]"', "STRING"), ('{"a": "]"}', "MAP<STRING, STRING>"), ("", None), (" ", None), ("null", "VOID"), ("1}", None),
        ('"a" "b"', None), ("1 2", None), ("1,", None), ("[1", None), ("1,null", None),
    ],
)
def test_one_document_only(spark, text, kind):
    df = spark.createDataFrame([(text,)], "v string")
    found = df.select(json_document(F.col("v")).alias("d")).first()["d"]
    assert (found is None) == (kind is None)
    if kind is not None:
        assert sql_type(infer_json(df, "v")) == kind
