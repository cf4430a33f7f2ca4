from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import rows

from lakeferry.functions.types import schema_ddl, sql_type
from lakeferry.operators.write import bulk_write_table
from lakeferry.sources.records import from_records, records_of, value_type
from lakeferry.sources.tables import Table, read_table


@pytest.mark.parametrize(
    ("value", "kind"),
    [
        (1, "INT"),
        (32_700, "INT"),
        (-(2**31), "INT"),
        (2**31, "BIGINT"),
        (2**62, "BIGINT"),
        (2**63, "DECIMAL(38,0)"),
        (True, "BOOLEAN"),
        (1.1, "FLOAT"),
        (0.0, "FLOAT"),
        (float("nan"), "FLOAT"),
        (float("inf"), "FLOAT"),
        (3.402e38 - 1, "FLOAT"),
        (1.79769e308, "DOUBLE"),
        (1e-300, "DOUBLE"),
        (Decimal("1.10"), "DECIMAL(3,2)"),
        (b"a", "BINARY"),
        ("1", "STRING"),
        (dt.date(2014, 1, 1), "DATE"),
        (dt.datetime(2014, 1, 1), "TIMESTAMP"),
        (None, "VOID"),
        ([], "ARRAY<VOID>"),
        ({}, "MAP<VOID, VOID>"),
        ([1, 2**40, None], "ARRAY<BIGINT>"),
        ([1, "x"], "ARRAY<STRING>"),
        ({"a": 1, "b": 2}, "MAP<STRING, INT>"),
        (
            {"k1": "v1", "k2": True, "k3": 1.1, "k4": 42},
            "STRUCT<k1 STRING, k2 BOOLEAN, k3 FLOAT, k4 INT>",
        ),
    ],
)
def test_value_types(value, kind):
    assert sql_type(value_type(value)) == kind


def test_unknown_value():
    with pytest.raises(TypeError):
        value_type(object())


def test_types_are_widened_over_all_records(spark):
    records = [
        {"i": 1, "s": {"a": 1, "b": "x"}, "l": []},
        {"i": 2**40, "s": {"a": None, "b": "y"}, "l": [1]},
        {"i": None, "extra": dt.date(2014, 1, 1)},
    ]
    df = from_records(spark, records)
    assert schema_ddl(df.schema) == (
        "`i` BIGINT, `s` STRUCT<a INT, b STRING>, `l` ARRAY<INT>, `extra` DATE"
    )
    assert [r.i for r in df.collect()] == [1, 2**40, None]


def test_records_under_a_schema(spark, ws):
    schema = {
        "col_int": "INT",
        "col_bin": "BINARY",
        "col_day": "DATE",
        "col_list": "ARRAY<INT>",
        "col_map": "MAP<STRING, INT>",
        "col_json": "JSON",
        "col_dec": "DECIMAL(5,2)",
        "col_double": "DOUBLE",
    }
    records = [
        {
            "col_int": 1,
            "col_bin": "a",
            "col_day": "2014-1-1",
            "col_list": [1, 2],
            "col_map": {"a": 1},
            "col_json": {"k": [1, None]},
            "col_dec": 1.1,
            "col_double": 2,
            "dropped": object(),
        },
        {},
    ]
    table = Table(ws.table("t"), schema=schema)
    bulk_write_table(spark, table, from_records(spark, records, schema))
    first, second = read_table(spark, table.identifier).orderBy("col_int", ascending=False).collect()
    assert tuple(first) == (
        1,
        b"a",
        dt.date(2014, 1, 1),
        [1, 2],
        {"a": 1},
        '{"k": [1, null]}',
        Decimal("1.10"),
        2.0,
    )
    assert tuple(second) == (None,) * 8
    typed = read_table(spark, table, ["col_json"]).selectExpr("variant_get(col_json, '$.k[0]', 'int')")
    assert {r[0] for r in typed.collect()} == {1, None}


def test_a_value_outside_its_type_is_an_error(spark):
    with pytest.raises(Exception):
        from_records(spark, [{"a": "x"}], "a INT").collect()


def test_no_records(spark):
    assert from_records(spark, [], "a INT").count() == 0


def test_records_made_in_tasks(spark):
    """Types are widened over all tasks; names, nested values and moments as from a program."""
    df = spark.range(0, 40, 1, 4)

    def make(row):
        i = row["id"]
        if i == 7:
            return None
        record = {"i": i if i < 39 else 2**40, "mixed": 1 if i % 2 else 1.5, "at": dt.datetime(2020, 1, 1, 5), "day": dt.date(2020, 1, 2)}
        record |= {"items": [i, None], "pair": {"a": i, "b": "x"}, "raw": b"\x00", "price": Decimal("1.5")}
        return record | ({"late": "x"} if i > 35 else {})

    found = records_of(df, make, float_type="double")
    plain = from_records(spark, [make({"id": i}) for i in range(40) if i != 7], float_type="double")
    assert {f.name: f.dataType for f in found.schema.fields} == {f.name: f.dataType for f in plain.schema.fields}
    assert rows(found.select(*plain.columns)) == rows(plain)
    forced = records_of(df, lambda r: {"i": r["id"], "m": {"k": r["id"]}, "j": {"x": [1]}, "extra": 1, "at": "2020-01-01 05:00:00"},
                        {"i": "STRING", "m": "MAP<STRING, BIGINT>", "j": "JSON", "none": "DATE", "at": "TIMESTAMP"})
    row = forced.where("i = '3'").first()
    assert (row.i, row.m, row.j, row.none, row["at"]) == ("3", {"k": 3}, '{"x": [1]}', None, dt.datetime(2020, 1, 1, 5))
    assert records_of(df.limit(0), make, "i INT").count() == 0
