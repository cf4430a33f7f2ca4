import pytest
from pyspark.sql import types as T

from lakeferry.functions.types import align, build_schema, is_json, schema_ddl, sql_type
from lakeferry.sources.tables import Table

MIXED = {
    "col_int": "INT",
    "col_string": T.StringType(),
    "col_boolean": "BOOLEAN",
    "col_array": T.ArrayType(T.IntegerType()),
    "col_map": "MAP<STRING, INT>",
    "col_json": "JSON",
}


def test_schema_from_every_form():
    as_list = [{"name": k, "type": v} for k, v in MIXED.items()]
    schema = build_schema(MIXED)
    assert build_schema(as_list) == schema
    assert build_schema(schema) is schema
    assert build_schema(None) is None
    assert build_schema("a INT, b STRING").names == ["a", "b"]
    assert is_json(schema["col_json"]) and not is_json(schema["col_string"])


@pytest.mark.parametrize(
    "bad",
    [
        [{"name": "a", "type": "INT"}, {"column_name": "b", "column_type": "INT"}],
        [{"name": "a"}],
        {"a": 7},
        {"": "INT"},
        {"a": "INT", "A": "STRING"},
    ],
)
def test_schema_rejects(bad):
    with pytest.raises(ValueError):
        build_schema(bad)


def test_schema_of_unknown_kind():
    with pytest.raises(TypeError):
        build_schema(5)


def test_ddl():
    assert schema_ddl(build_schema("a INT, b STRING")) == "`a` INT, `b` STRING"
    nested = build_schema("x ARRAY<STRUCT<n: STRING, m: MAP<STRING, DECIMAL(10,2)>>>, v VOID")
    assert sql_type(nested["x"].dataType) == "ARRAY<STRUCT<n STRING, m MAP<STRING, DECIMAL(10,2)>>>"
    assert schema_ddl(nested).endswith("`v` VOID")
    assert T.StructType.fromDDL(schema_ddl(nested)) == nested


def test_decimal_bounds():
    assert sql_type(T.DecimalType()) == "DECIMAL(10,0)"
    with pytest.raises(Exception, match="DECIMAL|precision|PARSE"):
        build_schema("a DECIMAL(39,0)")


def test_identifiers():
    assert Table("database.schema.table").name == "`database`.`schema`.`table`"
    assert Table("database!.schema.table+").name == "`database_`.`schema`.`table_`"
    assert Table("`database!`.`schema`.`table+`").name == "`database_`.`schema`.`table_`"
    assert Table("a-b.c_d.e").name == "`a-b`.`c_d`.`e`"
    for bad in ("table", "schema.table", "a.b.c.d"):
        with pytest.raises(ValueError):
            Table(bad)


def test_table_defaults_and_location():
    managed = Table("a.b.c")
    assert managed.format == "PARQUET" and not managed.is_unmanaged
    assert managed.external_path is None
    external = Table("a.b.c", format="csv", location="/data/x")
    assert external.is_unmanaged and external.external_path == "csv.`/data/x`"
    with pytest.raises(ValueError):
        Table("a.b.c", format="XLSX")
    with pytest.raises(TypeError):
        Table("a.b.c", partitioned_by="day")


def test_align_fills_drops_and_orders(spark):
    df = spark.createDataFrame([(1, "x", 2.0)], "B int, extra string, c double")
    out = align(df, build_schema("a STRING, b INT, c DOUBLE"))
    assert out.schema.simpleString() == "struct<a:string,b:int,c:double>"
    assert out.collect()[0] == (None, 1, 2.0)
