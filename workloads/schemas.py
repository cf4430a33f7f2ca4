"""Schemas and types: describe, infer, check, render and parse, nested and JSON columns."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.functions.literals import parse_literal, render_literal
from lakeferry.functions.typed import apply_schema
from lakeferry.functions.types import build_schema, sql_type
from lakeferry.operators.conform import type_fit_report, with_fit
from lakeferry.operators.infer import infer_json, infer_schema, schema_rows
from lakeferry.operators.write import write_table
from lakeferry.plans.workspace import Workspace
from lakeferry.sources.tables import read_table
from workloads.base import load

ISO = "yyyy-MM-dd'T'HH:mm:ss"
LITERALS = {
    "o_orderkey": T.LongType(),
    "o_custkey": T.ShortType(),
    "o_orderdate": T.DateType(),
    "o_orderstatus": T.StringType(),
}


def _describe(spark: SparkSession, sf: str) -> DataFrame:
    customer = load(spark, sf, "customer")
    return type_fit_report(customer, customer.schema).select("name", "type", "n_fit")


def _infer_text(spark: SparkSession, sf: str) -> DataFrame:
    events = load(spark, sf, "events")
    text = events.select(
        *[
            (F.date_format(c, ISO) if c == "ts" else F.col(c).cast("string")).alias(c)
            for c in events.columns
        ]
    )
    return schema_rows(text, infer_schema(text, parse_text=True))


def _infer_typed(spark: SparkSession, sf: str) -> DataFrame:
    lines = load(spark, sf, "lineitem")
    return schema_rows(lines, infer_schema(lines))


def _infer_nested(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders")
    nested = orders.select(
        F.array("o_orderkey", "o_custkey").alias("keys"),
        F.create_map("o_orderstatus", "o_custkey").alias("by_status"),
        F.struct("o_orderkey", "o_totalprice", "o_orderdate").alias("line"),
    )
    return schema_rows(orders, infer_schema(nested))


def _infer_json(spark: SparkSession, sf: str) -> DataFrame:
    events = load(spark, sf, "events")
    shape = infer_json(events, "props")
    return spark.createDataFrame([("props", sql_type(shape))], "name string, type string")


def _infer_json_struct(spark: SparkSession, sf: str) -> DataFrame:
    """Documents whose fields differ in type: a STRUCT."""
    orders = load(spark, sf, "orders")
    fields = F.struct("o_orderkey", "o_orderstatus", "o_totalprice", F.array("o_custkey").alias("keys"))
    documents = orders.select(F.to_json(fields).alias("doc"))
    shape = infer_json(documents, "doc")
    return spark.createDataFrame([("doc", sql_type(shape))], "name string, type string")


def _report(df: DataFrame, **targets: str) -> DataFrame:
    report = type_fit_report(df, dict(targets))
    return report.select("name", "n", "n_fit", "n_unfit", "n_null")


def _fit_int(spark: SparkSession, sf: str) -> DataFrame:
    key = F.col("o_orderkey")
    df = load(spark, sf, "orders").select(
        key.alias("tiny"),
        key.alias("small"),
        key.alias("whole"),
        key.cast("decimal(20,0)").alias("big"),
        F.when(F.col("o_orderstatus") != "P", key.cast("string")).alias("text"),
    )
    return _report(df, tiny="TINYINT", small="SMALLINT", whole="INT", big="BIGINT", text="SMALLINT")


def _fit_float(spark: SparkSession, sf: str) -> DataFrame:
    value = F.col("value")
    df = load(spark, sf, "events").select(
        value.alias("single"),
        (value * F.lit(1e38)).alias("large"),
        (value * F.lit(1e38)).alias("double"),
        (value * F.lit(1e-37)).alias("small"),
        value.cast("string").alias("text"),
    )
    return _report(
        df, single="FLOAT", large="FLOAT", double="DOUBLE", small="FLOAT", text="DECIMAL(4,2)"
    )


def _fit_temporal(spark: SparkSession, sf: str) -> DataFrame:
    day = F.date_format("ts", "yyyy-MM-dd")
    text = F.when(F.col("event_type") == "view", day).otherwise(F.date_format("ts", ISO))
    df = load(spark, sf, "events").select(
        text.alias("day"), text.alias("moment"), F.col("event_type").alias("neither")
    )
    return _report(df, day="DATE", moment="TIMESTAMP", neither="TIMESTAMP")


def _fit_nested(spark: SparkSession, sf: str) -> DataFrame:
    """Nested NULLs do not conform; every third status puts one into its row."""
    value = F.when(F.col("o_orderstatus") != "P", F.col("o_custkey"))
    df = load(spark, sf, "orders").select(
        F.array("o_orderkey", value).alias("items"),
        F.create_map(F.lit("k"), value).alias("by_name"),
        F.struct(F.col("o_orderkey").alias("a"), F.col("o_orderstatus").alias("b")).alias("line"),
        F.create_map(F.lit("a"), F.col("o_orderkey")).alias("as_struct"),
    )
    return _report(
        df,
        items="ARRAY<BIGINT>",
        by_name="MAP<STRING, SMALLINT>",
        line="STRUCT<a: BIGINT, b: STRING>",
        as_struct="STRUCT<a: SMALLINT>",
    )


def _fit_embedding(spark: SparkSession, sf: str) -> DataFrame:
    return _report(load(spark, sf, "embeddings"), embedding="ARRAY<FLOAT>")


def _fit_json(spark: SparkSession, sf: str) -> DataFrame:
    broken = F.when(F.col("event_type") == "error", F.expr("substr(props, 2)"))
    df = load(spark, sf, "events").select(broken.otherwise(F.col("props")).alias("props"))
    return _report(df, props="JSON")


def _quarantine(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders")
    text = F.when(F.col("o_orderstatus") == "P", "bad").otherwise(F.col("o_orderkey").cast("string"))
    rows = orders.select("o_orderkey", text.alias("key_text"))
    return with_fit(rows, {"key_text": "SMALLINT"}).select("o_orderkey", "accepted")


def _literal_input(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders").withColumn("customer", F.col("o_custkey"))
    return orders.select(
        "o_orderkey",
        F.expr("try_cast(o_custkey AS SMALLINT)").alias("o_custkey"),
        F.col("o_orderdate").cast("date").alias("o_orderdate"),
        "o_orderstatus",
        F.col("o_orderstatus").cast("binary").alias("bin"),
    )


def _serialize(spark: SparkSession, sf: str) -> DataFrame:
    def text(name: str, dtype: T.DataType, alias: str):
        return render_literal(F.col(name), dtype).alias(alias)

    return _literal_input(spark, sf).select(
        "o_orderkey",
        text("o_orderkey", T.LongType(), "key_lit"),
        text("o_custkey", T.ShortType(), "cust_lit"),
        text("o_orderdate", T.DateType(), "date_lit"),
        text("o_orderstatus", T.StringType(), "status_lit"),
        text("bin", T.BinaryType(), "bin_lit"),
    )


def _deserialize(spark: SparkSession, sf: str) -> DataFrame:
    rendered = _literal_input(spark, sf).select(
        *[render_literal(F.col(c), t).alias(c) for c, t in LITERALS.items()]
    )
    return rendered.select(*[parse_literal(F.col(c), t).alias(c) for c, t in LITERALS.items()])


NESTED = T.ArrayType(
    T.StructType(
        [
            T.StructField("a", T.LongType()),
            T.StructField("b", T.ArrayType(T.StringType())),
            T.StructField("c", T.MapType(T.StringType(), T.ShortType())),
        ]
    )
)


def _nested_literal(spark: SparkSession, sf: str) -> DataFrame:
    """ARRAY of STRUCT with an ARRAY and a MAP inside, rendered and parsed back."""
    status, key = F.col("o_orderstatus"), F.col("o_orderkey")
    item = F.struct(
        key.alias("a"),
        F.array(F.col("o_orderpriority"), F.concat(status, F.lit('", "x'))).alias("b"),
        F.create_map(status, F.lit(7).cast("smallint")).alias("c"),
    )
    orders = load(spark, sf, "orders").select("o_orderkey", F.array(item, F.lit(None)).alias("v"))
    text = orders.select("o_orderkey", render_literal(F.col("v").cast(NESTED), NESTED).alias("t"))
    back = text.select("o_orderkey", "t", parse_literal(F.col("t"), NESTED).alias("v"))
    first = F.col("v")[0]
    return back.select(
        "o_orderkey",
        F.size("v").cast("bigint").alias("n"),
        first["a"].alias("a"),
        first["b"][0].alias("b0"),
        first["b"][1].alias("b1"),
        F.map_keys(first["c"])[0].alias("c_key"),
        F.col("v")[1].isNull().alias("second_is_null"),
    )


def _json_column(spark: SparkSession, sf: str) -> DataFrame:
    """JSON text read as the column type that a schema gives it."""
    events = load(spark, sf, "events").select("event_id", "props")
    typed = apply_schema(events, build_schema({"event_id": "BIGINT", "props": "STRUCT<k: BIGINT>"}))
    return typed.select("event_id", F.col("props.k").alias("k"))


def _variant_column(spark: SparkSession, sf: str) -> DataFrame:
    """VARIANT values through a table: written, read back, one field extracted."""
    table = Workspace(spark).table("variants")
    events = load(spark, sf, "events").select(F.parse_json("props").alias("props"))
    write_table(spark, table, events)
    key = F.variant_get("props", "$.k", "bigint").alias("k")
    return read_table(spark, table).groupBy(key).agg(F.count("*").alias("n"))


def _nested_columns(spark: SparkSession, sf: str) -> DataFrame:
    """ARRAY, MAP and STRUCT columns through a table."""
    table = Workspace(spark).table("nested")
    orders = load(spark, sf, "orders").select(
        F.array("o_orderkey", "o_custkey").alias("items"),
        F.create_map("o_orderstatus", "o_totalprice").alias("prices"),
        F.struct(F.col("o_orderpriority").alias("priority")).alias("detail"),
    )
    write_table(spark, table, orders)
    return read_table(spark, table).select(
        F.col("items")[0].alias("o_orderkey"),
        F.array_min("items").alias("least"),
        F.map_keys("prices")[0].alias("o_orderstatus"),
        F.map_values("prices")[0].alias("o_totalprice"),
        F.col("detail.priority").alias("o_orderpriority"),
    )


QUERIES = {
    "schema_describe": _describe,
    "infer_schema": _infer_text,
    "infer_schema_typed": _infer_typed,
    "infer_schema_nested": _infer_nested,
    "infer_json_shape": _infer_json,
    "infer_json_struct": _infer_json_struct,
    "fit_report_int": _fit_int,
    "fit_report_float": _fit_float,
    "fit_report_temporal": _fit_temporal,
    "fit_report_nested": _fit_nested,
    "fit_report_embedding": _fit_embedding,
    "fit_report_json": _fit_json,
    "fit_quarantine": _quarantine,
    "serialize_literals": _serialize,
    "deserialize_literals": _deserialize,
    "nested_literals": _nested_literal,
    "json_column": _json_column,
    "variant_column": _variant_column,
    "nested_columns": _nested_columns,
}


def _whole(column: str) -> str:
    """The narrowest integer type of a column, from its data."""
    return f"CASE WHEN max({column}) <= 2147483647 AND min({column}) >= -2147483648 THEN 'INT' ELSE 'BIGINT' END"


def _floating(column: str) -> str:
    size = f"abs({column})"
    return f"CASE WHEN bool_and({column} = 0 OR {size} BETWEEN 1.175e-37 AND 3.402e38) THEN 'FLOAT' ELSE 'DOUBLE' END"


def _types(table: str, **columns: str) -> str:
    rows = [f"SELECT '{name}' AS name, {kind} AS type FROM {table}" for name, kind in columns.items()]
    return " UNION ALL ".join(rows)


def _always(kind: str) -> str:
    return f"max('{kind}')"


def _fits(table: str, **columns: str | tuple[str, str]) -> str:
    rows = []
    for name, rule in columns.items():
        fit, present = rule if isinstance(rule, tuple) else (rule, "true")
        rows.append(
            f"SELECT '{name}' AS name, count(*) AS n,"
            f" count(*) FILTER (WHERE ({present}) AND ({fit})) AS n_fit,"
            f" count(*) FILTER (WHERE ({present}) AND NOT ({fit})) AS n_unfit,"
            f" count(*) FILTER (WHERE NOT ({present})) AS n_null FROM {table}"
        )
    return " UNION ALL ".join(rows)


_SMALL = "o_orderkey BETWEEN -32768 AND 32767"

ORACLES = {
    "schema_describe": " UNION ALL ".join(
        f"SELECT '{name}' AS name, '{kind}' AS type, count({name}) AS n_fit FROM customer"
        for name, kind in {
            "c_custkey": "BIGINT",
            "c_name": "STRING",
            "c_nationkey": "INT",
            "c_acctbal": "DOUBLE",
            "c_mktsegment": "STRING",
        }.items()
    ),
    "infer_schema": _types(
        "events",
        event_id=_whole("event_id"),
        ts=_always("TIMESTAMP"),
        user_id=_whole("user_id"),
        event_type=_always("STRING"),
        value=_floating("value"),
        props=_always("STRING"),
    ),
    "infer_schema_typed": _types(
        "lineitem",
        l_orderkey=_whole("l_orderkey"),
        l_partkey=_whole("l_partkey"),
        l_suppkey=_whole("l_suppkey"),
        l_linenumber=_whole("l_linenumber"),
        l_quantity=_floating("l_quantity"),
        l_extendedprice=_floating("l_extendedprice"),
        l_discount=_floating("l_discount"),
        l_tax=_floating("l_tax"),
        l_returnflag=_always("STRING"),
        l_linestatus=_always("STRING"),
        l_shipdate=_always("TIMESTAMP"),
    ),
    "infer_schema_nested": _types(
        "orders",
        keys="'ARRAY<' || " + _whole("greatest(o_orderkey, o_custkey)") + " || '>'",
        by_status="'MAP<STRING, ' || " + _whole("o_custkey") + " || '>'",
        line="'STRUCT<o_orderkey ' || "
        + _whole("o_orderkey")
        + " || ', o_totalprice ' || "
        + _floating("o_totalprice")
        + " || ', o_orderdate TIMESTAMP>'",
    ),
    "infer_json_shape": _types(
        "events",
        props="'MAP<STRING, ' || " + _whole("CAST(json_extract(props, '$.k') AS BIGINT)") + " || '>'",
    ),
    "infer_json_struct": _types(
        "orders",
        doc="'STRUCT<keys ARRAY<' || "
        + _whole("o_custkey")
        + " || '>, o_orderkey ' || "
        + _whole("o_orderkey")
        + " || ', o_orderstatus STRING, o_totalprice ' || "
        + _floating("o_totalprice")
        + " || '>'",
    ),
    "fit_report_int": _fits(
        "orders",
        tiny="o_orderkey BETWEEN -128 AND 127",
        small=_SMALL,
        whole="o_orderkey BETWEEN -2147483648 AND 2147483647",
        big="true",
        text=(_SMALL, "o_orderstatus <> 'P'"),
    ),
    "fit_report_float": _fits(
        "events",
        single="value = 0 OR abs(value) BETWEEN 1.175e-37 AND 3.402e38",
        large="value = 0 OR abs(value * 1e38) BETWEEN 1.175e-37 AND 3.402e38",
        double="value = 0 OR abs(value * 1e38) BETWEEN 2.225e-307 AND 1.79769e308",
        small="value = 0 OR abs(value * 1e-37) BETWEEN 1.175e-37 AND 3.402e38",
        text="abs(round(value, 2)) < 100",
    ),
    "fit_report_temporal": _fits(
        "events", day="event_type = 'view'", moment="true", neither="false"
    ),
    "fit_report_nested": _fits(
        "orders",
        items="o_orderstatus <> 'P'",
        by_name="o_orderstatus <> 'P' AND o_custkey BETWEEN -32768 AND 32767",
        line="true",
        as_struct=_SMALL,
    ),
    "fit_report_embedding": _fits("embeddings", embedding="len(embedding) >= 0"),
    "fit_report_json": _fits("events", props="event_type <> 'error'"),
    "fit_quarantine": f"SELECT o_orderkey, {_SMALL} AND o_orderstatus <> 'P' AS accepted FROM orders",
    "serialize_literals": """
        SELECT o_orderkey, o_orderkey || 'L' AS key_lit,
               CASE WHEN o_custkey <= 32767 THEN o_custkey || 'S' ELSE 'NULL' END AS cust_lit,
               'DATE''' || strftime(o_orderdate, '%Y-%m-%d') || '''' AS date_lit,
               '"' || o_orderstatus || '"' AS status_lit,
               'X''' || hex(CAST(o_orderstatus AS BLOB)) || '''' AS bin_lit
        FROM orders""",
    "deserialize_literals": """
        SELECT o_orderkey,
               CAST(CASE WHEN o_custkey <= 32767 THEN o_custkey END AS SMALLINT) AS o_custkey,
               CAST(o_orderdate AS DATE) AS o_orderdate, o_orderstatus
        FROM orders""",
    "nested_literals": """
        SELECT o_orderkey, CAST(2 AS BIGINT) AS n, o_orderkey AS a, o_orderpriority AS b0,
               o_orderstatus || '", "x' AS b1, o_orderstatus AS c_key, true AS second_is_null
        FROM orders""",
    "json_column": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "variant_column": """
        SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n
        FROM events GROUP BY 1""",
    "nested_columns": """
        SELECT o_orderkey, least(o_orderkey, o_custkey) AS least, o_orderstatus, o_totalprice,
               o_orderpriority
        FROM orders""",
}
