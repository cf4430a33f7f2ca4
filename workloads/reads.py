"""Table scans and file formats."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeferry.operators.load import read_files_as_table
from lakeferry.operators.write import write_table
from lakeferry.plans.workspace import Workspace
from lakeferry.sources.files import read_files
from lakeferry.sources.tables import Table, read_external, read_table
from workloads.base import external, load, source_path, spread

SUPPLIER_DDL = "s_suppkey BIGINT, s_name STRING, s_nationkey INT"


def _read_table(spark: SparkSession, sf: str) -> DataFrame:
    return read_table(spark, external(spark, Workspace(spark), sf, "customer"))


def _read_columns(spark: SparkSession, sf: str) -> DataFrame:
    orders = external(spark, Workspace(spark), sf, "orders")
    return read_table(spark, orders, ["o_orderkey", "o_orderstatus"])


def _read_distinct(spark: SparkSession, sf: str) -> DataFrame:
    lineitem = external(spark, Workspace(spark), sf, "lineitem")
    return read_table(spark, lineitem, ["l_returnflag", "l_linestatus"], distinct=True)


def _read_limit(spark: SparkSession, sf: str) -> DataFrame:
    orders = external(spark, Workspace(spark), sf, "orders")
    return read_table(spark, orders, limit=10).agg(F.count("*").alias("n"))


def _read_schema(spark: SparkSession, sf: str) -> DataFrame:
    ws = Workspace(spark)
    orders = load(spark, sf, "orders")
    names = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate"]
    text = orders.select(
        *[
            (F.date_format(c, "yyyy-MM-dd") if c == "o_orderdate" else F.col(c).cast("string")).alias(c)
            for c in names
        ]
    )
    write_table(spark, ws.table("orders_text"), text)
    typed = Table(
        ws.table("orders_text"),
        schema={
            "o_orderkey": "BIGINT",
            "o_custkey": "BIGINT",
            "o_orderstatus": "STRING",
            "o_totalprice": "DECIMAL(12,2)",
            "o_orderdate": "DATE",
        },
    )
    return read_table(spark, typed)


def _read_external(spark: SparkSession, sf: str) -> DataFrame:
    table = Table("spark_catalog.default.customer", location=source_path(sf, "customer"))
    return read_external(spark, table).select("c_custkey", "c_name")


def _forced_schema(spark: SparkSession, sf: str) -> DataFrame:
    path = Workspace(spark).dir("orders_csv")
    load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus").write.csv(path)
    return read_files(spark, path, "CSV", "o_orderkey BIGINT, o_custkey INT, o_orderstatus STRING")


def _schema_hints(spark: SparkSession, sf: str) -> DataFrame:
    path = Workspace(spark).dir("orders_json")
    columns = ["o_orderkey", "o_totalprice", "o_orderstatus"]
    load(spark, sf, "orders").select(*columns).write.json(path)
    hinted = read_files(
        spark, path, "JSON", {"o_totalprice": "DECIMAL(12,2)"}, force_schema=False
    )
    return hinted.select(*columns)


def _merge_schema(spark: SparkSession, sf: str) -> DataFrame:
    """Two groups of files with different columns: closed orders, then the others."""
    path = Workspace(spark).dir("orders_mixed")
    orders = load(spark, sf, "orders")
    closed = F.col("o_orderstatus") == "F"
    orders.where(closed).select("o_orderkey", "o_orderstatus").write.parquet(path)
    rest = orders.where(~closed).select("o_orderkey", "o_orderpriority")
    rest.write.mode("append").parquet(path)
    return read_files(spark, path, "PARQUET").select(
        "o_orderkey", "o_orderstatus", "o_orderpriority"
    )


def _merge_schema_csv(spark: SparkSession, sf: str) -> DataFrame:
    path = Workspace(spark).dir("orders_mixed_csv")
    orders = load(spark, sf, "orders")
    closed = F.col("o_orderstatus") == "F"
    first = orders.where(closed).select("o_orderkey", "o_orderstatus", "o_custkey")
    first.write.csv(path, header=True)
    rest = orders.where(~closed).select("o_orderpriority", "o_orderkey")
    rest.write.mode("append").csv(path, header=True)
    return read_files(spark, path, "CSV", options={"header": True}).select(
        F.col("o_orderkey").cast("bigint").alias("o_orderkey"),
        F.col("o_custkey").cast("bigint").alias("o_custkey"),
        "o_orderstatus",
        "o_orderpriority",
    )


def _pattern(spark: SparkSession, sf: str) -> DataFrame:
    """Parts as Parquet and as CSV files in one directory; only the Parquet files are read."""
    path = Workspace(spark).dir("parts")
    part = load(spark, sf, "part").select("p_partkey", "p_name")
    part.write.parquet(path)
    part.write.mode("append").csv(path)
    return read_files(spark, path, "PARQUET", pattern=True)


def _files_as_table(spark: SparkSession, sf: str) -> DataFrame:
    ws = Workspace(spark)
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_custkey")
    orders.write.parquet(ws.dir("orders"))
    table = Table(ws.table("orders"), schema="o_orderkey BIGINT, o_orderstatus STRING")
    read_files_as_table(spark, table, ws.dir("orders"), "PARQUET")
    return read_table(spark, table)


def _written(format: str, **options):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        path = Workspace(spark).dir(format)
        rows = load(spark, sf, "supplier").select("s_suppkey", "s_name", "s_nationkey")
        spread(rows).write.format(format).options(**options).save(path)
        return read_files(spark, path, format, SUPPLIER_DDL, options=options)

    return run


def _text(spark: SparkSession, sf: str) -> DataFrame:
    path = Workspace(spark).dir("text")
    load(spark, sf, "customer").select(F.col("c_name").alias("value")).write.text(path)
    return read_files(spark, path, "TEXT")


def _binaryfile(spark: SparkSession, sf: str) -> DataFrame:
    from lakeferry.operators.volumes import export_files

    path = Workspace(spark).dir("binary")
    export_files(spark, text_files(load(spark, sf, "benchmark"), F.col("item_id"), "text"), path)
    found = read_files(spark, path, "BINARYFILE")
    return found.select(
        F.substring_index("path", "/", -1).alias("name"),
        "length",
        F.sha2("content", 256).alias("sha256"),
    )


def text_files(df: DataFrame, path, column: str, suffix: str = ".txt") -> DataFrame:
    """One file per row, as a files table."""
    content = F.col(column).cast("binary")
    return df.select(
        F.concat(path.cast("string"), F.lit(suffix)).alias("path"),
        F.octet_length(column).cast("bigint").alias("size"),
        F.sha2(content, 256).alias("sha256"),
        F.lit(0).cast("bigint").alias("part"),
        F.lit(1).cast("bigint").alias("n_parts"),
        content.alias("content"),
    )


def _libsvm(spark: SparkSession, sf: str) -> DataFrame:
    path = Workspace(spark).dir("libsvm")
    vectors = load(spark, sf, "embeddings")
    cells = F.transform("embedding", lambda x, i: F.concat_ws(":", i + 1, x))
    vectors.select(F.concat_ws(" ", "label", F.array_join(cells, " ")).alias("value")).write.text(path)
    width = vectors.agg(F.max(F.size("embedding")).alias("n")).first()["n"]
    found = read_files(spark, path, "LIBSVM", options={"numFeatures": width})
    return found.groupBy("label").agg(F.count("*").alias("n"))


_SUPPLIERS = "SELECT s_suppkey, s_name, s_nationkey FROM supplier"

QUERIES = {
    "read_table": _read_table,
    "read_table_columns": _read_columns,
    "read_table_distinct": _read_distinct,
    "read_table_limit": _read_limit,
    "read_table_schema": _read_schema,
    "read_external_path": _read_external,
    "read_files_forced_schema": _forced_schema,
    "read_files_schema_hints": _schema_hints,
    "read_files_merge_schema": _merge_schema,
    "read_files_merge_schema_csv": _merge_schema_csv,
    "read_files_pattern": _pattern,
    "read_files_as_table": _files_as_table,
    "format_csv": _written("csv", header=True),
    "format_json": _written("json"),
    "format_parquet": _written("parquet"),
    "format_orc": _written("orc"),
    "format_text": _text,
    "format_binaryfile": _binaryfile,
    "format_libsvm": _libsvm,
}

ORACLES = {
    "read_table": "SELECT * FROM customer",
    "read_table_columns": "SELECT o_orderkey, o_orderstatus FROM orders",
    "read_table_distinct": "SELECT DISTINCT l_returnflag, l_linestatus FROM lineitem",
    "read_table_limit": "SELECT count(*) AS n FROM (SELECT * FROM orders LIMIT 10)",
    "read_table_schema": """
        SELECT o_orderkey, o_custkey, o_orderstatus,
               CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice,
               CAST(o_orderdate AS DATE) AS o_orderdate
        FROM orders""",
    "read_external_path": "SELECT c_custkey, c_name FROM customer",
    "read_files_forced_schema": """
        SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS o_custkey, o_orderstatus FROM orders""",
    "read_files_schema_hints": """
        SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(12,2)) AS o_totalprice, o_orderstatus
        FROM orders""",
    "read_files_merge_schema": """
        SELECT o_orderkey,
               CASE WHEN o_orderstatus = 'F' THEN o_orderstatus END AS o_orderstatus,
               CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority
        FROM orders""",
    "read_files_merge_schema_csv": """
        SELECT o_orderkey,
               CASE WHEN o_orderstatus = 'F' THEN o_custkey END AS o_custkey,
               CASE WHEN o_orderstatus = 'F' THEN o_orderstatus END AS o_orderstatus,
               CASE WHEN o_orderstatus <> 'F' THEN o_orderpriority END AS o_orderpriority
        FROM orders""",
    "read_files_pattern": "SELECT p_partkey, p_name FROM part",
    "read_files_as_table": "SELECT o_orderkey, o_orderstatus FROM orders",
    "format_csv": _SUPPLIERS,
    "format_json": _SUPPLIERS,
    "format_parquet": _SUPPLIERS,
    "format_orc": _SUPPLIERS,
    "format_text": "SELECT c_name AS value FROM customer",
    "format_binaryfile": """
        SELECT item_id || '.txt' AS name, CAST(strlen(text) AS BIGINT) AS length,
               sha256(text) AS sha256
        FROM benchmark""",
    "format_libsvm": """
        SELECT CAST(label AS DOUBLE) AS label, count(*) AS n FROM embeddings GROUP BY label""",
}
