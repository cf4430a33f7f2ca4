"""Sinks: create, append, overwrite, replace, evolve, bulk loads and exports."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeferry.operators.export import export, row_groups, save_table_to_files, sql_to_files
from lakeferry.operators.load import bulk_write_files, copy_into
from lakeferry.operators.write import bulk_write_table, create_table, replace_table, write_table
from lakeferry.plans.workspace import Workspace, session_settings
from lakeferry.sources.records import records_of
from lakeferry.sources.tables import Table, read_table
from workloads.base import external, load, spread, views

# Rows that a task of the export of row groups takes, so that they do not grow with the table.
ROWS_PER_TASK = 2**20
CUSTOMER_DDL = "c_custkey BIGINT, c_mktsegment STRING"


def _create_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    ws = Workspace(spark)
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    table = Table(ws.table("orders"), schema=orders.schema, partitioned_by=["o_orderstatus"])
    create_table(spark, table)
    write_table(spark, table, orders)
    return read_table(spark, table).groupBy("o_orderstatus").agg(F.count("*").alias("n"))


def _replace(spark: SparkSession, sf: str) -> DataFrame:
    ws = Workspace(spark)
    table = ws.table("orders")
    orders = load(spark, sf, "orders")
    replace_table(spark, table, orders.select("o_orderkey", "o_totalprice"))
    newer = orders.select("o_orderkey", "o_orderpriority", F.lit("v2").alias("version"))
    replace_table(spark, table, newer)
    return read_table(spark, table)


def _append(spark: SparkSession, sf: str) -> DataFrame:
    table = Workspace(spark).table("customer")
    rows = load(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    write_table(spark, table, rows)
    write_table(spark, table, rows.where("c_mktsegment = 'BUILDING'"))
    return read_table(spark, table)


def _overwrite(spark: SparkSession, sf: str) -> DataFrame:
    table = Workspace(spark).table("customer")
    rows = load(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    write_table(spark, table, rows)
    write_table(spark, table, rows.where("c_acctbal > 0"), append=False)
    return read_table(spark, table, ["c_custkey", "c_mktsegment"])


def _missing_columns(spark: SparkSession, sf: str) -> DataFrame:
    table = Table(Workspace(spark).table("customer"), schema="c_custkey BIGINT, c_name STRING")
    write_table(spark, table, load(spark, sf, "customer").select("c_custkey", "c_acctbal"))
    return read_table(spark, table)


def _bulk_append(spark: SparkSession, sf: str) -> DataFrame:
    table = Workspace(spark).table("events")
    events = load(spark, sf, "events").select("event_id", "user_id", "event_type")
    bulk_write_table(spark, table, events)
    bulk_write_table(spark, table, events.where("event_type = 'click'"))
    return read_table(spark, table)


def _bulk_evolve(spark: SparkSession, sf: str) -> DataFrame:
    table = Workspace(spark).table("events")
    events = load(spark, sf, "events").select("event_id", "user_id", "event_type")
    view = F.col("event_type") == "view"
    bulk_write_table(spark, table, events.where(view).drop("event_type"))
    bulk_write_table(spark, table, events.where(~view))
    return read_table(spark, table)


def _bulk_replace(spark: SparkSession, sf: str) -> DataFrame:
    table = Workspace(spark).table("events")
    events = load(spark, sf, "events")
    bulk_write_table(spark, table, events.select("event_id", "user_id"))
    bulk_write_table(spark, table, events.select("event_id", "props"), append=False)
    return read_table(spark, table)


def _copy_into(spark: SparkSession, sf: str) -> DataFrame:
    ws = Workspace(spark)
    rows = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag")
    spread(rows).write.parquet(ws.dir("in"))
    copy_into(spark, ws.table("lineitem"), ws.dir("in"), "PARQUET")
    copy_into(spark, ws.table("lineitem"), ws.dir("in"), "PARQUET")
    return read_table(spark, ws.table("lineitem"))


def _bulk_files_append(spark: SparkSession, sf: str) -> DataFrame:
    ws = Workspace(spark)
    rows = load(spark, sf, "customer").select("c_custkey", "c_mktsegment")
    spread(rows).write.csv(ws.dir("in"))
    table = Table(ws.table("customer"), schema=CUSTOMER_DDL)
    bulk_write_files(spark, table, ws.dir("in"), "CSV")
    return read_table(spark, table)


def _bulk_files_replace(spark: SparkSession, sf: str) -> DataFrame:
    ws = Workspace(spark)
    rows = load(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal")
    table = Table(ws.table("customer"), schema=CUSTOMER_DDL)
    write_table(spark, table, rows)
    debtors = rows.where("c_acctbal < 0").select("c_custkey", "c_mktsegment")
    spread(debtors).write.csv(ws.dir("in"))
    bulk_write_files(spark, table, ws.dir("in"), "CSV", append=False)
    return read_table(spark, table)


def _save_table(spark: SparkSession, sf: str) -> DataFrame:
    ws = Workspace(spark)
    path = save_table_to_files(spark, external(spark, ws, sf, "part"), ws.dir("out"))
    return spark.read.parquet(path).select("p_partkey", "p_brand", "p_size")


def _sql_to_files(spark: SparkSession, sf: str) -> DataFrame:
    query = "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey"
    views(spark, sf, query)
    return spark.read.parquet(sql_to_files(spark, query, Workspace(spark).dir("out")))


def _chunks(spark: SparkSession, sf: str) -> DataFrame:
    """Files of at most a fiftieth of the rows, so their number does not grow with the data."""
    query = "SELECT l_orderkey, l_linenumber FROM lineitem"
    views(spark, sf, query)
    bound = -(-spark.table("lineitem").count() // 50)
    path = sql_to_files(spark, query, Workspace(spark).dir("out"), rows_per_file=bound)
    rows = spark.read.parquet(path)
    per_file = rows.groupBy(F.col("_metadata.file_path")).agg(F.count("*").alias("n"))
    return per_file.agg(
        F.sum("n").alias("n_rows"),
        (F.max("n") <= bound).alias("within_bound"),
        (F.count("*") >= F.sum("n") / bound).alias("enough_files"),
    )


def _row_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Small row groups, counted in the footers: no row is lost, groups are many and of like size."""
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_partkey", "l_extendedprice", "l_shipdate")
    files = max(4, lines.count() // ROWS_PER_TASK)
    path = export(lines.repartition(files), Workspace(spark).dir("out"), rows_per_file=None, row_group_bytes=8 * 1024)
    groups = row_groups(spark, path)
    return groups.groupBy("file").agg(F.count("*").alias("n"), F.sum("n_rows").alias("rows"), F.max("n_bytes").alias("most")).agg(
        F.sum("rows").alias("n_rows"),
        (F.min("n") > 1).alias("several_groups"),
        (F.max("most") < 256 * 1024).alias("within_bound"),
    )


def _copy_mixed_types(spark: SparkSession, sf: str) -> DataFrame:
    """JSON files with whole numbers, others with fractions, one batch per file."""
    ws = Workspace(spark)
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    whole = F.floor("o_totalprice").cast("bigint").alias("price")
    for status, price in (("F", whole), ("O", F.col("o_totalprice").alias("price")), ("P", whole)):
        rows = orders.where(F.col("o_orderstatus") == status).select("o_orderkey", price)
        rows.coalesce(2).write.mode("append").json(ws.dir("in"))
    copy_into(spark, ws.table("prices"), ws.dir("in"), "JSON", files_per_batch=1)
    return read_table(spark, ws.table("prices")).select("o_orderkey", "price")


def _overwrite_partitioned(spark: SparkSession, sf: str) -> DataFrame:
    """All partitions go, also in a session that overwrites single ones."""
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    name = Workspace(spark).table("orders")
    table = Table(name, schema=orders.schema, partitioned_by=["o_orderstatus"])
    write_table(spark, table, orders)
    with session_settings(spark, {"spark.sql.sources.partitionOverwriteMode": "dynamic"}):
        write_table(spark, table, orders.where("o_orderstatus = 'F'"), append=False)
    return read_table(spark, table).select("o_orderkey", "o_orderstatus")


def _overwrite_self(spark: SparkSession, sf: str) -> DataFrame:
    """A table from its own rows."""
    table = Workspace(spark).table("customer")
    write_table(spark, table, load(spark, sf, "customer").select("c_custkey", "c_acctbal"))
    write_table(spark, table, read_table(spark, table).where("c_acctbal > 0"), append=False)
    return read_table(spark, table)


def _typed_records(spark: SparkSession, sf: str) -> DataFrame:
    """Records that tasks make of the events, with the types that all of them have in common."""

    def record(row: dict) -> dict:
        found = {"event_id": row["event_id"], "day": row["ts"].date(), "props": json.loads(row["props"])}
        # one name has three types, another is missing in most records
        value = {"view": row["user_id"], "click": row["value"]}.get(row["event_type"])
        return found | {"value": value} | ({"failed": True} if row["event_type"] == "error" else {})

    records = records_of(load(spark, sf, "events"), record, float_type="double")
    table = Workspace(spark).table("records")
    bulk_write_table(spark, table, records)
    return read_table(spark, table).select("event_id", "day", "failed", "value", F.col("props")["k"].cast("bigint").alias("k"))


QUERIES = {
    "create_table_partitioned": _create_partitioned,
    "replace_table": _replace,
    "write_table_append": _append,
    "write_table_overwrite": _overwrite,
    "write_table_missing_cols": _missing_columns,
    "bulk_write_append": _bulk_append,
    "bulk_write_evolve": _bulk_evolve,
    "bulk_write_replace": _bulk_replace,
    "copy_into_idempotent": _copy_into,
    "bulk_write_files_append": _bulk_files_append,
    "bulk_write_files_replace": _bulk_files_replace,
    "save_table_to_files": _save_table,
    "sql_to_files": _sql_to_files,
    "sql_to_files_chunks": _chunks,
    "export_row_groups": _row_groups,
    "copy_into_mixed_types": _copy_mixed_types,
    "write_table_overwrite_partitioned": _overwrite_partitioned,
    "write_table_overwrite_self": _overwrite_self,
    "typed_records": _typed_records,
}

ORACLES = {
    "copy_into_mixed_types": """
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'O' THEN o_totalprice
                                ELSE CAST(floor(o_totalprice) AS DOUBLE) END AS price
        FROM orders""",
    "write_table_overwrite_partitioned": """
        SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F'""",
    "write_table_overwrite_self": "SELECT c_custkey, c_acctbal FROM customer WHERE c_acctbal > 0",
    "typed_records": """
        SELECT event_id, CAST(ts AS DATE) AS day, CASE WHEN event_type = 'error' THEN true END AS failed,
               CASE event_type WHEN 'view' THEN CAST(user_id AS DOUBLE) WHEN 'click' THEN value END AS value,
               CAST(json_extract(props, '$.k') AS BIGINT) AS k
        FROM events""",
    "create_table_partitioned": "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY o_orderstatus",
    "replace_table": "SELECT o_orderkey, o_orderpriority, 'v2' AS version FROM orders",
    "write_table_append": """
        SELECT c_custkey, c_mktsegment FROM customer
        UNION ALL
        SELECT c_custkey, c_mktsegment FROM customer WHERE c_mktsegment = 'BUILDING'""",
    "write_table_overwrite": "SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal > 0",
    "write_table_missing_cols": "SELECT c_custkey, CAST(NULL AS VARCHAR) AS c_name FROM customer",
    "bulk_write_append": """
        SELECT event_id, user_id, event_type FROM events
        UNION ALL
        SELECT event_id, user_id, event_type FROM events WHERE event_type = 'click'""",
    "bulk_write_evolve": """
        SELECT event_id, user_id,
               CASE WHEN event_type <> 'view' THEN event_type END AS event_type
        FROM events""",
    "bulk_write_replace": "SELECT event_id, props FROM events",
    "copy_into_idempotent": "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem",
    "bulk_write_files_append": "SELECT c_custkey, c_mktsegment FROM customer",
    "bulk_write_files_replace": "SELECT c_custkey, c_mktsegment FROM customer WHERE c_acctbal < 0",
    "save_table_to_files": "SELECT p_partkey, p_brand, p_size FROM part",
    "sql_to_files": "SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey",
    "export_row_groups": "SELECT count(*) AS n_rows, true AS several_groups, true AS within_bound FROM lineitem",
    "sql_to_files_chunks": "SELECT count(*) AS n_rows, true AS within_bound, true AS enough_files FROM lineitem",
}
