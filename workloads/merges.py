"""Upserts.  Target and source split a whole table by order status, so the two overlap in part."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeferry.operators.merge import merge_table, plan_merge
from lakeferry.operators.write import write_table
from lakeferry.plans.workspace import Workspace
from lakeferry.sources.tables import Table, read_table
from workloads.base import load


def _orders(spark: SparkSession, sf: str, *columns: str) -> DataFrame:
    return load(spark, sf, "orders").select(*columns)


def _upsert_input(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    table = Workspace(spark).table("orders")
    orders = _orders(spark, sf, "o_orderkey", "o_orderstatus", "o_totalprice")
    write_table(spark, table, orders.where("o_orderstatus <> 'O'"))
    source = orders.where("o_orderstatus <> 'F'").withColumn("o_orderstatus", F.lit("X"))
    return table, source


def _upsert(spark: SparkSession, sf: str) -> DataFrame:
    table, source = _upsert_input(spark, sf)
    merge_table(spark, table, source, "o_orderkey")
    return read_table(spark, table)


def _metrics(spark: SparkSession, sf: str) -> DataFrame:
    table, source = _upsert_input(spark, sf)
    return plan_merge(spark, table, source, "o_orderkey").metrics()


def _multi_key(spark: SparkSession, sf: str) -> DataFrame:
    table = Workspace(spark).table("counts")
    counts = _orders(spark, sf, "o_custkey", "o_orderpriority")
    counts = counts.groupBy("o_custkey", "o_orderpriority").agg(F.count("*").alias("n"))
    write_table(spark, table, counts.where("o_orderpriority < '4'"))
    source = counts.where("o_orderpriority >= '3'").withColumn("n", -F.col("n"))
    merge_table(spark, table, source, ["o_custkey", "o_orderpriority"])
    return read_table(spark, table)


def _null_keys(spark: SparkSession, sf: str) -> DataFrame:
    """A third of the rows, on both sides, has no key."""
    table = Workspace(spark).table("orders")
    key = F.when(F.col("o_orderstatus") != "P", F.col("o_orderkey")).alias("k")
    orders = _orders(spark, sf, "o_orderkey", "o_orderstatus", "o_orderpriority")
    write_table(spark, table, orders.select(key, F.col("o_orderpriority").alias("val")))
    source = orders.where("o_orderstatus <> 'F'").select(key, F.lit("new").alias("val"))
    merge_table(spark, table, source, "k")
    return read_table(spark, table)


def _repeated_target(spark: SparkSession, sf: str) -> DataFrame:
    """Many target rows per key: every one of them takes the matching source row's values."""
    table = Workspace(spark).table("lines")
    lines = load(spark, sf, "lineitem")
    lines = lines.select(F.col("l_orderkey").alias("k"), F.col("l_returnflag").alias("flag"))
    write_table(spark, table, lines)
    closed = _orders(spark, sf, "o_orderkey", "o_orderstatus").where("o_orderstatus = 'F'")
    source = closed.select(F.col("o_orderkey").alias("k"), F.lit("closed").alias("flag"))
    merge_table(spark, table, source, "k")
    return read_table(spark, table)


def _duplicate_keys(spark: SparkSession, sf: str) -> DataFrame:
    table = Workspace(spark).table("lines")
    lines = load(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    write_table(spark, table, lines.distinct())
    return plan_merge(spark, table, lines, ["l_orderkey", "l_linenumber"]).duplicates()


def _partition_scope(spark: SparkSession, sf: str) -> DataFrame:
    orders = _orders(spark, sf, "o_orderkey", "o_orderpriority", "o_orderstatus")
    table = Table(
        Workspace(spark).table("orders"), schema=orders.schema, partitioned_by=["o_orderstatus"]
    )
    write_table(spark, table, orders)
    done = orders.where("o_orderstatus = 'F'").withColumn("o_orderpriority", F.lit("0-DONE"))
    merge_table(spark, table, done, "o_orderkey")
    return read_table(spark, table)


QUERIES = {
    "merge_upsert": _upsert,
    "merge_multi_key": _multi_key,
    "merge_null_keys": _null_keys,
    "merge_repeated_target": _repeated_target,
    "merge_duplicate_keys": _duplicate_keys,
    "merge_metrics": _metrics,
    "merge_partition_scope": _partition_scope,
}

ORACLES = {
    "merge_upsert": """
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN 'F' ELSE 'X' END AS o_orderstatus,
               o_totalprice
        FROM orders""",
    "merge_multi_key": """
        SELECT o_custkey, o_orderpriority,
               CASE WHEN o_orderpriority >= '3' THEN -count(*) ELSE count(*) END AS n
        FROM orders GROUP BY o_custkey, o_orderpriority""",
    "merge_null_keys": """
        SELECT CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS k,
               CASE WHEN o_orderstatus = 'O' THEN 'new' ELSE o_orderpriority END AS val
        FROM orders
        UNION ALL
        SELECT NULL, 'new' FROM orders WHERE o_orderstatus = 'P'""",
    "merge_repeated_target": """
        SELECT l_orderkey AS k, CASE WHEN o_orderkey IS NULL THEN l_returnflag ELSE 'closed' END AS flag
        FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey AND o_orderstatus = 'F'
        UNION ALL
        SELECT o_orderkey, 'closed' FROM orders
        WHERE o_orderstatus = 'F'
          AND NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)""",
    "merge_duplicate_keys": """
        SELECT l_orderkey, l_linenumber, count(*) AS n
        FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "merge_metrics": """
        SELECT count(*) FILTER (WHERE o_orderstatus = 'P') AS n_updated,
               count(*) FILTER (WHERE o_orderstatus = 'O') AS n_inserted
        FROM orders""",
    "merge_partition_scope": """
        SELECT o_orderkey,
               CASE WHEN o_orderstatus = 'F' THEN '0-DONE' ELSE o_orderpriority END AS o_orderpriority,
               o_orderstatus
        FROM orders""",
}
