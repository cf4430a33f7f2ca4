"""Inputs shared by the registered queries."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from lakeferry.plans.workspace import Workspace
from lakeferry.sources.tables import Table

TABLES = (
    "region",
    "nation",
    "customer",
    "supplier",
    "part",
    "orders",
    "lineitem",
    "events",
    "documents",
    "embeddings",
    "pages",
    "benchmark",
    "labels",
    "conversations",
)


def source_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(source_path(sf_dir, name))


def external(spark: SparkSession, ws: Workspace, sf_dir: str, name: str) -> Table:
    """A catalog entry over the given files; nothing is copied."""
    ref = Table(ws.table(name))
    spark.sql(f"CREATE TABLE {ref.name} USING PARQUET LOCATION '{source_path(sf_dir, name)}'")
    return ref


def views(spark: SparkSession, sf_dir: str, query: str) -> None:
    """Views for the tables that a query names."""
    for name in TABLES:
        if re.search(rf"\b{name}\b", query):
            load(spark, sf_dir, name).createOrReplaceTempView(name)


def spread(df: DataFrame) -> DataFrame:
    """Over as many files as the session has shuffle partitions."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
