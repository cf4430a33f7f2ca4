"""Incremental ingest and streaming upserts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeferry.plans.workspace import Workspace
from lakeferry.sources.tables import read_table
from lakeferry.streaming.ingest import read_file_stream, stream_ingest
from lakeferry.streaming.upsert import stream_merge, stream_tags, tags_in_force
from workloads.base import load, spread
from workloads.trees import ORDER, TAG_LOG


def _event_files(spark: SparkSession, sf: str, ws: Workspace, rows: DataFrame) -> DataFrame:
    spread(rows).write.parquet(ws.dir("in"))
    return read_file_stream(spark, ws.dir("in"), "PARQUET", rows.schema)


def _ingest(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs over the same files: the second finds nothing new."""
    ws = Workspace(spark)
    rows = load(spark, sf, "events").select("event_id", "event_type")
    stream = _event_files(spark, sf, ws, rows)
    for _ in range(2):
        stream_ingest(stream, ws.table("events"), ws.dir("checkpoint")).awaitTermination()
    return read_table(spark, ws.table("events"))


def _merge(spark: SparkSession, sf: str) -> DataFrame:
    ws = Workspace(spark)
    rows = load(spark, sf, "events").select("user_id", "event_type", *ORDER)
    stream = _event_files(spark, sf, ws, rows)
    query = stream_merge(stream, ws.table("newest"), "user_id", ORDER, ws.dir("checkpoint"))
    query.awaitTermination()
    return read_table(spark, ws.table("newest"), ["user_id", "event_type", "event_id"])


def _tags(spark: SparkSession, sf: str) -> DataFrame:
    ws = Workspace(spark)
    kept = F.when(F.col("event_type") != "error", F.col("event_type"))
    rows = load(spark, sf, "events").select(
        F.col("user_id").cast("string").alias("entity"),
        F.get_json_object("props", "$.k").alias("name"),
        kept.alias("value"),
        *ORDER,
    )
    stream = _event_files(spark, sf, ws, rows)
    stream_tags(stream, ws.table("tags"), ws.dir("checkpoint"), order=ORDER).awaitTermination()
    return tags_in_force(read_table(spark, ws.table("tags")))


QUERIES = {"stream_ingest": _ingest, "stream_merge": _merge, "stream_tags": _tags}

ORACLES = {
    "stream_ingest": "SELECT event_id, event_type FROM events",
    "stream_merge": """
        WITH r AS (
            SELECT user_id, event_type, event_id,
                   row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
            FROM events)
        SELECT user_id, event_type, event_id FROM r WHERE rn = 1""",
    "stream_tags": TAG_LOG
    + """ SELECT CAST(user_id AS VARCHAR) AS entity, tag_name AS name, tag_value AS value
          FROM c WHERE rn = 1 AND tag_value IS NOT NULL""",
}
