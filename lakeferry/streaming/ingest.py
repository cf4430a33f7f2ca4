"""New files into a table as they arrive."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from lakeferry.functions.types import SchemaLike, align, build_schema
from lakeferry.operators.write import create_table, evolve_table
from lakeferry.plans.commit import append_once, recover
from lakeferry.sources.files import known_format
from lakeferry.sources.tables import Table, as_table, table_exists, table_facts


def read_file_stream(
    spark: SparkSession,
    path: str,
    format: str,
    schema: SchemaLike,
    *,
    pattern: str | bool | None = None,
    options: dict[str, object] | None = None,
) -> DataFrame:
    """Files below ``path`` as a stream.  Files are immutable: a changed one is not read again."""
    fmt = known_format(format)
    reader = spark.readStream.format("binaryFile" if fmt == "BINARYFILE" else fmt.lower())
    if pattern:
        glob = f"*.{fmt.lower()}" if pattern is True else pattern
        reader = reader.option("pathGlobFilter", glob)
    return reader.options(**(options or {})).schema(build_schema(schema)).load(path)


def query_id(spark: SparkSession) -> str:
    """The id that a checkpoint keeps across restarts, as seen inside ``foreachBatch``."""
    return spark.sparkContext.getLocalProperty("sql.streaming.queryId")


def stream_ingest(stream: DataFrame, table: str | Table, checkpoint: str) -> StreamingQuery:
    """Append a stream to a table and stop when everything present is in.

    A batch is published under the id of the checkpoint and its own number: if it is replayed
    after a crash, its rows are neither lost nor doubled.
    """
    ref = as_table(table)

    def append(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not table_exists(spark, ref):
            create_table(spark, replace(ref, schema=ref.schema or batch.schema))
        recover(spark, ref)
        evolve_table(spark, ref, batch.schema)
        rows = align(batch, table_facts(spark, ref).schema)
        append_once(spark, ref, rows, f"{query_id(spark)}-{batch_id}")

    writer = stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()
