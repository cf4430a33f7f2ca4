"""Export tables and query results to Parquet files."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeferry.operators.sql import run_sql
from lakeferry.sources.tables import Table, as_table
from lakeferry.sources.trees import list_tree, open_uri, spread_by_bytes

# Rows per exported file, and the size of a Parquet row group.
ROWS_PER_FILE = 100_000
ROW_GROUP_BYTES = 128 * 2**20
# What a footer counts when footers are dealt to tasks.
FOOTER_BYTES = 8 * 2**20


def export(
    df: DataFrame,
    results_path: str,
    *,
    rows_per_file: int | None = ROWS_PER_FILE,
    row_group_bytes: int = ROW_GROUP_BYTES,
    run_id: str | None = None,
) -> str:
    """Write ``df`` to ``<results_path>/<run id>`` and return that directory.

    Every partition is written in parallel, each file with at most ``rows_per_file`` rows
    (``None`` for no bound), in row groups of about ``row_group_bytes``.  The write fails as a whole or is complete.
    """
    target = f"{results_path.rstrip('/')}/{run_id or uuid.uuid4()}"
    writer = df.write.option("parquet.block.size", row_group_bytes)
    if rows_per_file is not None:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(target)
    return target


def sql_to_files(
    spark: SparkSession,
    query: str,
    results_path: str,
    *,
    params: dict[str, object] | None = None,
    rows_per_file: int | None = ROWS_PER_FILE,
) -> str:
    return export(run_sql(spark, query, params), results_path, rows_per_file=rows_per_file)


def save_table_to_files(
    spark: SparkSession,
    table: str | Table,
    results_path: str,
    *,
    rows_per_file: int | None = ROWS_PER_FILE,
) -> str:
    df = spark.table(as_table(table).name)
    return export(df, results_path, rows_per_file=rows_per_file)


def row_groups(spark: SparkSession, path: str) -> DataFrame:
    """``(file, row_group, n_rows, n_bytes)`` of the Parquet files below ``path``, from their footers.

    Footers are read in tasks, over as many as the number of files asks for; no data is.
    """

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for uri in batch.column(0).to_pylist():
                system, name = open_uri(uri)
                with system.open_input_file(name) as source:
                    footer = pq.ParquetFile(source).metadata
                groups = (footer.row_group(i) for i in range(footer.num_row_groups))
                found += [(uri, i, g.num_rows, g.total_byte_size) for i, g in enumerate(groups)]
            columns = list(zip(*found, strict=True)) or [()] * 4
            kinds = (pa.string(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=["file", "row_group", "n_rows", "n_bytes"]
            )

    opened = list_tree(spark, path, pattern="*.parquet").withColumn("size", F.lit(FOOTER_BYTES))
    return spread_by_bytes(opened, "uri").select("uri").mapInArrow(
        read, "file string, row_group bigint, n_rows bigint, n_bytes bigint"
    )
