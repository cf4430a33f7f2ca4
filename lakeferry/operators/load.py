"""Load files into tables: create from files, copy new files only, bulk load a directory."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import replace
from itertools import islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.functions.types import SchemaLike, align, build_schema, refuse_narrowing
from lakeferry.operators.write import (
    bulk_write_table,
    create_table,
    evolve_table,
    replace_table,
)
from lakeferry.plans import store
from lakeferry.plans.commit import append_once, ledger_rows, recover, token
from lakeferry.plans.workspace import Workspace, stage
from lakeferry.sources.files import known_format, read_files
from lakeferry.sources.records import widen
from lakeferry.sources.tables import Table, as_table, table_exists, table_facts
from lakeferry.sources.trees import hash_tree, list_tree

# the modification time is kept in microseconds: a clock change cannot make it ambiguous
FILE_SCHEMA = "uri string, size bigint, modified bigint, sha256 string"
FILES_PER_BATCH = 10_000


def read_files_as_table(
    spark: SparkSession,
    table: str | Table,
    path: str | list[str],
    format: str,
    *,
    replace: bool = False,
    force_schema: bool = True,
    pattern: str | bool | None = None,
    recursive: bool = False,
    options: dict[str, object] | None = None,
) -> None:
    """Create a table from files.  An existing table is an error unless ``replace``.

    With a schema on ``table`` the table has its columns, forced on the files or hinted to them.
    """
    ref = as_table(table)
    if not replace and table_exists(spark, ref):
        raise ValueError(f"{ref.identifier} exists already")
    df = read_files(
        spark,
        path,
        format,
        ref.schema,
        force_schema=force_schema,
        pattern=pattern,
        recursive=recursive,
        options=options,
    )
    if ref.schema is not None:
        df = align(df, ref.schema)
    replace_table(spark, ref, df)


def copy_into(
    spark: SparkSession,
    table: str | Table,
    path: str,
    format: str,
    *,
    schema: SchemaLike | None = None,
    pattern: str | bool | None = None,
    recursive: bool = False,
    options: dict[str, object] | None = None,
    by_content: bool = False,
    files_per_batch: int = FILES_PER_BATCH,
) -> int:
    """Append the files that are not in the table yet; returns how many were loaded.

    A ledger beside the table, one row per file, remembers every file by path, size and modification
    time, or by path and SHA-256 with ``by_content`` (which reads each file once more); files in it
    are left out by an anti-join.  Files go in batches, each committed on its own by the ledger's
    rows; a batch's names pass to the planner, which lists what it scans.  Columns
    that the table lacks are added.  Without a schema the files of one call are read with one type
    per column, the one that holds all of them, however many batches they make.  A column that the
    table cannot hold is refused before anything is loaded.  Running again, also after a crash, loads nothing twice.
    """
    ref = as_table(table)
    fmt = known_format(format)
    given = schema is not None or ref.schema is not None
    wanted = f"*.{fmt.lower()}" if pattern is True else pattern
    schema = build_schema(schema) or ref.schema
    exists = table_exists(spark, ref)
    if exists:
        recover(spark, ref)
    fresh = new_files(spark, ref, path, wanted, recursive, by_content)
    if not given:
        fresh, schema = _settled(spark, fresh, fmt, options, files_per_batch)
    if exists and schema is not None:
        refuse_narrowing(spark.table(ref.name).schema, schema, ref.identifier)
    loaded = 0
    for batch in _chunks(fresh.toLocalIterator(), files_per_batch):
        uris = [row["uri"] for row in batch]
        df = read_files(spark, uris, fmt, schema, options=options)
        if not exists:
            create_table(spark, replace(ref, schema=ref.schema or df.schema))
            exists = True
        evolve_table(spark, ref, df.schema)
        rows = align(df, table_facts(spark, ref).schema)
        append_once(spark, ref, rows, token(), spark.createDataFrame(batch, FILE_SCHEMA))
        loaded += len(uris)
    return loaded


def _settled(
    spark: SparkSession, fresh: DataFrame, fmt: str, options: dict | None, files_per_batch: int
) -> tuple[DataFrame, T.StructType | None]:
    """The new files, listed once, and one schema for all of them."""
    fresh, _ = stage(spark, fresh, Workspace(spark).dir("new"))
    schemas = [
        read_files(spark, [row["uri"] for row in batch], fmt, options=options).schema
        for batch in _chunks(fresh.toLocalIterator(), files_per_batch)
    ]
    if len(schemas) < 2:
        return fresh, schemas[0] if schemas else None
    columns: dict[str, T.DataType] = {}
    for schema in schemas:
        for f in schema.fields:
            columns[f.name] = widen(columns.get(f.name, T.NullType()), f.dataType)
    return fresh, T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


def new_files(
    spark: SparkSession,
    table: Table,
    path: str,
    pattern: str | None,
    recursive: bool,
    by_content: bool,
) -> DataFrame:
    """``(uri, size, modified, sha256)`` of the files below ``path`` that the ledger lacks."""
    found = list_tree(spark, path, pattern=pattern, recursive=recursive)
    if by_content:
        found = _with_hashes(spark, found, path, pattern, recursive)
        same = ["uri", "sha256"]
    else:
        found = found.withColumn("sha256", F.lit(None).cast("string"))
        same = ["uri", "size", "modified"]
    found = found.withColumn("modified", F.unix_micros("modified"))
    done = ledger(spark, table)
    if done is not None:
        found = found.join(done.select(*same), same, "left_anti")
    return found.select("uri", "size", "modified", "sha256")


def _with_hashes(
    spark: SparkSession, found: DataFrame, path: str, pattern: str | None, recursive: bool
) -> DataFrame:
    hashes = hash_tree(spark, path, pattern=pattern, recursive=recursive)
    return found.join(hashes.select("uri", "sha256"), "uri")


def ledger(spark: SparkSession, table: str | Table) -> DataFrame | None:
    """Every file that was loaded, with its batch; None before the first one."""
    ref = as_table(table)
    return ledger_rows(spark, table_facts(spark, ref)) if table_exists(spark, ref) else None


def bulk_write_files(
    spark: SparkSession,
    table: Table,
    path: str,
    format: str,
    *,
    append: bool = True,
    recursive: bool = False,
    options: dict[str, object] | None = None,
) -> None:
    """Append a file, or a directory's ``*.<format>`` files, or make them the table.

    The table's schema is forced on the files.  Unlike ``copy_into``, every call appends.
    """
    if table.schema is None:
        raise ValueError(f"{table.identifier} needs a schema for a bulk load")
    pattern = True if store.is_directory(spark, path) else None
    df = read_files(
        spark, path, format, table.schema, pattern=pattern, recursive=recursive, options=options
    )
    bulk_write_table(spark, table, df, append=append)


def _chunks(rows: Iterator, size: int) -> Iterator[list]:
    while chunk := list(islice(rows, size)):
        yield chunk
