"""How a finished result becomes the table's content.

Contract: one writer per table at a time.  A lost executor or a failed job leaves the old content
untouched.  New rows are always written by Spark's own writer, straight into the table; the names of
their files start with the commit's key, so that a commit that takes several steps, which is recorded
first, can be undone or finished by the next writer (``recover``).
"""

from __future__ import annotations

import uuid
from concurrent.futures import ThreadPoolExecutor
from contextlib import AbstractContextManager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.functions.types import quote
from lakeferry.plans import store
from lakeferry.plans.workspace import session_settings
from lakeferry.sources.tables import (
    LEDGER_AT,
    PENDING,
    PREVIOUS,
    Table,
    TableFacts,
    table_facts,
)

CONTENT, ADDING, DROPPING = "content", "adding", "dropping"
STARTED, LEDGER = "started", "files"
LEDGER_SCHEMA = "uri string, size bigint, modified bigint, sha256 string, batch string"
# The file that a row of a table is in, and a number for it, which is what moves with a row: names of
# files are longer than most rows.  Two files of one number are only rewritten together.
FILE, FILE_NUMBER, FIRST_ROW = "__file", "__file_number", "__first_row"
MOVERS = 16


def token() -> str:
    return uuid.uuid4().hex


def rebalance(df: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Before a partitioned write: few files per partition, a large partition over many tasks."""
    return df.hint("rebalance", *[F.col(quote(c)) for c in columns]) if columns else df


def as_stored(df: DataFrame, facts: TableFacts) -> DataFrame:
    """Columns in the table's order and types."""
    return df.select(
        *[F.col(quote(f.name)).cast(f.dataType).alias(f.name) for f in facts.schema.fields]
    )


def save(df: DataFrame, facts: TableFacts, path: str) -> None:
    """Write ``df`` as files of the table's format and layout."""
    writer = rebalance(df, facts.partition_columns).write.mode("overwrite")
    writer = writer.format(facts.provider).options(**facts.options)
    if facts.partition_columns:
        writer = writer.partitionBy(*facts.partition_columns)
    writer.save(path)


def named_files(spark: SparkSession, key: str) -> AbstractContextManager[None]:
    """Files written in the block have names that start with ``prefix_of(key)``."""
    return session_settings(spark, {"mapreduce.output.basename": prefix_of(key)[:-1]})


def prefix_of(key: str) -> str:
    return f"part-{key}-"


def append_rows(spark: SparkSession, table: Table, df: DataFrame, key: str) -> None:
    """Spark's own append, with the key in the names of the new files."""
    facts = table_facts(spark, table)
    with named_files(spark, key):
        rebalance(as_stored(df, facts), facts.partition_columns).write.insertInto(table.name)


def _discard(spark: SparkSession, table: Table, key: str) -> None:
    """Delete the files that an append under ``key`` left; only after a crash are names listed."""
    location = table_facts(spark, table).location
    for name in list(store.files(spark, location)):
        if name.rsplit("/", 1)[-1].startswith(prefix_of(key)):
            store.delete(spark, f"{location}/{name}")
    spark.catalog.refreshTable(table.name)


def set_property(spark: SparkSession, table: Table, key: str, value: str | None) -> None:
    if value is None:
        spark.sql(f"ALTER TABLE {table.name} UNSET TBLPROPERTIES IF EXISTS ('{key}')")
    else:
        spark.sql(f"ALTER TABLE {table.name} SET TBLPROPERTIES ('{key}' = {_value(value)})")


# ------------------------------------------------------- whole content


def replace_content(spark: SparkSession, table: Table, df: DataFrame) -> None:
    """Make ``df`` the whole content of an existing table; ``df`` may read that table.

    A managed table gets a new directory, and one catalog change makes it current; the directory
    it replaces is kept for running readers until the next replacement.  A partitioned table, or
    one at a location of its own, is overwritten in place from the staged copy.
    """
    facts = table_facts(spark, table)
    target = f"{facts.location.rstrip('/').split('__v_')[0]}__v_{token()}"
    save(as_stored(df, facts), facts, target)
    if facts.managed and not facts.partition_columns:
        _switch(spark, table, facts, target)
    else:
        set_property(spark, table, PENDING, f"{CONTENT} {target}")
        _overwrite_content(spark, table, target)


def _switch(spark: SparkSession, table: Table, facts: TableFacts, target: str) -> None:
    spark.sql(f"ALTER TABLE {table.name} SET LOCATION '{target}'")
    older = facts.properties.get(PREVIOUS)
    set_property(spark, table, PREVIOUS, facts.location)
    if older and older != target:
        store.delete(spark, older)


def _overwrite_content(spark: SparkSession, table: Table, staged: str) -> None:
    facts = table_facts(spark, table)
    reader = spark.read.format(facts.provider).options(**facts.options)
    rows = as_stored(reader.schema(facts.schema).load(staged), facts)
    with session_settings(spark, {"spark.sql.sources.partitionOverwriteMode": "static"}):
        rebalance(rows, facts.partition_columns).write.insertInto(table.name, overwrite=True)
    set_property(spark, table, PENDING, None)
    store.delete(spark, staged)


# ------------------------------------------------------- single files


def with_file(target: DataFrame) -> DataFrame:
    """The rows of a table with the file that each is in, its number, and whether the row names the file.

    That is the first row, where the format counts its rows, otherwise any.
    """
    about = target.metadataColumn("_metadata")
    counted = "row_index" in target.select(about).schema[0].dataType.names
    first = about["row_index"] == 0 if counted else F.lit(True)
    name = about["file_path"]
    return target.select("*", name.alias(FILE), F.xxhash64(name).alias(FILE_NUMBER), first.alias(FIRST_ROW))


def in_files(target: DataFrame, files: list[str]) -> DataFrame:
    """The rows of a table that are in some of its files; the scan opens no other."""
    return target.where(target.metadataColumn("_metadata")["file_path"].isin(files))


def replace_files(spark: SparkSession, table: Table, df: DataFrame, staged: str) -> None:
    """Put the rows ``df`` in the place of the files listed in ``staged/gone``.

    Every other file stays as it is.  The new files are written once, by an append; then the listed
    ones go.  A crash before the append is complete undoes it, a later one is finished.
    """
    set_property(spark, table, PENDING, f"{ADDING} {staged}")
    append_rows(spark, table, df, staged.rsplit("/", 1)[-1])
    set_property(spark, table, PENDING, f"{DROPPING} {staged}")
    _drop_files(spark, table, staged)


def _undo_files(spark: SparkSession, table: Table, staged: str) -> None:
    _discard(spark, table, staged.rsplit("/", 1)[-1])
    set_property(spark, table, PENDING, None)
    store.delete(spark, staged)


def _drop_files(spark: SparkSession, table: Table, staged: str) -> None:
    facts = table_facts(spark, table)
    gone = spark.read.parquet(f"{staged}/gone")
    with ThreadPoolExecutor(MOVERS) as pool:
        deletes = [pool.submit(store.delete_uri, spark, row[FILE]) for row in gone.select(FILE).toLocalIterator()]
        for done in deletes:
            done.result()
    spark.catalog.refreshTable(table.name)
    columns = facts.partition_columns
    if columns:
        # one row for each partition that lost a file
        touched = gone.groupBy(*[F.col(quote(c)) for c in columns]).agg(F.min(FILE).alias(FILE))
        for row in touched.toLocalIterator():
            if not any(name[0] not in "_." for name in store.children(spark, store.folder_of(spark, row[FILE]))):
                spec = ", ".join(f"{quote(c)} = {_value(row[c])}" for c in columns)
                _drop_partition(spark, table, facts, spec)
    set_property(spark, table, PENDING, None)
    store.delete(spark, staged)


def _drop_partition(spark: SparkSession, table: Table, facts: TableFacts, spec: str) -> None:
    """Drop a partition with its files, which a table at a location of its own would keep."""
    folders = spark.sql(f"SHOW PARTITIONS {table.name} PARTITION ({spec})").collect()
    spark.sql(f"ALTER TABLE {table.name} DROP IF EXISTS PARTITION ({spec})")
    for row in folders:
        store.delete(spark, f"{facts.location}/{row[0]}")


def _value(value: object) -> str:
    if value is None:
        return "NULL"
    return "'" + str(value).replace("\\", "\\\\").replace("'", "\\'") + "'"


# ------------------------------------------------------- append exactly once


def append_once(
    spark: SparkSession, table: Table, df: DataFrame, key: str, entries: DataFrame | None = None
) -> bool:
    """Append ``df`` under ``key``; a key that is in already changes nothing.

    Spark's writer appends the rows, then the ledger's rows for this key, which make the batch part
    of the table: one file, so all of them or none.  A crash before that is undone by the same call
    or by ``recover``, which delete the files named by the key.  Returns whether rows were added.
    """
    root = ledger_root(spark, table, table_facts(spark, table))
    if _is_in(spark, root, key):
        store.delete(spark, f"{root}/{STARTED}/{key}")
        return False
    if store.exists(spark, f"{root}/{STARTED}/{key}"):
        _discard(spark, table, key)
    store.touch(spark, f"{root}/{STARTED}/{key}")
    append_rows(spark, table, df, key)
    _enter(spark, root, key, entries)
    store.delete(spark, f"{root}/{STARTED}/{key}")
    return True


def _enter(spark: SparkSession, root: str, key: str, entries: DataFrame | None) -> None:
    """The ledger's rows of a batch; one without files is a row without a name."""
    fields = T.StructType.fromDDL(LEDGER_SCHEMA).fields
    if entries is None:
        entries = spark.range(1).select(*[F.lit(None).alias(f.name) for f in fields])
    rows = entries.withColumn("batch", F.lit(key)).select(*[F.col(f.name).cast(f.dataType) for f in fields])
    with named_files(spark, key):
        rows.coalesce(1).write.mode("append").parquet(f"{root}/{LEDGER}")


def _is_in(spark: SparkSession, root: str, key: str) -> bool:
    return store.matches(spark, f"{root}/{LEDGER}/{prefix_of(key)}*")


def ledger_root(spark: SparkSession, table: Table, facts: TableFacts) -> str:
    """The directory that remembers what is in the table; a table property names it.

    It is outside the data, which merges replace.  It lives as long as the table.
    """
    root = facts.properties.get(LEDGER_AT)
    if root is None:
        folder, name = facts.location.rstrip("/").rsplit("/", 1)
        root = f"{folder}/_lakeferry/{name.split('__v_')[0]}-{token()}"
        set_property(spark, table, LEDGER_AT, root)
    return root


def ledger_rows(spark: SparkSession, facts: TableFacts) -> DataFrame | None:
    """One row for every file that was loaded into the table, with its batch; None before the first."""
    root = facts.properties.get(LEDGER_AT)
    if root is None or not store.exists(spark, f"{root}/{LEDGER}"):
        return None
    return spark.read.schema(LEDGER_SCHEMA).parquet(f"{root}/{LEDGER}").where(F.col("uri").isNotNull())


def recover(spark: SparkSession, table: Table) -> None:
    """Finish or undo what a crashed writer had begun.

    Every writer of this package calls it first, so no write comes between.  The session also
    forgets the files it knew, since a stream or another session may have replaced some.
    """
    spark.catalog.refreshTable(table.name)
    facts = table_facts(spark, table)
    if pending := facts.properties.get(PENDING):
        kind, path = pending.split(" ", 1)
        finish = {CONTENT: _overwrite_content, ADDING: _undo_files, DROPPING: _drop_files}[kind]
        finish(spark, table, path)
    root = facts.properties.get(LEDGER_AT)
    for key in store.children(spark, f"{root}/{STARTED}") if root else []:
        if not _is_in(spark, root, key):
            _discard(spark, table, key)
        store.delete(spark, f"{root}/{STARTED}/{key}")
