"""Create, append, overwrite, replace and evolve tables."""

from __future__ import annotations

import dataclasses

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from lakeferry.functions.types import (
    align,
    missing_from,
    quote,
    refuse_narrowing,
    reject_void,
    schema_ddl,
    sql_type,
)
from lakeferry.plans import store
from lakeferry.plans.commit import rebalance, recover, replace_content, token
from lakeferry.sources.tables import (
    LEDGER_AT,
    PENDING,
    PREVIOUS,
    Table,
    as_table,
    table_exists,
    table_facts,
)


def create_table(spark: SparkSession, table: str | Table, replace: bool = False) -> None:
    """Create an empty table; an existing one is left alone, or emptied and redefined.

    The format is honored with and without a location.
    """
    ref = as_table(table)
    if ref.schema is not None:
        reject_void(ref.schema)
    if replace and table_exists(spark, ref):
        if ref.schema is None:
            raise ValueError(f"a replacement for {ref.identifier} needs a schema")
        replace_table(spark, ref, spark.createDataFrame([], ref.schema))
        return
    spark.sql(create_statement(ref))


def create_statement(table: Table) -> str:
    columns = f" ({schema_ddl(table.schema)})" if table.schema is not None else ""
    text = f"CREATE TABLE IF NOT EXISTS {table.name}{columns} USING {table.format}"
    if table.options:
        text += f" OPTIONS ({_pairs(table.options)})"
    if table.partitioned_by:
        text += f" PARTITIONED BY ({', '.join(quote(c) for c in table.partitioned_by)})"
    if table.location:
        text += f" LOCATION '{_escape(table.location)}'"
    if table.properties:
        text += f" TBLPROPERTIES ({_pairs(table.properties)})"
    return text


def _escape(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")


def _pairs(values: dict[str, str]) -> str:
    return ", ".join(f"'{_escape(str(k))}' = '{_escape(str(v))}'" for k, v in values.items())


def write_table(
    spark: SparkSession, table: str | Table, df: DataFrame, append: bool = True
) -> None:
    """Append to a table, or overwrite its rows and keep its schema.

    An overwrite is complete beside the table before the old rows go, whatever the session's
    overwrite mode, so a source that fails leaves them, and ``df`` may read the table.
    The table is created if absent.  With a schema on ``table``, columns of ``df`` outside it are
    dropped; columns the rows lack become NULL.  Without one, a column the table lacks is an error.
    """
    ref = as_table(table)
    if ref.schema is not None:
        df = align(df, ref.schema)
    _ensure(spark, ref, df.schema)
    _insert(spark, ref, df, overwrite=not append)


def bulk_write_table(
    spark: SparkSession, table: str | Table, df: DataFrame, append: bool = True
) -> None:
    """Append and add the columns the table lacks, or replace the table and its schema."""
    ref = as_table(table)
    if ref.schema is not None:
        df = align(df, ref.schema)
    if append:
        _ensure(spark, ref, df.schema)
        evolve_table(spark, ref, df.schema)
        _insert(spark, ref, df, overwrite=False)
    else:
        replace_table(spark, ref, df)


def evolve_table(spark: SparkSession, table: str | Table, schema: T.StructType) -> list[str]:
    """Add the columns of ``schema`` that the table lacks; returns their names.

    A column whose new type the table's column cannot hold is an error: nothing is narrowed.
    """
    ref = as_table(table)
    have = spark.table(ref.name)
    refuse_narrowing(have.schema, schema, ref.identifier)
    new = missing_from(have, schema.names, have.columns)
    if new:
        wanted = T.StructType([schema[name] for name in new])
        reject_void(wanted)
        columns = ", ".join(f"{quote(f.name)} {sql_type(f.dataType)}" for f in wanted.fields)
        spark.sql(f"ALTER TABLE {ref.name} ADD COLUMNS ({columns})")
    return new


def replace_table(spark: SparkSession, table: str | Table, df: DataFrame) -> None:
    """Make ``df`` the table: new rows, new schema, new layout.

    The rows are written beside the table first, so ``df`` may read the table it replaces.  Then
    the old folder is moved aside and the new one takes its place; if any step fails, the old
    folder and the old definition are put back.  Properties, tags and the comment stay.
    """
    ref = as_table(table)
    reject_void(df.schema)
    if not table_exists(spark, ref):
        _save_as(ref, df)
        return
    facts = table_facts(spark, ref)
    folder, name = facts.location.rstrip("/").rsplit("/", 1)
    beside = f"{folder}/_lakeferry/{name.split('__v_')[0]}-{token()}"
    if ref.location and facts.location != store.qualified(spark, ref.location):
        if store.children(spark, ref.location):
            raise ValueError(f"{ref.location} holds data that is not {ref.identifier}'s")
    kept = {k: v for k, v in facts.properties.items() if k not in (PREVIOUS, LEDGER_AT, PENDING)}
    comment = spark.catalog.getTable(ref.name).description
    _writer(ref, df).save(f"{beside}/new")
    fresh = dataclasses.replace(ref, schema=df.schema, properties={**kept, **ref.properties})
    old = Table(
        ref.identifier,
        facts.provider,
        facts.schema,
        None if facts.managed else facts.location,
        tuple(facts.partition_columns),
        kept,
        facts.options,
    )
    if PREVIOUS in facts.properties:  # an older version, kept for running readers, may be in the way
        store.delete(spark, facts.properties[PREVIOUS])
    store.move(spark, facts.location, f"{beside}/old")
    try:
        spark.sql(f"DROP TABLE {ref.name}")
        _install(spark, fresh, f"{beside}/new", comment)
    except BaseException:
        spark.sql(f"DROP TABLE IF EXISTS {ref.name}")
        _install(spark, old, f"{beside}/old", comment)
        raise
    if LEDGER_AT in facts.properties:
        store.delete(spark, facts.properties[LEDGER_AT])
    store.delete(spark, beside)


def _install(spark: SparkSession, table: Table, folder: str, comment: str | None) -> None:
    """Create a table over a finished folder, which becomes its own."""
    spark.sql(create_statement(table))
    location = table_facts(spark, table).location
    store.delete(spark, location)
    store.move(spark, folder, location)
    if table.partitioned_by:
        spark.sql(f"ALTER TABLE {table.name} RECOVER PARTITIONS")
    if comment:
        spark.sql(f"COMMENT ON TABLE {table.name} IS '{_escape(comment)}'")
    spark.catalog.refreshTable(table.name)


def _writer(ref: Table, df: DataFrame):
    writer = rebalance(df, ref.partitioned_by).write.format(ref.format.lower())
    writer = writer.options(**ref.options)
    return writer.partitionBy(*ref.partitioned_by) if ref.partitioned_by else writer


def _save_as(ref: Table, df: DataFrame) -> None:
    writer = _writer(ref, df)
    if ref.location:
        writer = writer.option("path", ref.location)
    writer.saveAsTable(ref.name)


def _ensure(spark: SparkSession, ref: Table, schema: T.StructType) -> None:
    if not table_exists(spark, ref):
        create_table(spark, dataclasses.replace(ref, schema=ref.schema or schema))


def _insert(spark: SparkSession, ref: Table, df: DataFrame, overwrite: bool) -> None:
    """By name: the table's column order decides, partition columns included."""
    recover(spark, ref)
    facts = table_facts(spark, ref)
    unknown = missing_from(df, df.columns, facts.schema.names)
    if unknown:
        raise ValueError(f"{ref.identifier} has no columns {unknown}")
    rows = align(df, facts.schema)
    if overwrite:
        replace_content(spark, ref, rows)
    else:
        rebalance(rows, facts.partition_columns).write.insertInto(ref.name)
