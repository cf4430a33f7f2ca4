"""Streaming upsert: the newest row of each key, whatever order the files arrive in."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from lakeferry.functions.types import quote
from lakeferry.operators.merge import merge_table
from lakeferry.operators.write import create_table
from lakeferry.sources.tables import Table, as_table, table_exists


def newest(df: DataFrame, keys: list[str], sequence: list[str]) -> DataFrame:
    """One row per key, the one with the greatest ``sequence``; combined on the map side."""
    rest = [c for c in df.columns if c not in keys]
    order = F.struct(*[F.col(quote(c)) for c in sequence])
    row = F.max_by(F.struct(*[F.col(quote(c)) for c in rest]), order)
    grouped = df.groupBy(*[F.col(quote(k)) for k in keys]).agg(row.alias("__row"))
    return grouped.select(
        *[F.col(quote(c)) if c in keys else F.col("__row")[c].alias(c) for c in df.columns]
    )


def _with_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    def present(name: str) -> Column:
        missing = F.raise_error(f"the key column {name} is NULL").cast(df.schema[name].dataType)
        return F.coalesce(F.col(quote(name)), missing).alias(name)

    return df.select(*[present(c) if c in keys else F.col(quote(c)) for c in df.columns])


def stream_merge(
    stream: DataFrame,
    table: str | Table,
    keys: str | list[str],
    sequence: str | list[str],
    checkpoint: str,
) -> StreamingQuery:
    """Upsert a stream into a table, keeping the highest ``sequence`` per key.

    Replaying a batch changes nothing, since no row is newer than itself.  A change with NULL
    values stays in the table as a removal mark, so that an older change cannot come back.
    A NULL key fails the stream: such a row matches nothing, so a replay would add it again.
    """
    ref = as_table(table)
    keys = [keys] if isinstance(keys, str) else list(keys)
    sequence = [sequence] if isinstance(sequence, str) else list(sequence)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        if not table_exists(spark, ref):
            create_table(spark, replace(ref, schema=ref.schema or batch.schema))
        rows = newest(_with_keys(batch, keys), keys, sequence)
        merge_table(spark, ref, rows, keys, newer_by=sequence)

    writer = stream.writeStream.foreachBatch(upsert).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).start()


def stream_tags(
    changes: DataFrame, table: str | Table, checkpoint: str, *, order: list[str]
) -> StreamingQuery:
    """Replay a stream of tag changes ``(entity, name, value, *order)``; see ``tags_in_force``."""
    return stream_merge(changes, table, ["entity", "name"], order, checkpoint)


def tags_in_force(state: DataFrame) -> DataFrame:
    """The tags of a replayed change stream without its removal marks."""
    return state.where(F.col("value").isNotNull()).select("entity", "name", "value")
