"""Tags and comments as change logs.

A change sets a value, or removes it with NULL.  The last change of each (entity, name) wins, so
thousands of entities are brought up to date by one aggregation.  Any name may be used for the
entities: tables, files tables, users.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeferry.functions.types import quote
from lakeferry.operators.write import write_table
from lakeferry.sources.tables import Table, as_table, table_exists, table_facts

CHANGES_SCHEMA = "entity string, name string, value string, at timestamp, seq bigint"
TAG_PROPERTY = "tag."


def latest(log: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """``(*keys, value)``: the last change per key, removals as NULL.

    Combined on the map side, so a key with very many changes costs one row per task.
    """
    newest = F.max_by(F.col(quote(value)), F.struct(*[F.col(quote(c)) for c in order]))
    return log.groupBy(*[F.col(quote(k)) for k in keys]).agg(newest.alias(value))


def replay(log: DataFrame, keys: list[str], value: str, order: list[str]) -> DataFrame:
    """The values in force: the last change per key, unless it is a removal."""
    return latest(log, keys, value, order).where(F.col(quote(value)).isNotNull())


def tag_maps(
    tags: DataFrame, entity: str, name: str, value: str, *, parts: int = 1
) -> DataFrame:
    """``(entity, part, tags)``: the tags of an entity as a map, one row for every entity.

    ``tags`` has one row per (entity, name); a row without a name is no tag and is passed over.
    A caller whose entities have more tags than a map should hold asks for ``parts``: then every
    entity is split alike, by a hash of the name, into at most that many rows.
    """
    named = tags.where(F.col(quote(name)).isNotNull())
    split = named.withColumn("part", F.pmod(F.xxhash64(F.col(quote(name))), F.lit(parts).cast("bigint")))
    pairs = F.collect_list(F.struct(F.col(quote(name)), F.col(quote(value))))
    grouped = split.groupBy(F.col(quote(entity)), F.col("part"))
    return grouped.agg(F.map_from_entries(pairs).alias("tags"))


# ---------------------------------------------------------------- a registry table


def record_changes(spark: SparkSession, registry: str | Table, changes: DataFrame) -> None:
    """Append changes ``(entity, name, value)`` to a registry, in one job for any number.

    A change without a name is an error.

    ``at`` is the current time; ``seq`` orders the changes of one call by ``changes.seq`` if given.
    """
    seq = F.col("seq") if "seq" in changes.columns else F.lit(0)
    rows = changes.select(
        F.col("entity").cast("string").alias("entity"),
        F.coalesce(F.col("name").cast("string"), F.raise_error(F.lit("a change needs a name"))).alias("name"),
        F.col("value").cast("string").alias("value"),
        F.current_timestamp().alias("at"),
        seq.cast("bigint").alias("seq"),
    )
    write_table(spark, registry, rows)


def set_tags(
    spark: SparkSession, registry: str | Table, entity: str, tags: dict[object, object]
) -> None:
    if not tags:
        raise ValueError("tags are a non-empty dictionary")
    rows = [(entity, str(k), str(v)) for k, v in tags.items()]
    record_changes(spark, registry, _changes(spark, rows))


def unset_tags(
    spark: SparkSession, registry: str | Table, entity: str, names: list[object]
) -> None:
    if not names:
        raise ValueError("names are a non-empty list")
    record_changes(spark, registry, _changes(spark, [(entity, str(n), None) for n in names]))


def get_tags(spark: SparkSession, registry: str | Table, entity: str) -> DataFrame:
    """``(name, value)`` of one entity; the filter reaches the scan."""
    ref = as_table(registry)
    if not table_exists(spark, ref):
        return spark.createDataFrame([], "name string, value string")
    log = spark.table(ref.name).where(F.col("entity") == entity)
    return replay(log, ["name"], "value", ["at", "seq"])


def set_comment(
    spark: SparkSession, registry: str | Table, entity: str, comment: str | None
) -> None:
    record_changes(spark, registry, _changes(spark, [(entity, "comment", comment or None)]))


def get_comment(spark: SparkSession, registry: str | Table, entity: str) -> str | None:
    row = get_tags(spark, registry, entity).where("name = 'comment'").first()
    return row["value"] if row else None


def _changes(spark: SparkSession, rows: list[tuple]) -> DataFrame:
    return spark.createDataFrame(rows, "entity string, name string, value string")


# ---------------------------------------------------------------- one table's own entry


def set_comment_on_table(spark: SparkSession, table: str | Table, comment: str | None) -> None:
    """An empty or absent comment removes the comment."""
    text = "NULL" if not comment else _text(comment)
    spark.sql(f"COMMENT ON TABLE {as_table(table).name} IS {text}")


def get_comment_on_table(spark: SparkSession, table: str | Table) -> str | None:
    return spark.catalog.getTable(as_table(table).name).description or None


def set_tags_on_table(
    spark: SparkSession, table: str | Table, tags: dict[object, object]
) -> None:
    """Tags of one table, kept among its properties."""
    if not tags:
        raise ValueError("tags are a non-empty dictionary")
    pairs = ", ".join(f"{_text(TAG_PROPERTY + str(k))} = {_text(str(v))}" for k, v in tags.items())
    spark.sql(f"ALTER TABLE {as_table(table).name} SET TBLPROPERTIES ({pairs})")


def unset_tags_on_table(spark: SparkSession, table: str | Table, names: list[object]) -> None:
    if not names:
        raise ValueError("names are a non-empty list")
    listed = ", ".join(_text(TAG_PROPERTY + str(n)) for n in names)
    spark.sql(f"ALTER TABLE {as_table(table).name} UNSET TBLPROPERTIES IF EXISTS ({listed})")


def get_tags_on_table(spark: SparkSession, table: str | Table) -> dict[str, str]:
    properties = table_facts(spark, table).properties
    return {
        k[len(TAG_PROPERTY):]: v for k, v in properties.items() if k.startswith(TAG_PROPERTY)
    }


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
