"""Tables by name: identifiers, existence, facts from the catalog, typed reads."""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field, replace

from pyspark.errors import AnalysisException, UnsupportedOperationException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.functions.typed import apply_schema
from lakeferry.functions.types import SchemaLike, build_schema, quote
from lakeferry.plans import store

# The table formats.
FORMATS = (
    "TEXT",
    "AVRO",
    "BINARYFILE",
    "CSV",
    "JSON",
    "PARQUET",
    "ORC",
    "DELTA",
    "JDBC",
    "LIBSVM",
)
ROW_LEVEL_PROVIDERS = ("delta", "iceberg", "hudi")
# Table properties: the directory that held the content before the last replacement, the
# directory of the load ledger, and an overwrite that has begun.
PREVIOUS = "lakeferry.previous"
LEDGER_AT = "lakeferry.ledger"
PENDING = "lakeferry.pending"

# Fixed value: the characters that become underscores in a name.
REPLACED = """!"#$%&'()*+,/:;<=>?@[\\]^{|}~"""
_REPLACED = re.compile(f"[{re.escape(REPLACED)}]")


@dataclass(frozen=True)
class Table:
    """A table ``catalog.database.name``, how it is stored, and the schema its rows should have."""

    identifier: str
    format: str = "PARQUET"
    schema: T.StructType | None = None
    location: str | None = None
    partitioned_by: tuple[str, ...] = ()
    properties: dict[str, str] = field(default_factory=dict)
    options: dict[str, str] = field(default_factory=dict)

    def __post_init__(self):
        if len(self.parts) != 3:
            raise ValueError(
                f"name a table as <catalog>.<database>.<table>, got {self.identifier!r}"
            )
        known = self.format.upper()
        if known not in FORMATS:
            raise ValueError(f"unknown table format {self.format!r}; known: {FORMATS}")
        object.__setattr__(self, "format", known)
        object.__setattr__(self, "schema", build_schema(self.schema))
        if isinstance(self.partitioned_by, str):
            raise TypeError("partitioned_by is a list of column names")
        object.__setattr__(self, "partitioned_by", tuple(self.partitioned_by))

    @property
    def parts(self) -> list[str]:
        """Catalog, database and table, each without quotes and fit for a catalog."""
        written = self.identifier.split(".")
        return [_REPLACED.sub("_", "".join(part.split("`"))) for part in written]

    @property
    def name(self) -> str:
        """The quoted identifier."""
        return ".".join(map(quote, self.parts))

    @property
    def is_unmanaged(self) -> bool:
        return bool(self.location)

    @property
    def external_path(self) -> str | None:
        """``FORMAT.`location` ``, usable in place of a table name in SQL."""
        return f"{self.format.lower()}.{quote(self.location)}" if self.location else None

    def sibling(self, suffix: str) -> Table:
        *above, table = self.parts
        return replace(self, identifier=".".join([*above, f"{table}__{suffix}"]), location=None)


def as_table(table: str | Table, schema: SchemaLike | None = None) -> Table:
    ref = table if isinstance(table, Table) else Table(table)
    return ref if schema is None else replace(ref, schema=build_schema(schema))


def table_exists(spark: SparkSession, table: str | Table) -> bool:
    return spark.catalog.tableExists(as_table(table).name)


def drop_table(spark: SparkSession, table: str | Table, if_exists: bool = False) -> None:
    """Drop a table, its load ledger, and what its last replacement left for running readers."""
    ref = as_table(table)
    if if_exists and not table_exists(spark, ref):
        return
    properties = table_facts(spark, ref).properties
    spark.sql(f"DROP TABLE {ref.name}")
    for key in (PREVIOUS, LEDGER_AT):
        if key in properties:
            store.delete(spark, properties[key])


@dataclass(frozen=True)
class TableFacts:
    """What the catalog knows about an existing table."""

    schema: T.StructType
    provider: str
    location: str | None
    managed: bool
    partition_columns: tuple[str, ...]
    options: dict[str, str]
    properties: dict[str, str]


def table_facts(spark: SparkSession, table: str | Table) -> TableFacts:
    ref = as_table(table)
    try:
        row = spark.sql(f"DESCRIBE TABLE EXTENDED {ref.name} AS JSON").first()
    except UnsupportedOperationException:
        return _facts_from_listing(spark, ref)
    except AnalysisException as error:
        # catalogs of their own describe their tables as rows only
        if not (error.getCondition() or "").startswith("UNSUPPORTED_FEATURE"):
            raise
        return _facts_from_listing(spark, ref)
    facts = json.loads(row[0])
    options = facts.get("storage_properties") or {}
    return TableFacts(
        schema=spark.table(ref.name).schema,
        provider=(facts.get("provider") or "").lower(),
        location=facts.get("location"),
        managed=facts.get("type") == "MANAGED",
        partition_columns=tuple(facts.get("partition_columns") or ()),
        options={k: v for k, v in options.items() if k != "serialization.format"},
        properties=dict(facts.get("table_properties") or {}),
    )


def _facts_from_listing(spark: SparkSession, ref: Table) -> TableFacts:
    """The same facts from the rows of ``DESCRIBE TABLE EXTENDED``; options are not among them."""
    listed: dict[str, str] = {}
    partitions: list[str] = []
    section = ""
    for name, value, _ in spark.sql(f"DESCRIBE TABLE EXTENDED {ref.name}").collect():
        if name.startswith("# ") and name != "# col_name":
            section = name
        elif name and section.startswith("# Partition") and name != "# col_name":
            # a row per column, or numbered rows whose value is the column
            partitions.append(value if name.startswith("Part ") else name)
        elif name and section == "# Detailed Table Information":
            listed[name] = value
    properties = spark.sql(f"SHOW TBLPROPERTIES {ref.name}").collect()
    return TableFacts(
        schema=spark.table(ref.name).schema,
        provider=listed.get("Provider", "").lower(),
        location=listed.get("Location"),
        managed=listed.get("Type") == "MANAGED",
        partition_columns=tuple(partitions),
        options={},
        properties={r["key"]: r["value"] for r in properties},
    )


def read_table(
    spark: SparkSession,
    table: str | Table,
    columns: list[str] | None = None,
    *,
    distinct: bool = False,
    limit: int | None = None,
) -> DataFrame:
    """The rows of a table; typed by its schema if it has one.

    One logical plan: the projection reaches the file scan, ``limit`` stops it early.  The files
    are those of now, not those that the session knew when it last read the table.
    """
    ref = as_table(table)
    spark.catalog.refreshTable(ref.name)
    df = spark.table(ref.name)
    if columns is not None:
        df = df.select(*[F.col(quote(c)) for c in columns])
    if distinct:
        df = distinct_rows(df)
    if limit is not None:
        df = df.limit(limit)
    return apply_schema(df, ref.schema) if ref.schema is not None else df


def read_external(spark: SparkSession, table: Table) -> DataFrame:
    """The rows at an unmanaged table's location, without a catalog entry."""
    if not table.is_unmanaged:
        raise ValueError(f"{table.identifier} has no location")
    reader = spark.read.format(table.format.lower()).options(**table.options)
    return (reader.schema(table.schema) if table.schema else reader).load(table.location)


def distinct_rows(df: DataFrame) -> DataFrame:
    """Distinct rows, also with MAP columns; VARIANT values cannot be compared."""
    if any(_contains(f.dataType, T.VariantType) for f in df.schema.fields):
        raise ValueError("VARIANT values cannot be compared; select other columns for distinct")
    if any(_contains(f.dataType, T.MapType) for f in df.schema.fields):
        columns = [F.col(quote(c)) for c in df.columns]
        return df.groupBy(*columns).agg(F.count("*").alias("__n")).drop("__n")
    return df.distinct()


def _contains(dtype: T.DataType, kind: type) -> bool:
    if isinstance(dtype, kind):
        return True
    if isinstance(dtype, T.ArrayType):
        return _contains(dtype.elementType, kind)
    if isinstance(dtype, T.MapType):
        return _contains(dtype.keyType, kind) or _contains(dtype.valueType, kind)
    if isinstance(dtype, T.StructType):
        return any(_contains(f.dataType, kind) for f in dtype.fields)
    return False
