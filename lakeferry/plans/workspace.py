"""Scratch space on storage that every executor can reach, and scoped session settings."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.plans import store

# A broadcast side may take this many times the session's limit in memory.
MEMORY_PER_LIMIT = 10

_local_roots: dict[str, str] = {}
_opened: list[Workspace] = []


def shared_root(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder on this machine; on a cluster the
    executors would not see it, so there the missing setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(
            "spark.checkpoint.dir is not set: name a folder that all executors share"
        )
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="lakeferry-")
    return _local_roots[app]


class Workspace:
    """A uniquely named folder and database; nothing outside them is ever written."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        token = uuid.uuid4().hex
        self.path = f"{(root or shared_root(spark)).rstrip('/')}/lakeferry/{token}"
        self.database = f"lakeferry_{token}"
        self._has_database = False
        _opened.append(self)

    def dir(self, name: str) -> str:
        return f"{self.path}/{name}"

    def table(self, name: str) -> str:
        """A three-part table name inside this workspace."""
        if not self._has_database:
            self.spark.sql(
                f"CREATE DATABASE IF NOT EXISTS `{self.database}` LOCATION '{self.path}/db'"
            )
            self._has_database = True
        return f"spark_catalog.{self.database}.{name}"

    def close(self) -> None:
        """Drop the database and the folder; DataFrames that read them are gone too."""
        if self in _opened:
            _opened.remove(self)
        if self._has_database:
            self.spark.sql(f"DROP DATABASE IF EXISTS `{self.database}` CASCADE")
        store.delete(self.spark, self.path)

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *exc) -> None:
        self.close()


def close_all() -> None:
    """Close every open workspace of this process."""
    for workspace in list(_opened):
        workspace.close()


def stage(spark: SparkSession, df: DataFrame, path: str) -> tuple[DataFrame, int]:
    """Write ``df`` once to shared storage; return it read back, with its size in bytes.

    Several branches of a plan can then use it without computing it again, a lost executor costs
    a re-read instead of a re-computation, and the optimizer knows its real size when it decides
    whether a join side may be broadcast.
    """
    df.write.mode("overwrite").parquet(path)
    return spark.read.schema(df.schema).parquet(path), store.tree_bytes(spark, path)


@contextmanager
def session_settings(spark: SparkSession, settings: dict[str, object] | None) -> Iterator[None]:
    """Set session settings for the block; put the old values back afterwards.

    A DataFrame is lazy, so whatever must run under the settings has to be executed inside.
    """
    before: dict[str, str | None] = {}
    try:
        for key, value in (settings or {}).items():
            before[key] = spark.conf.get(key, None)
            spark.conf.set(key, str(value).lower() if isinstance(value, bool) else str(value))
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def broadcast_limit(spark: SparkSession) -> int:
    """Bytes up to which the session broadcasts a join side; -1 if it never does."""
    return bytes_setting(spark, "spark.sql.autoBroadcastJoinThreshold")


def bytes_setting(spark: SparkSession, key: str) -> int:
    """A session setting of a size, like ``10MB``, in bytes; -1 for a negative one."""
    text = spark.conf.get(key).strip()
    if text.startswith("-"):
        return -1
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)


def memory_bytes(df: DataFrame) -> int:
    """What the rows of ``df`` take as Spark rows, measured: files may be far more compact."""
    measured = [F.count("*") * F.lit(16 + 8 * len(df.columns))]
    for field in df.schema.fields:
        column = F.col("`" + field.name.replace("`", "``") + "`")
        if isinstance(field.dataType, (T.StringType, T.BinaryType)):
            measured.append(F.coalesce(F.sum(F.octet_length(column)), F.lit(0)))
        elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType, T.VariantType)):
            text = F.octet_length(F.to_json(F.struct(column)))
            measured.append(F.coalesce(F.sum(text), F.lit(0)))
    total = reduce(lambda a, b: a + b, measured)
    return df.agg(total.cast("bigint").alias("n")).first()["n"]


def may_broadcast(df: DataFrame, file_bytes: int) -> bool:
    """Is staged data within the session's limit as files, and of a bounded size in memory?"""
    limit = broadcast_limit(df.sparkSession)
    return file_bytes <= limit and memory_bytes(df) <= MEMORY_PER_LIMIT * limit
