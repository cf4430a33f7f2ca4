"""Tables written to the cluster's shared folder, to be read more than once."""

from __future__ import annotations

import gc

from pyspark.sql import DataFrame, SparkSession

from lakeferry.plans import store
from lakeferry.plans.workspace import Workspace


class Scratch:
    """Named tables below one fresh folder in ``spark.checkpoint.dir``.

    A lost executor costs a re-read of a written table, not a re-computation. Tables that later
    steps don't read are deleted as soon as their successors are written.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.space = Workspace(spark)
        self._schemas = {}

    def put(self, df: DataFrame, name: str, **options: str) -> DataFrame:
        df.write.mode("overwrite").options(**options).parquet(self.space.dir(name))
        self._schemas[name] = df.schema
        return self.get(name)

    def get(self, name: str) -> DataFrame:
        return self.spark.read.schema(self._schemas[name]).parquet(self.space.dir(name))

    def drop(self, *names: str) -> None:
        for name in names:
            store.delete(self.spark, self.space.dir(name))

    def release(self) -> None:
        """Let Spark delete the shuffle files of plans that nothing refers to any more."""
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()
