"""Check whole columns against a schema: counts, split, or failure."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.functions.fit import fits_column
from lakeferry.functions.types import SchemaLike, build_schema, missing_from, quote, sql_type


class ConformanceError(ValueError):
    """Rows do not conform to the schema."""


def _predicates(df: DataFrame, schema: T.StructType, options: dict) -> dict[str, Column]:
    absent = missing_from(df, schema.names, df.columns)
    if absent:
        raise ValueError(f"columns {absent} of the schema are not in the data")
    types = {f.name.lower(): f for f in df.schema.fields}
    return {
        f.name: fits_column(
            types[f.name.lower()].name, types[f.name.lower()].dataType, f, **options
        )
        for f in schema.fields
    }


def type_fit_report(df: DataFrame, schema: SchemaLike, **options) -> DataFrame:
    """``(name, type, n, n_fit, n_unfit, n_null)`` per column of ``schema``.

    One pass over the columns involved, whatever their number; NULLs are counted apart.
    """
    schema = build_schema(schema)
    predicates = _predicates(df, schema, options)
    aggregates = [F.count("*").alias("n")]
    for i, (name, fit) in enumerate(predicates.items()):
        null = F.col(quote(name)).isNull()
        aggregates += [
            F.count_if(fit & ~null).alias(f"fit_{i}"),
            F.count_if(null).alias(f"null_{i}"),
        ]
    rows = [
        F.struct(
            F.lit(f.name).alias("name"),
            F.lit(sql_type(f.dataType)).alias("type"),
            F.col("n"),
            F.col(f"fit_{i}").alias("n_fit"),
            (F.col("n") - F.col(f"fit_{i}") - F.col(f"null_{i}")).alias("n_unfit"),
            F.col(f"null_{i}").alias("n_null"),
        )
        for i, f in enumerate(schema.fields)
    ]
    return df.agg(*aggregates).select(F.inline(F.array(*rows)))


def with_fit(
    df: DataFrame, schema: SchemaLike, flag: str = "accepted", **options
) -> DataFrame:
    """``df`` with a boolean column: do all values of the row conform?  NULLs do."""
    predicates = _predicates(df, build_schema(schema), options)
    ok = reduce(
        lambda a, b: a & b,
        [F.col(quote(name)).isNull() | fit for name, fit in predicates.items()],
        F.lit(True),
    )
    return df.withColumn(flag, ok)


def split_by_fit(
    df: DataFrame, schema: SchemaLike, *, strict: bool = False, **options
) -> tuple[DataFrame, DataFrame]:
    """Conforming and rejected rows.  With ``strict`` a rejected row is an error at once."""
    flagged = with_fit(df, schema, "__fit", **options)
    accepted = flagged.where("__fit").drop("__fit")
    rejected = flagged.where("NOT __fit").drop("__fit")
    if strict:
        sample = rejected.take(1)
        if sample:
            raise ConformanceError(f"a row does not conform to the schema: {sample[0]}")
    return accepted, rejected
