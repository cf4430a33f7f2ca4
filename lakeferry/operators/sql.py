"""SQL text with typed parameters and settings of its own."""

from __future__ import annotations

from collections.abc import Iterable
from decimal import Decimal
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lakeferry.functions.types import quote
from lakeferry.plans.workspace import Workspace, broadcast_limit, session_settings, stage

# A longer list becomes a join side, which the optimizer broadcasts or shuffles by its size.
INLINE_VALUES = 200
_WANTED = "__wanted"
# Bytes a row of one value takes beside the value.
VALUE_OVERHEAD = 32


def run_sql(
    spark: SparkSession,
    query: str,
    params: dict[str, object] | None = None,
    *,
    settings: dict[str, object] | None = None,
) -> DataFrame:
    """Run SQL text; ``:name`` markers take the typed values of ``params``.

    A list, tuple or set binds as an array, for ``array_contains(:names, column)``.  ``settings``
    are session settings for this query only: the query is executed under them, its result kept on
    shared storage until ``close_all``, and the old settings are back when this returns.
    """
    bound = {name: _bind(value) for name, value in (params or {}).items()}
    if settings is None:
        return spark.sql(query, args=bound)
    with session_settings(spark, settings):
        df = spark.sql(query, args=bound)
        kept, _ = stage(spark, df, Workspace(spark).dir("result"))
    return kept


def _bind(value: object) -> object:
    if isinstance(value, (set, frozenset)):
        value = sorted(value)
    if isinstance(value, (list, tuple)):
        return F.array(*[F.lit(v) for v in value])
    if isinstance(value, dict):
        return F.create_map(*[F.lit(x) for pair in value.items() for x in pair])
    if isinstance(value, int) and not isinstance(value, bool) and not -(2**63) <= value < 2**63:
        return F.lit(Decimal(value))
    return value


def where_in(df: DataFrame, column: str, values: Iterable[object]) -> DataFrame:
    """Rows whose ``column`` is one of ``values``.

    A short list is a predicate that reaches the file scan.  A long one is a semi-join, broadcast
    while its own size stays within the session's limit for that; its least and greatest value
    still reach the scan.  Both compare as SQL does, in the type that the column and the values
    have in common, so the length decides the plan only.
    """
    spark = df.sparkSession
    wanted = [v for v in dict.fromkeys(values) if v is not None]
    if not wanted:
        return df.where(F.lit(False))
    by_kind: dict[str, list] = {}
    for value in wanted:
        by_kind.setdefault(_kind(value), []).append(value)
    target = F.col(quote(column))
    if len(wanted) <= INLINE_VALUES:
        return df.where(target.isin(*map(_literal, wanted)))
    if len(by_kind) == 1 and not any(v != v for v in wanted):
        df = df.where((target >= _literal(min(wanted))) & (target <= _literal(max(wanted))))
    one_of_each = [_literal(some[0]) for some in by_kind.values()]
    common = spark.range(0).select(F.array(*one_of_each)).schema[0].dataType.elementType
    sides = []
    for kind, some in by_kind.items():
        plain = [Decimal(v) for v in some] if kind == "large" else some
        table = pa.table({_WANTED: pa.array(plain, to_arrow_type(_TYPES[kind]))})
        sides.append(spark.createDataFrame(table).select(F.col(_WANTED).cast(common)))
    side = reduce(DataFrame.union, sides)
    size = sum(len(str(v)) + VALUE_OVERHEAD for v in wanted)
    if size <= broadcast_limit(spark):
        side = F.broadcast(side)
    return df.join(side, df[quote(column)] == side[_WANTED], "left_semi").select(*[F.col(quote(c)) for c in df.columns])


_TYPES = {
    "bool": T.BooleanType(),
    "int": T.LongType(),
    "large": T.DecimalType(38, 0),
    "float": T.DoubleType(),
    "str": T.StringType(),
    "date": T.DateType(),
    "datetime": T.TimestampType(),
    "Decimal": T.DecimalType(38, 18),
    "bytes": T.BinaryType(),
}


def _kind(value: object) -> str:
    if isinstance(value, int) and not isinstance(value, bool) and not -(2**63) <= value < 2**63:
        return "large"
    name = type(value).__name__
    if name not in _TYPES:
        raise TypeError(f"no list of {name} values")
    return name


def _literal(value: object) -> Column:
    kind = _kind(value)
    return F.lit(Decimal(value) if kind == "large" else value).cast(_TYPES[kind])
