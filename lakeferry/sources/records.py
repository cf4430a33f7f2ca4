"""Python records as a DataFrame: those of the program, or those that tasks make of a table's rows."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Iterable, Iterator, Mapping
from decimal import Decimal
from functools import reduce

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from lakeferry.functions.fit import FLOAT_BOUNDS
from lakeferry.functions.typed import apply_schema
from lakeferry.functions.types import SchemaLike, build_schema, is_json

# Numbers, each type able to hold the ones before it.
_NUMBERS = (T.IntegerType(), T.LongType(), T.DecimalType(38, 0), T.FloatType(), T.DoubleType())
_MOMENTS = (T.DateType, T.TimestampType, T.TimestampNTZType)


def value_type(value: object, float_type: str = "float") -> T.DataType:
    """The type of one Python value, by the same ladder that ``infer_schema`` uses."""
    if value is None:
        return T.NullType()
    if isinstance(value, bool):
        return T.BooleanType()
    if isinstance(value, int):
        fitting = [t for t, bits in zip(_NUMBERS, (31, 63), strict=False) if -(2**bits) <= value < 2**bits]
        return fitting[0] if fitting else T.DecimalType(38, 0)
    if isinstance(value, float):
        low, high = FLOAT_BOUNDS[T.FloatType]
        single = value == 0 or not low > abs(value) and not high < abs(value) < float("inf")
        return T.FloatType() if single and float_type == "float" else T.DoubleType()
    if isinstance(value, Decimal):
        digits = value.as_tuple()
        scale = max(0, -digits.exponent)
        return T.DecimalType(max(len(digits.digits), scale), scale)
    if isinstance(value, (bytes, bytearray)):
        return T.BinaryType()
    if isinstance(value, dt.datetime):
        return T.TimestampType()
    if isinstance(value, dt.date):
        return T.DateType()
    if isinstance(value, str):
        return T.StringType()
    if isinstance(value, (list, tuple)):
        return T.ArrayType(_common([value_type(v, float_type) for v in value]))
    if isinstance(value, Mapping):
        return _mapping_type(value, float_type)
    raise TypeError(f"no type for a value of {type(value).__name__}")


def _mapping_type(value: Mapping, float_type: str) -> T.DataType:
    """A MAP if all values have one type, otherwise a STRUCT."""
    kinds = {k: value_type(v, float_type) for k, v in value.items()}
    key = _common([value_type(k, float_type) for k in value])
    if len(set(map(repr, kinds.values()))) <= 1 or not all(isinstance(k, str) for k in value):
        return T.MapType(key, _common(list(kinds.values())))
    return T.StructType([T.StructField(k, t) for k, t in kinds.items()])


def _common(types: list[T.DataType]) -> T.DataType:
    return reduce(widen, types, T.NullType())


def widen(a: T.DataType, b: T.DataType) -> T.DataType:
    """The narrowest type for values of both types; STRING if they do not go together."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    if a in _NUMBERS and b in _NUMBERS:
        return max(a, b, key=_NUMBERS.index)
    if isinstance(a, T.DateType) and isinstance(b, T.TimestampType):
        return b
    if isinstance(a, T.TimestampType) and isinstance(b, T.DateType):
        return a
    if isinstance(a, T.ArrayType) and isinstance(b, T.ArrayType):
        return T.ArrayType(widen(a.elementType, b.elementType))
    if isinstance(a, T.MapType) and isinstance(b, T.MapType):
        return T.MapType(widen(a.keyType, b.keyType), widen(a.valueType, b.valueType))
    if isinstance(a, T.StructType) and isinstance(b, T.StructType):
        names = list(dict.fromkeys([*a.names, *b.names]))
        return T.StructType([T.StructField(n, widen(_member(a, n), _member(b, n))) for n in names])
    return T.StringType()


def _member(struct: T.StructType, name: str) -> T.DataType:
    return struct[name].dataType if name in struct.names else T.NullType()


def from_records(
    spark: SparkSession,
    records: Iterable[Mapping[str, object]],
    schema: SchemaLike | None = None,
    *,
    float_type: str = "float",
) -> DataFrame:
    """Records as a DataFrame: keys outside the schema are dropped, missing ones become NULL.

    Without a schema the types of all records are widened to common ones.
    """
    records = list(records)
    schema = build_schema(schema)
    if schema is None:
        kinds: dict[str, T.DataType] = {}
        for record in records:
            for name, value in record.items():
                kinds[name] = widen(kinds.get(name, T.NullType()), value_type(value, float_type))
        schema = T.StructType([T.StructField(n, t) for n, t in kinds.items()])
    columns = {f.name: _values(f, [r.get(f.name) for r in records]) for f in schema.fields}
    given = T.StructType([T.StructField(f.name, columns[f.name][0]) for f in schema.fields])
    rows = list(zip(*(values for _, values in columns.values()), strict=True))
    return apply_schema(spark.createDataFrame(rows, given), schema, json_as="string")


def records_of(
    df: DataFrame,
    make: Callable[[dict[str, object]], Mapping[str, object] | None],
    schema: SchemaLike | None = None,
    *,
    float_type: str = "float",
) -> DataFrame:
    """The records that ``make`` makes of the rows, as typed columns; None makes no record.

    ``make`` runs in tasks, on one row as a dictionary, and its records become typed Arrow batches
    there.  Without a schema a first pass over all rows widens their types to common ones: a task
    sends each schema it met once, and only different schemas reach the driver.
    """
    schema = build_schema(schema)
    if schema is None:
        schema = _settled(df, make, float_type)
    kinds = [_carried(f) for f in schema.fields]
    arrow = [to_arrow_type(kind) for kind in kinds]
    names = schema.names

    def typed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            records = [r for r in map(make, batch.to_pylist()) if r is not None]
            columns = [
                pa.array([_carry(field, kind, r.get(field.name)) for r in records], target)
                for field, kind, target in zip(schema.fields, kinds, arrow, strict=True)
            ]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    carried = T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)])
    return apply_schema(df.mapInArrow(typed, carried), schema, json_as="string")


def _settled(df: DataFrame, make, float_type: str) -> T.StructType:
    """The common type of every name that any record has."""

    def met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, T.StructType] = {}
        for batch in batches:
            for record in map(make, batch.to_pylist()):
                if record is not None:
                    fields = [T.StructField(n, value_type(v, float_type)) for n, v in record.items()]
                    seen.setdefault(T.StructType(fields).json(), None)
        yield pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string())], names=["kind"])

    kinds: dict[str, T.DataType] = {}
    for row in df.mapInArrow(met, "kind string").distinct().orderBy("kind").toLocalIterator():
        for field in T.StructType.fromJson(json.loads(row["kind"])).fields:
            kinds[field.name] = widen(kinds.get(field.name, T.NullType()), field.dataType)
    return T.StructType([T.StructField(n, t) for n, t in sorted(kinds.items())])


def _carried(field: T.StructField) -> T.DataType:
    """The type in which a column leaves a task: dates and times as text, whatever records hold."""
    if isinstance(field.dataType, _MOMENTS) or is_json(field):
        return T.StringType()
    return field.dataType


def _carry(field: T.StructField, kind: T.DataType, value: object) -> object:
    if value is None:
        return None
    if is_json(field):
        return json.dumps(value)
    return _plain(kind, value)


def _plain(kind: T.DataType, value: object) -> object:
    """A value in the form that Arrow takes for a type."""
    if value is None:
        return None
    if isinstance(kind, T.StringType):
        return value if isinstance(value, str) else str(value)
    if isinstance(kind, T.BinaryType):
        return value.encode() if isinstance(value, str) else value
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return float(value)
    if isinstance(kind, T.DecimalType):
        return Decimal(str(value))
    if isinstance(kind, T.ArrayType):
        return [_plain(kind.elementType, v) for v in value]
    if isinstance(kind, T.MapType):
        return [(_plain(kind.keyType, k), _plain(kind.valueType, v)) for k, v in value.items()]
    if isinstance(kind, T.StructType):
        return {f.name: _plain(f.dataType, value.get(f.name)) for f in kind.fields}
    return value


def _values(field: T.StructField, values: list) -> tuple[T.DataType, list]:
    """A column's values in a form that Spark takes, and the type of that form."""
    if is_json(field):
        return T.StringType(), [None if v is None else json.dumps(v) for v in values]
    if isinstance(field.dataType, T.BinaryType):
        return field.dataType, [v.encode() if isinstance(v, str) else v for v in values]
    if isinstance(field.dataType, T.StringType):
        return field.dataType, [v if v is None or isinstance(v, str) else str(v) for v in values]
    if isinstance(field.dataType, _MOMENTS) and any(isinstance(v, str) for v in values):
        return T.StringType(), [None if v is None else str(v) for v in values]
    if isinstance(field.dataType, (T.FloatType, T.DoubleType)):
        return field.dataType, [None if v is None else float(v) for v in values]
    if isinstance(field.dataType, T.DecimalType):
        return field.dataType, [None if v is None else Decimal(str(v)) for v in values]
    return field.dataType, values
