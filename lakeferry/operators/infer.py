"""Infer a schema from a whole dataset: facts in one aggregate, the type ladder on the one row.

The ladder: BOOLEAN; INT, then BIGINT, then DECIMAL(38,0); FLOAT, then DOUBLE; DATE; TIMESTAMP;
STRING.  A column without any value is VOID.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.functions.fit import (
    DATE_PATTERN,
    FLOAT_BOUNDS,
    INTEGER_PATTERN,
    as_number,
    as_timestamp,
    in_float_range,
    json_document,
)
from lakeferry.functions.types import quote, sql_type
from lakeferry.plans.workspace import Workspace, stage

_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_INT_MIN, _INT_MAX = -(2**31), 2**31 - 1
_LONG_MIN, _LONG_MAX = -(2**63), 2**63 - 1
WIDE_INTEGER = T.DecimalType(38, 0)
# What a text value can spell.
_KINDS = ("whole", "float", "double", "bool", "date", "stamp", "other")


def infer_schema(
    df: DataFrame,
    *,
    parse_text: bool = False,
    float_type: str = "float",
    timestamp_formats: tuple[str, ...] = (),
) -> T.StructType:
    """The narrowest schema that holds every row.

    Typed columns are narrowed along the ladder (a BIGINT column whose values fit INT is INT).
    With ``parse_text`` text columns are typed by what all their values spell.
    ``float_type="double"`` keeps floating columns at DOUBLE.
    """
    if float_type not in ("float", "double"):
        raise ValueError(f"float_type is 'float' or 'double', got {float_type!r}")
    facts = _Facts(parse_text, float_type, timestamp_formats)
    plans = [(f, facts.plan(F.col(quote(f.name)), f.dataType, False)) for f in df.schema.fields]
    if not plans:
        return T.StructType([])
    row = df.select("*", *facts.prepared).agg(*facts.aggregates).first()
    return T.StructType([T.StructField(f.name, plan(row), True, f.metadata) for f, plan in plans])


def schema_rows(df: DataFrame, schema: T.StructType) -> DataFrame:
    """A schema as a DataFrame ``(name, type)`` with SQL type names."""
    rows = [(f.name, sql_type(f.dataType)) for f in schema.fields]
    return df.sparkSession.createDataFrame(rows, "name string, type string")


@dataclass
class _Facts:
    """Collects the aggregates a schema needs; each ``plan`` reads its own off the result row."""

    parse_text: bool
    float_type: str
    formats: tuple[str, ...]
    aggregates: list[Column] = field(default_factory=list)
    prepared: list[Column] = field(default_factory=list)

    def _once(self, value: Column) -> Column:
        """A column of its own for a value that several expressions use."""
        name = f"__lakeferry_{len(self.prepared)}"
        self.prepared.append(value.alias(name))
        return F.col(name)

    def _ask(self, aggregate: Column) -> str:
        name = f"f{len(self.aggregates)}"
        self.aggregates.append(aggregate.alias(name))
        return name

    def plan(self, v: Column, dtype: T.DataType, nested: bool):
        """``v`` is the value, or with ``nested`` an array of the values of one row."""
        if isinstance(dtype, _WHOLE):
            low, high = self._range(v, nested)
            return lambda r: _whole_type(r[low], r[high])
        if isinstance(dtype, (T.FloatType, T.DoubleType)):
            return self._floating(v, nested)
        if isinstance(dtype, T.StringType) and self.parse_text and not nested:
            return self._text(v)
        if isinstance(dtype, T.ArrayType):
            return self._array(v, dtype, nested)
        if isinstance(dtype, T.MapType):
            return self._map(v, dtype, nested)
        if isinstance(dtype, T.StructType):
            return self._struct(v, dtype, nested)
        some = self._ask(_count(_some(v, _is_there) if nested else _is_there(v)))
        if isinstance(dtype, T.TimestampNTZType):
            dtype = T.TimestampType()
        return lambda r: dtype if r[some] else T.NullType()

    def _range(self, v: Column, nested: bool) -> tuple[str, str]:
        low = F.array_min(v) if nested else v
        high = F.array_max(v) if nested else v
        return self._ask(F.min(low)), self._ask(F.max(high))

    def _floating(self, v: Column, nested: bool):
        low, high = FLOAT_BOUNDS[T.FloatType]

        def outside(x: Column) -> Column:
            return x.isNotNull() & ~in_float_range(x.cast("double"), low, high)

        some = self._ask(_count(_some(v, _is_there) if nested else _is_there(v)))
        wide = self._ask(_count(_some(v, outside) if nested else outside(v)))
        as_double = self.float_type == "double"

        def choose(r):
            if not r[some]:
                return T.NullType()
            return T.DoubleType() if as_double or r[wide] else T.FloatType()

        return choose

    def _text(self, v: Column):
        """Every value has one kind, the first that its text spells; the kinds decide the type."""
        number = self._once(as_number(v))
        whole = self._once(F.when(v.rlike(INTEGER_PATTERN), v.try_cast(WIDE_INTEGER)))
        bits = {name: 1 << i for i, name in enumerate(_KINDS)}
        kind = (
            F.when(v.isNull(), 0)
            .when(whole.isNotNull(), bits["whole"])
            .when(in_float_range(number, *FLOAT_BOUNDS[T.FloatType]), bits["float"])
            .when(number.isNotNull(), bits["double"])
            .when(F.lower(v).isin("true", "false"), bits["bool"])
            .when(v.rlike(DATE_PATTERN) & v.try_cast("date").isNotNull(), bits["date"])
            .when(as_timestamp(v, self.formats).isNotNull(), bits["stamp"])
            .otherwise(bits["other"])
        )
        kinds = self._ask(F.bit_or(kind))
        low, high = self._ask(F.min(whole)), self._ask(F.max(whole))

        def choose(r):
            found = {name for name, bit in bits.items() if (r[kinds] or 0) & bit}
            if not found:
                return T.NullType()
            if found == {"whole"}:
                return _whole_type(r[low], r[high])
            if found <= {"whole", "float", "double"}:
                single = self.float_type == "float" and "double" not in found
                return T.FloatType() if single else T.DoubleType()
            if found <= {"date", "stamp"}:
                return T.TimestampType() if "stamp" in found else T.DateType()
            return T.BooleanType() if found == {"bool"} else T.StringType()

        return choose

    def _array(self, v: Column, dtype: T.ArrayType, nested: bool):
        inner = self.plan(F.flatten(_present(v)) if nested else v, dtype.elementType, True)
        return lambda r: T.ArrayType(inner(r), True)

    def _map(self, v: Column, dtype: T.MapType, nested: bool):
        def part(get):
            return F.flatten(F.transform(_present(v), get)) if nested else get(v)

        key = self.plan(part(F.map_keys), dtype.keyType, True)
        value = self.plan(part(F.map_values), dtype.valueType, True)
        return lambda r: T.MapType(key(r), value(r), True)

    def _struct(self, v: Column, dtype: T.StructType, nested: bool):
        # on an array of structs the field name gives the array of that field
        plans = [(f, self.plan(v[f.name], f.dataType, nested)) for f in dtype.fields]
        return lambda r: T.StructType([T.StructField(f.name, p(r), True) for f, p in plans])


def _whole_type(low, high) -> T.DataType:
    if low is None:
        return T.NullType()
    if _INT_MIN <= low and high <= _INT_MAX:
        return T.IntegerType()
    if _LONG_MIN <= low and high <= _LONG_MAX:
        return T.LongType()
    return WIDE_INTEGER


def _count(flag: Column) -> Column:
    return F.count_if(F.coalesce(flag, F.lit(False)))


def _is_there(v: Column) -> Column:
    return v.isNotNull()


def _some(values: Column, test) -> Column:
    return F.exists(values, lambda x: test(x))


def _present(values: Column) -> Column:
    return F.filter(values, lambda x: x.isNotNull())


def infer_json(
    df: DataFrame, column: str, *, float_type: str = "float", mixed: str = "struct"
) -> T.DataType:
    """The type of the JSON documents in a text column, over all rows.

    Objects whose values share one type are a MAP, other objects a STRUCT, or a VARIANT if
    ``mixed`` says so; the number of keys decides nothing.  Types are merged per key inside the
    aggregation and written as rows (``json_types``); one row of facts about them settles the kind,
    so the driver holds names of keys only if they are the fields of the STRUCT it returns.  Rows
    that are no JSON are passed over; with none left the type is VOID.
    """
    if mixed not in ("struct", "variant"):
        raise ValueError("mixed objects are a struct or a variant")
    spark = df.sparkSession
    with Workspace(spark) as space:
        types, _ = stage(spark, json_types(df, column), space.dir("types"))
        shape = _shape(types, mixed)
    if shape is None:
        return T.VariantType()
    return _narrow_json(df, column, shape, float_type) if _has_numbers(shape) else shape


def _shape(types: DataFrame, mixed: str) -> T.DataType | None:
    """The type of documents with these types by key; None if no type but VARIANT holds them."""
    named, typed = F.col("key").isNotNull(), ~F.col("type").isin("VOID", _EMPTY)
    facts = types.agg(
        F.count_distinct(F.when(named & typed, F.col("type"))).alias("n"),
        F.max(F.when(named & typed, F.col("type"))).alias("value"),
        F.max(F.when(~named & typed, F.col("type"))).alias("other"),
        F.coalesce(F.bool_or(named | (F.col("type") == _EMPTY)), F.lit(False)).alias("objects"),
    ).first()
    if facts["other"] is not None:  # documents that are no objects do not go with objects
        return None if facts["objects"] else _from_variant(facts["other"])
    if not facts["n"]:
        return T.MapType(T.StringType(), T.NullType()) if facts["objects"] else T.NullType()
    if facts["n"] == 1:
        return T.MapType(T.StringType(), _from_variant(facts["value"]))
    if mixed == "variant":
        return None
    fields = types.where(named).agg(F.array_sort(F.collect_list(F.struct("key", "type"))).alias("f")).first()["f"]
    return T.StructType([T.StructField(f["key"], _from_variant(f["type"])) for f in fields])


def _has_numbers(dtype: T.DataType) -> bool:
    """Only numbers may have a narrower type, which their values tell."""
    if isinstance(dtype, T.ArrayType):
        return _has_numbers(dtype.elementType)
    if isinstance(dtype, T.MapType):
        return _has_numbers(dtype.valueType)
    if isinstance(dtype, T.StructType):
        return any(_has_numbers(f.dataType) for f in dtype.fields)
    return isinstance(dtype, T.NumericType)


def json_types(df: DataFrame, column: str) -> DataFrame:
    """``(key, type)``: the merged type of each key of the JSON objects in a text column."""
    document = json_document(F.col(quote(column)))
    return _types_by_key(df.select(document.alias("v")).where("v IS NOT NULL"))


def _types_by_key(documents: DataFrame) -> DataFrame:
    """``(key, type)``: the merged type per object key.

    Documents without a key, which are empty objects and other values, have the key NULL.
    """
    entries = F.map_entries(F.try_variant_get("v", "$", "map<string, variant>"))
    itself = F.array(F.struct(F.lit(None).cast("string").alias("key"), F.col("v").alias("value")))
    each = documents.select(F.explode(F.when(F.size(entries) > 0, entries).otherwise(itself)).alias("e"))
    merged = F.regexp_replace(F.schema_of_variant_agg("e.value"), _FRACTION, "DOUBLE")
    return each.groupBy(F.col("e.key").alias("key")).agg(merged.alias("type"))


# The variant type of an object without keys.
_EMPTY = "OBJECT<>"
# A JSON number with a fraction is a floating number on the ladder, whatever its digits.
_FRACTION = r"DECIMAL\(\d+,\s*[1-9]\d*\)"


def _from_variant(text: str) -> T.DataType:
    """The SQL type for a variant's type text: an OBJECT is a STRUCT."""
    return T.DataType.fromDDL(re.sub(_FRACTION, "DOUBLE", text).replace("OBJECT<", "STRUCT<"))


def _narrow_json(df: DataFrame, column: str, dtype: T.DataType, float_type: str) -> T.DataType:
    parsed = json_document(F.col(quote(column)))
    typed = df.select(F.try_variant_get(parsed, "$", sql_type(dtype)).alias("v"))
    return infer_schema(typed, float_type=float_type)["v"].dataType
