"""Does a value conform to a type?  One boolean expression per column, never NULL.

A NULL conforms only to VOID, INTERVAL, JSON and VARIANT, also inside arrays, maps and structs.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.functions.types import INTERVALS, quote

# Bit widths of the integer types.
INT_BITS = {T.ByteType: 8, T.ShortType: 16, T.IntegerType: 32, T.LongType: 64}
# Smallest and largest magnitude of a normal FLOAT and DOUBLE.
FLOAT_BOUNDS = {T.FloatType: (1.175e-37, 3.402e38), T.DoubleType: (2.225e-307, 1.79769e308)}
# Fixed value: a calendar date as text; year 0000 does not exist.
DATE_PATTERN = r"^(?!0000)\d{4}-\d{1,2}-\d{1,2}$"
INTEGER_PATTERN = r"^\s*[+-]?\d+\s*$"
NUMBER_PATTERN = (
    r"(?i)^\s*(?:[+-]?(?:\d+\.?\d*|\.\d+)(?:e[+-]?\d+)?|nan|[+-]?inf(?:inity)?)\s*$"
)

_INTEGERS = tuple(INT_BITS)
_NUMERIC = (*_INTEGERS, T.DecimalType, T.FloatType, T.DoubleType, T.BooleanType)


def _yes() -> Column:
    return F.lit(True)


def _no() -> Column:
    return F.lit(False)


def conforms(
    value: Column,
    source: T.DataType,
    target: T.DataType,
    *,
    json: bool = False,
    parse_text: bool = True,
    timestamp_formats: tuple[str, ...] = (),
) -> Column:
    """True where ``value`` (of type ``source``) is a valid ``target``.

    ``parse_text`` lets text conform to a number or a boolean it spells; without it text conforms
    only to text-like types, dates and timestamps.  ``json`` asks for a JSON document.
    """
    rules = _Rules(parse_text, timestamp_formats)
    return rules.json(value, source) if json else rules.of(value, source, target)


class _Rules:
    def __init__(self, parse_text: bool, timestamp_formats: tuple[str, ...]):
        self.parse_text = parse_text
        self.timestamp_formats = timestamp_formats

    def of(self, v: Column, source: T.DataType, target: T.DataType) -> Column:
        if isinstance(target, (T.VariantType, *INTERVALS)):
            return _yes()
        if isinstance(target, T.NullType):
            return v.isNull()
        return v.isNotNull() & F.coalesce(self._present(v, source, target), _no())

    def _present(self, v: Column, source: T.DataType, target: T.DataType) -> Column:
        if isinstance(target, _INTEGERS):
            return self._integer(v, source, INT_BITS[type(target)])
        if isinstance(target, T.DecimalType):
            return self._decimal(v, source, target)
        if isinstance(target, (T.FloatType, T.DoubleType)):
            return self._floating(v, source, *FLOAT_BOUNDS[type(target)])
        if isinstance(target, T.DateType):
            if isinstance(source, T.StringType):
                return v.rlike(DATE_PATTERN) & v.try_cast("date").isNotNull()
            return F.lit(isinstance(source, T.DateType))
        if isinstance(target, (T.TimestampType, T.TimestampNTZType)):
            if isinstance(source, T.StringType):
                return as_timestamp(v, self.timestamp_formats).isNotNull()
            return F.lit(isinstance(source, (T.DateType, T.TimestampType, T.TimestampNTZType)))
        if isinstance(target, T.BinaryType):
            return F.lit(isinstance(source, (T.StringType, T.BinaryType)))
        if isinstance(target, T.BooleanType):
            if isinstance(source, T.StringType) and self.parse_text:
                return F.lower(v).isin("true", "false")
            return F.lit(isinstance(source, T.BooleanType))
        if isinstance(target, T.StringType):
            return F.lit(isinstance(source, T.StringType))
        if isinstance(target, T.ArrayType):
            return self._array(v, source, target)
        if isinstance(target, T.MapType):
            return self._map(v, source, target)
        if isinstance(target, T.StructType):
            return self._struct(v, source, target)
        raise TypeError(f"no conformance rule for {target.simpleString()}")

    def _integer(self, v: Column, source: T.DataType, bits: int) -> Column:
        if isinstance(source, T.BooleanType):
            return _yes()
        if isinstance(source, _INTEGERS):
            if INT_BITS[type(source)] <= bits:
                return _yes()
            return v.between(-(2 ** (bits - 1)), 2 ** (bits - 1) - 1)
        wide = "decimal(38,0)"
        low, high = (F.lit(str(b)).cast(wide) for b in (-(2 ** (bits - 1)), 2 ** (bits - 1) - 1))
        if isinstance(source, T.DecimalType):
            return (v % F.lit(1) == 0) & v.try_cast(wide).between(low, high)
        if isinstance(source, T.StringType) and self.parse_text:
            return v.rlike(INTEGER_PATTERN) & v.try_cast(wide).between(low, high)
        return _no()

    def _decimal(self, v: Column, source: T.DataType, target: T.DecimalType) -> Column:
        if isinstance(source, _NUMERIC) or (isinstance(source, T.StringType) and self.parse_text):
            if isinstance(source, T.BooleanType):
                v = v.cast("int")
            return v.try_cast(target).isNotNull()
        return _no()

    def _floating(self, v: Column, source: T.DataType, low: float, high: float) -> Column:
        if isinstance(source, T.BooleanType):
            return _yes()
        if isinstance(source, _NUMERIC):
            return in_float_range(v.cast("double"), low, high)
        if isinstance(source, T.StringType) and self.parse_text:
            return in_float_range(as_number(v), low, high)
        return _no()

    def _array(self, v: Column, source: T.DataType, target: T.ArrayType) -> Column:
        if not isinstance(source, T.ArrayType):
            return _no()
        return F.forall(v, lambda x: self.of(x, source.elementType, target.elementType))

    def _map(self, v: Column, source: T.DataType, target: T.MapType) -> Column:
        if isinstance(source, T.MapType):
            return F.forall(
                F.map_entries(v),
                lambda e: self.of(e["key"], source.keyType, target.keyType)
                & self.of(e["value"], source.valueType, target.valueType),
            )
        if isinstance(source, T.StructType) and isinstance(target.keyType, T.StringType):
            return _all(self.of(v[f.name], f.dataType, target.valueType) for f in source.fields)
        return _no()

    def _struct(self, v: Column, source: T.DataType, target: T.StructType) -> Column:
        if isinstance(source, T.StructType):
            if set(source.names) != set(target.names):
                return _no()
            return _all(
                self.of(v[f.name], source[f.name].dataType, f.dataType) for f in target.fields
            )
        if isinstance(source, T.MapType) and isinstance(source.keyType, T.StringType):
            return (F.size(v) == len(target.fields)) & _all(
                F.map_contains_key(v, f.name)
                & self.of(F.try_element_at(v, F.lit(f.name)), source.valueType, f.dataType)
                for f in target.fields
            )
        return _no()

    def json(self, v: Column, source: T.DataType) -> Column:
        """NULL is a JSON document too, so only a present value can fail."""
        if isinstance(source, T.StringType):
            return v.isNull() | json_document(v).isNotNull()
        if isinstance(source, T.ArrayType):
            inner = F.forall(v, lambda x: self.json(x, source.elementType))
            return v.isNull() | F.coalesce(inner, _no())
        if isinstance(source, T.MapType):
            inner = F.forall(F.map_values(v), lambda x: self.json(x, source.valueType))
            return v.isNull() | F.coalesce(inner, _no())
        if isinstance(source, T.StructType):
            fields = (self.json(v[f.name], f.dataType) for f in source.fields)
            return v.isNull() | _all(fields)
        writable = (*_INTEGERS, T.FloatType, T.DoubleType, T.BooleanType, T.NullType, T.VariantType)
        return _yes() if isinstance(source, writable) else v.isNull()


def in_float_range(v: Column, low: float, high: float) -> Column:
    """Zero, NaN, an infinity, or a magnitude between ``low`` and ``high``."""
    size = F.abs(v)
    return (
        (v == 0.0) | F.isnan(v) | (size == float("inf")) | ((size >= low) & (size <= high))
    )


def json_document(v: Column) -> Column:
    """Text that is one JSON document, as a VARIANT; other text is NULL.

    The JSON parser stops after the first document.  In brackets a text that is one document is an
    array of one element, unless it closes the bracket itself; a text with such a bracket also has
    to be an object's only value.
    """
    element = F.try_parse_json(F.concat(F.lit("["), v, F.lit("]")))
    value = F.try_parse_json(F.concat(F.lit('{"v":'), v, F.lit("}")))
    alone = F.when(F.contains(v, F.lit("]")), value.isNotNull()).otherwise(F.lit(True))
    more = F.try_variant_get(element, "$[1]", "variant").isNotNull()
    return F.when(element.isNotNull() & alone & ~more, F.try_variant_get(element, "$[0]", "variant"))


def as_number(v: Column) -> Column:
    """Text read as a DOUBLE: digits, NaN or an infinity, but no literal suffix as in ``1F``."""
    return F.when(v.rlike(NUMBER_PATTERN), v.try_cast("double"))


def as_timestamp(v: Column, formats: tuple[str, ...] = (), target: str = "timestamp") -> Column:
    """The first reading of text as a timestamp: ISO forms, then the given patterns."""
    readings = [v.try_cast(target)]
    readings += [F.try_to_timestamp(v, F.lit(f)).cast(target) for f in formats]
    return F.coalesce(*readings)


def _all(parts) -> Column:
    return reduce(lambda a, b: a & b, parts, _yes())


def fits_column(name: str, source: T.DataType, field: T.StructField, **options) -> Column:
    """``conforms`` for a named column against a schema field."""
    json = bool((field.metadata or {}).get("json"))
    return conforms(F.col(quote(name)), source, field.dataType, json=json, **options)
