"""Columns to SQL-literal text and back.

Rendering follows the SQL literal of each type (``1Y``, ``1L``, ``DATE'2014-01-01'``, ``X'61'``,
``ARRAY(1, 2)``).  Parsing is led by the known type: a literal of a given type is matched by one
pattern, and a nested literal is cut into the literals of its parts by the patterns of the parts.
"""

from __future__ import annotations

import json
import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.functions.types import INTERVALS

# Type suffixes of numeric literals.
SUFFIX = {
    T.ByteType: "Y",
    T.ShortType: "S",
    T.IntegerType: "",
    T.LongType: "L",
    T.DecimalType: "BD",
    T.FloatType: "F",
    T.DoubleType: "D",
}
NULL_TEXT = "NULL"

_NESTED = (T.ArrayType, T.MapType, T.StructType)


# ---------------------------------------------------------------- rendering


def render_literal(value: Column, dtype: T.DataType) -> Column:
    """The SQL literal of each value; NULL renders as the text ``NULL``."""
    return F.when(value.isNull(), F.lit(NULL_TEXT)).otherwise(_render(value, dtype))


def _render(v: Column, dtype: T.DataType) -> Column:
    text = v.cast("string") if not isinstance(dtype, (*_NESTED, T.VariantType)) else None
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        kind = "float" if isinstance(dtype, T.FloatType) else "double"
        return (
            F.when(F.isnan(v), F.lit(f"{kind}('NaN')"))
            .when(v == float("inf"), F.lit(f"{kind}('inf')"))
            .when(v == -float("inf"), F.lit(f"{kind}('-inf')"))
            .otherwise(F.concat(text, F.lit(SUFFIX[type(dtype)])))
        )
    if type(dtype) in SUFFIX:
        return F.concat(text, F.lit(SUFFIX[type(dtype)]))
    if isinstance(dtype, T.BooleanType):
        return text
    if isinstance(dtype, T.DateType):
        return F.concat(F.lit("DATE'"), text, F.lit("'"))
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        # the text form drops trailing zeros of the fraction, the literal shows six digits or none
        dot = F.instr(text, ".")
        whole = F.when(dot > 0, F.rpad(text, 26, "0")).otherwise(text)
        stamp = F.replace(whole, F.lit(" "), F.lit("T"))
        word = "TIMESTAMP_NTZ'" if isinstance(dtype, T.TimestampNTZType) else "TIMESTAMP'"
        return F.concat(F.lit(word), stamp, F.lit("'"))
    if isinstance(dtype, T.BinaryType):
        return F.concat(F.lit("X'"), F.hex(v), F.lit("'"))
    if isinstance(dtype, T.StringType):
        return quote_text(v)
    if isinstance(dtype, T.VariantType):
        return F.concat(F.lit("PARSE_JSON("), quote_text(F.to_json(v)), F.lit(")"))
    if isinstance(dtype, INTERVALS):
        return text
    if isinstance(dtype, T.NullType):
        return F.lit(NULL_TEXT)
    if isinstance(dtype, T.ArrayType):
        items = F.transform(v, lambda x: render_literal(x, dtype.elementType))
        return F.concat(F.lit("ARRAY("), F.array_join(items, ", "), F.lit(")"))
    if isinstance(dtype, T.MapType):
        pairs = F.transform(
            F.map_entries(v),
            lambda e: F.concat_ws(
                ", ",
                render_literal(e["key"], dtype.keyType),
                render_literal(e["value"], dtype.valueType),
            ),
        )
        return F.concat(F.lit("MAP("), F.array_join(pairs, ", "), F.lit(")"))
    if isinstance(dtype, T.StructType):
        parts = []
        for field in dtype.fields:
            parts += [quote_text(F.lit(field.name)), render_literal(v[field.name], field.dataType)]
        return F.concat(F.lit("named_struct("), F.concat_ws(",", *parts), F.lit(")"))
    raise TypeError(f"no literal form for {dtype.simpleString()}")


def quote_text(v: Column) -> Column:
    """A JSON string literal in plain ASCII, which SQL reads as the same text."""
    escaped = F.replace(F.replace(v, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"'))
    needs_codes = escaped.rlike("[^ -~]")
    body = F.when(needs_codes, _escape_units(escaped)).otherwise(escaped)
    return F.concat(F.lit('"'), body, F.lit('"'))


def _escape_units(v: Column) -> Column:
    """Every UTF-16 unit outside printable ASCII as an escape sequence."""
    units = F.regexp_extract_all(F.hex(F.encode(v, "UTF-16BE")), F.lit("(.{4})"), F.lit(1))
    # The short escape sequences of JSON.
    short = {"0008": "\\b", "0009": "\\t", "000A": "\\n", "000C": "\\f", "000D": "\\r"}

    def one(unit: Column) -> Column:
        shown = reduce(
            lambda done, pair: done.when(unit == pair[0], F.lit(pair[1])),
            short.items(),
            F.when(unit.between("0020", "007E"), F.decode(F.unhex(unit), "UTF-16BE")),
        )
        return shown.otherwise(F.concat(F.lit("\\u"), F.lower(unit)))

    return F.array_join(F.transform(units, one), "")


# ---------------------------------------------------------------- parsing


def parse_literal(text: Column, dtype: T.DataType) -> Column:
    """The value a SQL literal of type ``dtype`` stands for.

    The text ``NULL`` and text that is not such a literal give NULL; a plain number, date or
    timestamp without its literal marks is read as well.
    """
    if isinstance(dtype, T.StringType):
        return _or_none(text, dtype)
    trimmed = F.trim(text)
    if not isinstance(dtype, _NESTED):
        return _or_none(trimmed, dtype)
    whole = "^" + literal_pattern(dtype) + "$"
    return _let(trimmed, lambda t: F.when(t.rlike(whole), _nested(t, dtype)))


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value computed once, however often ``use`` mentions it."""
    return F.transform(F.array(value), lambda x: use(x))[0]


def _or_none(text: Column, dtype: T.DataType) -> Column:
    return F.when(text != NULL_TEXT, _value(text, dtype))


def _value(text: Column, dtype: T.DataType) -> Column:
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        kind = "float" if isinstance(dtype, T.FloatType) else "double"
        special = F.regexp_extract(text, rf"^{kind}\('([^']*)'\)$", 1)
        number = F.regexp_replace(text, f"(?<=[0-9.]){SUFFIX[type(dtype)]}$", "")
        return F.when(special != "", special).otherwise(number).try_cast(dtype)
    if type(dtype) in SUFFIX:
        suffix = SUFFIX[type(dtype)]
        return F.regexp_replace(text, f"(?<=[0-9.]){suffix}$", "").try_cast(dtype)
    if isinstance(dtype, T.BooleanType):
        return F.when(F.lower(text).isin("true", "false"), text.try_cast("boolean"))
    if isinstance(dtype, T.DateType):
        return F.regexp_replace(text, r"^DATE'([^']*)'$", "$1").try_cast("date")
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return F.regexp_replace(text, r"^TIMESTAMP(?:_NTZ)?'([^']*)'$", "$1").try_cast(dtype)
    if isinstance(dtype, T.BinaryType):
        return F.when(text.rlike("^X'[0-9A-Fa-f]*'$"), F.unhex(F.regexp_extract(text, "'(.*)'", 1)))
    if isinstance(dtype, T.StringType):
        quoted = text.rlike('(?s)^"' + _TEXT_BODY + '"$')
        return F.when(quoted, unquote_text(text)).otherwise(text)
    if isinstance(dtype, T.VariantType):
        inner = F.regexp_extract(text, r"(?s)^PARSE_JSON\((.*)\)$", 1)
        return F.try_parse_json(F.when(inner != "", unquote_text(inner)).otherwise(text))
    if isinstance(dtype, INTERVALS):
        return text.try_cast(dtype)
    if isinstance(dtype, T.NullType):
        return F.lit(None)
    return F.when(text != NULL_TEXT, _nested(text, dtype))


def _nested(text: Column, dtype: T.DataType) -> Column:
    """``text`` is known to match the pattern of ``dtype``, and so do its parts theirs."""
    body = F.regexp_extract(text, r"(?s)^\w+\((.*)\)$", 1)
    if isinstance(dtype, T.ArrayType):
        item = f"({_or_null(dtype.elementType)})"
        return _values(_matches(body, item, 1), dtype.elementType).cast(dtype)
    if isinstance(dtype, T.MapType):
        pair = f"({literal_pattern(dtype.keyType)}),\\s*+({_or_null(dtype.valueType)})"
        return F.map_from_arrays(
            _values(_matches(body, pair, 1), dtype.keyType),
            _values(_matches(body, pair, 2), dtype.valueType),
        )
    names = "|".join(_name_pattern(f.name) for f in dtype.fields)
    either = "|".join(dict.fromkeys(literal_pattern(f.dataType) for f in dtype.fields))
    pair = f'(?:{names}),\\s*+({either}|{NULL_TEXT})'
    return _let(
        _matches(body, pair, 1),
        lambda parts: F.struct(
            *[_or_none(parts[i], f.dataType).alias(f.name) for i, f in enumerate(dtype.fields)]
        ),
    )


def _matches(text: Column, pattern: str, group: int) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def _values(texts: Column, dtype: T.DataType) -> Column:
    return F.transform(texts, lambda x: _or_none(x, dtype))


def unquote_text(v: Column) -> Column:
    return F.get_json_object(F.concat(F.lit("["), v, F.lit("]")), "$[0]")


# Possessive repeats keep the matcher iterative, so long text cannot overflow its stack.
_TEXT_BODY = r'[^"\\]*+(?:\\.[^"\\]*+)*+'
_NUMBER = r"[+-]?+[0-9.]++(?:[eE][+-]?+[0-9]++)?+"


def _or_null(dtype: T.DataType) -> str:
    return f"(?:{literal_pattern(dtype)}|{NULL_TEXT})"


def literal_pattern(dtype: T.DataType) -> str:
    """A regular expression, without capture groups, for the literals of a type."""
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        kind = "float" if isinstance(dtype, T.FloatType) else "double"
        return rf"(?:{kind}\('[^']*+'\)|{_NUMBER}{SUFFIX[type(dtype)]}?+)"
    if type(dtype) in SUFFIX:
        suffix = SUFFIX[type(dtype)]
        return f"{_NUMBER}(?:{suffix})?+" if suffix else _NUMBER
    if isinstance(dtype, T.BooleanType):
        return "(?:true|false)"
    if isinstance(dtype, T.DateType):
        return "DATE'[^']*+'"
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        return "TIMESTAMP(?:_NTZ)?+'[^']*+'"
    if isinstance(dtype, T.BinaryType):
        return "X'[0-9A-Fa-f]*+'"
    if isinstance(dtype, T.StringType):
        return f'"{_TEXT_BODY}"'
    if isinstance(dtype, T.VariantType):
        return rf'PARSE_JSON\("{_TEXT_BODY}"\)'
    if isinstance(dtype, INTERVALS):
        return r"INTERVAL '[^']*+'(?: [A-Z]++)++"
    if isinstance(dtype, T.NullType):
        return NULL_TEXT
    if isinstance(dtype, T.ArrayType):
        return rf"ARRAY\((?:{_or_null(dtype.elementType)}(?:,\s*+)?+)*+\)"
    if isinstance(dtype, T.MapType):
        pair = rf"{literal_pattern(dtype.keyType)},\s*+{_or_null(dtype.valueType)}"
        return rf"MAP\((?:{pair}(?:,\s*+)?+)*+\)"
    if isinstance(dtype, T.StructType):
        return _struct_pattern(dtype)
    raise TypeError(f"no literal form for {dtype.simpleString()}")


def _name_pattern(name: str) -> str:
    """A field name as `quote_text` writes it, or as it is."""
    shown = json.dumps(name).replace("\x7f", "\\u007f")
    return f"(?:{re.escape(shown)}|{re.escape(chr(34) + name + chr(34))})"


def _struct_pattern(dtype: T.StructType) -> str:
    parts = [rf"{_name_pattern(f.name)},\s*+{_or_null(f.dataType)}" for f in dtype.fields]
    return r"named_struct\(" + r",\s*+".join(parts) + r"\)"
