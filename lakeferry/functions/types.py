"""Table schemas: one builder for the accepted forms, SQL type names and name-based alignment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A JSON column is stored as text; its field metadata tells it from an ordinary STRING.
JSON_META = {"json": True}

# SQL names of the plain types.
SQL_NAMES = {
    T.ByteType: "TINYINT",
    T.ShortType: "SMALLINT",
    T.IntegerType: "INT",
    T.LongType: "BIGINT",
    T.FloatType: "FLOAT",
    T.DoubleType: "DOUBLE",
    T.DateType: "DATE",
    T.TimestampType: "TIMESTAMP",
    T.TimestampNTZType: "TIMESTAMP_NTZ",
    T.BinaryType: "BINARY",
    T.BooleanType: "BOOLEAN",
    T.StringType: "STRING",
    T.NullType: "VOID",
    T.VariantType: "VARIANT",
}

INTERVALS = (T.DayTimeIntervalType, T.YearMonthIntervalType, T.CalendarIntervalType)

SchemaLike = T.StructType | str | Mapping[str, object] | Sequence[Mapping[str, object]]


def quote(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def is_json(field: T.StructField) -> bool:
    return isinstance(field.dataType, T.StringType) and bool((field.metadata or {}).get("json"))


def _field(name: object, dtype: object) -> T.StructField:
    if not isinstance(name, str) or not name:
        raise ValueError(f"a column needs a name, got {name!r}")
    if isinstance(dtype, T.DataType):
        return T.StructField(name, dtype)
    if not isinstance(dtype, str):
        raise ValueError(f"column {name!r} needs a type, got {dtype!r}")
    if dtype.strip().upper() == "JSON":
        return T.StructField(name, T.StringType(), metadata=dict(JSON_META))
    return T.StructField(name, T.DataType.fromDDL(dtype))


def build_schema(obj: SchemaLike | None) -> T.StructType | None:
    """A schema from a StructType, DDL text, ``{name: type}`` or ``[{"name":…, "type":…}]``.

    Types are Spark types or their SQL names; ``JSON`` names text holding JSON documents.
    """
    if obj is None or isinstance(obj, T.StructType):
        schema = obj
    elif isinstance(obj, str):
        schema = T.StructType.fromDDL(obj)
    elif isinstance(obj, Mapping):
        schema = T.StructType([_field(k, v) for k, v in obj.items()])
    elif isinstance(obj, Sequence):
        for column in obj:
            if not isinstance(column, Mapping) or set(column) != {"name", "type"}:
                raise ValueError(f"a column needs exactly a name and a type, got {column!r}")
        schema = T.StructType([_field(c["name"], c["type"]) for c in obj])
    else:
        raise TypeError(f"cannot build a schema from {type(obj).__name__}")
    if schema is not None:
        seen: set[str] = set()
        for name in schema.names:
            if name.lower() in seen:
                raise ValueError(f"column {name!r} appears twice")
            seen.add(name.lower())
    return schema


def sql_type(dtype: T.DataType) -> str:
    """The SQL name of a type, as used in DDL."""
    if isinstance(dtype, T.DecimalType):
        return f"DECIMAL({dtype.precision},{dtype.scale})"
    if isinstance(dtype, T.ArrayType):
        return f"ARRAY<{sql_type(dtype.elementType)}>"
    if isinstance(dtype, T.MapType):
        return f"MAP<{sql_type(dtype.keyType)}, {sql_type(dtype.valueType)}>"
    if isinstance(dtype, T.StructType):
        inner = ", ".join(f"{_plain(f.name)} {sql_type(f.dataType)}" for f in dtype.fields)
        return f"STRUCT<{inner}>"
    return SQL_NAMES.get(type(dtype)) or dtype.simpleString().upper()


def _plain(name: str) -> str:
    return name if name.replace("_", "a").isalnum() and not name[0].isdigit() else quote(name)


def schema_ddl(schema: T.StructType) -> str:
    """```a` INT, `b` STRING``: column names always quoted."""
    return ", ".join(f"{quote(f.name)} {sql_type(f.dataType)}" for f in schema.fields)


def _resolver(df: DataFrame):
    sensitive = df.sparkSession.conf.get("spark.sql.caseSensitive", "false") == "true"
    return (lambda name: name) if sensitive else str.lower


def missing_from(df: DataFrame, names: Sequence[str], other: Sequence[str]) -> list[str]:
    """The ``names`` that are not among ``other``, under the session's case rule."""
    key = _resolver(df)
    have = {key(n) for n in other}
    return [n for n in names if key(n) not in have]


def align(df: DataFrame, schema: T.StructType) -> DataFrame:
    """``df`` with exactly the columns of ``schema``, by name and in its order.

    Columns that ``df`` lacks become typed NULLs, columns that ``schema`` lacks are dropped.
    """
    key = _resolver(df)
    have = {key(n): n for n in df.columns}
    return df.select(
        *[
            (
                F.col(quote(have[key(f.name)]))
                if key(f.name) in have
                else F.lit(None).cast(f.dataType)
            ).alias(f.name)
            for f in schema.fields
        ]
    )


_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
_DIGITS = {T.ByteType: 3, T.ShortType: 5, T.IntegerType: 10, T.LongType: 19}


def holds(have: T.DataType, new: T.DataType) -> bool:
    """Can a column of type ``have`` take values of type ``new`` without losing any?

    Whole numbers go into DOUBLE, as they do when text with fractions is read at once.
    """
    if have == new or isinstance(new, T.NullType):
        return True
    if isinstance(have, T.StructType) and isinstance(new, T.StructType):
        fields = {f.name.lower(): f.dataType for f in have.fields}
        return all(f.name.lower() in fields and holds(fields[f.name.lower()], f.dataType) for f in new.fields)
    if isinstance(have, T.ArrayType) and isinstance(new, T.ArrayType):
        return holds(have.elementType, new.elementType)
    if isinstance(have, T.MapType) and isinstance(new, T.MapType):
        return holds(have.keyType, new.keyType) and holds(have.valueType, new.valueType)
    if isinstance(have, (T.VariantType, *([T.StringType] if isinstance(new, T.AtomicType) else []))):
        return True
    if isinstance(new, _WHOLE):
        if isinstance(have, _WHOLE):
            return _DIGITS[type(have)] >= _DIGITS[type(new)]
        if isinstance(have, T.DecimalType):
            return have.precision - have.scale >= _DIGITS[type(new)]
        return isinstance(have, T.DoubleType)
    if isinstance(new, T.DecimalType):
        if isinstance(have, T.DecimalType):
            return have.scale >= new.scale and have.precision - have.scale >= new.precision - new.scale
        return isinstance(have, T.DoubleType)
    if isinstance(new, T.FloatType):
        return isinstance(have, T.DoubleType)
    if isinstance(new, T.DateType):
        return isinstance(have, (T.TimestampType, T.TimestampNTZType))
    return False


def refuse_narrowing(have: T.StructType, new: T.StructType, name: str) -> None:
    """An error if a column of ``new`` has values that the same column of ``have`` cannot hold."""
    types = {f.name.lower(): f.dataType for f in have.fields}
    wrong = [
        f"{f.name}: {sql_type(f.dataType)} into {sql_type(types[f.name.lower()])}"
        for f in new.fields
        if f.name.lower() in types and not holds(types[f.name.lower()], f.dataType)
    ]
    if wrong:
        raise ValueError(f"{name} cannot hold these columns: {wrong}")


def reject_void(schema: T.StructType) -> None:
    """Files cannot store a column without a type; say so before a job starts."""
    untyped = [f.name for f in schema.fields if isinstance(f.dataType, T.NullType)]
    if untyped:
        raise ValueError(f"columns without a type cannot be stored: {untyped}; give a schema")
