"""Read columns as the types of a schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.functions.fit import as_timestamp, json_document
from lakeferry.functions.types import is_json, missing_from, quote, sql_type


def apply_schema(
    df: DataFrame,
    schema: T.StructType,
    *,
    on_error: str = "raise",
    json_as: str = "variant",
    timestamp_formats: tuple[str, ...] = (),
) -> DataFrame:
    """Every column of ``df`` read as its type in ``schema``.

    Columns absent from ``df`` stay absent; a column that ``schema`` does not know is an error
    before any job runs.  A value that cannot be read fails the query, or becomes NULL with
    ``on_error="null"``.  JSON columns become VARIANT, or stay text with ``json_as="string"``.
    """
    if on_error not in ("raise", "null"):
        raise ValueError(f"on_error is 'raise' or 'null', got {on_error!r}")
    unknown = missing_from(df, df.columns, schema.names)
    if unknown:
        raise ValueError(f"columns {unknown} are not in the schema {schema.names}")
    by_name = {f.name.lower(): f for f in schema.fields}
    out = []
    for source in df.schema.fields:
        target = by_name[source.name.lower()]
        col = F.col(quote(source.name))
        as_json = is_json(target) and json_as == "variant"
        out.append(
            _read(col, source.dataType, target, as_json, on_error, timestamp_formats).alias(
                source.name
            )
        )
    return df.select(*out)


def _read(
    col: Column,
    source: T.DataType,
    target: T.StructField,
    as_json: bool,
    on_error: str,
    formats: tuple[str, ...],
) -> Column:
    dtype = target.dataType
    if as_json:
        value = json_document(col)
        dtype, kind = T.VariantType(), "JSON"
        return value if on_error == "null" else _or_fail(col, value, target.name, kind, dtype)
    if source == dtype:
        return col
    if isinstance(source, T.StringType) and isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
        value = as_timestamp(col, formats, dtype.simpleString())
    elif isinstance(dtype, (T.MapType, T.StructType, T.ArrayType)) and isinstance(
        source, T.StringType
    ):
        value = F.from_json(col, dtype, {"mode": "PERMISSIVE"})
    else:
        value = col.try_cast(dtype)
    if on_error == "null":
        return value
    return _or_fail(col, value, target.name, sql_type(dtype), dtype)


def _or_fail(col: Column, value: Column, name: str, kind: str, dtype: T.DataType) -> Column:
    message = F.concat(F.lit(f"column {name}: not a {kind}: "), col.cast("string"))
    unread = col.isNotNull() & value.isNull()
    return F.when(unread, F.raise_error(message).cast(dtype)).otherwise(value)
