"""Files of every supported format as a DataFrame: forced, hinted or merged schema."""

from __future__ import annotations

import uuid
from itertools import groupby, islice

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.functions.typed import apply_schema
from lakeferry.functions.types import SchemaLike, build_schema, quote
from lakeferry.operators.infer import infer_schema
from lakeferry.plans import store
from lakeferry.plans.workspace import Workspace, may_broadcast, shared_root, stage
from lakeferry.sources.tables import FORMATS
from lakeferry.sources.trees import first_lines, list_scanned

# Formats that carry their own column types: a hint is a cast there, not another way to parse.
SELF_DESCRIBING = ("PARQUET", "ORC", "AVRO", "DELTA")
FILES_PER_SCAN = 10_000
_FILE, _PLACES, _VALUES = "__file", "__places", "__values"
# Fixed value: the formats that need a package which a plain Spark does not ship.
NEEDS_PACKAGE = {"AVRO": "spark-avro", "DELTA": "delta-spark"}


def read_files(
    spark: SparkSession,
    path: str | list[str],
    format: str,
    schema: SchemaLike | None = None,
    *,
    force_schema: bool = True,
    pattern: str | bool | None = None,
    recursive: bool = False,
    options: dict[str, object] | None = None,
) -> DataFrame:
    """Scan a file, a directory or a list of files.

    ``schema`` with ``force_schema`` is used as it is and no data is read to infer one; without
    ``force_schema`` its columns are hints that override single columns of the inferred schema.
    Without ``schema`` the schemas of all files are merged.  ``pattern`` is a glob on file names;
    ``True`` stands for ``*.<format>``.
    """
    fmt = known_format(format)
    schema = build_schema(schema)
    wanted: dict[str, object] = dict(options or {})
    if pattern:
        wanted["pathGlobFilter"] = f"*.{fmt.lower()}" if pattern is True else pattern
    if recursive:
        wanted["recursiveFileLookup"] = True
    if schema is not None and force_schema:
        return _reader(spark, fmt, wanted).schema(schema).load(path)
    if schema is not None:
        return _read_hinted(spark, path, fmt, schema, wanted)
    return _read_merged(spark, path, fmt, wanted)


def known_format(format: str) -> str:
    fmt = format.upper()
    if fmt not in FORMATS or fmt == "JDBC":
        raise ValueError(f"{format!r} is not a file format; known: {FORMATS}")
    return fmt


def _reader(spark: SparkSession, fmt: str, options: dict[str, object]):
    if fmt in NEEDS_PACKAGE:
        _require_source(spark, fmt)
    return spark.read.format("binaryFile" if fmt == "BINARYFILE" else fmt.lower()).options(
        **options
    )


def _require_source(spark: SparkSession, fmt: str) -> None:
    try:
        found = spark._jvm.org.apache.spark.sql.execution.datasources.DataSource
        found.lookupDataSource(fmt.lower(), spark._jsparkSession.sessionState().conf())
    except Exception as error:
        raise ValueError(
            f"format {fmt} needs the {NEEDS_PACKAGE[fmt]} package on the cluster"
        ) from error


def _read_hinted(
    spark: SparkSession, path, fmt: str, hints: T.StructType, options: dict[str, object]
) -> DataFrame:
    if fmt == "CSV" and _is_on(options, "header"):
        return _merge_csv(spark, path, options, hints)
    if fmt in SELF_DESCRIBING:
        found = _read_merged(spark, path, fmt, options)
        return apply_schema(found, _patched(found.schema, hints), json_as="string")
    infer = {"inferSchema": True} if fmt == "CSV" else {}
    found = _reader(spark, fmt, {**infer, **options}).load(path)
    # text is parsed again under the hinted types: casting the inferred values would lose digits
    return _reader(spark, fmt, options).schema(_patched(found.schema, hints)).load(path)


def _patched(found: T.StructType, hints: T.StructType) -> T.StructType:
    """The found schema with the hinted types."""
    by_name = {f.name.lower(): f for f in hints.fields}
    absent = set(by_name) - {n.lower() for n in found.names}
    if absent:
        raise ValueError(f"hinted columns {sorted(absent)} are not in the files")
    kinds = {f.name: by_name.get(f.name.lower(), f).dataType for f in found.fields}
    return T.StructType([T.StructField(name, kind) for name, kind in kinds.items()])


def _is_on(options: dict[str, object], name: str, default: str = "false") -> bool:
    return str(options.get(name, default)).lower() == "true"


def _read_merged(spark: SparkSession, path, fmt: str, options: dict[str, object]) -> DataFrame:
    if fmt in ("PARQUET", "ORC"):
        options = {"mergeSchema": True, **options}
    if fmt == "CSV" and _is_on(options, "header"):
        return _merge_csv(spark, path, options)
    if fmt == "CSV":
        options = {"inferSchema": True, **options}
    return _reader(spark, fmt, options).load(path)


def _merge_csv(
    spark: SparkSession, path, options: dict[str, object], hints: T.StructType | None = None
) -> DataFrame:
    """CSV files with differing headers, their columns brought together by name.

    One scan reads all files by position, and each file's header says where a column is.  Columns without a hint are typed over all files at once, so two files never disagree on a
    type.  A value that its hinted type cannot hold is NULL, or an error in ``FAILFAST`` mode.
    """
    plain = {k: v for k, v in options.items() if k != "inferSchema"}
    listed = list_scanned(
        spark,
        path,
        pattern=options.get("pathGlobFilter"),
        recursive=_is_on(options, "recursiveFileLookup"),
    )
    scratch = f"{shared_root(spark)}/lakeferry/headers-{uuid.uuid4().hex}"
    try:
        headers, _ = stage(spark, first_lines(listed.where("size > 0")), scratch)
        examples = headers.groupBy("header").agg(F.min("uri").alias("uri")).orderBy("header").collect()
        if len(examples) < 2:
            merged = _text_csv(spark, path, examples[0]["uri"] if examples else path, plain)
        elif str(plain.get("mode", "PERMISSIVE")).upper() != "PERMISSIVE":
            # a file with fewer columns than another one must not count as malformed
            merged = _union_csv(spark, headers, plain)
        else:
            merged = _one_scan_csv(spark, path, headers, examples, plain)
    finally:
        store.delete(spark, scratch)
    formats = (str(options["timestampFormat"]),) if "timestampFormat" in options else ()
    hints = hints or T.StructType([])
    schema = _patched(merged.schema, hints)
    if _is_on(options, "inferSchema", "true"):
        hinted = {n.lower() for n in hints.names}
        free = merged.select(*[F.col(quote(n)) for n in merged.columns if n.lower() not in hinted])
        found = infer_schema(
            free, parse_text=True, float_type="double", timestamp_formats=formats
        )
        known = [f for f in found.fields if not isinstance(f.dataType, T.NullType)]
        schema = _patched(schema, T.StructType(known))
    strict = str(options.get("mode", "")).upper() == "FAILFAST"
    return apply_schema(
        merged,
        schema,
        on_error="raise" if strict else "null",
        json_as="string",
        timestamp_formats=formats,
    )


def _one_scan_csv(
    spark: SparkSession, path, headers: DataFrame, examples: list, options: dict[str, object]
) -> DataFrame:
    """CSV files with several headers, every column as text.

    Spark's own reader names the columns of one file per header; a file is joined to the places of
    the columns in it, so the plan has one scan however many headers there are.
    """
    layouts = [(row["header"], _text_csv(spark, row["uri"], row["uri"], options).columns) for row in examples]
    names: dict[str, str] = {}
    for _, columns in layouts:
        for name in columns:
            names.setdefault(name.lower(), name)
    places = []
    for header, columns in layouts:
        at = {name.lower(): i for i, name in enumerate(columns)}
        places.append((bytearray(header), [at.get(key) for key in names]))
    known = spark.createDataFrame(places, "header binary, places array<int>")
    folder = Workspace(spark).dir("places")
    by_file, size = stage(spark, headers.join(known, "header").select(F.col("file").alias(_FILE), F.col("places").alias(_PLACES)), folder)
    width = max(len(columns) for _, columns in layouts)
    text = T.StructType([T.StructField(f"_c{i}", T.StringType()) for i in range(width)])
    scan = _reader(spark, "CSV", options).schema(text).load(path)
    values = scan.select(F.array(*text.names).alias(_VALUES), F.col("_metadata.file_path").alias(_FILE))
    joined = values.join(F.broadcast(by_file) if may_broadcast(by_file, size) else by_file, _FILE)
    return joined.select(
        *[F.get(F.col(_VALUES), F.get(F.col(_PLACES), F.lit(i))).alias(name) for i, name in enumerate(names.values())]
    )


def _text_csv(spark: SparkSession, path, example, options: dict[str, object]) -> DataFrame:
    """CSV files that share the header of ``example``, every column as text."""
    one = {k: v for k, v in options.items() if k != "pathGlobFilter"}
    names = _reader(spark, "CSV", {**one, "inferSchema": False}).load(example).columns
    text = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return _reader(spark, "CSV", options).schema(text).load(path)


def _union_csv(spark: SparkSession, headers: DataFrame, options: dict[str, object]) -> DataFrame:
    """One scan per header, its files named in lists of bounded length; for modes that refuse rows."""
    options = {k: v for k, v in options.items() if k != "pathGlobFilter"}
    merged: DataFrame | None = None
    by_header = groupby(
        headers.orderBy("header", "uri").toLocalIterator(), key=lambda row: row["header"]
    )
    for _, rows in by_header:
        while uris := [row["uri"] for row in islice(rows, FILES_PER_SCAN)]:
            part = _text_csv(spark, uris, uris[0], options)
            merged = part if merged is None else merged.unionByName(part, allowMissingColumns=True)
    return merged


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    lower_bound: object = None,
    upper_bound: object = None,
    num_partitions: int | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """A database table; with a partition column it is read in parallel ranges."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **(options or {}))
    ranges = (partition_column, lower_bound, upper_bound, num_partitions)
    if any(r is not None for r in ranges):
        if any(r is None for r in ranges):
            raise ValueError("a parallel read needs the column, both bounds and the partitions")
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=str(lower_bound),
            upperBound=str(upper_bound),
            numPartitions=str(num_partitions),
        )
    return reader.load()
