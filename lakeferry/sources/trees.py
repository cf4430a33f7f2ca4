"""Trees of non-tabular files as rows.

A *files table* has one row per part of a file: ``(path, size, sha256, part, n_parts, content)``.
Most files have one part.  A file larger than ``part_bytes`` has several, read in parallel ranges,
so no row ever holds more than ``part_bytes`` of content.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from fnmatch import fnmatchcase
from itertools import islice
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeferry.plans import store
from lakeferry.plans.workspace import Workspace, stage

PART_BYTES = 64 * 2**20
# Bytes of file content per task and per batch, what opening a file counts, the files from which another
# task is worth its start, a bound on the tasks of a shuffle, and the files listed in one batch.
TASK_BYTES = 128 * 2**20
BATCH_BYTES = 16 * 2**20
OPEN_BYTES = 128 * 2**10
FEW_FILES = 32
MAX_TASKS = 100_000
LISTED = 10_000
# File systems that tasks open by themselves, under the names that Hadoop gives them; files on any
# other are read through Spark's own scan, which knows all of them.
OPENED = {"file": "file", "hdfs": "hdfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs", "abfs": "abfs", "abfss": "abfss"}
FILES_SCHEMA = (
    "path string, size bigint, sha256 string, part bigint, n_parts bigint, content binary"
)


def list_tree(
    spark: SparkSession,
    root: str | list[str],
    *,
    pattern: str | None = None,
    recursive: bool = True,
    with_empty: bool = False,
) -> DataFrame:
    """``(uri, size, modified)`` of every visible file; no content is read.

    Spark's listing skips files and directories whose names start with ``.`` or ``_``, and files
    without content; ``with_empty`` adds the latter.
    """
    found = _scan(spark, root, pattern, recursive).select(
        F.col("path").alias("uri"),
        F.col("length").alias("size"),
        F.col("modificationTime").alias("modified"),
    )
    if not with_empty:
        return found
    return found.unionByName(
        empty_files(spark, root, pattern=pattern, recursive=recursive).select(
            "uri", F.lit(0).cast("bigint").alias("size"), "modified"
        )
    )


def empty_files(
    spark: SparkSession, root: str, *, pattern: str | None = None, recursive: bool = True
) -> DataFrame:
    """``(uri, modified)`` of the visible files without content, which Spark's scans leave out.

    One task lists ``root`` itself; the directories below it are listed in parallel, each by a
    task that holds one directory at a time.
    """
    base = store.qualified(spark, root).rstrip("/")
    columns = "uri string, modified timestamp"
    if not opened_by_tasks(base):
        found = [(uri, modified) for uri, modified in store.empty_files(spark, base, recursive) if not pattern or fnmatchcase(uri.rsplit("/", 1)[-1], pattern)]
        return spark.createDataFrame(found, "uri string, millis bigint").select("uri", F.timestamp_millis("millis").alias("modified"))
    start = spark.createDataFrame([(base,)], "uri string")
    tops = start.mapInArrow(_empty_finder(pattern, "top" if recursive else "none"), columns)
    if not recursive:
        return tops
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return tops.repartition(tasks).select("uri").mapInArrow(_empty_finder(pattern, "all"), columns)


def _scan(spark: SparkSession, root, pattern: str | None, recursive: bool) -> DataFrame:
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", recursive)
    return (reader.option("pathGlobFilter", pattern) if pattern else reader).load(root)


def relative_path(spark: SparkSession, uri: Column, root: str, prefix: str = "") -> Column:
    """``prefix`` plus the path below ``root``, or the bare name if ``root`` is the file itself."""
    base = store.qualified(spark, root).rstrip("/")
    below = F.when(
        F.startswith(uri, F.lit(base + "/")), F.substring(uri, len(base) + 2, 2**31 - 1)
    ).otherwise(F.substring_index(uri, "/", -1))
    return F.concat_ws("/", F.lit(prefix.strip("/")), below) if prefix.strip("/") else below


def read_tree(
    spark: SparkSession,
    root: str,
    *,
    prefix: str = "",
    pattern: str | None = None,
    recursive: bool = True,
    absolute: bool = False,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """The files below ``root`` as a files table, with a SHA-256 of each whole file.

    Paths are relative to ``root`` and below ``prefix``, or full URIs with ``absolute``.
    """
    if _can_walk(spark, root, pattern):
        uri = F.col("uri")
        files = _walk(spark, root, pattern, recursive).select(
            "uri", (uri if absolute else relative_path(spark, uri, root, prefix)).alias("path"), "size"
        )
        small = spread_by_bytes(files.where(F.col("size") <= part_bytes), "uri").mapInArrow(_read_whole, FILES_SCHEMA)
        large = files.where(F.col("size") > part_bytes)
        return small if large.isEmpty() else small.unionByName(_read_large(large, part_bytes))
    found = _scan(spark, root, pattern, recursive)
    path = F.col("path") if absolute else relative_path(spark, F.col("path"), root, prefix)
    # the length filter reaches the source, so neither branch opens the other's files
    small = found.where(F.col("length") <= part_bytes).select(
        path.alias("path"),
        F.col("length").alias("size"),
        F.sha2("content", 256).alias("sha256"),
        F.lit(0).cast("bigint").alias("part"),
        F.lit(1).cast("bigint").alias("n_parts"),
        "content",
    )
    nothing = empty_files(spark, root, pattern=pattern, recursive=recursive)
    uri = F.col("uri")
    empty = nothing.select(
        (uri if absolute else relative_path(spark, uri, root, prefix)).alias("path"),
        F.lit(0).cast("bigint").alias("size"),
        F.sha2(F.lit(b""), 256).alias("sha256"),
        F.lit(0).cast("bigint").alias("part"),
        F.lit(1).cast("bigint").alias("n_parts"),
        F.lit(b"").alias("content"),
    )
    files = small.unionByName(empty)
    large = found.where(F.col("length") > part_bytes).select(
        F.col("path").alias("uri"), path.alias("path"), F.col("length").alias("size")
    )
    if large.isEmpty():
        return files
    if not opened_by_tasks(store.qualified(spark, root)):
        whole = found.where(F.col("length") > part_bytes).select(path.alias("path"), F.col("length").alias("size"), F.sha2("content", 256).alias("sha256"), "content")
        return files.unionByName(_in_parts(whole, part_bytes))
    return files.unionByName(_read_large(large, part_bytes))


def hash_tree(
    spark: SparkSession, root: str, *, pattern: str | None = None, recursive: bool = True
) -> DataFrame:
    """``(uri, size, sha256)`` of every visible file below ``root``; content stays in the tasks that read it."""
    if _can_walk(spark, root, pattern):
        files = _walk(spark, root, pattern, recursive)
        return spread_by_bytes(files, "uri").mapInArrow(_hash_files, "uri string, size bigint, sha256 string")
    files = read_tree(spark, root, pattern=pattern, recursive=recursive, absolute=True)
    return files.where("part = 0").select(F.col("path").alias("uri"), "size", "sha256")


def _can_walk(spark: SparkSession, root: str, pattern: str | None) -> bool:
    """Can tasks list ``root`` themselves, and do its name and the pattern mean to them what they mean to Spark?"""
    return (
        isinstance(root, str)
        and not set(root) & set("*?[]{}\\")
        and not set(pattern or "") & set("[]{}\\^")
        and opened_by_tasks(store.qualified(spark, root))
        and store.exists(spark, root)
    )


def _walk(spark: SparkSession, root: str, pattern: str | None, recursive: bool) -> DataFrame:
    """``(uri, size)`` of every visible file, those without content too, listed once by tasks and staged.

    One task lists ``root`` itself; the directories below it are listed in parallel.  No listing passes
    through the driver, and what follows has as many tasks as the files need.
    """
    columns = "uri string, size bigint, folder boolean"
    start = spark.createDataFrame([(store.qualified(spark, root).rstrip("/"), 0, True)], columns)
    found = start.mapInArrow(_file_finder(pattern, "top" if recursive else "none"), columns)
    if recursive:
        tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
        found = found.repartition(tasks).mapInArrow(_file_finder(pattern, "all"), columns)
    return stage(spark, found.select("uri", "size"), Workspace(spark).dir("listing"))[0]


def opened_by_tasks(uri: str) -> bool:
    return uri.split(":", 1)[0] in OPENED


def _read_large(files: DataFrame, part_bytes: int) -> DataFrame:
    """Large files: hashes by one streaming pass per file, content by parallel range reads."""
    hashed = spread_by_bytes(files.select("uri", "size"), "uri").mapInArrow(_hash_files, "uri string, size bigint, sha256 string")
    hashes = hashed.drop("size")
    return read_listed(files.join(hashes, "uri"), part_bytes=part_bytes, by=files)


def read_listed(
    files: DataFrame, *, part_bytes: int = PART_BYTES, by: DataFrame | None = None
) -> DataFrame:
    """The content of listed files ``(uri, path, size, sha256)``; no other file is opened.

    ``by`` has the sizes of the same files where that is cheaper to read than ``files``.
    """
    n_parts = F.greatest(F.lit(1), F.ceil(F.col("size") / F.lit(part_bytes))).cast("bigint")
    numbers = F.sequence(F.lit(0).cast("bigint"), F.col("n_parts") - 1)
    parts = files.withColumn("n_parts", n_parts).withColumn("part", F.explode(numbers))
    wanted = parts.select("uri", "path", "size", "sha256", "n_parts", "part")
    content = spread_by_bytes(wanted, "uri", "part", by=files if by is None else by).mapInArrow(
        _range_reader(part_bytes),
        "uri string, path string, size bigint, sha256 string, n_parts bigint, part bigint,"
        " content binary",
    )
    return content.select("path", "size", "sha256", "part", "n_parts", "content")


def _in_parts(files: DataFrame, part_bytes: int) -> DataFrame:
    """Whole files ``(path, size, sha256, content)`` as a files table."""
    n_parts = F.greatest(F.lit(1), F.ceil(F.col("size") / F.lit(part_bytes))).cast("bigint")
    each = files.withColumn("n_parts", n_parts).withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n_parts") - 1)))
    content = F.substring("content", (F.col("part") * part_bytes + 1).cast("int"), F.lit(part_bytes))
    return each.select("path", "size", "sha256", "part", "n_parts", content.alias("content"))


def read_scanned(spark: SparkSession, files: DataFrame, root, *, part_bytes: int = PART_BYTES) -> DataFrame:
    """The content of listed files ``(uri, path, size, sha256)`` by Spark's scan of ``root``, which
    opens no other file: their names are a filter on the files' metadata."""
    scanned = _scan(spark, root, None, True).select("path", "length", F.col("_metadata.file_path").alias("file"))
    wanted = files.join(scanned.select(F.col("path").alias("uri"), "file"), "uri").select("file")
    names = [row["file"] for row in wanted.toLocalIterator()]
    found = _scan(spark, root, None, True)
    content = found.where(F.col("_metadata.file_path").isin(names)).select(F.col("path").alias("uri"), "content")
    some = files.where("size > 0").join(content, "uri")
    none = files.where("size = 0").withColumn("content", F.lit(b""))
    return _in_parts(some.select(*none.columns).union(none).select("path", "size", "sha256", "content"), part_bytes)


def spread_by_bytes(df: DataFrame, *columns: str, by: DataFrame | None = None) -> DataFrame:
    """Names of files over enough tasks for the bytes behind them, and for opening each file.

    The rows are small, so adaptive execution would put them all into one task: the number of
    partitions is set from the sizes of the files.
    """
    cost = F.sum(F.col("size") + F.lit(OPEN_BYTES))
    total, count = (df if by is None else by).agg(cost, F.count("*")).first()
    cores = df.sparkSession.sparkContext.defaultParallelism
    wanted = max(1, -(-(total or 0) // TASK_BYTES), min(cores, count // FEW_FILES))
    return df.repartition(min(wanted, MAX_TASKS), *[F.col(c) for c in columns])


# The functions below run inside tasks.


def open_uri(uri: str):
    """The pyarrow file system of a Hadoop path, and the path in it.

    Hadoop writes ``file:/a b``, where a URI is ``file:///a%20b``.
    """
    scheme, rest = uri.split(":", 1)
    authority, path = "", rest
    if rest.startswith("//"):
        authority, _, path = rest[2:].partition("/")
    return fs.FileSystem.from_uri(f"{OPENED.get(scheme, scheme)}://{authority}/{quote(path.lstrip('/'))}")


def _empty_finder(pattern: str | None, below: str):
    """Finds empty files in directories, and what is to be done for the directories in them:

    nothing (``none``), name them (``top``), or search them as well (``all``).
    """

    def hidden(name: str) -> bool:
        return name.startswith((".", "_"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for top in batch.column("uri").to_pylist():
                system, name = open_uri(top)
                todo = system.get_file_info([name])
                while todo:
                    info = todo.pop()
                    if info.type == fs.FileType.Directory and (info.path == name or below == "all"):
                        inside = system.get_file_info(fs.FileSelector(info.path))
                        todo += [i for i in inside if not hidden(i.base_name)]
                        continue
                    empty = info.type == fs.FileType.File and not info.size
                    if empty and pattern and not fnmatchcase(info.base_name, pattern):
                        continue
                    if empty or (info.type == fs.FileType.Directory and below == "top"):
                        uri = pa.array([top + info.path[len(name):]], pa.string())
                        when = pa.array([info.mtime], pa.timestamp("us", "UTC"))
                        yield pa.RecordBatch.from_arrays([uri, when], names=["uri", "modified"])

    return find


def _range_reader(part_bytes: int):
    columns = ("uri", "path", "size", "sha256", "n_parts", "part")

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.select(list(columns))
            first, contents, held = 0, [], 0
            for i, (uri, size, part) in enumerate(
                zip(*(batch.column(c).to_pylist() for c in ("uri", "size", "part")), strict=True)
            ):
                content = _read_range(uri, part * part_bytes, size, part_bytes)
                contents.append(content)
                held += len(content)
                if held >= part_bytes:
                    yield _with_content(rows.slice(first, len(contents)), contents)
                    first, contents, held = i + 1, [], 0
            if contents:
                yield _with_content(rows.slice(first, len(contents)), contents)

    return read


def _read_range(uri: str, start: int, size: int, part_bytes: int) -> bytes:
    wanted = min(part_bytes, size - start)
    system, name = open_uri(uri)
    with system.open_input_file(name) as source:
        content = source.read_at(wanted, start)
    if len(content) != wanted:
        raise OSError(f"{uri} changed while it was read")
    return content


def _with_content(rows: pa.RecordBatch, contents: list[bytes]) -> pa.RecordBatch:
    arrays = [*rows.columns, pa.array(contents, pa.binary())]
    return pa.RecordBatch.from_arrays(arrays, names=[*rows.schema.names, "content"])


def list_scanned(spark: SparkSession, root, *, pattern: str | None = None, recursive: bool = True) -> DataFrame:
    """``(uri, size, file)``: as ``list_tree``, with the name that a scan gives the file in ``_metadata``."""
    found = _scan(spark, root, pattern, recursive)
    return found.select(
        F.col("path").alias("uri"), F.col("length").alias("size"), F.col("_metadata.file_path").alias("file")
    )


def first_lines(files: DataFrame) -> DataFrame:
    """``(uri, file, header)``: the first line of every listed file, as bytes, and nothing after it."""
    example = files.first()
    if example is not None and not opened_by_tasks(example["uri"]):
        return _scanned_lines(files)
    opened = files.withColumn("size", F.lit(0))
    return spread_by_bytes(opened, "uri").select("uri", "file").mapInArrow(
        _first_lines, "uri string, file string, header binary"
    )


def _scanned_lines(files: DataFrame) -> DataFrame:
    """First lines by a scan of the listed files, where tasks cannot open them."""
    uris = [row["uri"] for row in files.select("uri").toLocalIterator()]
    scan = _scan(files.sparkSession, uris, None, False).select(F.col("path").alias("uri"), F.col("_metadata.file_path").alias("file"), "content")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lines = [c.as_py().split(b"\n", 1)[0].rstrip(b"\r") for c in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(lines, pa.binary())], names=["uri", "file", "header"])

    return scan.mapInArrow(cut, "uri string, file string, header binary")


def _first_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        uris = batch.column("uri").to_pylist()
        found = []
        for uri in uris:
            system, name = open_uri(uri)
            with system.open_input_stream(name, compression="detect") as source:
                line = b""
                while b"\n" not in line and (block := source.read(2**14)):
                    line += block
            found.append(line.split(b"\n", 1)[0].rstrip(b"\r"))
        headers = pa.array(found, pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns, headers], names=["uri", "file", "header"])


def _file_finder(pattern: str | None, below: str):
    """Finds files in directories, and what is to be done for the directories in them: nothing
    (``none``), name them (``top``), or search them as well (``all``).  Files given are passed on."""

    def visible(info: fs.FileInfo) -> bool:  # as Spark's listing has it
        name = info.base_name
        if info.type == fs.FileType.Directory and name.startswith(("_common_metadata", "_metadata")):
            return True
        return not (name.startswith(".") or (name.startswith("_") and "=" not in name) or name.endswith("._COPYING_"))

    def search(top: str) -> Iterator[tuple[str, int, bool]]:
        system, name = open_uri(top)
        todo = system.get_file_info([name])
        while todo:
            info = todo.pop()
            if info.type == fs.FileType.Directory and (info.path == name or below == "all"):
                inside = system.get_file_info(fs.FileSelector(info.path))
                todo += [i for i in inside if visible(i)]
            elif info.type == fs.FileType.File:
                if not pattern or fnmatchcase(info.base_name, pattern):
                    yield top + info.path[len(name):], info.size, False
            elif info.type == fs.FileType.Directory and below == "top":
                yield top + info.path[len(name):], 0, True

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, int, bool]]:
        for batch in batches:
            for uri, size, folder in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if folder:
                    yield from search(uri)
                else:
                    yield uri, size, False

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = found(batches)
        while some := list(islice(rows, LISTED)):
            columns = list(zip(*some, strict=True))
            kinds = (pa.string(), pa.int64(), pa.bool_())
            arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(arrays, names=["uri", "size", "folder"])

    return find


def _read_whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Files in one part, with their hashes."""

    def made(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.binary())
        arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["path", "size", "sha256", "part", "n_parts", "content"])

    rows, held = [], 0
    for batch in batches:
        for uri, path, size in zip(*(batch.column(c).to_pylist() for c in ("uri", "path", "size")), strict=True):
            content = _read_range(uri, 0, size, size)
            rows.append((path, size, hashlib.sha256(content).hexdigest(), 0, 1, content))
            held += size
            if held >= BATCH_BYTES or len(rows) >= LISTED:
                yield made(rows)
                rows, held = [], 0
    if rows:
        yield made(rows)


def _hash_files(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``(uri, size)`` with the hash of each file, which is streamed."""
    for batch in batches:
        found = []
        for uri in batch.column("uri").to_pylist():
            system, name = open_uri(uri)
            digest = hashlib.sha256()
            with system.open_input_stream(name) as source:
                while block := source.read(2**20):
                    digest.update(block)
            found.append(digest.hexdigest())
        columns = [batch.column("uri"), batch.column("size"), pa.array(found, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=["uri", "size", "sha256"])
