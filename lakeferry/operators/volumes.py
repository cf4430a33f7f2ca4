"""Files as data: plan a sync, find conflicts, list, export and drop sub-trees.

A *files table* has the columns of ``lakeferry.sources.trees``: one row per part of a file.  A *store*
keeps files as two tables: a manifest of paths, and the content of each hash once.
"""

from __future__ import annotations

import posixpath
import uuid
from collections.abc import Iterator
from dataclasses import replace

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.functions.types import quote
from lakeferry.operators.merge import delete_unmatched, delete_where, merge_table, update_where
from lakeferry.operators.write import create_table
from lakeferry.plans import store
from lakeferry.plans.commit import append_once, recover, token
from lakeferry.plans.workspace import shared_root, stage
from lakeferry.sources.tables import Table, as_table, read_table
from lakeferry.sources.trees import (
    FEW_FILES,
    FILES_SCHEMA,
    PART_BYTES,
    hash_tree,
    open_uri,
    opened_by_tasks,
    read_listed,
    read_scanned,
    relative_path,
)

MANIFEST_SCHEMA = "path string, size bigint, sha256 string"
CONTENT_SCHEMA = "sha256 string, part bigint, n_parts bigint, content binary"


class FileConflictError(ValueError):
    """Files exist already at the paths to be written."""


def in_subtree(path: Column, prefix: str) -> Column:
    """The file ``prefix`` itself, or below it: ``a/b`` holds ``a/b/x`` but not ``a/b1/x``."""
    base = prefix.strip("/")
    if not base:
        return F.lit(True)
    return (path == base) | F.startswith(path, F.lit(base + "/"))


def list_files(files: DataFrame, prefix: str = "") -> DataFrame:
    """One row ``(path, size, sha256)`` per file of a sub-tree; no content is read."""
    first = files.where(F.col("part") == 0) if "part" in files.columns else files
    return first.where(in_subtree(F.col("path"), prefix)).select("path", "size", "sha256")


def sync_plan(listing: DataFrame, manifest: DataFrame) -> DataFrame:
    """``(path, sha256, action)`` per listed file: ``new``, ``changed`` or ``same``.

    Both sides have one row per path with its SHA-256; only paths and hashes move.
    """
    known = manifest.select(F.col("path"), F.col("sha256").alias("__known"))
    action = (
        F.when(F.col("__known").isNull(), "new")
        .when(F.col("__known") == F.col("sha256"), "same")
        .otherwise("changed")
    )
    joined = listing.select("path", "sha256").join(known, "path", "left")
    return joined.select("path", "sha256", action.alias("action"))


def conflicts(listing: DataFrame, manifest: DataFrame) -> DataFrame:
    """Listed paths that exist in the manifest already."""
    return listing.select("path").join(manifest.select("path"), "path", "left_semi")


def create_files_table(spark: SparkSession, table: str | Table) -> Table:
    """A store of files: ``table`` is its manifest, a sibling holds every content once.

    Changes of the tree are changes of the manifest, rows of a path, a size and a hash; the sibling,
    keyed by the hash, is only ever appended to, and what no path needs any more goes by
    ``drop_unused_content``.
    """
    ref = as_table(table)
    content = content_table(ref)
    create_table(spark, replace(ref, schema=MANIFEST_SCHEMA))
    create_table(spark, replace(content, schema=CONTENT_SCHEMA))
    return ref


def content_table(table: str | Table) -> Table:
    return as_table(table).sibling("content")


def stored_files(spark: SparkSession, table: str | Table, prefix: str = "") -> DataFrame:
    """The files of a sub-tree with their content, as a files table.

    A manifest within the session's broadcast limit is broadcast, so content does not move.
    """
    ref = as_table(table)
    manifest = read_table(spark, ref.name).where(in_subtree(F.col("path"), prefix))
    joined = manifest.join(read_table(spark, content_table(ref)), "sha256")
    return joined.select(*T.StructType.fromDDL(FILES_SCHEMA).names)


def put_files(spark: SparkSession, table: str | Table, files: DataFrame) -> None:
    """Add or replace files given as a files table; content that is stored already is not written."""
    ref = create_files_table(spark, table)
    listing = list_files(files)
    scratch = f"{shared_root(spark)}/lakeferry/put-{token()}"
    try:
        listed, _ = stage(spark, listing, f"{scratch}/listing")
        wanted, _ = stage(spark, _lacking(spark, ref, listed).select("path"), f"{scratch}/wanted")
        rows = files.join(wanted, "path", "left_semi").select(*T.StructType.fromDDL(CONTENT_SCHEMA).names)
        _store(spark, ref, None if wanted.isEmpty() else rows, listed)
    finally:
        store.delete(spark, scratch)


def _lacking(spark: SparkSession, ref: Table, listed: DataFrame) -> DataFrame:
    """One row of ``(sha256, path, …)`` for each content that the store lacks; only hashes are compared."""
    rest = [F.col(c) for c in listed.columns if c not in ("sha256", "path")]
    first = listed.groupBy("sha256").agg(F.min(F.struct("path", *rest)).alias("one")).select("sha256", "one.*")
    known = read_table(spark, content_table(ref), ["sha256", "part"]).where("part = 0")
    return first.join(known, "sha256", "left_anti")


def _store(spark: SparkSession, ref: Table, content: DataFrame | None, manifest: DataFrame) -> None:
    """Content first: a crash before the manifest leaves content that the next call finds."""
    recover(spark, content_table(ref))
    if content is not None:
        append_once(spark, content_table(ref), content, token())
    merge_table(spark, ref, manifest.select(*T.StructType.fromDDL(MANIFEST_SCHEMA).names), "path")


def ingest_tree(
    spark: SparkSession,
    table: str | Table,
    root: str,
    *,
    prefix: str = "",
    if_exists: str = "sync",
    part_bytes: int = PART_BYTES,
) -> dict[str, int]:
    """Bring the files below ``root`` into a store; returns how many were written or kept.

    ``if_exists="sync"`` skips files with the same path and content and replaces changed ones;
    ``"error"`` refuses if any path exists; ``"replace"`` enters every file again.  Every file is
    hashed once; only files whose content the store lacks are read a second time and written, so a
    renamed or copied file is a row of the manifest and nothing else.
    """
    if if_exists not in ("sync", "error", "replace"):
        raise ValueError(f"if_exists is 'sync', 'error' or 'replace', got {if_exists!r}")
    ref = create_files_table(spark, table)
    scratch = f"{shared_root(spark)}/lakeferry/ingest-{token()}"
    try:
        listing = hash_tree(spark, root).select(
            "uri", relative_path(spark, F.col("uri"), root, prefix).alias("path"), "size", "sha256"
        )
        listed, _ = stage(spark, listing, f"{scratch}/listing")
        plan = sync_plan(listed, read_table(spark, ref.name)).select("path", "action").join(listed, "path")
        plan, _ = stage(spark, plan, f"{scratch}/plan")
        if if_exists == "error":
            clash = plan.where("action <> 'new'").take(5)
            if clash:
                raise FileConflictError(f"files exist already, as {[r.path for r in clash]}")
        if if_exists == "replace":
            plan = plan.replace("same", "changed", "action")
        counts = {r["action"]: r["n"] for r in plan.groupBy("action").agg(_n()).collect()}
        entered = plan.where("action <> 'same'")
        if set(counts) - {"same"}:
            wanted, _ = stage(spark, _lacking(spark, ref, entered.select("sha256", "path", "uri", "size")), f"{scratch}/wanted")
            if opened_by_tasks(store.qualified(spark, root)):
                rows = read_listed(wanted, part_bytes=part_bytes)
            else:
                rows = read_scanned(spark, wanted, root, part_bytes=part_bytes)
            content = rows.select(*T.StructType.fromDDL(CONTENT_SCHEMA).names)
            _store(spark, ref, None if wanted.isEmpty() else content, entered)
        return {"new": 0, "changed": 0, "same": 0, **counts}
    finally:
        store.delete(spark, scratch)


def move_files(spark: SparkSession, table: str | Table, prefix: str, target: str) -> None:
    """Give a sub-tree, or a single file, another place; only rows of the manifest change.

    A path that exists already outside the sub-tree is an error before anything is written.
    """
    ref = as_table(table)
    base, to = prefix.strip("/"), target.strip("/")
    manifest = read_table(spark, ref.name)
    inside = in_subtree(F.col("path"), base)
    rest = F.col("path") if not base else F.substring(F.col("path"), len(base) + 2, 2**31 - 1)
    moved = F.concat_ws("/", *[F.nullif(part, F.lit("")) for part in (F.lit(to), rest)])
    moving = manifest.where(inside).select(moved.alias("path"))
    clash = conflicts(moving, manifest.where(~inside)).take(5)
    if clash:
        raise FileConflictError(f"files exist already, as {[r.path for r in clash]}")
    update_where(spark, ref, inside, {"path": moved})


def drop_unused_content(spark: SparkSession, table: str | Table) -> None:
    """Delete content that no path has any more; files of the store without any are left alone."""
    keep = read_table(spark, as_table(table).name).select("sha256")
    delete_unmatched(spark, content_table(table), keep, ["sha256"])


def _n() -> Column:
    return F.count("*").alias("n")


def drop_files(spark: SparkSession, table: str | Table, prefix: str = "") -> None:
    """Delete a sub-tree from a store of files; only rows of the manifest go."""
    delete_where(spark, table, in_subtree(F.col(quote("path")), prefix))


def export_files(
    spark: SparkSession, files: DataFrame, target: str, *, prefix: str = "", spread: bool = True
) -> DataFrame:
    """Write the files of a sub-tree below ``target``; returns ``(path, size)`` as written.

    Paths are relative to ``prefix``.  ``target`` is on storage that all executors reach.  Each
    file is written under a temporary name and renamed when it is whole, so a task that runs twice
    does no harm.  Files in one part need no shuffle, unless one task has far more than its share of
    them; ``spread=False`` saves counting them where they are dealt well, as by ``read_tree``.  The
    parts of a larger file come to one task in order and are streamed, never held together.
    """
    base = prefix.strip("/")
    path = F.col("path")
    below = (
        path
        if not base
        else F.when(path == base, F.substring_index(path, "/", -1)).otherwise(
            F.substring(path, len(base) + 2, 2**31 - 1)
        )
    )
    rows = files.where(in_subtree(path, base)).select(
        below.alias("path"), "part", "n_parts", "content"
    )
    write = _file_writer(store.qualified(spark, target))
    whole = rows.where(F.col("n_parts") == 1)
    whole = (_spread(whole) if spread else whole).mapInArrow(write, "path string, size bigint")
    split = (
        rows.where(F.col("n_parts") > 1)
        .repartition("path")
        .sortWithinPartitions("path", "part")
        .mapInArrow(write, "path string, size bigint")
    )
    scratch = f"{shared_root(spark)}/lakeferry/export-{token()}"
    report, _ = stage(spark, whole.unionByName(split), scratch)
    return report


def _spread(files: DataFrame) -> DataFrame:
    """Over more tasks, by path, if one task has over twice its share of the files.

    So it is if few row groups hold them all, which no setting splits.
    """
    counts = files.groupBy(F.spark_partition_id()).agg(_n())
    most, total = counts.agg(F.max("n"), F.sum("n")).first()
    share = (total or 0) / files.sparkSession.sparkContext.defaultParallelism
    return files.hint("rebalance", F.col("path")) if (most or 0) > max(FEW_FILES, 2 * share) else files


def _file_writer(target: str):
    """Runs in tasks: rows of ``(path, part, n_parts, content)``, the parts of a file in order."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = open_uri(target)
        context = TaskContext.get()
        attempt = f"{context.taskAttemptId()}-{uuid.uuid4().hex}" if context else uuid.uuid4().hex
        out, size, folders = None, 0, set()
        for batch in batches:
            paths, sizes = [], []
            contents = batch.column("content")
            names = (batch.column(c).to_pylist() for c in ("path", "part", "n_parts"))
            for i, (path, part, n_parts) in enumerate(zip(*names, strict=True)):
                name = posixpath.join(root, path)
                folder, leaf = posixpath.split(name)
                if folder not in folders or leaf == "..":
                    inside = posixpath.commonpath([root, posixpath.normpath(folder)]) == root.rstrip("/")
                    if leaf == ".." or not inside:
                        raise ValueError(f"{path} leads outside the target")
                    system.create_dir(folder, recursive=True)
                    folders.add(folder)
                partial = posixpath.join(folder, f".{leaf}.{attempt}")
                if part == 0:
                    out, size = system.open_output_stream(partial), 0
                content = contents[i].as_buffer()
                if content is not None:
                    out.write(content)
                    size += content.size
                if part == n_parts - 1:
                    out.close()
                    system.move(partial, name)
                    paths.append(path)
                    sizes.append(size)
            arrays = [pa.array(paths, pa.string()), pa.array(sizes, pa.int64())]
            yield pa.RecordBatch.from_arrays(arrays, names=["path", "size"])

    return write
