"""Small helpers over the Hadoop file system of a path (local, HDFS or an object store)."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import SparkSession


def _path(spark: SparkSession, path: str):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark: SparkSession, path: str):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def qualified(spark: SparkSession, path: str) -> str:
    return _fs(spark, path).makeQualified(_path(spark, path)).toString()


def exists(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).exists(_path(spark, path))


def is_directory(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).getFileStatus(_path(spark, path)).isDirectory()


def delete(spark: SparkSession, path: str) -> bool:
    return _fs(spark, path).delete(_path(spark, path), True)


def delete_uri(spark: SparkSession, uri: str) -> bool:
    """Delete the file that a scan names in ``_metadata.file_path``, where special characters are escaped."""
    path = _of_uri(spark, uri)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, False)


def folder_of(spark: SparkSession, uri: str) -> str:
    return _of_uri(spark, uri).getParent().toString()


def _of_uri(spark: SparkSession, uri: str):
    return spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(uri))


def matches(spark: SparkSession, pattern: str) -> bool:
    """Does any path fit the pattern?"""
    found = _fs(spark, pattern).globStatus(_path(spark, pattern))
    return found is not None and len(found) > 0


def tree_bytes(spark: SparkSession, path: str) -> int:
    return _fs(spark, path).getContentSummary(_path(spark, path)).getLength()


def touch(spark: SparkSession, path: str) -> None:
    _fs(spark, path).create(_path(spark, path), True).close()


def children(spark: SparkSession, path: str) -> list[str]:
    """Names directly under ``path``; empty if it does not exist."""
    if not exists(spark, path):
        return []
    return [s.getPath().getName() for s in _fs(spark, path).listStatus(_path(spark, path))]


def files(spark: SparkSession, path: str) -> Iterator[str]:
    """Paths of all files below ``path``, relative to it, one at a time."""
    fs = _fs(spark, path)
    root = qualified(spark, path).rstrip("/") + "/"
    found = fs.listFiles(_path(spark, path), True)
    while found.hasNext():
        yield found.next().getPath().toString()[len(root):]


def empty_files(spark: SparkSession, path: str, recursive: bool) -> Iterator[tuple[str, int]]:
    """(uri, milliseconds) of the visible files without content below ``path``, one at a time."""
    found = _fs(spark, path).listFiles(_path(spark, path), recursive)
    root = qualified(spark, path)
    while found.hasNext():
        status = found.next()
        uri = status.getPath().toString()
        hidden = any(part.startswith((".", "_")) for part in uri[len(root):].split("/"))
        if not hidden and not status.getLen():
            yield uri, status.getModificationTime()


def move(spark: SparkSession, source: str, target: str) -> None:
    fs = _fs(spark, source)
    destination = _path(spark, target)
    fs.mkdirs(destination.getParent())
    if not fs.rename(_path(spark, source), destination):
        raise OSError(f"cannot move {source} to {target}")
