"""Trees of files as rows: ingest, sync, list, export, drop."""

from __future__ import annotations

import hashlib
from pathlib import Path

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from lakeferry.operators import volumes
from lakeferry.operators.volumes import (
    FileConflictError,
    content_table,
    drop_files,
    drop_unused_content,
    export_files,
    in_subtree,
    ingest_tree,
    list_files,
    move_files,
    put_files,
    stored_files,
    sync_plan,
)
from lakeferry.plans import store
from lakeferry.sources.files import read_files
from lakeferry.sources.tables import read_table, table_facts
from lakeferry.sources.trees import FILES_SCHEMA, hash_tree, list_tree, read_tree

TREE = {
    "file": b"one",
    "sub/file": b"",
    "sub/sub2/file": bytes(range(256)) * 50,
    "sub1/file": "größer".encode(),
    "same": b"one",
    "odd names/a%20b #1?.txt": b"odd",
}


def grow(root, tree=TREE):
    for name, content in tree.items():
        path = Path(root) / name
        path.parent.mkdir(parents=True, exist_ok=True)
        path.write_bytes(content)


def expected(tree=TREE, prefix=""):
    return sorted(
        (prefix + name, len(content), hashlib.sha256(content).hexdigest())
        for name, content in tree.items()
    )


def on_disk(root):
    return {
        str(p.relative_to(root)): p.read_bytes() for p in Path(root).rglob("*") if p.is_file()
    }


def exported(root):
    """Without the checksum files that a Hadoop local file system may leave."""
    return {k: v for k, v in on_disk(root).items() if not k.rsplit("/", 1)[-1].startswith(".")}


def test_read_a_tree(spark, ws):
    grow(ws.dir("in"), {**TREE, ".hidden": b"x", "_meta": b"y", ".dir/file": b"z"})
    files = read_tree(spark, ws.dir("in"))
    assert files.schema.simpleString() == spark.createDataFrame([], FILES_SCHEMA).schema.simpleString()
    assert rows(list_files(files)) == expected()
    assert rows(list_files(read_tree(spark, ws.dir("in"), prefix="/pre/fix/"))) == expected(
        prefix="pre/fix/"
    )
    single = read_tree(spark, ws.dir("in") + "/sub1/file", prefix="up")
    assert [r.path for r in single.collect()] == ["up/file"]


@pytest.mark.parametrize("part_bytes", [1, 100, 256, 12_800, 10**6])
def test_parts_hold_whole_files(spark, ws, part_bytes):
    tree = {k: v[:300] for k, v in TREE.items()} if part_bytes == 1 else TREE
    grow(ws.dir("in"), tree)
    files = read_tree(spark, ws.dir("in"), part_bytes=part_bytes)
    parts = {}
    for row in files.orderBy("path", "part").collect():
        assert len(row.content) <= part_bytes
        parts.setdefault(row.path, []).append(row)
    assert rows(list_files(files)) == expected(tree)
    for name, found in parts.items():
        assert [r.part for r in found] == list(range(found[0].n_parts))
        assert b"".join(bytes(r.content) for r in found) == tree[name]


def test_listing_reads_no_content(spark, ws):
    grow(ws.dir("in"))
    plan = list_tree(spark, ws.dir("in"))._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan


@pytest.mark.parametrize("part_bytes", [64, 10**6])
def test_export_and_back(spark, ws, part_bytes):
    grow(ws.dir("in"))
    files = read_tree(spark, ws.dir("in"), part_bytes=part_bytes)
    report = export_files(spark, files, ws.dir("out"))
    assert exported(ws.dir("out")) == TREE
    assert rows(report) == [(p, n) for p, n, _ in expected()]
    export_files(spark, files, ws.dir("out"))
    assert exported(ws.dir("out")) == TREE


def test_export_of_a_subtree(spark, ws):
    grow(ws.dir("in"))
    files = read_tree(spark, ws.dir("in"))
    export_files(spark, files, ws.dir("out"), prefix="sub")
    assert exported(ws.dir("out")) == {"file": b"", "sub2/file": TREE["sub/sub2/file"]}
    export_files(spark, files, ws.dir("one"), prefix="sub1/file")
    assert exported(ws.dir("one")) == {"file": TREE["sub1/file"]}


def test_export_stays_inside_its_target(spark, ws):
    files = spark.createDataFrame([("../x", 1, "h", 0, 1, b"x")], FILES_SCHEMA)
    with pytest.raises(Exception, match="outside"):
        export_files(spark, files, ws.dir("out"))


def test_subtrees(spark):
    paths = spark.createDataFrame([("a/b",), ("a/b/x",), ("a/b1/x",), ("b",)], "path string")

    def under(prefix):
        return [r[0] for r in rows(paths.where(in_subtree(F.col("path"), prefix)))]

    assert under("a/b") == under("/a/b/") == ["a/b", "a/b/x"]
    assert under("a") == ["a/b", "a/b/x", "a/b1/x"]
    assert len(under("")) == 4


def test_plan(spark):
    listing = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "path string, sha256 string")
    manifest = spark.createDataFrame([("a", "1"), ("b", "x"), ("z", "9")], "path string, sha256 string")
    assert rows(sync_plan(listing, manifest).select("path", "action")) == [
        ("a", "same"),
        ("b", "changed"),
        ("c", "new"),
    ]


@pytest.mark.parametrize("part_bytes", [64, 10**6])
def test_sync(spark, ws, part_bytes):
    table = ws.table("files")
    grow(ws.dir("in"))

    def again(**options):
        return ingest_tree(spark, table, ws.dir("in"), part_bytes=part_bytes, **options)

    assert again() == {"new": 6, "changed": 0, "same": 0}
    assert again() == {"new": 0, "changed": 0, "same": 6}
    tree = {**TREE, "file": b"two", "sub/sub2/file": b"short", "new/file": bytes(1000)}
    grow(ws.dir("in"), tree)
    assert again() == {"new": 1, "changed": 2, "same": 4}
    assert rows(list_files(read_table(spark, table))) == expected(tree)
    export_files(spark, stored_files(spark, table), ws.dir("out"))
    assert exported(ws.dir("out")) == tree
    assert again(if_exists="replace") == {"new": 0, "changed": 7, "same": 0}
    assert rows(list_files(read_table(spark, table))) == expected(tree)


def test_conflicts(spark, ws):
    table = ws.table("files")
    grow(ws.dir("in"), {"a": b"1"})
    assert ingest_tree(spark, table, ws.dir("in"), if_exists="error")["new"] == 1
    with pytest.raises(FileConflictError, match="'a'"):
        ingest_tree(spark, table, ws.dir("in"), if_exists="error")
    with pytest.raises(ValueError):
        ingest_tree(spark, table, ws.dir("in"), if_exists="maybe")


def test_sync_opens_only_planned_files(spark, ws, monkeypatch):
    table = ws.table("files")
    grow(ws.dir("in"))
    ingest_tree(spark, table, ws.dir("in"))
    grow(ws.dir("in"), {"file": b"two"})
    asked = []
    real = volumes.read_listed
    monkeypatch.setattr(
        volumes, "read_listed", lambda files, **k: asked.extend(rows(files.select("path"))) or real(files, **k)
    )
    ingest_tree(spark, table, ws.dir("in"))
    assert asked == [("file",)]


def test_drop(spark, ws):
    table = ws.table("files")
    grow(ws.dir("in"))
    ingest_tree(spark, table, ws.dir("in"))
    drop_files(spark, table, "sub")
    assert [r.path for r in list_files(read_table(spark, table)).orderBy("path").collect()] == [
        "file",
        "odd names/a%20b #1?.txt",
        "same",
        "sub1/file",
    ]
    drop_files(spark, table)
    assert read_table(spark, table).count() == 0


def content_bytes(spark, table):
    return store.tree_bytes(spark, table_facts(spark, content_table(table)).location)


def test_moves_drops_and_copies_write_no_content(spark, ws):
    table = ws.table("files")
    tree = {f"d{i}/f{j}": bytes([i, j]) * 500 for i in range(3) for j in range(4)}
    grow(ws.dir("in"), tree)
    ingest_tree(spark, table, ws.dir("in"))
    before = content_bytes(spark, table)
    assert spark.table(content_table(table).name).count() == 12
    move_files(spark, table, "d0", "moved/deep")
    move_files(spark, table, "d1/f0", "single")
    drop_files(spark, table, "d2")
    # files that were renamed or copied outside come back under other paths
    grow(ws.dir("again"), {"copy/a": tree["d2/f1"], "copy/b": tree["d2/f1"], "copy/c": tree["d0/f0"]})
    assert ingest_tree(spark, table, ws.dir("again")) == {"new": 3, "changed": 0, "same": 0}
    assert content_bytes(spark, table) == before
    now = {k.replace("d0/", "moved/deep/"): v for k, v in tree.items() if k[:2] in ("d0", "d1")}
    now["single"] = now.pop("d1/f0")
    now |= {"copy/a": tree["d2/f1"], "copy/b": tree["d2/f1"], "copy/c": tree["d0/f0"]}
    assert {r.path: bytes(r.content) for r in stored_files(spark, table).collect()} == now
    with pytest.raises(FileConflictError):
        move_files(spark, table, "d1", "moved/deep")
    with pytest.raises(FileConflictError):
        move_files(spark, table, "single", "copy/a")
    drop_unused_content(spark, table)
    assert spark.table(content_table(table).name).count() == 9
    assert {r.path: bytes(r.content) for r in stored_files(spark, table).collect()} == now


def test_put_files(spark, ws):
    table = ws.table("files")
    grow(ws.dir("in"))
    put_files(spark, table, read_tree(spark, ws.dir("in"), part_bytes=1000))
    assert {r.path for r in list_files(read_table(spark, table)).collect()} == set(TREE)
    # "file" and "same" have one content
    assert spark.table(content_table(table).name).where("part = 0").count() == len(TREE) - 1
    put_files(spark, table, read_tree(spark, ws.dir("in"), prefix="more", part_bytes=1000))
    export_files(spark, stored_files(spark, table, "more"), ws.dir("out"), prefix="more")
    assert exported(ws.dir("out")) == TREE


def test_a_crash_between_content_and_manifest(spark, ws, monkeypatch):
    table = ws.table("files")
    grow(ws.dir("in"))

    def crash(*args):
        raise RuntimeError("crash")

    with monkeypatch.context() as patch:
        patch.setattr(volumes, "merge_table", crash)
        with pytest.raises(RuntimeError):
            ingest_tree(spark, table, ws.dir("in"))
    assert read_table(spark, table).isEmpty()
    assert ingest_tree(spark, table, ws.dir("in"))["new"] == len(TREE)
    assert {r.path: bytes(r.content) for r in stored_files(spark, table).collect()} == TREE


@pytest.fixture
def linked(spark, ws):
    """A folder under a name that only Hadoop file systems resolve."""
    Path(ws.dir("in")).mkdir(parents=True, exist_ok=True)
    conf = spark._jsc.hadoopConfiguration()
    conf.set("fs.viewfs.mounttable.far.link./in", f"file://{ws.dir('in')}")
    conf.set("fs.viewfs.impl.disable.cache", "true")
    yield "viewfs://far/in"
    conf.unset("fs.viewfs.mounttable.far.link./in")


@pytest.mark.parametrize("part_bytes", [1000, 10**6])
def test_files_that_only_spark_can_open(spark, ws, linked, part_bytes):
    grow(ws.dir("in"), {**TREE, ".hidden/x": b"", "_y": b""})
    assert rows(list_files(read_tree(spark, linked, part_bytes=part_bytes))) == expected()
    table = ws.table("files")
    assert ingest_tree(spark, table, linked, part_bytes=part_bytes)["new"] == len(TREE)
    grow(ws.dir("in"), {"file": b"two", "sub/again": TREE["sub/sub2/file"]})
    assert ingest_tree(spark, table, linked, part_bytes=part_bytes) == {"new": 1, "changed": 1, "same": len(TREE) - 1}
    tree = {**TREE, "file": b"two", "sub/again": TREE["sub/sub2/file"]}
    export_files(spark, stored_files(spark, table), ws.dir("out"))
    assert exported(ws.dir("out")) == tree


def test_csv_headers_that_only_spark_can_open(spark, ws, linked):
    grow(ws.dir("in"), {"a 1.csv": b"x,y\n1,2\n", "b.csv": b"y,z\r\n3,4\r\n"})
    df = read_files(spark, linked, "CSV", options={"header": True})
    assert {(r.x, r.y, r.z) for r in df.collect()} == {(1, 2, None), (None, 3, 4)}


def test_tasks_do_not_follow_small_files(spark, ws):
    """Two hundred files are four tasks, one for each core; Spark's own scan has one for 32 files."""
    grow(ws.dir("in"), {f"{i % 3}/{i}": b"%d" % i for i in range(200)})
    files = read_tree(spark, ws.dir("in"))
    assert files.rdd.getNumPartitions() == 4
    assert files.count() == 200 == hash_tree(spark, ws.dir("in")).count()


def test_hidden_names_are_spark_s(spark, ws):
    names = ["_a", "_a=b", ".c", "_metadata", "_common_metadata2", "d._COPYING_", "e=_f", "_x/g", "_x=y/h", ".z/i", "_metadata2/j"]
    grow(ws.dir("in"), {f"{top}{name}": b"x" for name in names for top in ("", "sub/")})
    seen = rows(list_tree(spark, ws.dir("in")).select("uri"))
    assert rows(hash_tree(spark, ws.dir("in")).select("uri")) == seen
    assert rows(read_tree(spark, ws.dir("in"), absolute=True).select("path")) == seen
    for pattern in ("*=*", "?"):
        assert rows(hash_tree(spark, ws.dir("in"), pattern=pattern).select("uri")) == rows(list_tree(spark, ws.dir("in"), pattern=pattern).select("uri"))
    flat = {r.uri.rsplit("/", 1)[-1] for r in hash_tree(spark, ws.dir("in"), recursive=False).collect()}
    assert flat == {"_a=b", "e=_f"}


def test_tasks_do_not_follow_small_files_in_parts(spark, ws):
    grow(ws.dir("in"), {f"{i % 3}/{i}": b"%04d" % i for i in range(200)})
    files = read_tree(spark, ws.dir("in"), part_bytes=3)
    assert files.rdd.getNumPartitions() == 5  # four, and one for files of one part
    assert files.count() == 400
    export_files(spark, files, ws.dir("out"))
    assert exported(ws.dir("out")) == {f"{i % 3}/{i}": b"%04d" % i for i in range(200)}


def test_writers_do_not_follow_the_row_groups_of_the_input(spark, ws):
    """Files from a single row group, which one task reads, are written by a task for each core."""
    tree = {f"{i % 3}/{i}": hashlib.shake_128(b"%d" % i).digest(20_000) for i in range(400)}
    given = [(k, len(v), "h", 0, 1, v) for k, v in tree.items()]
    spark.createDataFrame(given, FILES_SCHEMA).coalesce(1).write.parquet(ws.dir("given"))
    report = export_files(spark, spark.read.parquet(ws.dir("given")), ws.dir("out"))
    assert exported(ws.dir("out")) == tree
    assert rows(report) == sorted((k, len(v)) for k, v in tree.items())
    assert report.select(F.input_file_name()).distinct().count() == 4


def test_only_uneven_files_move(spark):
    even = spark.range(0, 400, 1, 4).select(F.col("id").cast("string").alias("path"))
    assert volumes._spread(even) is even
    assert volumes._spread(even.where("false")).isEmpty()
    few = spark.range(0, 20, 1, 1).select(F.col("id").cast("string").alias("path"))
    assert volumes._spread(few) is few
    assert sorted(r.path for r in volumes._spread(even.coalesce(1)).collect()) == sorted(r.path for r in even.collect())
    assert "REBALANCE" in plan_of(volumes._spread(even.coalesce(1)))


@pytest.mark.parametrize("paths", [["a/.."], ["../out", "../x"], ["a/x", "a/../../x"], ["/x"]])
def test_no_path_leads_outside(spark, ws, paths):
    files = spark.createDataFrame([(p, 1, "h", 0, 1, b"x") for p in paths], FILES_SCHEMA).coalesce(1)
    with pytest.raises(Exception, match="outside"):
        export_files(spark, files, ws.dir("out"))
    assert not Path(ws.dir("x")).exists()
