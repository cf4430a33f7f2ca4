"""Files into tables, once each, also after a crash at any point."""

from __future__ import annotations

import gzip
from pathlib import Path

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeferry.functions.types import schema_ddl
from lakeferry.operators import load as loading
from lakeferry.operators.load import bulk_write_files, copy_into, ledger, read_files_as_table
from lakeferry.operators.merge import merge_table
from lakeferry.operators.write import create_table, replace_table, write_table
from lakeferry.plans import commit
from lakeferry.sources.files import read_files, read_jdbc
from lakeferry.sources.tables import Table, read_table, table_facts
from lakeferry.streaming.ingest import read_file_stream, stream_ingest


def put(spark, path, low, high, files=3):
    spark.range(low, high, 1, files).write.mode("append").parquet(path)


def ids(spark, table):
    return sorted(r[0] for r in read_table(spark, table, ["id"]).collect())


# ---------------------------------------------------------------- scans


def test_forced_schema_reads_no_data_to_infer(spark, ws):
    put(spark, ws.dir("in"), 0, 5)
    df = read_files(spark, ws.dir("in"), "parquet", "id BIGINT, other STRING")
    assert rows(df) == [(i, None) for i in range(5)]
    assert "ReadSchema: struct<id:bigint>" in plan_of(df.select("id"))


def test_hints_change_how_text_is_parsed(spark, ws):
    Path(ws.dir("in")).mkdir(parents=True)
    (Path(ws.dir("in")) / "a.csv").write_text("id,price,code\n1,0.1234567890123456789,007\n")
    plain = read_files(spark, ws.dir("in"), "CSV", options={"header": True})
    assert plain.schema["code"].dataType == T.IntegerType()
    hinted = read_files(
        spark,
        ws.dir("in"),
        "CSV",
        {"price": "DECIMAL(20,19)", "code": "STRING"},
        force_schema=False,
        options={"header": True},
    )
    row = hinted.first()
    assert str(row["price"]) == "0.1234567890123456789" and row["code"] == "007"
    assert hinted.schema["id"].dataType == T.IntegerType()
    (Path(ws.dir("in")) / "b.csv").write_text("code,id\nx1,2\n")
    both = read_files(
        spark,
        ws.dir("in"),
        "CSV",
        {"code": "STRING", "price": "INT"},
        force_schema=False,
        options={"header": True},
    )
    assert rows(both.select("id", "price", "code")) == [(1, None, "007"), (2, None, "x1")]
    with pytest.raises(Exception, match="not a INT"):
        read_files(
            spark,
            ws.dir("in"),
            "CSV",
            {"price": "INT"},
            force_schema=False,
            options={"header": True, "mode": "FAILFAST"},
        ).collect()
    with pytest.raises(ValueError, match="zz"):
        read_files(spark, ws.dir("in"), "CSV", {"zz": "INT"}, force_schema=False)


def test_hints_on_parquet_cast(spark, ws):
    put(spark, ws.dir("in"), 0, 3)
    df = read_files(spark, ws.dir("in"), "PARQUET", {"id": "STRING"}, force_schema=False)
    assert rows(df) == [("0",), ("1",), ("2",)]


def test_csv_headers_are_merged_by_name(spark, ws):
    root = Path(ws.dir("in"))
    root.mkdir(parents=True)
    (root / "1.csv").write_text('a,"b,x"\n1,"two\nlines"\n')
    (root / "2.csv").write_text("c,a\n0.5,2\n")
    (root / "3.csv").write_text("c,a\n7,x\n")
    (root / "4.csv").write_bytes(b"")
    with gzip.open(root / "5.csv.gz", "wt") as f:
        f.write("a,d\n9,true\n")
    options = {"header": True, "multiLine": True}
    df = read_files(spark, str(root), "CSV", options=options)
    assert schema_ddl(df.select("a", "b,x", "c", "d").schema) == (
        "`a` STRING, `b,x` STRING, `c` DOUBLE, `d` BOOLEAN"
    )
    assert rows(df.select("a", "b,x", "c", "d")) == [
        ("1", "two\nlines", None, None),
        ("2", None, 0.5, None),
        ("9", None, None, True),
        ("x", None, 7.0, None),
    ]
    only = read_files(spark, str(root), "CSV", pattern="2*", options=options)
    assert rows(only) == [(0.5, 2)]


def test_merged_parquet_and_json(spark, ws):
    spark.range(2).write.parquet(ws.dir("p"))
    spark.range(2).selectExpr("id", "'x' AS s").write.mode("append").parquet(ws.dir("p"))
    assert rows(read_files(spark, ws.dir("p"), "PARQUET").select("id", "s")) == [
        (0, "x"),
        (0, None),
        (1, "x"),
        (1, None),
    ]
    spark.range(1).write.json(ws.dir("j"))
    spark.range(1).selectExpr("'y' AS t").write.mode("append").json(ws.dir("j"))
    assert set(read_files(spark, ws.dir("j"), "JSON").columns) == {"id", "t"}


def test_pattern_and_recursion(spark, ws):
    put(spark, ws.dir("in"), 0, 2)
    put(spark, ws.dir("in/sub"), 2, 4)
    spark.range(9).write.mode("append").csv(ws.dir("in"))
    assert read_files(spark, ws.dir("in"), "PARQUET", "id BIGINT", pattern=True).count() == 2
    deep = read_files(spark, ws.dir("in"), "PARQUET", "id BIGINT", pattern=True, recursive=True)
    assert deep.count() == 4


@pytest.mark.parametrize("format", ["AVRO", "DELTA"])
def test_formats_without_their_package(spark, ws, format):
    with pytest.raises(ValueError, match="package"):
        read_files(spark, ws.dir("in"), format)


def test_unknown_formats(spark):
    for bad in ("XLSX", "JDBC"):
        with pytest.raises(ValueError):
            read_files(spark, "/x", bad)
    with pytest.raises(ValueError, match="both bounds"):
        read_jdbc(spark, "jdbc:x:y", "t", partition_column="id")


# ---------------------------------------------------------------- create from files


def test_read_files_as_table(spark, ws):
    put(spark, ws.dir("in"), 0, 3)
    table = Table(ws.table("t"), schema="id BIGINT")
    read_files_as_table(spark, table, ws.dir("in"), "PARQUET")
    assert ids(spark, table.identifier) == [0, 1, 2]
    with pytest.raises(ValueError, match="exists"):
        read_files_as_table(spark, table, ws.dir("in"), "PARQUET")
    put(spark, ws.dir("in"), 3, 5)
    read_files_as_table(spark, table, ws.dir("in"), "PARQUET", replace=True)
    assert ids(spark, table.identifier) == [0, 1, 2, 3, 4]


# ---------------------------------------------------------------- copy into


def test_copy_loads_only_new_files(spark, ws):
    put(spark, ws.dir("in"), 0, 10)
    table = ws.table("t")
    assert copy_into(spark, table, ws.dir("in"), "PARQUET", files_per_batch=2) == 3
    assert copy_into(spark, table, ws.dir("in"), "PARQUET") == 0
    put(spark, ws.dir("in"), 10, 12, 1)
    assert copy_into(spark, table, ws.dir("in"), "PARQUET") == 1
    assert ids(spark, table) == list(range(12))
    assert ledger(spark, table).count() == 4


def test_copy_adds_columns(spark, ws):
    put(spark, ws.dir("in"), 0, 2)
    table = ws.table("t")
    copy_into(spark, table, ws.dir("in"), "PARQUET")
    spark.range(2, 4).selectExpr("id", "'x' AS s").write.mode("append").parquet(ws.dir("in"))
    copy_into(spark, table, ws.dir("in"), "PARQUET")
    assert rows(read_table(spark, table)) == [(0, None), (1, None), (2, "x"), (3, "x")]


def test_copy_by_content(spark, ws):
    root = Path(ws.dir("in"))
    root.mkdir(parents=True)
    (root / "a.csv").write_text("1\n")
    table = Table(ws.table("t"), schema="id INT")

    def again():
        return copy_into(spark, table, str(root), "CSV", by_content=True)

    assert again() == 1
    (root / "a.csv").touch()
    assert again() == 0
    (root / "a.csv").write_text("2\n")
    assert again() == 1
    assert ids(spark, table.identifier) == [1, 2]


def test_copy_into_a_partitioned_table(spark, ws):
    spark.range(0, 10).selectExpr("id", "id % 3 AS p").write.parquet(ws.dir("in"))
    table = Table(ws.table("t"), schema="id BIGINT, p BIGINT", partitioned_by=["p"])
    create_table(spark, table)
    copy_into(spark, table, ws.dir("in"), "PARQUET")
    copy_into(spark, table, ws.dir("in"), "PARQUET")
    assert ids(spark, table.identifier) == list(range(10))
    assert read_table(spark, table.identifier).where("p = 1").count() == 3


def test_the_ledger_outlives_merges(spark, ws):
    put(spark, ws.dir("in"), 0, 10)
    table = ws.table("t")
    copy_into(spark, table, ws.dir("in"), "PARQUET")
    merge_table(spark, table, spark.range(5, 15), "id")
    assert copy_into(spark, table, ws.dir("in"), "PARQUET") == 0
    assert ids(spark, table) == list(range(15))
    write_table(spark, table, spark.range(1), append=False)
    assert copy_into(spark, table, ws.dir("in"), "PARQUET") == 0
    replace_table(spark, table, spark.range(1))
    assert copy_into(spark, table, ws.dir("in"), "PARQUET") == 3


def test_partition_values_of_every_kind(spark, ws):
    df = spark.createDataFrame(
        [(1, "a b/c%=:'x"), (2, None), (3, "ü")], "id bigint, p string"
    ).repartition(3)
    df.write.parquet(ws.dir("in"))
    table = Table(ws.table("t"), schema="id BIGINT, p STRING", partitioned_by=["p"])
    create_table(spark, table)
    copy_into(spark, table, ws.dir("in"), "PARQUET")
    assert rows(read_table(spark, table.identifier)) == rows(df)
    assert rows(spark.table(table.name).where("p = 'ü'")) == [(3, "ü")]


class Crash(Exception):
    pass


@pytest.mark.parametrize("point", ["started", "append", "appended", "enter", "clean"])
@pytest.mark.parametrize("partitioned", [(), ("p",)])
def test_copy_survives_a_crash_at_any_point(spark, ws, monkeypatch, point, partitioned):
    spark.range(0, 20).selectExpr("id", "id % 3 AS p").repartition(4).write.parquet(ws.dir("in"))
    table = ws.table("t")
    create_table(spark, Table(table, schema="id BIGINT, p BIGINT", partitioned_by=partitioned))
    real_append, real_enter, store = commit.append_rows, commit._enter, commit.store
    real_touch, real_delete = store.touch, store.delete

    def touch(spark, path):
        real_touch(spark, path)
        if point == "started":
            raise Crash

    def append(spark, table, df, key):
        if point == "append":
            df = df.limit(7)
        real_append(spark, table, df, key)
        if point in ("append", "appended"):
            raise Crash

    def enter(*args):
        real_enter(*args)
        if point == "enter":
            raise Crash

    def delete(spark, path):
        if point == "clean" and "/started/" in path:
            raise Crash
        return real_delete(spark, path)

    with monkeypatch.context() as patch:
        patch.setattr(commit, "append_rows", append)
        patch.setattr(commit, "_enter", enter)
        patch.setattr(commit.store, "touch", touch)
        patch.setattr(commit.store, "delete", delete)
        with pytest.raises(Crash):
            copy_into(spark, table, ws.dir("in"), "PARQUET")
    copy_into(spark, table, ws.dir("in"), "PARQUET")
    copy_into(spark, table, ws.dir("in"), "PARQUET")
    assert ids(spark, table) == list(range(20))
    assert ledger(spark, table).count() == 4
    root = table_facts(spark, table).properties["lakeferry.ledger"]
    assert store.children(spark, f"{root}/started") == []


def test_the_ledger_names_the_batch_of_every_file(spark, ws):
    put(spark, ws.dir("in"), 0, 10, 3)
    table = ws.table("t")
    copy_into(spark, table, ws.dir("in"), "PARQUET", files_per_batch=2)
    batches = {r["batch"]: r["n"] for r in ledger(spark, table).groupBy("batch").agg(F.count("*").alias("n")).collect()}
    assert sorted(batches.values()) == [1, 2]
    path = spark.table(table).metadataColumn("_metadata")["file_name"]
    written = {r[0] for r in spark.table(table).select(path).distinct().collect()}
    assert {name.split("-")[1] for name in written} == set(batches)


# ---------------------------------------------------------------- directories


def test_bulk_files(spark, ws):
    spark.range(0, 6).selectExpr("id", "concat('n', id) AS name").repartition(3).write.csv(ws.dir("in"))
    table = Table(ws.table("t"), schema="id INT, name STRING")
    bulk_write_files(spark, table, ws.dir("in"), "CSV")
    assert ids(spark, table.identifier) == list(range(6))
    bulk_write_files(spark, table, ws.dir("in"), "CSV")
    assert ids(spark, table.identifier) == sorted([*range(6)] * 2)
    single = next(Path(ws.dir("in")).glob("*.csv"))
    bulk_write_files(spark, table, str(single), "CSV", append=False)
    assert read_table(spark, table.identifier).count() == len(single.read_text().splitlines())
    with pytest.raises(ValueError, match="schema"):
        bulk_write_files(spark, Table(ws.table("u")), ws.dir("in"), "CSV")


# ---------------------------------------------------------------- streams


def test_stream_ingest_is_incremental(spark, ws):
    put(spark, ws.dir("in"), 0, 10)
    table = ws.table("t")

    def run():
        stream = read_file_stream(spark, ws.dir("in"), "PARQUET", "id BIGINT", pattern=True)
        stream_ingest(stream, table, ws.dir("ck")).awaitTermination()

    run()
    run()
    put(spark, ws.dir("in"), 10, 12)
    run()
    assert ids(spark, table) == list(range(12))


def test_a_replayed_batch_adds_nothing(spark, ws, monkeypatch):
    put(spark, ws.dir("in"), 0, 10)
    table = ws.table("t")
    create_table(spark, Table(table, schema="id BIGINT"))
    real = commit.store.delete

    def run():
        stream = read_file_stream(spark, ws.dir("in"), "PARQUET", "id BIGINT")
        stream_ingest(stream, table, ws.dir("ck")).awaitTermination()

    def delete(spark, path):
        if "/started/" in path:
            raise Crash
        return real(spark, path)

    with monkeypatch.context() as patch:
        # the rows are in and entered, but the batch fails before the checkpoint knows
        patch.setattr(commit.store, "delete", delete)
        with pytest.raises(Exception, match="Crash"):
            run()
    assert ids(spark, table) == list(range(10))
    run()
    assert ids(spark, table) == list(range(10))


def test_a_new_checkpoint_is_a_new_load(spark, ws):
    """Batch numbers start over with a new checkpoint and must not be taken for done ones."""
    put(spark, ws.dir("in"), 0, 3)
    table = ws.table("t")
    for name in ("ck1", "ck2"):
        stream = read_file_stream(spark, ws.dir("in"), "PARQUET", "id BIGINT")
        stream_ingest(stream, table, ws.dir(name)).awaitTermination()
    assert ids(spark, table) == [0, 0, 1, 1, 2, 2]


def test_names_on_the_driver_are_bounded(spark, ws):
    put(spark, ws.dir("in"), 0, 10, 5)
    assert [len(c) for c in loading._chunks(iter(range(5)), 2)] == [2, 2, 1]
    assert copy_into(spark, ws.table("t"), ws.dir("in"), "PARQUET", files_per_batch=1) == 5
    assert read_table(spark, ws.table("t")).agg(F.count("*")).first()[0] == 10


# ---------------------------------------------------------------- one schema per load


@pytest.mark.parametrize("batch", [1, 100])
def test_types_do_not_depend_on_batches(spark, ws, batch):
    folder = Path(ws.dir("in"))
    folder.mkdir(parents=True)
    for i, value in enumerate(["1", "1.5"]):
        (folder / f"{i}.json").write_text(f'{{"v": {value}}}\n')
    copy_into(spark, ws.table("t"), str(folder), "JSON", files_per_batch=batch)
    assert rows(read_table(spark, ws.table("t"))) == [(1.0,), (1.5,)]
    (folder / "9.json").write_text('{"v": 7}\n')
    copy_into(spark, ws.table("t"), str(folder), "JSON", files_per_batch=batch)
    assert rows(read_table(spark, ws.table("t"))) == [(1.0,), (1.5,), (7.0,)]


def test_a_type_that_does_not_fit_is_refused_first(spark, ws):
    folder = Path(ws.dir("in"))
    folder.mkdir(parents=True)
    (folder / "0.json").write_text('{"v": 1}\n')
    copy_into(spark, ws.table("t"), str(folder), "JSON")
    (folder / "1.json").write_text('{"v": 2}\n')
    (folder / "2.json").write_text('{"v": 2.5}\n')
    with pytest.raises(ValueError, match="cannot hold"):
        copy_into(spark, ws.table("t"), str(folder), "JSON", files_per_batch=1)
    assert rows(read_table(spark, ws.table("t"))) == [(1,)]
    assert ledger(spark, ws.table("t")).count() == 1
