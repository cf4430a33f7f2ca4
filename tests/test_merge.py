"""Merges against a brute-force model, on every physical path."""

from __future__ import annotations

import random

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from lakeferry.operators import merge as operators_merge
from lakeferry.operators.merge import (
    DuplicateKeysError,
    delete_where,
    merge_statement,
    merge_table,
    merged_files,
    only_partitions,
    plan_merge,
    replace_keys,
    with_bucket,
)
from lakeferry.operators.write import write_table
from lakeferry.plans import commit, store
from lakeferry.plans.workspace import session_settings
from lakeferry.sources.tables import Table, read_table, table_facts
from lakeferry.streaming.upsert import stream_merge

SCHEMA = "k int, j string, v int"


def model(target, source, keys):
    """MERGE by hand: matched rows take the source's values, the rest of the source is added."""
    positions = [["k", "j", "v"].index(key) for key in keys]

    def key(row):
        return tuple(row[p] for p in positions)

    by_key = {}
    for row in source:
        if None not in key(row):
            by_key.setdefault(key(row), []).append(row)
    out, used = [], set()
    for row in target:
        matches = by_key.get(key(row), []) if None not in key(row) else []
        if len(matches) > 1:
            raise DuplicateKeysError
        used.update([key(row)] if matches else [])
        out.append(matches[0] if matches else row)
    return sorted(out + [r for r in source if key(r) not in used], key=repr)


def random_rows(rng, n, keys):
    return [
        (rng.choice([None, *range(keys)]), rng.choice(["x", "y", None]), rng.randrange(1000))
        for _ in range(n)
    ]


@pytest.mark.parametrize("threshold", ["10485760b", "-1"])
@pytest.mark.parametrize("partitioned", [(), ("j",)])
@pytest.mark.parametrize("keys", [["k"], ["k", "j"]])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_the_model(spark, ws, threshold, partitioned, keys, seed):
    rng = random.Random(seed)
    target = random_rows(rng, 60, 25)
    unique = {}
    for row in random_rows(rng, 30, 40):
        unique.setdefault(row[0] if keys == ["k"] else row[:2], row)
    # unmatched keys may repeat in the source
    source = [*unique.values(), (900, "x", 1), (900, "x", 2), (None, "y", 3), (None, "y", 3)]
    table = Table(ws.table("t"), schema=SCHEMA, partitioned_by=partitioned)
    write_table(spark, table, spark.createDataFrame(target, SCHEMA))
    with session_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": threshold}):
        merge_table(spark, table, spark.createDataFrame(source, SCHEMA), keys)
    got = read_table(spark, table.identifier).select("k", "j", "v")
    assert rows(got) == model(target, source, keys)


def test_many_target_rows_take_one_source_row(spark, ws):
    table = ws.table("t")
    write_table(spark, table, spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string"))
    merge_table(spark, table, spark.createDataFrame([(1, "z")], "k int, v string"), "k")
    assert rows(read_table(spark, table)) == [(1, "z"), (1, "z"), (2, "c")]


@pytest.mark.parametrize("threshold", ["10485760b", "-1"])
def test_duplicate_source_keys(spark, ws, threshold):
    table = ws.table("t")
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    write_table(spark, table, df)
    twice = spark.createDataFrame([(1, "x"), (1, "y"), (7, "u"), (7, "w")], "k int, v string")
    with session_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": threshold}):
        with pytest.raises(DuplicateKeysError):
            merge_table(spark, table, twice, "k")
        assert rows(plan_merge(spark, table, twice, "k").duplicates()) == [(1, 2)]
        assert rows(plan_merge(spark, table, twice, "k").metrics()) == [(1, 2)]
        assert rows(read_table(spark, table)) == [(1, "a"), (2, "b")]
        merge_table(spark, table, twice.where("k = 7"), "k")
    assert rows(read_table(spark, table)) == [(1, "a"), (2, "b"), (7, "u"), (7, "w")]


def test_request_is_checked(spark, ws):
    table = ws.table("t")
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    write_table(spark, table, df)
    with pytest.raises(ValueError, match="lacks"):
        merge_table(spark, table, df.select("k"), "k")
    with pytest.raises(ValueError, match="no columns"):
        merge_table(spark, table, df, "zz")
    with pytest.raises(ValueError, match="at least one"):
        merge_table(spark, table, df, [])


def test_extra_columns_are_dropped_and_order_does_not_matter(spark, ws):
    table = ws.table("t")
    write_table(spark, table, spark.createDataFrame([(1, "a")], "k int, v string"))
    source = spark.createDataFrame([("z", 1, 0.5), ("y", 2, 0.5)], "v string, k int, extra double")
    merge_table(spark, table, source, "k")
    assert rows(read_table(spark, table)) == [(1, "z"), (2, "y")]


def test_merging_twice_changes_nothing(spark, ws):
    table = ws.table("t")
    write_table(spark, table, spark.range(0, 50).selectExpr("id AS k", "'a' AS v"))
    source = spark.range(25, 75).selectExpr("id AS k", "'b' AS v")
    merge_table(spark, table, source, "k")
    once = rows(read_table(spark, table))
    merge_table(spark, table, source, "k")
    assert rows(read_table(spark, table)) == once and len(once) == 75


def test_source_may_read_the_target(spark, ws):
    table = ws.table("t")
    write_table(spark, table, spark.range(0, 5).selectExpr("id AS k", "id AS v"))
    merge_table(spark, table, spark.table(table).withColumn("v", F.col("v") * 10), "k")
    assert rows(read_table(spark, table)) == [(i, i * 10) for i in range(5)]


def test_newer_rows_only(spark, ws):
    table = ws.table("t")
    write_table(spark, table, spark.createDataFrame([(1, 5, "a"), (2, 5, "b")], "k int, at int, v string"))
    source = spark.createDataFrame([(1, 4, "old"), (2, 6, "new"), (3, 1, "c")], "k int, at int, v string")
    merge_table(spark, table, source, "k", newer_by=["at"])
    assert rows(read_table(spark, table)) == [(1, 5, "a"), (2, 6, "new"), (3, 1, "c")]


def test_only_touched_partitions_are_rewritten(spark, ws):
    table = Table(ws.table("t"), schema="k INT, p STRING", partitioned_by=["p"])
    write_table(spark, table, spark.createDataFrame([(1, "x"), (2, "y"), (3, "z")], "k int, p string"))

    def files(part):
        path = F.col("_metadata.file_path")
        return {r[0] for r in spark.table(table.name).where(f"p = '{part}'").select(path).collect()}

    before = files("z")
    # key 1 leaves partition x empty, a new partition appears
    merge_table(spark, table, spark.createDataFrame([(1, "y"), (4, "w")], "k int, p string"), "k")
    assert rows(read_table(spark, table.identifier)) == [(1, "y"), (2, "y"), (3, "z"), (4, "w")]
    assert files("z") == before
    parts = {r[0] for r in spark.sql(f"SHOW PARTITIONS {table.name}").collect()}
    assert parts == {"p=w", "p=y", "p=z"}


def test_unmanaged_table_keeps_its_location(spark, ws):
    table = Table(ws.table("t"), schema="k INT, v STRING", location=ws.dir("t"))
    write_table(spark, table, spark.createDataFrame([(1, "a")], "k int, v string"))
    where = table_facts(spark, table).location
    merge_table(spark, table, spark.createDataFrame([(1, "z"), (2, "b")], "k int, v string"), "k")
    assert rows(spark.read.parquet(ws.dir("t"))) == [(1, "z"), (2, "b")]
    assert table_facts(spark, table).location == where


def test_many_merges_leave_nothing_behind(spark, ws):
    table = ws.table("t")
    write_table(spark, table, spark.createDataFrame([(0, "a")], "k int, v string"))
    for i in range(4):
        merge_table(spark, table, spark.createDataFrame([(i, f"v{i}")], "k int, v string"), "k")
    assert rows(read_table(spark, table)) == [(i, f"v{i}") for i in range(4)]
    assert [n for n in store.children(spark, ws.dir("db")) if n.startswith("t")] == ["t"]


def names(spark, table):
    spark.catalog.refreshTable(table)
    path = spark.table(table).metadataColumn("_metadata")["file_path"]
    return {r[0] for r in spark.table(table).select(path).distinct().collect()}


@pytest.mark.parametrize("threshold", ["10485760b", "-1"])
@pytest.mark.parametrize("partitioned", [(), ("p",)])
def test_only_touched_files_are_rewritten(spark, ws, threshold, partitioned):
    table = Table(ws.table("t"), schema="k BIGINT, p BIGINT, v STRING", partitioned_by=partitioned)
    for part in range(6):
        some = spark.range(part * 10, part * 10 + 10).selectExpr("id AS k", "id % 2 AS p", "'a' AS v")
        write_table(spark, table, some.coalesce(1))
    before = names(spark, table.name)
    assert len(before) == 6 * (2 if partitioned else 1)
    with session_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": threshold}):
        merge_table(spark, table, spark.createDataFrame([(23, 1, "b")], "k long, p long, v string"), "k")
        after = names(spark, table.name)
        # one file is gone, one is new, all others have their names
        assert len(before - after) == 1 and len(after - before) == 1
        merge_table(spark, table, spark.createDataFrame([(77, 1, "b")], "k long, p long, v string"), "k")
        added = names(spark, table.name)
        assert after < added and len(added - after) == 1
        replace_keys(spark, table, spark.createDataFrame([(5, 1, "c"), (5, 1, "d")], "k long, p long, v string"), "k")
        assert len(names(spark, table.name) & before) == len(before) - 2
        delete_where(spark, table, F.col("k") == 41)
        delete_where(spark, table, F.col("k") == 4100)
        assert len(names(spark, table.name) & before) == len(before) - 3
    got = {(r.k, r.v) for r in spark.table(table.name).collect()}
    assert got == {(k, "a") for k in range(60) if k not in (5, 23, 41)} | {(23, "b"), (77, "b"), (5, "c"), (5, "d")}


@pytest.mark.parametrize("threshold", ["10485760b", "-1"])
def test_rows_that_are_not_newer_rewrite_nothing(spark, ws, threshold):
    table = ws.table("t")
    for part in range(3):
        write_table(spark, table, spark.range(part * 5, part * 5 + 5).selectExpr("id AS k", "id AS at", "'a' AS v").coalesce(1))
    before = names(spark, table)
    with session_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": threshold}):
        merge_table(spark, table, spark.range(15).selectExpr("id AS k", "id AS at", "'b' AS v"), "k", newer_by=["at"])
        assert names(spark, table) == before
        later = spark.range(15).selectExpr("id AS k", "IF(id = 7, 99, id) AS at", "'b' AS v")
        merge_table(spark, table, later, "k", newer_by=["at"])
    assert len(names(spark, table) & before) == 2
    assert rows(read_table(spark, table).where("v = 'b'")) == [(7, 99, "b")]


def test_a_streamed_batch_rewrites_its_own_files(spark, ws):
    schema = "k long, at long, v string"
    table = ws.table("t")
    for part in range(5):
        write_table(spark, table, spark.range(part * 10, part * 10 + 10).selectExpr("id AS k", "0L AS at", "'a' AS v").coalesce(1))
    before = names(spark, table)

    def run(changes):
        spark.createDataFrame(changes, schema).coalesce(1).write.mode("append").parquet(ws.dir("in"))
        stream = spark.readStream.schema(schema).parquet(ws.dir("in"))
        stream_merge(stream, table, "k", "at", ws.dir("ck")).awaitTermination()
        return names(spark, table)

    first = run([(3, 1, "b"), (3, 2, "c"), (60, 1, "n")])
    assert len(before & first) == 4
    second = run([(3, 1, "late"), (61, 1, "n")])  # an older change of a known key rewrites nothing
    assert first < second
    got = {(r.k, r.v) for r in read_table(spark, table).collect()}
    assert got == {(k, "a") for k in range(50) if k != 3} | {(3, "c"), (60, "n"), (61, "n")}


def test_awkward_partition_names(spark, ws):
    schema = "k int, p string, v int"
    table = Table(ws.table("t"), schema=schema, partitioned_by=["p"])
    values = ["a b%c", "z=1/ü", None, "100%25", "it's"]
    write_table(spark, table, spark.createDataFrame([(i, p, 0) for i, p in enumerate(values)], schema))
    merge_table(spark, table, spark.createDataFrame([(i, p, 1) for i, p in enumerate(values)], schema), "k")
    got = read_table(spark, table.identifier).select("k", "p", "v")
    assert rows(got) == rows(spark.createDataFrame([(i, p, 1) for i, p in enumerate(values)], schema))
    delete_where(spark, table, F.col("k") < 4)
    assert spark.sql(f"SHOW PARTITIONS {table.name}").count() == 1


def test_a_failing_source_leaves_the_table(spark, ws):
    table = ws.table("t")
    write_table(spark, table, spark.createDataFrame([(1, "a")], "k int, v string"))
    bad = spark.range(2).select(
        F.col("id").cast("int").alias("k"), F.raise_error(F.lit("no")).cast("string").alias("v")
    )
    with pytest.raises(Exception, match="no"):
        merge_table(spark, table, bad, "k")
    assert rows(read_table(spark, table)) == [(1, "a")]


@pytest.mark.parametrize("partitioned", [(), ("p",)])
def test_replace_keys(spark, ws, partitioned):
    schema = "k int, p string, v int"
    table = Table(ws.table("t"), schema=schema, partitioned_by=partitioned)
    target = [(1, "x", 1), (1, "x", 2), (2, "x", 3), (None, "y", 4)]
    write_table(spark, table, spark.createDataFrame(target, schema))
    source = [(1, "y", 7), (1, "y", 8), (1, "y", 9), (5, "x", 1)]
    replace_keys(spark, table, spark.createDataFrame(source, schema), "k")
    got = read_table(spark, table.identifier).select("k", "p", "v")
    assert rows(got) == sorted([(2, "x", 3), (None, "y", 4), *source], key=repr)


def test_a_small_source_does_not_move_the_target(spark, ws):
    table = ws.table("t")
    write_table(spark, table, spark.range(0, 1000).selectExpr("id AS k", "'a' AS v"))
    small = plan_merge(spark, table, spark.range(5).selectExpr("id AS k", "'b' AS v"), "k")
    plan = plan_of(small.updated())
    assert "BroadcastHashJoin" in plan and "Exchange hashpartitioning" not in plan
    with session_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        large = plan_merge(spark, table, spark.range(5).selectExpr("id AS k", "'b' AS v"), "k")
        assert not large.source_is_small
        plan = plan_of(large.result())
    assert "BroadcastExchange" not in plan and "CartesianProduct" not in plan


def test_native_statement():
    text = merge_statement(Table("c.d.t"), "src", ["a", "b"], ("at",))
    assert text == (
        "MERGE INTO `c`.`d`.`t` AS t USING src AS s ON s.`a` = t.`a` AND s.`b` = t.`b`"
        " WHEN MATCHED AND struct(s.`at`) > struct(t.`at`) THEN UPDATE SET *"
        " WHEN NOT MATCHED THEN INSERT *"
    )


def test_partition_keys_limit_the_search(spark, ws):
    """With the partition column among the keys, only the source's partitions are read."""
    table = Table(ws.table("t"), schema="k BIGINT, p BIGINT, v STRING", partitioned_by=["p"])
    write_table(spark, table, spark.range(0, 40).selectExpr("id AS k", "id % 4 AS p", "'a' AS v"))
    source = spark.range(0, 60, 4).selectExpr("id AS k", "id % 4 AS p", "'b' AS v")
    merge = plan_merge(spark, table, source, ["k", "p"])
    result = merged_files(spark, table_facts(spark, table), merge, ws.dir("scratch"))
    assert result.count() == 15 and result.where("p <> 0").count() == 0
    scoped = only_partitions(merge.target, spark.read.parquet(ws.dir("scratch/touched")), ["p"])
    assert "dynamicpruning" in plan_of(scoped)
    merge_table(spark, table, source, ["k", "p"])
    got = read_table(spark, table.identifier)
    assert got.count() == 45 and got.where("v = 'b'").count() == 15


def test_a_null_partition(spark, ws):
    schema = "k int, p string, v int"
    table = Table(ws.table("t"), schema=schema, partitioned_by=["p"])
    write_table(spark, table, spark.createDataFrame([(1, None, 1), (2, None, 2), (3, "x", 3)], schema))
    merge_table(spark, table, spark.createDataFrame([(1, "x", 10), (4, None, 4)], schema), "k")
    got = read_table(spark, table.identifier).select("k", "p", "v")
    assert rows(got) == rows(
        spark.createDataFrame([(1, "x", 10), (2, None, 2), (3, "x", 3), (4, None, 4)], schema)
    )
    # the last row of the NULL partition moves away
    merge_table(spark, table, spark.createDataFrame([(2, "y", 0), (4, "y", 0)], schema), "k")
    assert read_table(spark, table.identifier).where("p IS NULL").count() == 0
    assert spark.sql(f"SHOW PARTITIONS {table.name}").count() == 2


@pytest.mark.parametrize(
    ("partitioned", "external"), [((), True), (("p",), False), (("p",), True)]
)
def test_a_crash_in_a_merge_is_settled_by_the_next_writer(
    spark, ws, monkeypatch, partitioned, external
):
    schema = "k int, p string"
    table = Table(
        ws.table("t"),
        schema=schema,
        partitioned_by=partitioned,
        location=ws.dir("t") if external else None,
    )
    write_table(spark, table, spark.createDataFrame([(1, "x"), (2, "y"), (3, "y")], schema))

    def crash(*args):
        raise RuntimeError("crash")

    def crash_after(step):
        def run(*args):
            step(*args)
            raise RuntimeError("crash")

        return run

    source = spark.createDataFrame([(1, "z"), (4, "y")], schema)
    # before the append is complete the merge is undone, afterwards it is finished
    for name, step, merged in (
        ("append_rows", crash, False),
        ("append_rows", crash_after(commit.append_rows), False),
        ("_drop_files", crash, True),
    ):
        with monkeypatch.context() as patch:
            patch.setattr(commit, name, step)
            with pytest.raises(RuntimeError, match="crash"):
                merge_table(spark, table, source, "k")
        write_table(spark, table, spark.createDataFrame([(5, "x")], schema))
        delete_where(spark, table, F.col("k") == 5)
        got = read_table(spark, table.identifier).select("k", "p")
        expected = [(1, "z"), (2, "y"), (3, "y"), (4, "y")] if merged else [(1, "x"), (2, "y"), (3, "y")]
        assert rows(got) == expected
        assert "lakeferry.pending" not in table_facts(spark, table).properties


def test_a_compact_file_may_be_large_in_memory(spark, ws):
    """Half a million equal rows are a tiny file, but not a tiny broadcast."""
    table = ws.table("t")
    write_table(spark, table, spark.range(10).selectExpr("id AS k", "'a' AS v"))
    source = spark.range(500_000).selectExpr("id % 10 AS k", "repeat('x', 200) AS v")
    with session_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "8000000b"}):
        merge = plan_merge(spark, table, source, "k")
        assert not merge.source_is_small
        assert "BroadcastHashJoin" not in plan_of(merge.updated())


def test_a_frequent_target_key_is_split(spark, ws):
    """A third of the target has one key; adaptive execution splits it on the target side."""
    table = ws.table("t")
    rows_in = spark.range(0, 300_000, 1, 8).selectExpr(
        "IF(id % 3 = 0, 0, id) AS k", "sha2(CAST(id AS STRING), 256) AS v"
    )
    write_table(spark, table, rows_in)
    source = spark.range(0, 200_000).selectExpr("id AS k", "'new' AS v")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "1m",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    with session_settings(spark, settings):
        merge = plan_merge(spark, table, source, "k")
        result = merge.updated().groupBy((F.col("v") == "new").alias("new")).count()
        found = {r["new"]: r["count"] for r in result.collect()}
        assert "skew=true" in plan_of(result)
    # keys up to 199,999 exist in the source, the frequent key 0 among them
    above = sum(1 for i in range(200_000, 300_000) if i % 3)
    assert found == {True: 300_000 - above, False: above}


@pytest.mark.parametrize("partitioned", [(), ("p",)])
def test_delete_where(spark, ws, partitioned):
    schema = "k int, p string"
    table = Table(ws.table("t"), schema=schema, partitioned_by=partitioned)
    write_table(
        spark, table, spark.createDataFrame([(1, "x"), (2, "x"), (3, "y"), (None, "z")], schema)
    )
    delete_where(spark, table, F.col("k").isin(1, 3))
    got = read_table(spark, table.identifier).select("k", "p")
    assert rows(got) == rows(spark.createDataFrame([(2, "x"), (None, "z")], schema))
    delete_where(spark, table, F.col("k") > 100)
    assert read_table(spark, table.identifier).count() == 2


def test_buckets(spark, ws):
    table = Table(ws.table("t"), schema="id BIGINT, v STRING, bucket INT", partitioned_by=["bucket"])
    first = spark.range(100).selectExpr("id", "'a' AS v")
    write_table(spark, table, with_bucket(first, ["id"], 8))
    source = spark.range(90, 110).selectExpr("id", "'b' AS v")
    merge_table(spark, table, with_bucket(source, ["id"], 8), ["id", "bucket"])
    got = read_table(spark, table.identifier)
    assert got.groupBy("v").count().orderBy("v").collect() == [("a", 90), ("b", 20)]


def test_rows_without_keys_are_dealt_out(spark, ws):
    """95 % of the target without a key, no broadcast: no task gets them all."""
    table = ws.table("t")
    write_table(spark, table, spark.range(2_000).selectExpr("if(id % 20 = 0, id, NULL) AS k", "id AS v"))
    source = spark.range(0, 2_000, 40).selectExpr("id AS k", "-id AS v")
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": -1,
        "spark.sql.adaptive.enabled": False,
        "spark.sql.shuffle.partitions": 4,
    }
    with session_settings(spark, settings):
        merge = plan_merge(spark, Table(table), source, "k")
        sizes = [r["count"] for r in merge.updated().groupBy(F.spark_partition_id()).count().collect()]
        assert sum(sizes) == 2_000 and max(sizes) < 800
        merge_table(spark, table, source, "k")
        assert spark.table(table).where("v < 0").count() == 49
        assert spark.table(table).count() == 2_000
        replace_keys(spark, table, source.where("k > 1000"), "k")
        assert spark.table(table).count() == 2_000
        assert spark.table(table).where("k IS NULL").count() == 1_900


def test_a_large_merge_moves_numbers_of_files(spark, ws):
    table = ws.table("t")
    write_table(spark, table, spark.range(0, 100, 1, 4).selectExpr("id AS k", "'a' AS v"))
    with session_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        merge = plan_merge(spark, table, spark.range(5).selectExpr("id AS k", "'b' AS v"), "k")
        assert {f.dataType.typeName() for f in merge.hits().schema} == {"long", "boolean"}


def test_tasks_of_a_large_merge_follow_its_rows(spark, ws, monkeypatch):
    table, seen = ws.table("t"), []
    write_table(spark, table, spark.range(0, 100, 1, 4).selectExpr("id AS k", "'a' AS v"))
    files = set(read_table(spark, table).inputFiles())

    def replace(session, ref, df, staged):
        seen.append(int(session.conf.get("spark.sql.shuffle.partitions")))
        commit.replace_files(session, ref, df, staged)

    monkeypatch.setattr(operators_merge, "SHUFFLED_ROWS", 10)
    monkeypatch.setattr(operators_merge, "replace_files", replace)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with session_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        merge_table(spark, table, spark.range(75, 105).selectExpr("id AS k", "'b' AS v"), "k")
    assert seen == [13] and spark.conf.get("spark.sql.shuffle.partitions") == before
    got = read_table(spark, table)
    assert {tuple(r) for r in got.collect()} == {(k, "a" if k < 75 else "b") for k in range(105)}
    assert len(files & set(got.inputFiles())) == 3


@pytest.mark.parametrize("kind", ["PARQUET", "CSV"])
def test_files_of_one_number_are_rewritten_together(spark, ws, monkeypatch, kind):
    """Also in a format that does not count its rows."""
    table = Table(ws.table("t"), format=kind, schema="k BIGINT, v STRING")
    write_table(spark, table, spark.range(0, 40, 1, 4).selectExpr("id AS k", "'a' AS v"))
    monkeypatch.setattr(commit.F, "xxhash64", lambda *columns: F.length(columns[0]).cast("bigint"))
    merge_table(spark, table, spark.range(38, 42).selectExpr("id AS k", "'b' AS v"), "k")
    assert read_table(spark, table).groupBy("v").count().orderBy("v").collect() == [("a", 38), ("b", 4)]
