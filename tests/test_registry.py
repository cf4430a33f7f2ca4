"""Tags, comments and streaming upserts."""

from __future__ import annotations

import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from lakeferry.operators.registry import (
    get_comment,
    get_comment_on_table,
    get_tags,
    get_tags_on_table,
    record_changes,
    replay,
    set_comment,
    set_comment_on_table,
    set_tags,
    set_tags_on_table,
    tag_maps,
    unset_tags,
    unset_tags_on_table,
)
from lakeferry.operators.write import write_table
from lakeferry.sources.tables import Table, read_table, table_facts
from lakeferry.streaming.ingest import read_file_stream, stream_ingest
from lakeferry.streaming.upsert import newest, stream_merge, stream_tags, tags_in_force


def test_replay_against_a_model(spark):
    rng = random.Random(3)
    log = [
        (rng.randrange(5), rng.choice("abc"), rng.choice([None, "x", "y"]), i) for i in range(200)
    ]
    state = {}
    for entity, name, value, _ in log:
        state[entity, name] = value
    rng.shuffle(log)
    df = spark.createDataFrame(log, "entity int, name string, value string, at int")
    expected = sorted((*k, v) for k, v in state.items() if v is not None)
    assert rows(replay(df, ["entity", "name"], "value", ["at"])) == expected


@pytest.mark.parametrize("parts", [1, 3, 1000])
def test_maps_keep_every_tag(spark, parts):
    tags = [(e, f"t{i}", f"v{i}") for e in range(3) for i in range(10 * e + 1)]
    df = spark.createDataFrame(tags, "entity int, name string, value string")
    maps = tag_maps(df, "entity", "name", "value", parts=parts).collect()
    found = sorted((m.entity, k, v) for m in maps for k, v in m.tags.items())
    assert found == sorted(tags)
    assert len(maps) == 3 if parts == 1 else len(maps) > 3


def test_one_map_however_many_tags(spark):
    tags = spark.range(30_000).selectExpr("'e' AS entity", "if(id = 5, NULL, 't' || id) AS name", "'v' AS value")
    maps = tag_maps(tags, "entity", "name", "value").collect()
    assert [(m.entity, m.part, len(m.tags)) for m in maps] == [("e", 0, 29_999)]


def test_changes_need_names(spark, ws):
    nameless = spark.createDataFrame([("e", None, "v")], "entity string, name string, value string")
    with pytest.raises(Exception, match="needs a name"):
        record_changes(spark, ws.table("registry"), nameless)


def test_registry_table(spark, ws):
    registry = ws.table("registry")
    assert rows(get_tags(spark, registry, "a.b.t")) == []
    set_tags(spark, registry, "a.b.t", {"k": "v", 2: 3})
    set_tags(spark, registry, "a.b.other", {"k": "other"})
    assert rows(get_tags(spark, registry, "a.b.t")) == [("2", "3"), ("k", "v")]
    set_tags(spark, registry, "a.b.t", {"k": "w"})
    unset_tags(spark, registry, "a.b.t", ["2"])
    assert rows(get_tags(spark, registry, "a.b.t")) == [("k", "w")]
    for call in (set_tags, unset_tags):
        with pytest.raises(ValueError):
            call(spark, registry, "a.b.t", {})


def test_many_changes_in_one_job(spark, ws):
    registry = ws.table("registry")
    changes = spark.range(1000).selectExpr(
        "concat('e', id % 10) AS entity", "'n' AS name", "CAST(id AS STRING) AS value", "id AS seq"
    )
    record_changes(spark, registry, changes)
    assert rows(get_tags(spark, registry, "e3")) == [("n", "993")]


def test_registry_comments(spark, ws):
    comments = ws.table("comments")
    assert get_comment(spark, comments, "a") is None
    set_comment(spark, comments, "a", 'it\'s "new"')
    assert get_comment(spark, comments, "a") == 'it\'s "new"'
    set_comment(spark, comments, "a", None)
    assert get_comment(spark, comments, "a") is None


def test_one_tables_own_entry(spark, ws):
    table = ws.table("t")
    write_table(spark, table, spark.range(1))
    assert get_comment_on_table(spark, table) is None
    set_comment_on_table(spark, table, "it's *new*")
    assert get_comment_on_table(spark, table) == "it's *new*"
    set_comment_on_table(spark, table, None)
    assert get_comment_on_table(spark, table) is None
    set_tags_on_table(spark, table, {"tag1": "value1", 2: 3})
    assert get_tags_on_table(spark, table) == {"tag1": "value1", "2": "3"}
    unset_tags_on_table(spark, table, ["tag1", "absent"])
    assert get_tags_on_table(spark, table) == {"2": "3"}
    for call in (set_tags_on_table, unset_tags_on_table):
        with pytest.raises(ValueError):
            call(spark, table, {})


SCHEMA = "k int, seq int, v string"


def test_newest_row_per_key(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, None), (1, 2, "b"), (2, 1, "c")], SCHEMA)
    assert rows(newest(df, ["k"], ["seq"])) == [(1, 3, None), (2, 1, "c")]


def feed(spark, ws, changes):
    df = spark.createDataFrame(changes, SCHEMA)
    df.coalesce(1).write.mode("append").parquet(ws.dir("in"))


def test_stream_merge_ignores_arrival_order(spark, ws):
    rng = random.Random(5)
    changes = [(rng.randrange(6), i, f"v{i}") for i in range(60)]
    expected = {k: (k, s, v) for k, s, v in changes}
    rng.shuffle(changes)
    for i in range(0, 60, 20):
        feed(spark, ws, changes[i : i + 20])
        stream = read_file_stream(spark, ws.dir("in"), "PARQUET", SCHEMA)
        stream_merge(stream, ws.table("t"), "k", "seq", ws.dir("ck")).awaitTermination()
    assert rows(read_table(spark, ws.table("t"))) == sorted(expected.values())
    # the same files through another checkpoint: every row is known already
    stream = read_file_stream(spark, ws.dir("in"), "PARQUET", SCHEMA)
    stream_merge(stream, ws.table("t"), "k", "seq", ws.dir("ck2")).awaitTermination()
    assert rows(read_table(spark, ws.table("t"))) == sorted(expected.values())


def test_stream_merge_refuses_null_keys(spark, ws):
    feed(spark, ws, [(None, 1, "a")])
    stream = read_file_stream(spark, ws.dir("in"), "PARQUET", SCHEMA)
    with pytest.raises(Exception, match="key column k is NULL"):
        stream_merge(stream, ws.table("t"), "k", "seq", ws.dir("ck")).awaitTermination()


def test_a_late_change_does_not_undo_a_removal(spark, ws):
    schema = "entity string, name string, value string, seq int"
    for batch in ([("e", "n", None, 5), ("e", "m", "x", 1)], [("e", "n", "old", 4)]):
        spark.createDataFrame(batch, schema).write.mode("append").parquet(ws.dir("in"))
        stream = read_file_stream(spark, ws.dir("in"), "PARQUET", schema)
        stream_tags(stream, ws.table("t"), ws.dir("ck"), order=["seq"]).awaitTermination()
    assert rows(tags_in_force(read_table(spark, ws.table("t")))) == [("e", "m", "x")]


def test_a_hot_entity_is_combined_on_the_map_side(spark):
    log = spark.range(100).select(
        F.lit("hot").alias("entity"), F.col("id").alias("at"), F.lit("v").alias("value")
    )
    plan = replay(log, ["entity"], "value", ["at"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan


def test_streams_keep_the_tables_layout(spark, ws):
    feed(spark, ws, [(1, 1, "a"), (2, 1, "b")])
    for name, start in (
        ("merged", lambda s, t: stream_merge(s, t, "k", "seq", ws.dir("ck1"))),
        ("appended", lambda s, t: stream_ingest(s, t, ws.dir("ck2"))),
    ):
        table = Table(ws.table(name), format="ORC", schema=SCHEMA, partitioned_by=["v"])
        start(read_file_stream(spark, ws.dir("in"), "PARQUET", SCHEMA), table).awaitTermination()
        facts = table_facts(spark, table)
        assert (facts.provider, facts.partition_columns) == ("orc", ("v",))
        assert spark.table(table.name).count() == 2
