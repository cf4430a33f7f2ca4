"""Every writable format goes through append, load, merge and replacement alike."""

from __future__ import annotations

import pytest
from conftest import rows

import lakeferry as lf
from lakeferry.sources.tables import table_facts

SCHEMA = "k BIGINT, v STRING, p INT"


@pytest.mark.parametrize("partitioned", [(), ("p",)])
@pytest.mark.parametrize(
    ("format", "options"),
    [("PARQUET", {}), ("ORC", {}), ("JSON", {}), ("CSV", {"header": "true", "sep": ";"})],
)
def test_a_table_of_each_format(spark, ws, format, options, partitioned):
    table = lf.Table(
        ws.table("t"), format=format, schema=SCHEMA, options=options, partitioned_by=partitioned
    )
    low = spark.range(0, 5).selectExpr("id AS k", "'a;\"x\"' AS v", "CAST(id % 2 AS INT) AS p")
    lf.write_table(spark, table, low)
    assert table_facts(spark, table).provider == format.lower()
    high = spark.range(3, 8).selectExpr("id AS k", "'b' AS v", "CAST(id % 2 AS INT) AS p")
    high.write.format(format.lower()).options(**options).save(ws.dir("in"))
    # as a load: five rows more
    assert lf.copy_into(spark, table, ws.dir("in"), format, options=options) > 0
    assert lf.copy_into(spark, table, ws.dir("in"), format, options=options) == 0
    got = lf.read_table(spark, table.identifier).select("k", "v", "p")
    assert rows(got) == rows(low.union(high))
    # as a merge: keys 3 and 4 are twice in the target by now
    lf.merge_table(spark, table, high.selectExpr("k", "'c' AS v", "p"), "k")
    expected = [(k, 'a;"x"', k % 2) for k in range(3)]
    expected += [(k, "c", k % 2) for k in (3, 3, 4, 4, 5, 6, 7)]
    got = lf.read_table(spark, table.identifier).select("k", "v", "p")
    assert rows(got) == sorted(expected, key=repr)
    lf.replace_table(spark, table, high)
    assert rows(lf.read_table(spark, table.identifier).select("k", "v", "p")) == rows(high)
    lf.drop_table(spark, table)
    assert not lf.table_exists(spark, table)


def test_everything_named_is_there():
    assert all(hasattr(lf, name) for name in lf.__all__)


def test_binary_and_text(spark, ws):
    spark.createDataFrame([("x",), ("y",)], "value string").coalesce(1).write.text(ws.dir("t"))
    assert rows(lf.read_files(spark, ws.dir("t"), "TEXT")) == [("x",), ("y",)]
    found = lf.read_files(spark, ws.dir("t"), "BINARYFILE", pattern="*.txt")
    assert [bytes(r["content"]) for r in found.collect()] == [b"x\ny\n"]


def test_libsvm(spark, ws):
    spark.createDataFrame([("1 1:0.5 3:2",), ("0 2:1",)], "value string").write.text(ws.dir("v"))
    found = lf.read_files(spark, ws.dir("v"), "LIBSVM", options={"numFeatures": 3})
    got = {r["label"]: r["features"].toArray().tolist() for r in found.collect()}
    assert got == {1.0: [0.5, 0.0, 2.0], 0.0: [0.0, 1.0, 0.0]}
