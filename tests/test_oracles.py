"""Every registered query against its SQL, on the smallest given tables."""

from __future__ import annotations

import importlib.util
from pathlib import Path

import duckdb
import pytest

from lakeferry.plans.workspace import close_all
from workloads import merges, reads, schemas, sqltext, streams, trees, writes
from workloads.base import TABLES

SF = "/root/testdata/sf0.001"
ENTRY = Path(__file__).resolve().parent.parent / "__spark_entry__.py"

spec = importlib.util.spec_from_file_location("spark_entry", ENTRY)
entry = importlib.util.module_from_spec(spec)
spec.loader.exec_module(entry)

pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="the given tables are not here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return con


def normal(columns, found):
    order = sorted(columns)
    at = [columns.index(c) for c in order]
    return order, sorted(
        tuple(f"{type(row[i]).__name__}:{row[i]!r}" for i in at) for row in found
    )


OWN = [key for module in (reads, writes, merges, sqltext, schemas, trees, streams) for key in module.QUERIES]


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(entry.queries()) and set(OWN) <= set(entry.oracle_sql())


@pytest.mark.parametrize("key", sorted(OWN))
def test_same_result(spark, duck, key):
    df = entry.queries()[key](spark, SF)
    got = normal(df.columns, [tuple(r) for r in df.collect()])
    close_all()
    result = duck.execute(entry.oracle_sql()[key])
    expected = normal([c[0] for c in result.description], result.fetchall())
    assert got == expected
    assert got[1], "the result is empty"


def test_entry(spark):
    assert entry.entry(spark).count() > 0
