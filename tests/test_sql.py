from __future__ import annotations

import datetime as dt
from decimal import Decimal

import pytest
from conftest import plan_of, rows

from lakeferry.operators.sql import run_sql, where_in
from lakeferry.plans.workspace import Workspace, session_settings, shared_root


def test_constant(spark):
    assert run_sql(spark, "SELECT 1 + 1 AS v").first()["v"] == 2


def test_parameters_are_typed(spark):
    params = {
        "i": 1,
        "l": 2**40,
        "huge": 2**70,
        "f": 1.5,
        "d": Decimal("1.10"),
        "s": "it's",
        "b": True,
        "day": dt.date(2014, 1, 1),
        "items": ["x", "y"],
        "some": {3, 1, 2},
        "pairs": {"a": 1},
        "none": None,
    }
    query = "SELECT " + ", ".join(f":{name} AS {name}" for name in params)
    row = run_sql(spark, query, params).first().asDict()
    assert row == {**params, "some": [1, 2, 3], "huge": Decimal(2**70)}


def test_a_value_is_never_text_of_the_query(spark):
    df = run_sql(spark, "SELECT :v AS v", {"v": "x' OR '1' = '1"})
    assert df.first()["v"] == "x' OR '1' = '1"


def test_settings_hold_for_the_query_only(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run_sql(spark, "SELECT CAST('x' AS INT) AS v").collect()
    df = run_sql(spark, "SELECT CAST('x' AS INT) AS v", settings={"spark.sql.ansi.enabled": False})
    assert df.first()["v"] is None
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        run_sql(spark, "SELECT CAST('x' AS INT) AS v").collect()


def test_settings_come_back_after_an_error(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    with pytest.raises(ZeroDivisionError), session_settings(
        spark, {"spark.sql.shuffle.partitions": 3, "spark.sql.lakeferry.unset": "x"}
    ):
        assert spark.conf.get("spark.sql.shuffle.partitions") == "3"
        raise ZeroDivisionError
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("spark.sql.lakeferry.unset", None) is None


def test_lists(spark, ws):
    spark.range(5_000).write.parquet(ws.dir("ids"))
    ids = spark.read.parquet(ws.dir("ids"))
    short = where_in(ids, "id", [3, 3, 5, 9_999])
    assert rows(short) == [(3,), (5,)]
    assert "PushedFilters: [In(id, [3,5,9999])]" in plan_of(short)
    wide = where_in(ids, "id", range(-1, 2_000))
    assert wide.count() == 2_000
    assert "BroadcastHashJoin" in plan_of(wide) and "LeftSemi" in plan_of(wide)
    with session_settings(spark, {"spark.sql.autoBroadcastJoinThreshold": "1000b"}):
        assert "BroadcastHashJoin" not in plan_of(where_in(ids, "id", range(2_000)))


def test_the_shared_folder_is_the_sessions(spark):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")
    with Workspace(spark) as one:
        assert one.path.startswith(shared_root(spark))
        assert one.table("x").startswith("spark_catalog.lakeferry_")


def test_a_cluster_without_a_shared_folder_is_an_error(spark):
    class Conf:
        def get(self, key, default=None):
            return default

    class Context:
        master = "yarn"
        applicationId = "app"

        def getCheckpointDir(self):
            return None

    class Session:
        conf = Conf()
        sparkContext = Context()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_root(Session())
    Context.master = "local[2]"
    Context.applicationId = "app-local"
    assert shared_root(Session()) == shared_root(Session())


@pytest.mark.parametrize("n", [10, 1_500])
def test_long_and_short_lists_agree(spark, n):
    df = spark.range(2_000).selectExpr("id % 7 AS a", "cast(id AS int) AS b", "cast(id AS double) AS c", "'x' || id AS d")
    values = [*range(n), None, 2**40, 2**70, -3]
    for column in ("b", "B", "c"):
        found = where_in(df, column, values)
        assert found.columns == df.columns
        assert sorted(r.b for r in found.collect()) == list(range(n))
    assert where_in(df, "d", [f"x{i}" for i in range(n)]).count() == n
    assert where_in(df, "c", [i + 0.5 for i in range(n)]).count() == 0
    assert where_in(df, "b", []).count() == 0


@pytest.mark.parametrize("n", [3, 900])
def test_lists_of_every_kind_and_awkward_columns(spark, n):
    days = [dt.date(2020, 1, 1) + dt.timedelta(i) for i in range(n)]
    df = spark.createDataFrame(
        [(i, f"v{i}", days[0] + dt.timedelta(i), dt.datetime(2020, 1, 1) + dt.timedelta(hours=i), Decimal(i) / 4, i / 4, str(i).encode(), i % 2 == 0)
         for i in range(n + 5)],
        "`a.b` int, `c``d` string, day date, at timestamp, d decimal(10,2), f double, raw binary, flag boolean",
    )
    lists = {
        "a.b": range(n), "c`d": [f"v{i}" for i in range(n)], "day": days, "at": [dt.datetime(2020, 1, 1) + dt.timedelta(hours=i) for i in range(n)],
        "d": [Decimal(i) / 4 for i in range(n)], "f": [i / 4 for i in range(n)], "raw": [str(i).encode() for i in range(n)],
    }
    for column, values in lists.items():
        found = where_in(df, column, values)
        assert found.columns == df.columns
        assert sorted(r[0] for r in found.select("`a.b`").collect()) == list(range(n)), column
    assert where_in(df, "f", [*lists["f"], float("nan")]).count() == n
    assert where_in(df, "flag", [True]).count() == (n + 6) // 2


def test_a_long_list_narrows_the_scan(spark, ws):
    spark.range(5_000).selectExpr("id", "'v' || id AS v").write.parquet(ws.dir("ids"))
    found = where_in(spark.read.parquet(ws.dir("ids")), "id", range(100, 1_900))
    assert "GreaterThanOrEqual(id,100), LessThanOrEqual(id,1899)" in plan_of(found)
    assert found.count() == 1_800
