"""SQL text: parameters, lists, settings, and one query per relational feature."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lakeferry.operators.sql import run_sql, where_in
from workloads.base import load, views


def _text(query: str, params: dict[str, object] | None = None, settings=None):
    def run(spark: SparkSession, sf: str) -> DataFrame:
        views(spark, sf, query)
        return run_sql(spark, query, params, settings=settings)

    return run


def _in_list(spark: SparkSession, sf: str) -> DataFrame:
    orders = load(spark, sf, "orders").select("o_orderkey", "o_orderpriority")
    return where_in(orders, "o_orderpriority", ["1-URGENT", "2-HIGH"])


def _in_long_list(spark: SparkSession, sf: str) -> DataFrame:
    """Beyond the inline bound the list is a join side."""
    orders = load(spark, sf, "orders").select("o_orderkey", "o_custkey")
    return where_in(orders, "o_custkey", range(1, 1_400))


# Same text for Spark and for the check.
_SHARED = {
    "sql_const": "SELECT count(*) AS n, count(DISTINCT o_custkey) AS customers FROM orders",
    "sql_filter": """
        SELECT o_orderkey, CASE WHEN o_totalprice > 200000 THEN 'big' ELSE 'small' END AS size
        FROM orders WHERE o_orderpriority LIKE '1-%' AND o_totalprice BETWEEN 1000 AND 300000""",
    "sql_join_inner": """
        SELECT o.o_orderkey, c.c_name, n.n_name FROM orders o
        JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey""",
    "sql_join_outer": """
        SELECT c.c_custkey, count(o.o_orderkey) AS n
        FROM customer c LEFT JOIN orders o ON o.o_custkey = c.c_custkey GROUP BY c.c_custkey""",
    "sql_join_semi": """
        SELECT c_custkey FROM customer c WHERE EXISTS
        (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P')""",
    "sql_join_anti": """
        SELECT c_custkey FROM customer c WHERE NOT EXISTS
        (SELECT 1 FROM orders o WHERE o.o_custkey = c.c_custkey AND o.o_orderstatus = 'P')""",
    "sql_agg": """
        SELECT l_returnflag, l_linestatus, count(*) AS n, count(DISTINCT l_suppkey) AS n_supp,
               max(l_quantity) AS max_q
        FROM lineitem GROUP BY l_returnflag, l_linestatus""",
    "sql_rollup": """
        SELECT o_orderstatus, o_orderpriority, count(*) AS n
        FROM orders GROUP BY ROLLUP (o_orderstatus, o_orderpriority)""",
    "sql_cube": "SELECT p_brand, p_type, count(*) AS n FROM part GROUP BY CUBE (p_brand, p_type)",
    "sql_topk": """
        SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 20""",
    "sql_setops": """
        (SELECT o_custkey AS k FROM orders INTERSECT
         SELECT c_custkey FROM customer WHERE c_nationkey < 10)
        EXCEPT SELECT c_custkey FROM customer WHERE c_mktsegment = 'HOUSEHOLD'""",
    "sql_union": """
        SELECT 'customer' AS kind, c_nationkey AS nation FROM customer
        UNION SELECT 'supplier', s_nationkey FROM supplier""",
    "sql_scalar": """
        SELECT o_orderkey, upper(substr(o_orderpriority, 3)) AS p,
               CAST(year(o_orderdate) AS BIGINT) AS y, abs(o_custkey - 500) AS d
        FROM orders""",
    "sql_tumbling": """
        SELECT CAST(date_trunc('day', ts) AS DATE) AS day, event_type, count(*) AS n
        FROM events GROUP BY 1, 2""",
}

# A user with very many events is spread over the hours; what an hour needs from the hours before
# it is carried by one row per user and hour.
_ASOF = """
    WITH e AS (SELECT event_id, user_id, event_type, ts, date_trunc('hour', ts) AS h,
                      CASE WHEN event_type = 'purchase' THEN event_id END AS bought
               FROM events),
         hours AS (SELECT user_id, h, max_by(bought, ts) FILTER (WHERE bought IS NOT NULL) AS bought
                   FROM e GROUP BY user_id, h),
         carried AS (SELECT user_id, h, last_value(bought) IGNORE NULLS OVER
                        (PARTITION BY user_id ORDER BY h
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS bought
                     FROM hours),
         within AS (SELECT event_id, user_id, event_type, h, last_value(bought) IGNORE NULLS OVER
                       (PARTITION BY user_id, h ORDER BY ts
                        RANGE BETWEEN UNBOUNDED PRECEDING
                                  AND INTERVAL '0.000001' SECOND PRECEDING) AS bought
                    FROM e)
    SELECT w.event_id, coalesce(w.bought, c.bought) AS prev_purchase
    FROM within w JOIN carried c ON w.user_id = c.user_id AND w.h = c.h
    WHERE w.event_type = 'click'"""

_WINDOW = """
    WITH e AS (SELECT event_id, user_id, ts, date_trunc('hour', ts) AS h FROM events),
         hours AS (SELECT user_id, h, count(*) AS n, max_by(event_id, struct(ts, event_id)) AS last
                   FROM e GROUP BY user_id, h),
         carried AS (SELECT user_id, h, coalesce(sum(n) OVER w, 0) AS before,
                            last_value(last) OVER w AS last
                     FROM hours
                     WINDOW w AS (PARTITION BY user_id ORDER BY h
                                  ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
    SELECT e.event_id, c.before + row_number() OVER v AS rn,
           coalesce(lag(e.event_id) OVER v, c.last) AS prev,
           count(*) OVER f + least(3 - count(*) OVER f, c.before) AS c3
    FROM e JOIN carried c ON e.user_id = c.user_id AND e.h = c.h
    WINDOW v AS (PARTITION BY e.user_id, e.h ORDER BY e.ts, e.event_id),
           f AS (PARTITION BY e.user_id, e.h ORDER BY e.ts, e.event_id
                 ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)"""

_BANDS = "(VALUES ('low', 0, 50000), ('middle', 50000, 200000), ('high', 200000, 1000000))"

# A range join through cells of fixed width: the join is on the cell, the range is a filter on it.
_RANGE = f"""
    WITH cells AS (SELECT band, low, high,
                          explode(sequence(low DIV 10000, (high - 1) DIV 10000)) AS cell
                   FROM {_BANDS} AS b(band, low, high))
    SELECT c.band, count(*) AS n FROM orders o
    JOIN cells c ON CAST(floor(o.o_totalprice / 10000) AS INT) = c.cell
                AND o.o_totalprice >= c.low AND o.o_totalprice < c.high
    GROUP BY c.band"""

QUERIES = {
    **{key: _text(query) for key, query in _SHARED.items()},
    "sql_params": _text(
        "SELECT count(*) AS n FROM orders WHERE o_orderstatus = :s AND o_totalprice > :p",
        {"s": "F", "p": 1000.0},
    ),
    "sql_list_param": _text(
        "SELECT o_orderkey FROM orders WHERE array_contains(:wanted, o_orderpriority)",
        {"wanted": ["1-URGENT", "5-LOW"]},
    ),
    "sql_in_list": _in_list,
    "sql_in_long_list": _in_long_list,
    "sql_session_conf": _text(
        "SELECT count(*) AS n FROM customer WHERE CAST(c_name AS INT) IS NULL",
        settings={"spark.sql.ansi.enabled": False},
    ),
    "sql_join_range": _text(_RANGE),
    "sql_join_asof": _text(_ASOF),
    "sql_window": _text(_WINDOW),
    "sql_json": _text(
        "SELECT get_json_object(props, '$.k') AS k, count(*) AS n FROM events GROUP BY 1"
    ),
    "sql_arrays": _text(
        "SELECT label, count(*) AS n FROM embeddings LATERAL VIEW explode(embedding) t AS x "
        "WHERE x > 0 GROUP BY label"
    ),
}

ORACLES = {
    **_SHARED,
    "sql_params": "SELECT count(*) AS n FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 1000.0",
    "sql_list_param": "SELECT o_orderkey FROM orders WHERE o_orderpriority IN ('1-URGENT', '5-LOW')",
    "sql_in_list": """
        SELECT o_orderkey, o_orderpriority FROM orders
        WHERE o_orderpriority IN ('1-URGENT', '2-HIGH')""",
    "sql_in_long_list": "SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey BETWEEN 1 AND 1399",
    "sql_session_conf": """
        SELECT count(*) AS n FROM customer WHERE TRY_CAST(c_name AS INTEGER) IS NULL""",
    "sql_join_range": f"""
        SELECT b.band, count(*) AS n FROM orders o
        JOIN {_BANDS} AS b(band, low, high)
          ON o.o_totalprice >= b.low AND o.o_totalprice < b.high
        GROUP BY b.band""",
    "sql_join_asof": """
        SELECT e.event_id,
               (SELECT arg_max(p.event_id, p.ts) FROM events p
                WHERE p.user_id = e.user_id AND p.event_type = 'purchase' AND p.ts < e.ts)
               AS prev_purchase
        FROM events e WHERE e.event_type = 'click'""",
    "sql_window": """
        SELECT event_id, row_number() OVER w AS rn, lag(event_id) OVER w AS prev,
               count(*) OVER (PARTITION BY user_id ORDER BY ts, event_id
                              ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS c3
        FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
    "sql_json": "SELECT json_extract_string(props, '$.k') AS k, count(*) AS n FROM events GROUP BY 1",
    "sql_arrays": """
        SELECT label, count(*) AS n FROM (SELECT label, unnest(embedding) AS x FROM embeddings)
        WHERE x > 0 GROUP BY label""",
}
