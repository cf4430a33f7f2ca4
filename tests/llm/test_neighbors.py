from __future__ import annotations

import math

import numpy as np
import pytest
from cases import given
from pyspark.sql import functions as F

from lakeferry.llm import neighbors as N


def plain(rows: list[tuple], queries, k: int = 5) -> dict:
    usable = [
        (i, v) for i, v in rows
        if i is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)
    ]
    out = {}
    for q, a in usable:
        if queries(q):
            a = np.array(a)
            found = [
                (float((a * b).sum() / (np.linalg.norm(a) * np.linalg.norm(b))), i)
                for i, b in ((i, np.array(v)) for i, v in usable if i != q and len(v) == len(a))
            ]
            out[q] = sorted(((round(-s, 12), i) for s, i in found))[:k]
    return out


def check(spark, rows, queries, asked, certain=N.CERTAIN) -> float:
    vectors = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got: dict = {}
    for r in N.nearest(vectors, asked, certain=certain).collect():
        got.setdefault(r.query_id, []).append((r["rank"], round(-r.score, 12), r.vec_id))
    expected = plain(rows, queries)
    hits = total = 0
    for q, best in expected.items():
        own = sorted(got.get(q, []))
        assert [r for r, *_ in own] == list(range(1, len(best) + 1))
        assert [(s, i) for _, s, i in own] == sorted((s, i) for _, s, i in own)
        hits += len({i for *_, i in own} & {i for _, i in best})
        total += len(best)
    assert set(got) <= set(expected)
    return hits / total


def test_recall(spark):
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in given(spark, "embeddings", "/root/testdata/sf0.1").collect()]
    asked = F.col("vec_id") % 50 == 0
    assert check(spark, rows, lambda i: i % 50 == 0, asked) >= 0.95


def test_stop_is_early(spark, monkeypatch):
    """Clustered vectors: the stopping test ends the search before all leaves are read."""
    rng = np.random.default_rng(1)
    centers = rng.normal(size=(40, 24))
    points = (centers[rng.integers(0, 40, 6000)] + 0.05 * rng.normal(size=(6000, 24)))
    units = points / np.linalg.norm(points, axis=1)[:, None]
    matrix = N.planes(24)
    tree = N.Tree(units, matrix)
    quantile = N.chi_square_quantile(0.97, N.PLANES)
    enough = lambda rows, cosines: float(np.sort(cosines)[-5]) if len(cosines) >= 5 else None
    seen = [len(tree.search(units[i], units[i] @ matrix, enough, quantile)[0]) for i in range(50)]
    assert np.mean(seen) < 3000


def test_chi_square():
    assert N.chi_square_quantile(0.95, 2) == pytest.approx(5.991, abs=1e-3)
    assert N.chi_square_quantile(0.95, 16) == pytest.approx(26.296, abs=1e-3)


def test_odd_vectors(spark):
    rng = np.random.default_rng(2)
    same = [float(x) for x in rng.normal(size=8)]
    rows = [(i, same) for i in range(30)] + [(100 + i, [float(x) for x in rng.normal(size=8)]) for i in range(30)]
    rows += [(200, None), (201, [0.0] * 8), (202, [float("nan")] * 8), (203, [None, *same[1:]]), (204, [float("inf"), *same[1:]])]
    rows += [(None, same), (205, []), (300, [1.0, 2.0, 3.0]), (301, [1.0, 2.0, 3.5]), (5, same)]
    assert check(spark, rows, lambda i: i % 5 == 0, F.col("vec_id") % 5 == 0, certain=0.9999) == 1.0
    none = spark.createDataFrame([], "vec_id long, embedding array<float>, rank int, query_id string")
    assert N.nearest(none, F.col("vec_id") % 5 == 0).count() == 0
    alone = spark.createDataFrame([(0, [1.0, 2.0])], "vec_id long, embedding array<double>")
    assert N.nearest(alone, F.col("vec_id") % 5 == 0).count() == 0


def test_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(N, "BLOCK_ROWS", 60)
    monkeypatch.setattr(N, "QUERY_ROWS", 7)
    rows = [(r.vec_id, [float(x) for x in r.embedding]) for r in given(spark, "embeddings").collect()]
    assert check(spark, rows, lambda i: i % 20 == 0, F.col("vec_id") % 20 == 0) >= 0.95
