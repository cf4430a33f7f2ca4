from __future__ import annotations

from collections import defaultdict

import pytest
from cases import WORD, given, odd
from pyspark.sql import functions as F

from lakeferry.llm import mixing as M
from lakeferry.llm import queries


def fill(sizes: list[int], weights: list[int]) -> list[float]:
    """Targets by handing the excess of capped sources on until none is above its cap."""
    total, capped = float(sum(sizes)), set()
    while True:
        left = total - sum(3 * sizes[i] for i in capped)
        weight = sum(w for i, w in enumerate(weights) if i not in capped)
        found = [3.0 * s if i in capped else left * weights[i] / weight for i, s in enumerate(sizes)]
        above = {i for i, s in enumerate(sizes) if i not in capped and found[i] > 3 * s}
        if not above:
            return found
        capped |= above


@pytest.mark.parametrize("sizes", [[10, 10, 10], [1, 1000, 1, 5], [0, 7, 0, 9], [100], [3, 3, 300, 1, 1, 1, 900]])
def test_targets(spark, sizes):
    rows = [(f"s{i}", s, 1) for i, s in enumerate(sizes)]
    units = spark.createDataFrame(rows, "source string, size long, copies long")
    got = [r.target for r in M.targets(units).orderBy("source").collect()]
    assert got == pytest.approx(fill(sizes, [i % 3 + 1 for i in range(len(sizes))]))


def test_no_words(spark):
    docs = spark.createDataFrame([(1, "a", None), (2, None, "")], "doc_id long, source string, text string")
    assert {(r.target, r.times) for r in M.assign(docs).collect()} == {(0.0, 0)}


def test_taken_comes_near(spark, monkeypatch):
    docs = given(spark, "documents", "/root/testdata/sf0.01")
    found = M.assign(docs).collect()
    taken, target, largest = defaultdict(int), {}, defaultdict(int)
    for r in found:
        taken[r.source] += r.size * r.times * r.copies
        target[r.source] = r.target
        largest[r.source] = max(largest[r.source], r.size)
        assert 0 <= r.times <= 3
    for source in target:
        assert abs(taken[source] - target[source]) <= largest[source]
    monkeypatch.setattr(M, "ROWS_PER_BUCKET", 7)  # many buckets, same sums
    again = {r.id: (r.before, r.times) for r in M.assign(docs).collect()}
    assert again == {r.id: (r.before, r.times) for r in found}


def test_curriculum(spark):
    rows = [(i, f"s{i % 3}", " ".join(["w"] * 10)) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    found = M.slots(M.assign(docs)).select("source", "position").collect()
    assert all(0 <= r.position <= 1 for r in found)
    early = {s: sum(r.position < 0.5 for r in found if r.source == s) / sum(r.source == s for r in found) for s in ("s0", "s1", "s2")}
    # schedules that fall, stay and rise; their integrals to one half are 0.625, 0.5 and 0.375
    assert early["s0"] == pytest.approx(0.625, abs=0.02)
    assert early["s1"] == pytest.approx(0.5, abs=0.02)
    assert early["s2"] == pytest.approx(0.375, abs=0.02)


def test_mixed_rows(spark):
    docs = odd(spark)
    found = M.mixed(docs)
    assert found.columns == docs.columns
    units = {(r.id, r.source, r.size): r for r in M.assign(docs).collect()}
    expected, got = defaultdict(int), defaultdict(int)
    for r in docs.collect():
        key = (r.doc_id, r.source, len(WORD.findall(r.text or "")))
        expected[key] += units[key].times
    for r in found.collect():
        got[(r.doc_id, r.source, len(WORD.findall(r.text or "")))] += 1
    assert got == {k: v for k, v in expected.items() if v}
    assert M.mixed(odd(spark, empty=True)).count() == 0


def test_hot_source_has_no_large_window(spark):
    docs = spark.range(20_000).select(F.col("id").alias("doc_id"), F.lit("one").alias("source"), F.lit("a b").alias("text"))
    found = M.assign(docs)
    assert found.agg(F.sum("times")).first()[0] == 20_000
    assert found.agg(F.countDistinct("before")).first()[0] == 20_000


def test_query_is_in_training_order(spark):
    """Positions are those of the slots, the rows are sorted by them, and words are taken at them."""
    rows = [r.asDict() for r in queries.op3_mixing(spark, "/root/testdata/sf0.01").collect()]
    dues = [2.0 if r["first_position"] is None else r["first_position"] for r in rows]
    assert dues == sorted(dues)
    due = defaultdict(list)
    for r in M.slots(M.assign(given(spark, "documents", "/root/testdata/sf0.01"))).collect():
        due[r.id].append(r.position)
    for r in rows:
        own = sorted(due[r["doc_id"]])
        assert r["taken"] == r["size"] * len(own)
        assert (r["first_position"], r["last_position"]) == ((own[0], own[-1]) if own else (None, None))
