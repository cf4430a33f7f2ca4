from __future__ import annotations

import random
from collections import defaultdict
from itertools import combinations

import pytest
from cases import WORD, given, odd, prose
from pyspark.sql import Window
from pyspark.sql import functions as F

from lakeferry.llm import near_dup as N
from lakeferry.llm.components import components
from lakeferry.llm.scratch import Scratch

LOWER = {c: c + 32 for c in range(65, 91)}


def shingles(text: str | None) -> frozenset:
    words = WORD.findall((text or "").translate(LOWER))
    if len(words) < 5:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + 5]) for i in range(len(words) - 4))


def plain(rows: list[tuple]) -> dict:
    """id -> (set size, component) by comparing all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in rows}
    holders = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            holders[x].append(i)
    shared = defaultdict(int)
    for ids in holders.values():
        for pair in combinations(sorted(ids), 2):
            shared[pair] += 1
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i: (len(s), find(i)) for i, s in sets.items()}


def check(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in N.near_duplicates(docs).collect()}
    assert got == plain(rows)
    return got


def test_given_documents(spark):
    check(spark, [(r.doc_id, r.text) for r in given(spark, "documents").collect()])


def edited(text: str, share: float, rng: random.Random) -> str:
    words = text.split()
    return " ".join(f"new{rng.random()}" if rng.random() < share else w for w in words)


def test_hot_groups(spark):
    """Exact and near copies, a chain of edits, a passage that hundreds share, and similar sets
    below the threshold, all larger than a node may be."""
    rng = random.Random(5)
    base, passage, template = prose(7, 150), prose(8, 40), prose(9, 200).split()
    rows = [(i, base) for i in range(150)]
    rows += [(200 + i, edited(base, 0.01, rng)) for i in range(150)]
    chain = prose(10, 120)
    for i in range(60):
        rows.append((400 + i, chain))
        chain = edited(chain, 0.02, rng)
    rows += [(500 + i, passage + " " + prose(1000 + i, 60)) for i in range(200)]
    rows += [(800 + i, " ".join([*template[:150], *prose(3000 + i, 40).split()])) for i in range(120)]
    rng.shuffle(rows)
    got = check(spark, rows)
    assert len({c for _, c in got.values()}) > 200


def test_nodes_that_never_part(spark, monkeypatch):
    """With no levels left, large nodes are compared block by block."""
    monkeypatch.setattr(N, "DEPTH", 0)
    monkeypatch.setattr(N, "MINORITY", 3)
    rows = [(i, " ".join([prose(9, 100), prose(100 + i // 4, 40)]) + f" {i}") for i in range(60)]
    check(spark, rows)


def test_pairs_meet_after_many_levels(spark):
    """Of 400 pairs whose tokens agree with the threshold's probability, every one still has a
    common node after ten levels."""
    rng = random.Random(11)
    rows = []
    for pair in range(400):
        tokens = bytes(rng.randrange(256) for _ in range(N.TOKENS))
        other = bytes(t if rng.random() < 0.75 else (t + 1) % 256 for t in tokens)
        for side, held in enumerate((tokens, other)):
            rows += [((pair * 100 + root) * 256 + held[root], 2 * pair + side, pair, 1, bytearray(held)) for root in range(N.ROOTS)]
    members = spark.createDataFrame(rows, "node long, id long, component long, n long, tokens binary")
    met = lambda df: df.withColumn("many", F.count("*").over(Window.partitionBy("node"))).where("many > 1").drop("many")
    for _ in range(10):
        members = met(N._branched(met(members))).localCheckpoint()
    assert members.select("component").distinct().count() == 400


def test_recall_of_trees():
    """The branching rate keeps its promise at every depth, and the sum agrees with a simulation."""
    assert all(N.missed(N.TWICE, depth) <= N.MISSED for depth in range(N.DEPTH + 1))
    assert N.missed(1 / 3, 8) > 0.01
    rng, runs = random.Random(3), 4000

    def meets(equal: int, depth: int) -> bool:
        if rng.random() >= equal / N.TOKENS:
            return False
        return not depth or any(meets(equal, depth - 1) for _ in range(2 if rng.random() < 0.4 else 1))

    lost = 0
    for _ in range(runs):
        equal = sum(rng.random() < 0.75 for _ in range(N.TOKENS))
        lost += not any(meets(equal, 6) for _ in range(4))
    assert abs(lost / runs - N.missed(0.4, 6, roots=4)) < 0.03


def test_odd_documents(spark):
    docs = odd(spark)
    found = N.near_duplicates(docs).collect()
    assert len(found) == docs.count()
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    assert [by_id[i].component_id for i in (1, 2, 3, 4, 5, 6, 7, 11, 12)] == [1, 1, 1, 4, 5, 6, 7, 11, 11]
    assert [by_id[i].n_shingles for i in (4, 5, 6, 7, 11)] == [0, 0, 0, 1, 1]
    assert all(r.component_id is None and r.kept for r in found if r.doc_id is None)
    kept = N.keep_one(docs)
    assert kept.columns == docs.columns
    ids = sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)
    assert ids == sorted(i for i, r in by_id.items() if r.kept)
    assert N.near_duplicates(odd(spark, empty=True)).count() == 0


@pytest.mark.parametrize("seed", range(3))
def test_components(spark, seed):
    rng = random.Random(seed)
    pairs = [(rng.randint(0, 80), rng.randint(0, 80)) for _ in range(50)] + [(100 + i, 101 + i) for i in range(40)]
    root = {i: i for p in pairs for i in p}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, b in pairs:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = dict(components(spark.createDataFrame(pairs, "a long, b long"), Scratch(spark)).collect())
    linked = {i for a, b in pairs for i in (a, b) if a != b}
    assert got == {i: find(i) for i in linked}
    assert components(spark.createDataFrame([], "a long, b long"), Scratch(spark)).count() == 0


def test_words_that_no_hash_may_confuse(spark):
    from test_words import thue_morse

    rows = [(2 * n + i, w) for n in (256, 1024, 4096) for i, w in enumerate(thue_morse(n))]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = N.near_duplicates(docs).collect()
    assert len(found) == 6 and all(r.kept and r.component_id == r.doc_id for r in found)


def test_columns_of_any_name_stay(spark):
    text = prose(1, 40)
    docs = spark.createDataFrame([(1, text, "a", 1, 2), (2, text, "b", 1, 2), (None, text, "c", 1, 2)], "doc_id long, text string, `gone id` string, gone int, Gone_ int")
    left = N.keep_one(docs)
    assert left.columns == docs.columns
    assert sorted(r["gone id"] for r in left.collect()) == ["a", "c"]
