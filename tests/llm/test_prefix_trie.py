from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given as drawn
from hypothesis import settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeferry.llm import prefix_trie as P

SCHEMA = "conv_id long, turn long, role string, text string, name string, conv string, place int"


def plain_trie(rows, opening=None):
    """{prefix: (smallest member, parent's, members, children, leaves, saved, ids that end)}, by walking."""
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            digest = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).digest()
            own[conv].append(((turn is not None, turn or 0), digest, (role, text)))
    own = {c: [x[2] for x in sorted(turns, key=lambda x: x[:2])] for c, turns in own.items()}
    if opening:
        whole = {}
        for c, turns in own.items():
            other, h = opening(c)
            whole[c] = own.get(other, [])[:h] + turns[h:]
        own = whole
    members, ends, children = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in own.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                children[tuple(turns[: d - 1])].add(tuple(turns[:d]))
        ends[tuple(turns)].append(c)
    leaves, saved = Counter(), Counter()
    for node in members:
        for d in range(len(node) + 1):
            leaves[node[:d]] += not children[node]
            saved[node[:d]] += (len(members[node]) - 1) * len(node[-1][1]) if node else 0
    return sorted(
        (
            min(members[n]), len(n), min(members[n[:-1]]) if n else None, len(members[n]), len(children[n]), leaves[n], saved[n],
            hashlib.sha256(",".join(map(str, sorted(ends[n]))).encode()).hexdigest(),
        )
        for n in members
    )


def collected(spark, rows, opening=None, large=P.LARGE):
    df = spark.createDataFrame([(*r, "n", "c", k) for k, r in enumerate(rows)], SCHEMA).repartition(3)
    trie = P.prefix_trie(df, opening=opening, large=large)
    found = trie.nodes.join(P.id_digests(trie.ends), "name", "left").select(
        "conv", "depth", "parent_conv", "n_convs", "n_children", "n_leaves", "saved", F.coalesce("sha256", F.sha2(F.lit(""), 256))
    )
    return sorted(map(tuple, found.collect()), key=lambda r: r[:2])


def conversations(seed: int, n: int, longest: int) -> list[tuple]:
    """Conversations that share openings, a third of them the same one."""
    rng = random.Random(seed)
    rows, hot = [], [("user", f"hot {i}") for i in range(5)]
    for c in range(n):
        turns = list(hot[: rng.randint(1, 5)]) if c % 3 == 0 else []
        turns += [(rng.choice(["user", "bot"]), rng.choice(["a", "bé", ""])) for _ in range(rng.randint(0 if turns else 1, longest))]
        rows += [(c, i, *t) for i, t in enumerate(turns)]
    return rows


@pytest.mark.parametrize("large", [1, 20, P.LARGE])
def test_trie(spark, large):
    rows = conversations(1, 60, 5)
    assert collected(spark, rows, large=large) == plain_trie(rows)


def test_openings(spark):
    rows = conversations(2, 120, 6)
    # 3 and 103 are absent, 5's turns are all replaced, 100 has one turn
    rows = [r for r in rows if r[0] not in (0, 3, 103) and not (r[0] == 100 and r[1] > 0)]

    def plain(c):
        return c - c % 100, zlib.crc32(str(c).encode()) % 6

    opening = (F.col("conv") - F.col("conv") % 100, F.crc32(F.col("conv").cast("string").cast("binary")) % 6)
    found = collected(spark, rows, opening, large=30)
    assert found == plain_trie(rows, plain)
    assert found[0][1] == 0 and found[0][7] != hashlib.sha256(b"").hexdigest()  # some have no turns left


def test_long_conversations(spark):
    """Lengths about a block and its square, with branches at block bounds."""
    base = [("user" if i % 2 else "bot", f"t{i}") for i in range(P.BLOCK * P.BLOCK + 70)]
    rows = []
    for c, n in enumerate([1, 63, 64, 65, 127, 128, 129, 200, P.BLOCK * P.BLOCK, P.BLOCK * P.BLOCK + 65]):
        rows += [(c, i, *t) for i, t in enumerate(base[:n])]
    for c, at in enumerate([0, 63, 64, 65, 128, 190], 20):
        rows += [(c, i, *t) for i, t in enumerate([*base[:at], ("user", "other"), *base[at + 1 : 200]])]
    found = collected(spark, rows, large=3000)
    # the plain version is quadratic in the length, so the longest ones are compared by counts
    short = [r for r in rows if r[0] not in (8, 9)]
    assert collected(spark, short, large=300) == plain_trie(short)
    assert len({r[1] for r in found}) == P.BLOCK * P.BLOCK + 66
    assert [r[3] for r in found if r[1] == P.BLOCK * P.BLOCK] == [2] and found[0][5] == 7


def test_odd_rows(spark):
    rows = [
        (1, None, "user", "first"), (1, 0, None, None), (1, 1, "user", ""), (2, None, "user", "first"), (2, 0, "", ""),
        (3, 5, "a", "x"), (3, 5, "b", "x"), (3, 5, "a", "x"), (4, 5, "b", "x"), (4, 5, "a", "x"), (4, 6, "a", "x"),
        (None, 1, "user", "lost"), (5, 0, "ab", "c"), (6, 0, "a", "bc"), (-7, 0, "é", "日本"), (8, 0, "x", "long " * 100_000),
    ]
    assert collected(spark, rows) == collected(spark, rows, large=2) == plain_trie(rows)
    assert collected(spark, []) == []
    assert collected(spark, [(None, 1, "a", "b")]) == []


def test_text_ids(spark):
    df = spark.createDataFrame([("b", 0, "u", "x"), ("a", 0, "u", "x"), ("a", 1, "u", "y")], "conv_id string, turn int, role string, text string")
    trie = P.prefix_trie(df)
    assert sorted(map(tuple, trie.nodes.select("depth", "conv", "n_convs").collect())) == [(0, "a", 2), (1, "a", 2), (2, "a", 1)]
    assert {r.sha256 for r in P.id_digests(trie.ends).collect()} == {hashlib.sha256(x).hexdigest() for x in (b"a", b"b")}


def test_digest_of_many_ids(spark):
    """A node at which very many conversations end is hashed in order, from pieces of several tasks."""
    ends = spark.range(25_000).select(F.when(F.col("id") % 5 == 0, F.lit(b"x")).otherwise(F.lit(b"y")).alias("name"), F.col("id").alias("conv"))
    found = {bytes(r.name): r.sha256 for r in P.id_digests(ends.repartition(7)).collect()}
    for name, ids in ((b"x", range(0, 25_000, 5)), (b"y", [i for i in range(25_000) if i % 5])):
        assert found[name] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


@settings(max_examples=200, deadline=None)
@drawn(st.lists(st.tuples(st.integers(0, 10**6), st.integers(-5, 5), st.integers(1, 4)), max_size=60), st.sampled_from(["any", "chain", "star"]))
def test_split_all(drawn_nodes, shape):
    n = len(drawn_nodes)
    parent = np.array([-1 if not i or x % 9 == 0 else {"any": x % i, "chain": i - 1, "star": 0}[shape] for i, (x, _, _) in enumerate(drawn_nodes)], np.int64)
    value = np.array([v for _, v, _ in drawn_nodes], np.int64)
    depth, weight, expected = np.zeros(n, np.int64), np.array([w for *_, w in drawn_nodes], np.int64), value.copy()
    for i in range(n):
        depth[i] = depth[parent[i]] + 1 if parent[i] >= 0 else 0
    for i in range(n - 1, -1, -1):
        if parent[i] >= 0:
            weight[parent[i]] += weight[i]
            expected[parent[i]] += expected[i]
    assert (P.split_all(parent, depth, weight, [value])[0] == expected).all()


def test_components_over_batches(spark, monkeypatch):
    rows = conversations(4, 90, 4)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    monkeypatch.setattr(P, "CHUNK_NODES", 10)
    try:
        assert collected(spark, rows, large=40) == plain_trie(rows)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
