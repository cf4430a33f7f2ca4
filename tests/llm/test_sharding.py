from __future__ import annotations

import hashlib

import pytest
from cases import odd

from lakeferry.llm import sharding as S


def number(text: str) -> int:
    return int(hashlib.md5(text.encode()).hexdigest()[:8], 16)


def plain(shards, size) -> dict:
    """The table by taking turns."""
    owner: dict[int, str] = {}
    place = dict.fromkeys(shards, 0)
    while len(owner) < size:
        for s in shards:
            if len(owner) < size:
                start, skip = number("offset:" + s) % size, number("skip:" + s) % (size - 1) + 1
                while (start + place[s] * skip) % size in owner:
                    place[s] += 1
                owner[(start + place[s] * skip) % size] = s
    return owner


@pytest.mark.parametrize("n, size", [(1, 7), (3, 31), (10, 211), (5, 5)])
def test_table(spark, n, size):
    shards = S.SHARDS[:n]
    got = dict(S.lookup_table(spark, shards, size).collect())
    assert got == plain(shards, size)
    held = [list(got.values()).count(s) for s in shards]
    assert max(held) - min(held) <= 1


def test_few_slots_move(spark):
    before = dict(S.lookup_table(spark, S.SHARDS, 211).collect())
    after = dict(S.lookup_table(spark, S.SHARDS[:-1], 211).collect())
    moved = sum(before[k] != after[k] for k in before if before[k] != S.SHARDS[-1])
    assert moved < 211 * 0.25


def test_placing(spark):
    docs = odd(spark)
    table = plain(S.SHARDS, S.SIZE)
    found = S.placed(docs).collect()
    assert len(found) == docs.count()
    for r in found:
        slot = number("doc:" + ("" if r.doc_id is None else str(r.doc_id))) % S.SIZE
        assert (r.slot, r.shard) == (slot, table[slot])
    assert S.placed(odd(spark, empty=True)).count() == 0
    assert "Python" not in S.placed(docs)._jdf.queryExecution().executedPlan().toString()


def test_refuses_bad_sizes(spark):
    for size in (12, 7):
        with pytest.raises(ValueError):
            S.lookup_table(spark, S.SHARDS, size)
