from __future__ import annotations

import hashlib
import random
import zlib

import numpy as np
import pytest
from cases import SF, WORD, given, odd
from hypothesis import given as drawn
from hypothesis import settings
from hypothesis import strategies as st

from lakeferry.llm import queries
from lakeferry.llm import word_runs as R


def plain_runs(words: list, least: int) -> list[tuple[int, int, int]]:
    """(start, length, period) by trying every period."""
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            start = i
            while i + q < n and words[i] == words[i + q]:
                i += 1
            if i + q - start >= max(least, 2 * q):
                found.setdefault((start, i + q), q)
            i += 1
    return sorted(((s, e - s, q) for (s, e), q in found.items()), key=lambda r: (r[0], r[2]))


def collapse(words: list[str], runs: list[tuple[int, int, int]]) -> str:
    gone = {i for s, length, q in runs for i in range(s + q, s + length)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


SEQUENCE = st.one_of(
    st.lists(st.integers(0, 2), max_size=60),
    st.tuples(st.lists(st.integers(0, 3), max_size=6), st.lists(st.integers(0, 3), min_size=1, max_size=9), st.integers(0, 40)).map(
        lambda x: x[0] + [x[1][i % len(x[1])] for i in range(x[2])]
    ),
)


@settings(max_examples=400, deadline=None)
@drawn(st.lists(SEQUENCE, max_size=4), st.sampled_from([2, 3, 5, 12, 20]))
def test_runs_of_sequences(sequences, least):
    symbols = np.array(sum(sequences, []), np.int64)
    of = np.repeat(np.arange(len(sequences)), [len(x) for x in sequences])
    start, end, period = R.runs(symbols, of, least)
    offset, expected = 0, []
    for x in sequences:
        expected += [(s + offset, n, q) for s, n, q in plain_runs(x, least)]
        offset += len(x)
    assert [(int(s), int(e - s), int(q)) for s, e, q in zip(start, end, period, strict=True)] == expected


def test_lookups_in_parts(monkeypatch):
    words, other = [0], [0, 1]
    while len(other) < 300:
        words, other = other, other + words
    whole = R.runs(np.array(other), np.zeros(len(other), np.int64))
    monkeypatch.setattr(R, "LOOKUPS", 3)
    parts = R.runs(np.array(other), np.zeros(len(other), np.int64))
    assert all((a == b).all() for a, b in zip(whole, parts, strict=True))
    assert [tuple(map(int, x)) for x in zip(whole[0], whole[1] - whole[0], whole[2], strict=True)] == plain_runs(other, R.LEAST_WORDS)


def test_every_run_has_a_square_of_least_depth():
    for least in range(2, 40):
        depth = R.least_depth(least)
        for q in range(1, 60):
            for length in range(max(least, 2 * q), 2 * q + least + 2):
                assert any(d % q == 0 and 2 * d <= length for d in range(depth, length + 1))


def checked(rows, texts):
    assert len(rows) == len(texts)
    for row, (doc_id, text) in zip(rows, texts, strict=True):
        words = WORD.findall(text or "")
        expected = plain_runs(words, R.LEAST_WORDS)
        assert row[0] == doc_id and [tuple(r) for r in row.runs] == expected
        assert row.collapsed == collapse(words, expected)


def test_odd_documents(spark):
    rng = random.Random(5)
    long_line = " ".join(rng.choice(["ja", "nein", "é"]) for _ in range(3000))
    thue_morse = "a"
    while len(thue_morse) < 512:
        thue_morse += thue_morse.translate(str.maketrans("ab", "ba"))
    flipped = thue_morse.translate(str.maketrans("ab", "ba"))
    texts = [
        (1, None), (2, ""), (3, " \t\n"), (None, "w " * 12), (None, "w " * 11), (4, "x\ty z\n" * 40), (4, "x\ty z\n" * 40),
        (5, long_line), (6, f"{thue_morse} {flipped} " * 5), (7, "a " * 30_000), (8, "日本 語 " * 9 + "end " * 20),
        (9, "\n".join(["one line of it"] * 500)),
    ]
    docs = spark.createDataFrame([(i, t, "r", k) for k, (i, t) in enumerate(texts)], "doc_id long, text string, runs string, start int").coalesce(1)
    found = R.word_runs(docs).collect()
    plain = [(i, t) for i, t in texts if i != 7]
    checked([r for r in found if r[0] != 7], plain)
    assert [tuple(r) for r in next(r for r in found if r[0] == 7).runs] == [(0, 30_000, 1)]
    assert R.word_runs(odd(spark)).count() == odd(spark).count()
    assert R.word_runs(odd(spark, empty=True)).count() == 0


def test_query_equals_brute_force(spark):
    rows = {r.doc_id: r for r in queries.op13_word_runs(spark, SF).collect()}
    docs = given(spark, "documents").collect()
    assert len(rows) == len(docs)
    some = 0
    for doc in docs:
        words = WORD.findall(doc.text or "")
        n, h = len(words), zlib.crc32(str(doc.doc_id).encode())
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        if n > 1500:
            continue
        runs, row = plain_runs(words, 12), rows[doc.doc_id]
        some += len(runs)
        assert row.n_runs == len(runs)
        best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None, None, None))
        assert (row.start, row.length, row.period) == best
        assert row.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        assert row.runs_sha256 == hashlib.sha256("".join(f"{s},{m},{q}\n" for s, m, q in runs).encode()).hexdigest()
        assert row.collapsed_sha256 == hashlib.sha256(collapse(words, runs).encode()).hexdigest()
    assert some > 5


@pytest.mark.parametrize("least", [2, 12])
def test_no_words(least):
    none = np.zeros(0, np.int64)
    assert all(len(x) == 0 for x in R.runs(none, none, least))
