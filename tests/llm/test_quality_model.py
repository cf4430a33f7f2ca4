from __future__ import annotations

import tracemalloc
import zlib
from itertools import product

import numpy as np
import pyarrow as pa
import pytest
from cases import given, odd
from pyspark.sql import functions as F

from lakeferry.llm import quality_model as Q
from lakeferry.llm.words import chunks

SF = "/root/testdata/sf0.1"


def test_marginals_are_exact():
    rng = np.random.default_rng(0)
    doc = np.array([0, 0, 0, 0, 2, 2, 3])
    scores, moves = rng.normal(size=7), rng.normal(size=(2, 2))
    likely, both = Q.Chains(doc, 4).marginals(scores, moves)
    expected, pairs = np.zeros(7), np.zeros((2, 2))
    for d in range(4):
        own = np.flatnonzero(doc == d)
        total, good, moved = 0.0, np.zeros(len(own)), np.zeros((2, 2))
        for states in product((0, 1), repeat=len(own)):
            weight = np.exp(sum(scores[i] * s for i, s in zip(own, states, strict=True)) + sum(moves[a, b] for a, b in zip(states, states[1:], strict=False)))
            total += weight
            good += weight * np.array(states)
            for a, b in zip(states, states[1:], strict=False):
                moved[a, b] += weight
        if len(own):
            expected[own] = good / total
            pairs += moved / total
    assert likely == pytest.approx(expected) and both == pytest.approx(pairs)


def test_one_long_document_among_short_ones():
    """Memory follows the lines, and the scores are those of each text alone."""
    texts = ["a short line | here\nand another one"] * 2000 + ["some | line\n" * 3 + "and words here\n" * 60_000]
    weights, moves = np.linspace(-1, 1, Q.FEATURES), np.array([[0.5, -0.5], [-0.2, 0.3]])
    part = next(x for *_, x in chunks(pa.array(texts)))
    tracemalloc.start()
    found = Q.scores(part, weights, moves)
    assert tracemalloc.get_traced_memory()[1] < 250e6
    tracemalloc.stop()
    for i in (0, 1999, 2000):
        alone = next(x for *_, x in chunks(pa.array([texts[i]])))
        assert found[i] == pytest.approx(Q.scores(alone, weights, moves)[0])


def test_neighbouring_lines_count():
    texts = [x for *_, x in chunks(pa.array(["aa bb\ncc | dd\n\nee", "x"]))][0]
    features, size, doc = Q.line_features(texts)
    assert doc.tolist() == [0, 0, 0, 1] and size.tolist() == [5, 7, 2, 1]
    own, before, after = (features[:, i * Q.OWN : (i + 1) * Q.OWN] for i in range(3))
    assert (before[1] == own[0]).all() and (after[1] == own[2]).all()
    assert not before[0].any() and not after[2].any() and not before[3].any()


def test_held_out_accuracy(spark):
    docs, labels = given(spark, "documents", SF), given(spark, "labels", SF)
    found = Q.quality(docs, labels)
    assert found.count() == docs.count()
    rows = found.join(labels, "doc_id").where("held_out").collect()
    good = np.array([r.score for r in rows if r.quality == 1])
    bad = np.array([r.score for r in rows if r.quality == 0])
    assert (good[:, None] > bad[None, :]).mean() > 0.99
    assert np.mean([r.predicted == r.quality for r in rows]) > 0.97
    assert (good >= Q.THRESHOLD).mean() > 0.99
    for r in rows[:50]:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0)


def test_held_out_labels_are_not_learnt(spark):
    docs, labels = given(spark, "documents"), given(spark, "labels")
    turned = labels.withColumn("quality", F.when(Q.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    for a, b in zip(Q.train(docs, labels), Q.train(docs, turned), strict=True):
        assert (a == b).all()


def test_odd_documents(spark):
    docs, labels = odd(spark), given(spark, "labels")
    weights, moves = Q.train(given(spark, "documents"), labels)
    found = docs.select("doc_id", Q.score(docs["text"], weights, moves).alias("score")).collect()
    assert len(found) == docs.count() and all(0 <= r.score <= 1 for r in found)
    assert Q.quality(odd(spark, empty=True), labels).count() == 0
    none = labels.limit(0)
    assert {r.score for r in Q.quality(docs, none).collect()} == {0.5}
    nulls = spark.createDataFrame([(None, 1), (1, None), (2, 0), (2, 0)], "doc_id long, quality int")
    assert Q.quality(docs, nulls).where("score >= 0").count() == docs.count()
