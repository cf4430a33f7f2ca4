from __future__ import annotations

from collections import defaultdict

import corpus_pipeline
import pytest
from cases import WORD, given, odd
from test_near_dup import plain as groups
from test_packing import check as check_pieces
from test_quality_rules import plain as measures
from test_quality_rules import verdict

from lakeferry.llm import mixing, packing, secrets
from lakeferry.plans.workspace import close_all

SF = "/root/testdata/sf0.001"


def test_stages_match_plain_python(spark):
    from tokenizers import Tokenizer

    docs = given(spark, "documents")
    rows = docs.collect()
    steps = dict(corpus_pipeline.STAGES)
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_dedup", "secret_scan", "mixing", "packing"]

    kept = steps["quality_rules"](spark, docs, SF)
    rows = [r for r in rows if verdict(measures(r.text), r.lang)]
    assert sorted(kept.collect()) == sorted(rows) and kept.columns == docs.columns

    kept = steps["near_dedup"](spark, kept, SF)
    of = groups([(r.doc_id, r.text) for r in rows])
    rows = [r for r in rows if of[r.doc_id][1] == r.doc_id]
    assert sorted(kept.collect()) == sorted(rows) and kept.columns == docs.columns

    kept = steps["secret_scan"](spark, kept, SF)
    texts = {r.doc_id: secrets.redact(r.text, secrets.vocabulary_path(), "[SECRET]") for r in rows}
    got = kept.collect()
    assert {r.doc_id: r.text for r in got} == texts and kept.columns == docs.columns
    assert all(r.n_chars == len(r.text) for r in got)

    sizes = {r.doc_id: len(WORD.findall(r.text)) for r in got}
    mixed = steps["mixing"](spark, kept, SF)
    assert mixed.columns == docs.columns
    times, taken = defaultdict(int), defaultdict(int)
    for r in mixed.collect():
        times[r.doc_id] += 1
        taken[r.source] += sizes[r.doc_id]
    target = {r.source: r.target for r in mixing.assign(kept).select("source", "target").distinct().collect()}
    assert max(times.values()) <= 3
    assert all(abs(taken[s] - target[s]) <= max(sizes.values()) for s in target)

    model = Tokenizer.from_file(packing.vocabulary_path())
    model.encode_special_tokens = True
    once = mixed.dropDuplicates(["doc_id"])
    pieces = steps["packing"](spark, once, SF).collect()
    assert check_pieces(pieces, {r.doc_id: r.text for r in once.collect()}, model) == 0


def test_run(spark):
    found = corpus_pipeline.run(spark, SF)
    assert found.columns[0] == "doc_id" and found.count() > 0
    again = corpus_pipeline.run(spark, SF)
    words = lambda df: df.selectExpr("sum(length)").first()[0]
    assert words(found) == words(again)
    close_all()


@pytest.mark.parametrize("empty", [False, True])
def test_odd_documents_pass(spark, empty):
    docs = odd(spark, empty)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        docs = spark.createDataFrame(docs.collect(), docs.schema)
        if name != "packing":
            assert docs.columns == odd(spark).columns
    assert (docs.count() == 0) == empty
