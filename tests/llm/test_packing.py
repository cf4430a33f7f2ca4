from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from cases import given, odd
from hypothesis import given as examples
from hypothesis import settings
from hypothesis import strategies as st

from lakeferry.llm import packing as P
from lakeferry.llm.words import Texts, chunks


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(P.vocabulary_path())
    model.encode_special_tokens = True
    return model


def check(pieces, texts: dict, tokenizer, window: int = P.WINDOW) -> int:
    """Every id in one piece, gapless windows; returns the padding."""
    by_doc, by_window = defaultdict(list), defaultdict(list)
    for r in pieces:
        by_doc[r.doc_id].append(r)
        by_window[r.sequence_id].append(r)
    assert set(by_doc) == set(texts)
    for doc, text in texts.items():
        ids = np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [1], "<u4")
        at = 0
        for r in sorted(by_doc[doc], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(ids[at : at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    padding = 0
    for held in by_window.values():
        at = 0
        for r in sorted(held, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert 0 < at <= window
        padding += window - at if at & (at - 1) else 0
    return padding


def test_given_documents(spark, tokenizer):
    docs = given(spark, "documents").repartition(3)
    pieces = P.pack(docs).collect()
    assert check(pieces, {r.doc_id: r.text for r in docs.collect()}, tokenizer) == 0


def test_odd_documents(spark, tokenizer):
    rows = [r for r in odd(spark).dropDuplicates(["doc_id"]).collect()]
    docs = spark.createDataFrame(rows, odd(spark).schema)
    found = P.pack(docs, with_ids=True)
    assert check(found.collect(), {r.doc_id: r.text for r in rows}, tokenizer) == 0
    assert all(zlib.crc32(np.array(r.ids, "<u4").tobytes()) == r.ids_crc32 for r in found.collect())
    assert P.pack(odd(spark, empty=True)).count() == 0
    # repeated rows are documents of their own
    assert P.pack(docs.union(docs)).selectExpr("sum(length)").first()[0] == 2 * P.pack(docs).selectExpr("sum(length)").first()[0]


TRICKY = st.lists(st.sampled_from(["Hello", "don't", "ΣΑΣ", "ﬁne", "éa", "İx", "42", "a1b", "<|endoftext|>", "…", "word.", "WORD,", "!!", " ", "ñandú!?", "日本", "'s", "x'll", "ŉ", "\x1c"]), max_size=12)


@settings(max_examples=300, deadline=None)
@examples(TRICKY)
def test_word_by_word_is_the_whole(words):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(P.vocabulary_path())
    model.encode_special_tokens = True
    text = " ".join(words)
    ids = test_word_by_word_is_the_whole.ids
    got = [x for *_, part in chunks(pa.array([text]), lower=True) for x in ids.encode(part)][0]
    assert got.tolist() == model.encode(text, add_special_tokens=False).ids + [1]


test_word_by_word_is_the_whole.ids = P.Ids(P.vocabulary_path())


@settings(max_examples=60, deadline=None)
@examples(st.lists(st.integers(1, 40), max_size=60), st.integers(1, 8))
def test_sum_of_squares(sizes, most):
    packer, windows = P.Packer(16, most), []
    for i, size in enumerate(sizes):
        before = packer.counts.copy()
        rest = size % 16
        if rest and packer.held:
            level = packer.level_for(rest)

            def cost(h, rest=rest, before=before):
                after = before.copy()
                after[h] -= h > 0
                after[h + rest] += h + rest < 16
                return int((after[1:16] ** 2).sum())

            open_levels = [0, *[h for h in range(1, 16 - rest + 1) if before[h]]]
            assert level in open_levels and cost(level) == min(map(cost, open_levels))
        windows += packer.add(i, np.arange(size, dtype=np.uint32))
    windows += packer.close()
    assert packer.held == 0
    assert all((n := sum(len(p.ids) for p in w)) == 16 or n & (n - 1) == 0 for w in windows)
    back = defaultdict(list)
    for w in windows:
        for p in w:
            back[p.doc] += [(p.start + k, v) for k, v in enumerate(p.ids.tolist())]
    assert all(sorted(back[i]) == [(k, k) for k in range(s)] for i, s in enumerate(sizes))


def test_words_that_no_hash_may_confuse(spark):
    """Thue-Morse words and their complements, over documents, and words equal at both ends."""
    from test_words import thue_morse

    texts = [w for n in (256, 1024, 4096) for w in thue_morse(n)]
    texts += ["abcdefgh" + x + "ijklmnop" for x in ("q", "r", "qq")]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    ids = P.Ids(P.vocabulary_path())
    found = {}
    for r in P.pack(docs, with_ids=True).orderBy("doc_id", "start").collect():
        found.setdefault(r.doc_id, []).extend(r.ids)
    for i, text in enumerate(texts):
        assert found[i] == [*ids.alone(text.encode()).tolist(), P.END]


def test_parts_with_the_hash_of_others_are_encoded_whole(spark, monkeypatch):
    monkeypatch.setattr(Texts, "hashes", lambda self, starts, ends: (ends - starts).astype(np.uint64) * np.uint64(7))
    ids = P.Ids(P.vocabulary_path())
    texts = ["one two, three!", "six ten, seven?", "", "one", "abc"]
    part = next(x for *_, x in chunks(pa.array(texts)))
    for text, own in zip(texts, ids.encode(part), strict=True):
        assert own.tolist() == [*ids.alone(text.encode()).tolist(), P.END]
