from __future__ import annotations

import math
from collections import Counter

import pytest
from cases import WORD, given, odd

from lakeferry.llm import quality_rules as Q


def plain(text: str | None) -> dict:
    text = text or ""
    words = WORD.findall(text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    covered = {j for i in range(len(words) - 7) if windows[tuple(words[i : i + 8])] > 1 for j in range(i, i + 8)}
    model, fallback = Q._model(Q.vocabulary_path())
    tokens = [t for w in words for t in model.encode(w)]
    counts = Counter(tokens)
    entropy = -sum(c / len(tokens) * math.log2(c / len(tokens)) for c in counts.values()) if tokens else 0.0
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)), "n_symbols": sum(c in "#*$%&|<>" for c in text),
        "n_dup_lines": dup, "n_repeat_words": len(covered), "n_tokens": len(tokens),
        "chars_per_token": sum(map(len, words)) / max(len(tokens), 1),
        "fallback_share": sum(bool(fallback[t]) for t in tokens) / max(len(tokens), 1), "token_entropy": entropy,
        "base_failed": len(words) < 20 or 100 * len(covered) > 30 * len(words),
    }


def verdict(found: dict, lang: str | None) -> bool:
    band = Q.BANDS.get(lang, Q.BANDS[None])
    if found["base_failed"]:
        return False
    short = found["n_tokens"] < band.short_tokens
    least_chars = band.least_chars * (band.short_chars if short else 1)
    most_fallback = band.most_fallback * (band.short_fallback if short else 1)
    most = math.log2(max(min(found["n_tokens"], band.entropy_tokens), 2))
    return (
        least_chars <= found["chars_per_token"] <= band.most_chars
        and found["fallback_share"] <= most_fallback
        and found["token_entropy"] >= band.least_entropy * most
    )


def check(docs):
    for text, lang, *row in docs.select("text", "lang", Q.judge(docs["text"], docs["lang"]).alias("found")).collect():
        expected, got = plain(text), row[0].asDict()
        for name, value in expected.items():
            assert got[name] == (pytest.approx(value, abs=1e-9) if isinstance(value, float) else value), (name, text)
        assert got["kept"] == verdict(expected, lang)


def test_given_documents(spark):
    check(given(spark, "documents"))


def test_odd_documents(spark):
    check(odd(spark))
    found = Q.quality_rules(odd(spark))
    assert found.columns[0] == "doc_id" and found.count() == odd(spark).count()
    assert Q.quality_rules(odd(spark, empty=True)).count() == 0
    kept = Q.keep_quality(odd(spark))
    assert kept.columns == odd(spark).columns and 0 < kept.count() < odd(spark).count()


def test_good_documents_stay(spark):
    labels = given(spark, "labels", "/root/testdata/sf0.1")
    docs = given(spark, "documents", "/root/testdata/sf0.1").join(labels.where("quality = 1"), "doc_id")
    found = Q.quality_rules(docs).where("NOT base_failed")
    assert found.where("NOT kept").count() <= 0.002 * found.count()


def test_bands_reject(spark):
    text = " ".join(f"qz{i}xkjv" for i in range(300))
    rows = [(1, text, "en"), (2, "ꙮ꙰ " * 200, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in Q.quality_rules(docs, bands={"en": Q.Band(least_chars=2.5, least_entropy=0.0), None: Q.Band()}).collect()}
    assert not found[1].base_failed and not found[1].kept
    assert found[2].fallback_share > 0.5 and not found[2].kept


def test_short_texts_are_judged(spark):
    """Texts of some 24 words take a band of their own; none is kept unjudged."""
    strange = " ".join(chr(0x1E900 + i) for i in range(24))
    same = " ".join(f"{w} {w} {w} {w} {w} {w}" for w in ("of", "the", "and", "in"))
    plain_words = "the cat sat on a mat and looked at the bird that sang in an old tree near our house by the river"
    rows = [(1, strange, "en"), (2, strange, "de"), (3, plain_words, "en"), (4, same, "en")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r.doc_id: r for r in Q.quality_rules(docs).collect()}
    assert not any(found[i].base_failed for i in (1, 2, 3)) and all(found[i].n_tokens < 100 or i < 3 for i in found)
    assert [found[i].kept for i in (1, 2, 3)] == [False, False, True]
    check(docs)


def test_short_good_documents_are_kept(spark):
    docs, labels = given(spark, "documents", "/root/testdata/sf0.1"), given(spark, "labels", "/root/testdata/sf0.1")
    found = Q.quality_rules(docs).join(labels, "doc_id").where("n_tokens < 100 AND quality = 1 AND NOT base_failed")
    kept = [r.kept for r in found.select("kept").collect()]
    assert len(kept) > 20 and all(kept)


def test_lines_that_are_no_repeats(spark):
    """Lines of Thue-Morse words and their complements."""
    from test_words import thue_morse

    docs = spark.createDataFrame([(n, "\n".join(thue_morse(n) * 2), "en") for n in (256, 1024, 4096)], "doc_id long, text string, lang string")
    assert [r.n_dup_lines for r in Q.quality_rules(docs).collect()] == [2, 2, 2]
    check(docs)
