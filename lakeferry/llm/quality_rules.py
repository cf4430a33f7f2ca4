"""Quality rules on words, lines and tokens: what a public vocabulary makes of each whole text.

Base rules are counts of words, symbols, repeated lines and repeated word windows. The method is
tokeniser fertility: every word is split by a public piece vocabulary with byte fallback, and the
characters per token, the share of byte-fallback tokens and the entropy of the tokens must lie in
a band that the document's language names; texts of under `short_tokens` tokens take a wider one of
the same language, and none is kept unjudged. Entropy is divided by the most that so many tokens could
have, so that short texts are not below it for being short.

Defined results: a null or empty text has no words and fails the base rules; a null or unknown
language takes the band named ``None``; equal rows get equal verdicts, rows keep null ids, and an
empty table gives an empty one. Other columns are never read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeferry.llm.words import LEADS, Texts, chunks, mix, seeds, windows, within

VOCABULARY = "piece_bpe_32k.model"


@dataclass(frozen=True)
class Band:
    """What fertility a language allows."""

    least_chars: float = 0.3
    most_chars: float = 12.0
    most_fallback: float = 0.5
    # Of the entropy that as many tokens (up to `entropy_tokens`) could have.
    least_entropy: float = 0.5
    entropy_tokens: int = 2000
    # Texts of fewer tokens have a band of their own: one name or number weighs more in them.
    short_tokens: int = 100
    short_chars: float = 0.8  # of `least_chars`
    short_fallback: float = 1.5  # of `most_fallback`


# Set below what 99.9 % of the labelled good documents of each language reach.
LATIN = {"most_chars": 8.0, "most_fallback": 0.2, "least_entropy": 0.57}
BANDS: dict[str | None, Band] = {
    "en": Band(least_chars=1.8, **LATIN),
    "de": Band(least_chars=1.9, **LATIN),
    "fr": Band(least_chars=1.75, **LATIN),
    "es": Band(least_chars=1.7, **LATIN),
    None: Band(),
}

WINDOW = 8
SYMBOLS = np.zeros(256, np.int64)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = 1

FIELDS = (
    "n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "n_tokens long, chars_per_token double, fallback_share double, token_entropy double, "
    "base_failed boolean, kept boolean"
)

_models: dict[str, tuple] = {}


def _model(path: str):
    if path not in _models:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        fallback = np.array([model.is_byte(i) for i in range(model.get_piece_size())])
        _models[path] = (model, fallback)
    return _models[path]


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _per_doc(keys: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """Keys that are equal only inside one document."""
    return mix(keys ^ seeds(int(doc[-1]) + 1)[doc]) if len(keys) else keys


def lines(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """Where the lines with a word begin and end."""
    breaks = np.flatnonzero(texts.data == 10)
    begin = np.union1d(texts.bounds[:-1], breaks + 1)
    begin = begin[begin < len(texts.data)]
    end = np.append(breaks, len(texts.data))[np.searchsorted(breaks, begin)]
    end = np.minimum(end, texts.bounds[np.searchsorted(texts.bounds, begin, "right")])
    worded = np.searchsorted(texts.starts, end) > np.searchsorted(texts.starts, begin)
    return begin[worded], end[worded]


def repeated_lines(texts: Texts) -> np.ndarray:
    """Lines with a word that equal an earlier line of the document."""
    begin, end = lines(texts)
    doc = np.searchsorted(texts.bounds, begin, "right") - 1
    _, first = np.unique(_per_doc(texts.hashes(begin, end), doc), return_index=True)
    return np.bincount(doc, minlength=texts.count) - np.bincount(doc[first], minlength=texts.count)


def in_repeats(texts: Texts, hashes: np.ndarray) -> np.ndarray:
    """Which words lie inside windows that occur twice or more in the document."""
    n = len(hashes)
    found = windows(hashes, WINDOW)
    at = np.flatnonzero(within(texts.word_bounds, WINDOW, n))
    if not len(at):
        return np.zeros(n, bool)
    keys = _per_doc(found[at], texts.word_doc[at])
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    same = keys[1:] == keys[:-1]
    again = np.zeros(len(keys), bool)
    again[1:] = same
    again[:-1] |= same
    cover = np.zeros(n + 1, np.int64)
    where = at[order[again]]
    np.add.at(cover, where, 1)
    np.add.at(cover, where + WINDOW, -1)
    return np.cumsum(cover[:-1]) > 0


def fertility(texts: Texts, hashes: np.ndarray, path: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per document: tokens, byte-fallback tokens, entropy of the tokens in bits."""
    model, fallback = _model(path)
    if not len(hashes):
        return np.zeros(texts.count, np.int64), np.zeros(texts.count), np.zeros(texts.count)
    _, first, code = np.unique(hashes, return_index=True, return_inverse=True)
    pieces = model.encode([texts.word(i).decode("utf-8", "replace") for i in first])
    lengths = np.fromiter(map(len, pieces), np.int64, len(pieces))
    flat = np.fromiter((t for p in pieces for t in p), np.int64, int(lengths.sum()))
    offsets = np.cumsum(lengths) - lengths
    each = lengths[code]
    place = np.repeat(offsets[code] - (np.cumsum(each) - each), each) + np.arange(int(each.sum()))
    tokens = flat[place]
    doc = np.repeat(texts.word_doc, each)
    n = np.bincount(doc, minlength=texts.count)
    keys = np.sort(doc * len(fallback) + tokens)
    edge = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    counts = np.diff(np.append(edge, len(keys)))
    weighted = np.bincount(keys[edge] // len(fallback), counts * np.log2(counts), texts.count)
    entropy = np.log2(np.maximum(n, 1)) - weighted / np.maximum(n, 1)
    return n, np.bincount(doc, fallback[tokens], texts.count), entropy


def measure(texts: Texts, langs: list[str | None], path: str, bands: dict[str | None, Band]) -> dict:
    hashes = texts.word_hashes()
    lead = np.zeros(len(texts.data) + 1, np.int64)
    np.cumsum(LEADS[texts.data], out=lead[1:])
    chars = np.bincount(texts.word_doc, lead[texts.ends] - lead[texts.starts], texts.count).astype(np.int64)
    del lead
    repeats = np.bincount(texts.word_doc[in_repeats(texts, hashes)], minlength=texts.count)
    same_lines = repeated_lines(texts)
    texts.release()
    tokens, fallback, entropy = fertility(texts, hashes, path)
    some = np.maximum(tokens, 1)
    per_token, share = chars / some, fallback / some
    failed = (texts.n_words < 20) | (100 * repeats > 30 * texts.n_words)
    own = [bands.get(lang, bands[None]) for lang in langs]
    take = lambda field: np.array([getattr(b, field) for b in own])
    most = np.log2(np.maximum(np.minimum(tokens, take("entropy_tokens")), 2))
    short = tokens < take("short_tokens")
    fits = (
        (per_token >= take("least_chars") * np.where(short, take("short_chars"), 1.0))
        & (per_token <= take("most_chars"))
        & (share <= take("most_fallback") * np.where(short, take("short_fallback"), 1.0))
        & (entropy >= take("least_entropy") * most)
    )
    return {
        "n_words": texts.n_words,
        "word_chars": chars,
        "n_symbols": texts.totals(SYMBOLS[texts.data]),
        "n_dup_lines": same_lines,
        "n_repeat_words": repeats,
        "n_tokens": tokens,
        "chars_per_token": per_token,
        "fallback_share": share,
        "token_entropy": entropy,
        "base_failed": failed,
        "kept": ~failed & fits,
    }


def judge(text: Column, lang: Column, path: str | None = None, bands: dict | None = None) -> Column:
    """A struct of the measures of a text and the verdict ``kept``, one Arrow batch at a time."""
    path, bands = path or vocabulary_path(), bands or BANDS

    def measured(column: pa.Array, language: pa.Array) -> pa.Array:
        langs, parts = language.to_pylist(), []
        for first, last, texts in chunks(column):
            found = measure(texts, langs[first:last], path, bands)
            parts.append(pa.StructArray.from_arrays([pa.array(v) for v in found.values()], list(found)))
        return pa.concat_arrays(parts) if parts else pa.array([], schema_type)

    schema_type = pa.struct(
        [
            (name, {"long": pa.int64(), "double": pa.float64(), "boolean": pa.bool_()}[kind])
            for name, kind in (f.split() for f in FIELDS.split(", "))
        ]
    )
    measured.__annotations__ = {"column": pa.Array, "language": pa.Array, "return": pa.Array}
    return F.arrow_udf(measured, FIELDS)(text, lang.cast("string"))


def quality_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **how) -> DataFrame:
    """(id, measures, ``base_failed``, ``kept``) for every row."""
    found = docs.select(F.col(id_col), judge(F.col(text_col), F.col(lang_col), **how).alias("found"))
    return found.select(id_col, "found.*")


def keep_quality(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", **how) -> DataFrame:
    """The rows that the rules keep, with all their columns."""
    return docs.where(judge(F.col(text_col), F.col(lang_col), **how)["kept"])
