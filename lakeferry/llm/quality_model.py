"""Document quality from a linear-chain conditional random field over lines.

Every line with a word is labelled good or bad. The features of a line are shares of byte classes,
word lengths and repeats of its own, and the same of the line before and after it. Two states,
weights for the features and a transition matrix give a chain whose exact forward-backward
marginals say how likely each line is good; a document's score is their mean, weighted by the
bytes of the lines.

The labels are of documents, so in training all lines of a document carry its label. The model is
fitted on the driver to a bounded sample: at most `MOST_DOCS` labelled documents, those of smallest
id hash, of at most `MOST_LINES` lines each. Everything else covers all rows: scoring is one pass
over whole texts without a shuffle, and the weights are a few hundred numbers.

Defined results: a null or empty text, or one without words, is one line without features; a null
label is none; rows are scored one by one, whatever their ids; a null id is not held out; without
any labelled document every score is 0.5; an empty table gives an empty one. Only id and text are
read for a score.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeferry.llm.quality_rules import in_repeats, lines
from lakeferry.llm.words import Texts, chunks, mix, seeds

MOST_DOCS = 4000
MOST_LINES = 128
ROUNDS = 120
THRESHOLD = 0.3

_CLASSES = {
    "upper": range(65, 91),
    "lower": range(97, 123),
    "digit": range(48, 58),
    "symbol": b"#*$%&|<>",
    "bar": b"|",
    "bang": b"!?",
    "stop": b".,;:",
    "space": (9, 11, 12, 13, 32),
    "wide": range(128, 256),
}
_MEMBER = np.zeros((len(_CLASSES), 256), np.int64)
for _i, _bytes in enumerate(_CLASSES.values()):
    _MEMBER[_i, list(_bytes)] = 1
OWN = len(_CLASSES) + 7
FEATURES = 3 * OWN + 1


def line_features(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(features, bytes, document) of every line with a word."""
    begin, end = lines(texts)
    doc = np.searchsorted(texts.bounds, begin, "right") - 1
    size = (end - begin).astype(float)
    own = np.zeros((len(begin), OWN))
    for i, member in enumerate(_MEMBER):
        sums = np.zeros(len(texts.data) + 1, np.int64)
        np.cumsum(member[texts.data], out=sums[1:])
        own[:, i] = (sums[end] - sums[begin]) / size
    hashes = texts.word_hashes()
    first, last = np.searchsorted(texts.starts, begin), np.searchsorted(texts.starts, end)
    count = np.maximum(last - first, 1).astype(float)
    line = np.repeat(np.arange(len(begin)), last - first)

    def share(flags: np.ndarray) -> np.ndarray:
        return np.bincount(line[flags], minlength=len(begin)) / count

    def fresh(group: np.ndarray) -> np.ndarray:
        keys = mix(hashes ^ seeds(int(group.max(initial=0)) + 1)[group])
        flags = np.zeros(len(hashes), bool)
        flags[np.unique(keys, return_index=True)[1]] = True
        return flags

    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])
    at = len(_CLASSES)
    own[:, at] = share(same)
    own[:, at + 1] = share(fresh(line))
    own[:, at + 2] = share(fresh(texts.word_doc))
    own[:, at + 3] = share(in_repeats(texts, hashes))
    own[:, at + 4] = np.bincount(line, texts.ends - texts.starts, len(begin)) / count / 10
    own[:, at + 5] = np.log1p(size) / 6
    own[:, at + 6] = own[:, list(_CLASSES).index("bar")] > 0
    features = np.zeros((len(begin), FEATURES))
    features[:, :OWN] = own
    if len(begin) > 1:
        together = doc[1:] == doc[:-1]
        features[1:, OWN : 2 * OWN] = own[:-1] * together[:, None]
        features[:-1, 2 * OWN : 3 * OWN] = own[1:] * together[:, None]
    features[:, -1] = 1
    return features, size, doc


class Chains:
    """Lines of some documents, longest document first: all first lines, then all second ones, and so on.

    There is one row per line, so one long document among short ones takes no more than its lines.
    """

    def __init__(self, doc: np.ndarray, count: int):
        lengths = np.bincount(doc, minlength=count)
        order = np.argsort(-lengths, kind="stable")
        order = order[lengths[order] > 0]
        row = np.zeros(count, np.int64)
        row[order] = np.arange(len(order))
        starts = np.cumsum(lengths) - lengths
        # documents that have a line at each place, and where those lines begin
        self.active = np.searchsorted(-lengths[order], -np.arange(lengths.max(initial=0)), "left").tolist()
        self.begin = np.concatenate([[0], np.cumsum(self.active, dtype=np.int64)]).tolist()
        self.at = np.array(self.begin, np.int64)[np.arange(len(doc)) - starts[doc]] + row[doc]

    def marginals(self, scores: np.ndarray, moves: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(how likely each line is good, expected moves between states) from line scores."""
        good = np.zeros(len(scores))
        good[self.at] = 1 / (1 + np.exp(-np.clip(scores, -30, 30)))
        emit = np.stack([1 - good, good], -1)
        step = np.exp(moves)
        ahead = np.zeros(emit.shape)
        for t, (m, a) in enumerate(zip(self.active, self.begin, strict=False)):
            now = emit[a : a + m]
            if t:
                before = self.begin[t - 1]
                now = (ahead[before : before + m] @ step) * now
            ahead[a : a + m] = now / now.sum(1, keepdims=True)
        both = np.zeros((2, 2))
        behind = np.ones((self.active[0] if self.active else 0, 2))
        found = np.zeros(len(scores))
        for t in range(len(self.active) - 1, -1, -1):
            m, a = self.active[t], self.begin[t]
            joint = ahead[a : a + m] * behind[:m]
            joint /= joint.sum(1, keepdims=True)
            found[a : a + m] = joint[:, 1]
            if t:
                into = emit[a : a + m] * behind[:m]
                before = self.begin[t - 1]
                pair = ahead[before : before + m, :, None] * step * into[:, None, :]
                both += (pair / pair.sum((1, 2), keepdims=True)).sum(0)
                back = into @ step.T
                behind[:m] = back / back.sum(1, keepdims=True)
        return found[self.at], both


def fit(features: np.ndarray, doc: np.ndarray, labels: np.ndarray, rounds: int = ROUNDS, rate: float = 0.1, decay: float = 1e-3) -> tuple[np.ndarray, np.ndarray]:
    """(weights, moves) by gradient steps on the likelihood of all lines' labels, with equal say
    for both labels."""
    weights, moves = np.zeros(FEATURES), np.zeros((2, 2))
    if not len(labels):
        return weights, moves
    chains = Chains(doc, len(labels))
    truth = labels[doc].astype(float)
    lengths = np.bincount(doc, minlength=len(labels))
    share = np.array([(labels == v).sum() for v in (0, 1)])
    if share.min() == 0:  # one label only: nothing to tell apart
        weights[-1] = 2.0 if share[1] else -2.0
        return weights, moves
    seen = np.diag([float(np.maximum(lengths[labels == v] - 1, 0).sum()) for v in (0, 1)])
    say = (0.5 / share)[labels][doc] / np.maximum(lengths, 1)[doc]
    pairs = max(seen.sum(), 1.0)
    state = [np.zeros(FEATURES), np.zeros(FEATURES), np.zeros((2, 2)), np.zeros((2, 2))]
    for i in range(1, rounds + 1):
        likely, both = chains.marginals(features @ weights, moves)
        slopes = (features.T @ ((likely - truth) * say) + decay * weights, (both - seen) / pairs + 0.05 * moves)
        for j, (slope, values) in enumerate(zip(slopes, (weights, moves), strict=True)):
            state[2 * j] = 0.9 * state[2 * j] + 0.1 * slope
            state[2 * j + 1] = 0.99 * state[2 * j + 1] + 0.01 * slope**2
            values -= rate * (state[2 * j] / (1 - 0.9**i)) / (np.sqrt(state[2 * j + 1] / (1 - 0.99**i)) + 1e-8)
    return weights, moves


def scores(texts: Texts, weights: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The share of good lines of every document, weighted by their bytes."""
    features, size, doc = line_features(texts)
    out = np.full(texts.count, 1 / (1 + np.exp(-weights[-1])))
    if len(doc):
        likely, _ = Chains(doc, texts.count).marginals(features @ weights, moves)
        total = np.bincount(doc, size, texts.count)
        some = total > 0
        out[some] = np.bincount(doc, size * likely, texts.count)[some] / total[some]
    return np.clip(out, 0.0, 1.0)


def held_out(id_col: Column) -> Column:
    """A fifth of the documents, whose labels are never learnt."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality",
          most_docs: int = MOST_DOCS, most_lines: int = MOST_LINES) -> tuple[np.ndarray, np.ndarray]:
    """(weights, moves) from the sample of labelled documents that are not held out."""
    wanted = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
        .groupBy("id").agg(F.max("label").alias("label"))
        .orderBy(F.xxhash64("id"), "id").limit(most_docs)
    )
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).join(F.broadcast(wanted), "id")

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, texts in chunks(batch.column(1)):
                features, _, doc = line_features(texts)
                short = np.bincount(doc, minlength=texts.count) <= most_lines
                kept = [i for i in range(texts.count) if short[i]]
                raw = [features[doc == i].astype(np.float32).tobytes() for i in kept]
                part = batch.slice(first, last - first).take(pa.array(kept, pa.int64()))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(2), pa.array(raw, pa.binary())], names=["id", "label", "lines"])

    kind = rows.schema["id"].dataType.simpleString()
    found = rows.select("id", "text", "label").mapInArrow(made, f"id {kind}, label int, lines binary").collect()
    found.sort(key=lambda r: (r.id, bytes(r.lines)))
    parts = [np.frombuffer(r.lines, np.float32).reshape(-1, FEATURES).astype(float) for r in found]
    parts = [(p, r.label) for p, r in zip(parts, found, strict=True) if len(p)]
    if not parts:
        return np.zeros(FEATURES), np.zeros((2, 2))
    doc = np.repeat(np.arange(len(parts)), [len(p) for p, _ in parts])
    return fit(np.concatenate([p for p, _ in parts]), doc, np.array([y for _, y in parts]))


def score(text: Column, weights: np.ndarray, moves: np.ndarray) -> Column:
    """The quality of a text, 0 to 1."""

    def scored(column: pa.Array) -> pa.Array:
        parts = [scores(texts, weights, moves) for _, _, texts in chunks(column)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    scored.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(scored, "double")(text)


def quality(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(id, held_out, score, predicted) for every row."""
    weights, moves = train(docs, labels, id_col, text_col, **how)
    found = docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), score(F.col(text_col).cast("string"), weights, moves).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
