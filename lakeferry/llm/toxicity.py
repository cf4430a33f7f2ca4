"""Toxicity of documents by FTRL-proximal logistic regression over hashed word n-grams and skip-grams.

A text's features are its words, pairs of neighbours, and pairs with one and with two words between
them, hashed into 2^`BITS` places; each counts once, however often it occurs. Words are runs of
characters other than ASCII white space and punctuation, in lower case. FTRL-proximal keeps a learning
rate for every coordinate and an L1 penalty that leaves most weights at exactly 0, so the model is a
short list of places and weights that every task gets.

The labels are read from a bounded sample: at most `MOST_DOCS` labelled documents, half of each label,
those of smallest id hash; of each at most `MOST_FEATURES` features, those of smallest hash. The model
is fitted to it in the order of the hash, in `ROUNDS` passes, with equal say for both labels. Everything
else covers all rows: scoring is one pass over whole texts without a shuffle.

Defined results: a null or empty text, or one without words, has no features and gets the score of the
intercept; a null label, or one other than 0 and 1, is none, and of several labels of one id the highest
counts; rows are scored one by one, whatever their ids; a null id is not held out; without labelled
documents every score is 0.5; an empty table gives an empty one. Only id and text are read for a score;
extra columns are left out, whatever they are called.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeferry.llm.quality_model import held_out
from lakeferry.llm.words import Texts, chunks, mix, seeds

BITS = 22
GAPS = (1, 2, 3)
MOST_DOCS = 8000
MOST_FEATURES = 6000
ROUNDS = 3
THRESHOLD = 0.5

# ASCII punctuation, which separates words as white space does.
_PLAIN = np.arange(256, dtype=np.uint8)
_PLAIN[[b for b in range(33, 128) if not chr(b).isalnum()]] = 32
_KINDS = seeds(len(GAPS) + 1, 1 << 21)


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray]:
    """(document, place) of every n-gram and skip-gram, repeats included."""
    plain = Texts(_PLAIN[texts.data], texts.bounds)
    words = plain.word_hashes()
    hashed, docs = [mix(words ^ _KINDS[0])], [plain.word_doc]
    for gap, kind in zip(GAPS, _KINDS[1:], strict=True):
        together = plain.word_doc[gap:] == plain.word_doc[:-gap]
        pair = mix((words[:-gap] ^ kind) * np.uint64(0x9E3779B97F4A7C15) + words[gap:])
        hashed.append(pair[together])
        docs.append(plain.word_doc[gap:][together])
    return np.concatenate(docs), (np.concatenate(hashed) >> np.uint64(64 - BITS)).astype(np.uint32)


def distinct(doc: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    both = np.unique(doc.astype(np.int64) << BITS | place)
    return both >> BITS, (both & ((1 << BITS) - 1)).astype(np.uint32)


class Ftrl:
    """FTRL-proximal logistic regression on sets of places.

    Per place it keeps ``z`` and ``n``, the sum of squared slopes; a weight is
    ``-(z - sign(z) l1) / ((beta + sqrt(n)) / alpha + l2)``, and 0 while ``|z| <= l1``. The intercept is a
    place of its own without penalties.
    """

    def __init__(self, alpha: float = 1.0, beta: float = 1.0, l1: float = 10.0, l2: float = 1.0, bits: int = BITS):
        self.alpha, self.beta, self.l1, self.l2 = alpha, beta, l1, l2
        self.z, self.n = np.zeros(1 << bits), np.zeros(1 << bits)
        self.z0 = self.n0 = 0.0

    def weights(self, places: np.ndarray) -> np.ndarray:
        z, n = self.z[places], self.n[places]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0.0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.alpha + self.l2)

    def intercept(self) -> float:
        return float(-self.z0 / ((self.beta + np.sqrt(self.n0)) / self.alpha))

    def learn(self, places: np.ndarray, label: int, say: float) -> None:
        """One step on one document; its places are distinct."""
        weights, first = self.weights(places), self.intercept()
        p = 1 / (1 + np.exp(-np.clip(weights.sum() + first, -35, 35)))
        slope = (p - label) * say
        n = self.n[places]
        rate = (np.sqrt(n + slope**2) - np.sqrt(n)) / self.alpha
        self.z[places] += slope - rate * weights
        self.n[places] = n + slope**2
        self.z0 += slope - (np.sqrt(self.n0 + slope**2) - np.sqrt(self.n0)) / self.alpha * first
        self.n0 += slope**2

    def model(self) -> tuple[np.ndarray, np.ndarray, float]:
        """(places, weights, intercept) of the weights that aren't 0."""
        places = np.flatnonzero(np.abs(self.z) > self.l1).astype(np.uint32)
        return places, self.weights(places).astype(np.float32), self.intercept()


Model = tuple[np.ndarray, np.ndarray, float]
NO_MODEL: Model = (np.zeros(0, np.uint32), np.zeros(0, np.float32), 0.0)


def fit(documents: list[tuple[np.ndarray, int]], rounds: int = ROUNDS, **how) -> Model:
    """The model of (places, label), in this order."""
    counts = np.bincount([y for _, y in documents], minlength=2)
    if not counts.sum():
        return NO_MODEL
    say = [counts.sum() / (2 * c) if c else 0.0 for c in counts]
    learner = Ftrl(**how)
    for _ in range(rounds):
        for places, label in documents:
            learner.learn(places, label, say[label])
    return learner.model()


def sample(labels: DataFrame, id_col: str, label_col: str, most_docs: int) -> DataFrame:
    """(id, label, turn) of the documents that the model learns from, at most ``most_docs``."""
    known = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("id").isNotNull() & ~held_out(F.col("id")))
        .groupBy("id").agg(F.max("label").alias("label"))
        .withColumn("turn", F.xxhash64("id"))
    )
    each = [known.where(F.col("label") == y).orderBy("turn", "id").limit(most_docs // 2) for y in (0, 1)]
    return each[0].union(each[1])


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
          most_docs: int = MOST_DOCS, most_features: int = MOST_FEATURES, **how) -> Model:
    """The model of the sample of labelled documents that are not held out."""
    rows = docs.select(F.col(id_col).alias("id"), F.lower(F.col(text_col).cast("string")).alias("text")).join(
        F.broadcast(sample(labels, id_col, label_col, most_docs)), "id"
    )

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, texts in chunks(batch.column(0)):
                doc, place = distinct(*features(texts))
                bounds = np.searchsorted(doc, np.arange(texts.count + 1))
                raw = []
                for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                    own = place[a:b]
                    if len(own) > most_features:
                        own = np.sort(own[np.argsort(mix(own.astype(np.uint64)))[:most_features]])
                    raw.append(own.tobytes())
                part = batch.slice(first, last - first)
                yield pa.RecordBatch.from_arrays([part.column(1), part.column(2), pa.array(raw, pa.binary())], names=["turn", "label", "places"])

    found = rows.select("text", "turn", "label").mapInArrow(made, "turn bigint, label int, places binary").toArrow()
    turns = found.column("turn").to_numpy()
    sets = [np.frombuffer(x, np.uint32) for x in found.column("places").to_pylist()]
    ys = found.column("label").to_pylist()
    order = sorted(range(len(sets)), key=lambda i: (turns[i], ys[i], sets[i].tobytes()))
    return fit([(sets[i], ys[i]) for i in order], **how)


def scores(texts: Texts, table: np.ndarray, intercept: float) -> np.ndarray:
    """How likely each of some texts is toxic; ``table`` holds the weight of every place."""
    doc, place = features(texts)
    some = table[place] != 0
    doc, place = distinct(doc[some], place[some])
    return 1 / (1 + np.exp(-np.clip(np.bincount(doc, table[place], texts.count) + intercept, -35, 35)))


def table_of(model: Model) -> np.ndarray:
    table = np.zeros(1 << BITS, np.float32)
    table[model[0]] = model[1]
    return table


def score(text: Column, model: Model) -> Column:
    """The toxicity of a text, 0 to 1."""
    tables: list[np.ndarray] = []

    def scored(column: pa.Array) -> pa.Array:
        if not tables:
            tables.append(table_of(model))
        parts = [scores(texts, tables[0], model[2]) for _, _, texts in chunks(column)]
        return pa.array(np.concatenate(parts) if parts else np.zeros(0), pa.float64())

    scored.__annotations__ = {"column": pa.Array, "return": pa.Array}
    return F.arrow_udf(scored, "double")(F.lower(text))


def toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """(id, held_out, score, predicted) for every row."""
    model = train(docs, labels, id_col, text_col, **how)
    found = docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"), score(F.col(text_col).cast("string"), model).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
