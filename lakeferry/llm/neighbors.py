"""Approximate nearest neighbours by stable projections, a kd-tree and a chi-square stop.

Vectors of length 1 are projected by a fixed Gaussian matrix to `PLANES` numbers; a distance d
becomes one whose square over d squared follows a chi-square distribution with `PLANES` degrees of
freedom. A kd-tree over the projections yields projected neighbours from near to far; each is
verified in the original space. The search stops once a vector as near as the k-th found so far
would, with probability `CERTAIN`, have been met already: when the squared projected distance
reached is at least the chi-square quantile times the squared distance of the k-th. So every true
neighbour is found with at least that probability, whatever the data.

Every vector is indexed, in blocks: equal vectors first become one entry that keeps their k + 1
smallest ids (more can never be in a result), then entries are dealt into blocks of about
`BLOCK_ROWS` by a hash, each with a kd-tree of its own. Queries are a stated set, in blocks of
`QUERY_ROWS`; each block of queries meets each block of vectors once, and the k best of every
meeting are merged, first within a block pair, then by partial aggregation over all of them.

Defined results: vectors that are null, zero, of another length than most in their block of
equal lengths, or that hold a null or a non-finite component take no part, neither as query nor
as candidate; vectors of different lengths never meet. Rows with a null id take no part. Rows of
the same id and vector are one. Ties go to the smaller id. An empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeferry.llm.scratch import Scratch
from lakeferry.llm.words import seeds
from lakeferry.plans.workspace import session_settings

PLANES = 16  # even, so that the chi-square distribution is a finite sum
CERTAIN = 0.97
LEAF = 64
LEAVES_AT_ONCE = 8
BLOCK_ROWS = 8192
QUERY_ROWS = 2048


def chi_square_quantile(certain: float, degrees: int) -> float:
    """The value that a chi-square variable of even degrees is below with a probability."""

    def below(x: float) -> float:
        term, total = 1.0, 1.0
        for i in range(1, degrees // 2):
            term *= x / 2 / i
            total += term
        return 1 - float(np.exp(-x / 2)) * total

    low, high = 0.0, 10.0 * degrees + 100
    for _ in range(100):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) < certain else (low, middle)
    return high


def planes(dimension: int, count: int = PLANES) -> np.ndarray:
    """A Gaussian matrix, the same in every process."""
    raw = seeds(2 * dimension * count, 1 << 43)
    uniform = (raw >> np.uint64(11)).astype(float) / 2**53
    a, b = np.split(np.clip(uniform, 1e-300, 1), 2)
    return (np.sqrt(-2 * np.log(a)) * np.cos(2 * np.pi * b)).reshape(dimension, count)


class Tree:
    """A kd-tree over the projections of some unit vectors, as a list of leaf boxes."""

    def __init__(self, units: np.ndarray, matrix: np.ndarray):
        self.units = units
        self.points = units @ matrix
        self.leaves = []
        todo = [np.arange(len(units))]
        while todo:
            rows = todo.pop()
            if len(rows) <= LEAF:
                self.leaves.append(rows)
                continue
            points = self.points[rows]
            axis = int(np.argmax(points.max(0) - points.min(0)))
            half = len(rows) // 2
            order = np.argpartition(points[:, axis], half)
            todo += [rows[order[:half]], rows[order[half:]]]
        self.low = np.array([self.points[rows].min(0) for rows in self.leaves])
        self.high = np.array([self.points[rows].max(0) for rows in self.leaves])

    def search(self, unit: np.ndarray, point: np.ndarray, enough, quantile: float) -> tuple[np.ndarray, np.ndarray]:
        """(rows, cosines) verified until the chi-square stop. ``enough(rows, cosines)`` is the
        k-th best cosine of what was verified, or None."""
        outside = np.maximum(self.low - point, 0) + np.maximum(point - self.high, 0)
        reach = (outside**2).sum(1)
        order = np.argsort(reach, kind="stable")
        rows, cosines = [], []
        for at in range(0, len(order), LEAVES_AT_ONCE):
            if at:
                kth = enough(np.concatenate(rows), np.concatenate(cosines))
                if kth is not None and reach[order[at]] >= quantile * max(2 - 2 * kth, 0) + 1e-12:
                    break
            some = np.concatenate([self.leaves[i] for i in order[at : at + LEAVES_AT_ONCE]])
            rows.append(some)
            cosines.append(self.units[some] @ unit)
        return np.concatenate(rows), np.concatenate(cosines)


def _usable(vector: Column) -> Column:
    odd = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return vector.isNotNull() & ~odd & F.exists(vector, lambda x: x != 0)


def _stack(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(False).astype(float).reshape(-1, dimension)


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
            vector_col: str = "embedding", certain: float = CERTAIN) -> DataFrame:
    """(query_id, rank, id, score): the ``k`` nearest by cosine of every row that ``is_query``."""
    spark = vectors.sparkSession
    scratch = Scratch(spark)
    rows = vectors.select(
        F.col(id_col).cast("long").alias("id"),
        F.col(vector_col).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asked"),
    ).where(F.col("id").isNotNull() & _usable(F.col("vector")))
    rows = scratch.put(rows, "rows")
    # the k + 1 smallest ids of equal vectors; the rank limit also works before the shuffle
    by_vector = Window.partitionBy("vector").orderBy("id")
    entries = (
        rows.select("id", "vector").withColumn("place", F.dense_rank().over(by_vector)).where(F.col("place") <= k + 1)
        .groupBy("vector").agg(F.sort_array(F.collect_set("id")).alias("ids"))
    )
    entries = scratch.put(entries.withColumn("key", F.xxhash64("vector")), "entries")
    length = F.size("vector").alias("dimension")
    n_entries, n_asked = entries.count(), rows.where("asked").count()
    blocks = max(1, -(-n_entries // BLOCK_ROWS))
    asked_blocks = max(1, -(-n_asked // QUERY_ROWS))
    candidates = entries.groupBy(length, F.pmod("key", F.lit(blocks)).alias("block")).agg(
        F.collect_list(F.struct("ids", "vector")).alias("entries")
    )
    asked = (
        rows.where("asked").select("id", "vector").distinct()
        .groupBy(length, F.pmod(F.xxhash64("id"), F.lit(asked_blocks)).alias("asked_block"))
        .agg(F.collect_list(F.struct("id", "vector")).alias("queries"))
    )
    spread = candidates.withColumn("asked_block", F.explode(F.sequence(F.lit(0), F.lit(asked_blocks - 1))))
    pairs = spread.join(asked, ["dimension", "asked_block"]).repartition("dimension", "block", "asked_block")
    quantile = chi_square_quantile(certain, PLANES)

    def searched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                dimension = batch.column("dimension")[i].as_py()
                yield _block(batch.column("entries")[i].values, batch.column("queries")[i].values, dimension, k, quantile)

    schema = "query_id long, id long, score double"
    # a row is two blocks, so each makes a batch of its own
    with session_settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": 1}):
        found = scratch.put(pairs.select("dimension", "entries", "queries").mapInArrow(searched, schema), "found")
    scratch.drop("rows", "entries")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("id"))
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", F.col("id").alias(id_col), "score")


def _block(entries: pa.StructArray, queries: pa.StructArray, dimension: int, k: int, quantile: float) -> pa.RecordBatch:
    """The k best of one block of vectors for each of one block of queries."""
    ids, vectors = entries.field(0), _stack(entries.field(1), dimension)
    flat, counts = ids.flatten().to_numpy(False), ids.value_lengths().to_numpy(False).astype(np.int64)
    first = np.cumsum(counts) - counts
    norms = np.sqrt((vectors**2).sum(1))
    matrix = planes(dimension)
    tree = Tree(vectors / norms[:, None], matrix)
    asked, wanted = queries.field(0).to_numpy(False), _stack(queries.field(1), dimension)
    own_norms = np.sqrt((wanted**2).sum(1))
    units = wanted / own_norms[:, None]
    points = units @ matrix
    out_query, out_id, out_score = [], [], []
    for q in range(len(asked)):

        def kth(rows: np.ndarray, cosines: np.ndarray) -> float | None:
            # of all ids behind the entries, with one to spare for the query itself
            m = min(k + 1, len(rows))
            top = np.argpartition(-cosines, m - 1)[:m]
            top = top[np.argsort(-cosines[top])]
            enough = np.flatnonzero(np.cumsum(counts[rows[top]]) >= k + 1)
            return float(cosines[top[enough[0]]]) if len(enough) else None

        rows, cosines = tree.search(units[q], points[q], kth, quantile)
        if len(rows) > 2 * k + 2:
            limit = -np.partition(-cosines, k)[k] - 1e-9
            rows = rows[cosines >= limit]
        score = (vectors[rows] * wanted[q]).sum(1) / (norms[rows] * own_norms[q])
        each = counts[rows]
        at = np.repeat(first[rows] - (np.cumsum(each) - each), each) + np.arange(int(each.sum()))
        names, values = flat[at], np.repeat(score, each)
        other = names != asked[q]
        names, values = names[other], values[other]
        order = np.lexsort((names, -values))[:k]
        out_query += [asked[q]] * len(order)
        out_id.append(names[order])
        out_score.append(values[order])
    join = lambda parts, kind: np.concatenate(parts) if parts else np.zeros(0, kind)
    return pa.RecordBatch.from_arrays(
        [pa.array(np.array(out_query, np.int64)), pa.array(join(out_id, np.int64), pa.int64()), pa.array(join(out_score, float), pa.float64())],
        names=["query_id", "id", "score"],
    )
