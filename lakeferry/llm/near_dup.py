"""Near-duplicate documents by a chosen-path set similarity join on minwise tokens.

A document is the set of its shingles. Each of `TOKENS` minwise functions picks one shingle of a
set, its token for that function; two sets share a token with the probability of their Jaccard
similarity. `ROOTS` independent trees start from one token each: all sets with the same token form
a node. A node branches by one or two further tokens, chosen by the node's own hash, so that similar
sets keep meeting and others part. A node stops branching as soon as it is small: then its sets are compared exhaustively, by their tokens, and what may reach the
threshold is confirmed on the full sets.

Two exact rules keep groups of copies from costing the square of their size. Equal sets are one
set. And links are components: the members of a node that are known to be connected need no
comparison with each other, so a node counts as small once at most `MINORITY` members lie outside
its largest component, however many lie in it; these are compared with all members, `CHUNK` against
`CHUNK` at a time. For that the first step compares every set with one member of each of its
root nodes and contracts the links found. Nodes that stay large for `DEPTH` levels are compared in
the same chunks as they are.

Recall: a pair at the very threshold agrees in a binomial number of its tokens, and given that
number its trees are independent branching processes, so `missed` is the exact probability that no
tree keeps it down to a given depth. With 1 / threshold branches a node, a process is critical and dies
out the deeper it goes (11 % of pairs at depth 24 even if three quarters of the tokens agree); so the
share of nodes that branch by two, `TWICE`, is the least for which at most `MISSED` of the pairs at the
threshold are lost at the last depth, and fewer at every other. Each level then makes 1.78
memberships of one, of which a node of sets with similarity s below the threshold keeps s.
Comparing tokens drops a pair only if fewer than `LEAST_EQUAL` of 128 agree, about one in 800,000
pairs at the very threshold.

Nothing is collected: nodes, links and components are tables in the shared folder. A hot token is
counted with partial aggregation and met in joins that Spark can split.

Defined results: a text without words has the empty set and no links; rows with a null id take no
part, their component is null and they are kept; rows with the same id are one document, linked to
what any of them is linked to; an empty table gives an empty one. Only the id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeferry.llm.components import components
from lakeferry.llm.scratch import Scratch
from lakeferry.llm.words import Texts, chunks, mix, seeds, windows, within
from lakeferry.plans.workspace import session_settings

WORDS = 5
THRESHOLD = (3, 4)  # intersection : union
TOKENS = 128
ROOTS = 16
LEAST_EQUAL = 72
TINY = 32  # members that are compared as one row
MINORITY = 1024
CHUNK = 1024
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": 1024}
DEPTH = 24
MISSED = 1e-4  # of the pairs at the threshold, by the trees, at any depth


def missed(twice: float, depth: int, roots: int = ROOTS) -> float:
    """The probability that a pair at the threshold meets in no node of this depth, if a share
    ``twice`` of the nodes branches by two."""
    above, below = THRESHOLD
    chance = above / below
    equal = np.arange(TOKENS + 1)
    weight = np.array([comb(TOKENS, int(k)) * chance**k * (1 - chance) ** (TOKENS - k) for k in equal])
    kept = np.ones(TOKENS + 1)  # of a node that both are in, down to the last level
    for _ in range(depth):
        lost = 1 - equal / TOKENS * kept
        kept = 1 - ((1 - twice) * lost + twice * lost**2)
    return float((weight * (1 - equal / TOKENS * kept) ** roots).sum())


def _rate() -> float:
    """The least share of nodes that must branch by two, in thousandths."""
    fits = [n / 1000 for n in range(0, 1001, 5) if missed(n / 1000, DEPTH) <= MISSED]
    return fits[0]


TWICE = _rate()

_MASKS = seeds(TOKENS, 1 << 40)
_FACTORS = seeds(TOKENS, 1 << 41) | np.uint64(1)
_BLOCK = 4096


def shingles(texts: Texts, k: int = WORDS) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles and the bounds of each document's; repeats are not removed."""
    words = texts.word_hashes()
    n = len(words)
    found = windows(words, k)
    inside = within(texts.word_bounds, k, n)
    doc = texts.word_doc[: len(found)][inside]
    found = found[inside]
    short = np.flatnonzero((texts.n_words > 0) & (texts.n_words < k))
    if len(short):
        whole = [windows(words[texts.word_bounds[i] : texts.word_bounds[i + 1]], int(texts.n_words[i]))[0] for i in short]
        doc = np.concatenate([doc, short])
        found = np.concatenate([found, np.array(whole, np.uint64)])
        order = np.argsort(doc, kind="stable")
        doc, found = doc[order], found[order]
    return found, np.searchsorted(doc, np.arange(texts.count + 1))


def tokens_of(distinct: np.ndarray) -> np.ndarray:
    """The least value of each minwise function over a set."""
    best = np.full(TOKENS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(distinct), _BLOCK):
        values = distinct[None, at : at + _BLOCK] ^ _MASKS[:, None]
        values *= _FACTORS[:, None]
        np.minimum(best, values.min(axis=1), out=best)
    return best


def _sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    for _, _, texts in chunks(column, lower=True):
        found, bounds = shingles(texts, k)
        for i in range(texts.count):
            yield np.unique(found[bounds[i] : bounds[i + 1]])


def features(docs: DataFrame, k: int) -> DataFrame:
    """(id, n, set_a, set_b, roots, tokens): the set's size, its 128-bit hash, its root nodes and
    one byte of each token."""
    place = seeds(ROOTS, 1 << 42)

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, first, second, roots, tokens = [], [], [], [], []
            for distinct in _sets(batch.column(1), k):
                sizes.append(len(distinct))
                first.append(int(mix(distinct + np.uint64(1)).sum(dtype=np.uint64).view(np.int64)))
                second.append(int(np.bitwise_xor.reduce(mix(distinct ^ np.uint64(0xABCDEF)), initial=np.uint64(0)).view(np.int64)))
                if len(distinct):
                    least = tokens_of(distinct)
                    roots.append(mix(least[:ROOTS] ^ place).view(np.int64))
                    tokens.append((mix(least) & np.uint64(255)).astype(np.uint8).tobytes())
                else:
                    roots.append(np.zeros(0, np.int64))
                    tokens.append(None)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int64()),
                    pa.array(first, pa.int64()),
                    pa.array(second, pa.int64()),
                    pa.array(roots, pa.list_(pa.int64())),
                    pa.array(tokens, pa.binary()),
                ],
                names=["id", "n", "set_a", "set_b", "roots", "tokens"],
            )

    kind = docs.schema["id"].dataType.simpleString()
    return docs.mapInArrow(made, f"id {kind}, n long, set_a long, set_b long, roots array<long>, tokens binary")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, TOKENS)


def _equal(a: Column, b: Column) -> Column:
    """How many tokens two sets share."""

    def shared(x: pa.Array, y: pa.Array) -> pa.Array:
        if not len(x):
            return pa.array([], pa.int32())
        return pa.array((_matrix(x) == _matrix(y)).sum(axis=1).astype(np.int32))

    shared.__annotations__ = {"x": pa.Array, "y": pa.Array, "return": pa.Array}
    return F.arrow_udf(shared, "int")(a, b)


def _may_reach(n: Column, m: Column) -> Column:
    """Can sets of these sizes be similar enough?"""
    above, below = THRESHOLD
    return below * F.least(n, m) >= above * F.greatest(n, m)


class Join:
    """The steps of one similarity join; `docs` is (id, text)."""

    def __init__(self, docs: DataFrame, k: int, scratch: Scratch):
        self.docs, self.k, self.scratch = docs, k, scratch
        # batches of few rows, since each is a copy of its texts beside the arrays made of them
        with session_settings(docs.sparkSession, BATCH):
            self.features = scratch.put(features(docs, k), "features")
        first = F.min_by(F.struct("roots", "tokens"), "id")
        self.sets = scratch.put(
            self.features.where("n > 0 AND id IS NOT NULL")
            .groupBy("n", "set_a", "set_b")
            .agg(F.min("id").alias("id"), first.alias("x"))
            .select("id", "n", "set_a", "set_b", "x.roots", "x.tokens"),
            "sets",
        )

    def full(self, wanted: DataFrame, name: str) -> DataFrame:
        """(id, shingles): the whole sets of the ids (id)."""
        k = self.k

        def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = 0
                held, size = [], 0
                for distinct in _sets(batch.column(1), k):
                    held.append(distinct.view(np.int64))
                    size += len(distinct)
                    if size > 1 << 20:
                        yield _listed(batch.column(0), at, held)
                        at += len(held)
                        held, size = [], 0
                if held:
                    yield _listed(batch.column(0), at, held)

        kind = self.docs.schema["id"].dataType.simpleString()
        # always the same plan: texts are dealt by id, never met by a table that grows with them
        texts = self.docs.join(wanted.distinct().hint("shuffle_hash"), "id", "left_semi").select("id", "text")
        with session_settings(self.docs.sparkSession, BATCH):
            found = self.scratch.put(texts.mapInArrow(made, f"id {kind}, shingles array<long>"), name)
        self.scratch.release()
        return found

    def confirmed(self, pairs: DataFrame, full: DataFrame, name: str) -> DataFrame:
        """The pairs (a, b) that reach the threshold on their full sets."""
        both = pairs.join(full.select(F.col("id").alias("a"), F.col("shingles").alias("x")), "a").join(
            full.select(F.col("id").alias("b"), F.col("shingles").alias("y")), "b"
        )
        above, below = THRESHOLD
        shared = F.size(F.array_intersect("x", "y"))
        links = both.where(below * shared >= above * (F.size("x") + F.size("y") - shared)).select("a", "b")
        return self.scratch.put(links.distinct(), name)

    def stars(self) -> tuple[DataFrame, DataFrame]:
        """Root nodes of two sets or more (node, id), and the links to one member of each."""
        members = self.sets.select("id", F.explode("roots").alias("node"))
        # one member of each node, chosen by a hash, so that a set meets many others over its roots
        one = F.min_by("id", F.struct(F.xxhash64("node", "id"), "id")).alias("one")
        # written before the join: Spark splits a hot node of two plain shuffles, not of an aggregate
        nodes = self.scratch.put(members.groupBy("node").agg(F.count("*").alias("size"), one).where("size > 1"), "root-nodes")
        roots = self.scratch.put(members.join(nodes, "node").select("node", "id", "one"), "roots")
        pairs = _ordered(roots.where("id <> one").select(F.col("one").alias("a"), F.col("id").alias("b")))
        tokens = self.sets.select("id", "n", "tokens")
        both = pairs.join(tokens.toDF("a", "n_a", "tokens_a"), "a").join(tokens.toDF("b", "n_b", "tokens_b"), "b")
        near = both.where(_may_reach(F.col("n_a"), F.col("n_b")))
        near = near.where(_equal(F.col("tokens_a"), F.col("tokens_b")) >= LEAST_EQUAL).select("a", "b")
        near = self.scratch.put(near, "star-pairs")
        full = self.full(near.select(F.explode(F.array("a", "b")).alias("id")), "star-sets")
        links = self.confirmed(near, full, "star-links")
        self.scratch.drop("star-pairs", "star-sets")
        return roots.select("node", "id"), links

    def trees(self, roots: DataFrame, known: DataFrame) -> DataFrame:
        """Links (a, b) between different known components, enough of them to connect these."""
        scratch, sets = self.scratch, self.sets.select("id", "n", "tokens")
        members = roots.join(known, "id", "left").select("node", "id", F.coalesce("component", "id").alias("component"))
        members = scratch.put(members, "rooted")
        levels = []
        for depth in range(DEPTH + 1):
            alive = members.join(scratch.put(_sizes(members), f"sizes-{depth}"), "node")
            if not depth:  # sizes need ids only; tokens follow for the nodes that are left
                alive = alive.join(sets, "id")
            alive = scratch.put(alive, f"alive-{depth}")
            large = (F.col("minority") > MINORITY) & F.lit(depth < DEPTH)
            levels.append(alive.where(~large))
            rest = alive.where(large)
            if rest.isEmpty():
                break
            members = _branched(rest)
        small = reduce(DataFrame.union, [x.select(*levels[0].columns) for x in levels])
        pairs = scratch.put(_compared_tiny(small.where(F.col("size") <= TINY)), "tree-pairs")
        near = scratch.put(_near(small.where(F.col("size") > TINY)), "tree-near")
        scratch.drop("rooted", "root-nodes", *[f"{name}-{depth}" for name in ("alive", "sizes") for depth in range(len(levels))])
        wanted = pairs.select(F.explode(F.array("a", "b")).alias("id")).union(near.select("id"))
        full = self.full(wanted, "tree-sets")
        links = self.confirmed(pairs, full, "tree-links").union(_connected(near.join(full, "id")))
        return scratch.put(links.distinct(), "more-links")

    def run(self) -> DataFrame:
        """(id, component) of every set that is linked."""
        roots, links = self.stars()
        known = self.scratch.put(components(links, self.scratch), "known")
        self.scratch.release()
        more = self.trees(roots, known)
        # links between components decide the rest
        name = lambda side: known.select(F.col("id").alias(side), F.col("component").alias(f"{side}_of"))
        lifted = (
            more.join(name("a"), "a", "left").join(name("b"), "b", "left")
            .select(F.coalesce("a_of", "a").alias("a"), F.coalesce("b_of", "b").alias("b"))
        )
        merged = components(lifted, self.scratch).select(F.col("id").alias("component"), F.col("component").alias("root"))
        again = known.join(merged, "component", "left").select("id", F.coalesce("root", "component").alias("component"))
        rest = merged.join(known, merged["component"] == known["id"], "left_anti").select(
            F.col("component").alias("id"), F.col("root").alias("component")
        )
        return self.scratch.put(again.union(rest), "components")


def _listed(ids: pa.Array, at: int, held: list[np.ndarray]) -> pa.RecordBatch:
    bounds = np.cumsum([0] + [len(h) for h in held])
    values = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(np.concatenate(held), pa.int64()))
    return pa.RecordBatch.from_arrays([ids.slice(at, len(held)), values], names=["id", "shingles"])


def _sizes(members: DataFrame) -> DataFrame:
    """(node, major, size, minority) of the nodes with more than one component: the largest
    component, the number of members, and of those outside it."""
    counts = members.groupBy("node", "component").agg(F.count("*").alias("n"))
    return (
        counts.groupBy("node")
        .agg(F.sum("n").alias("size"), F.max("n").alias("most"), F.max_by("component", F.struct("n", "component")).alias("major"))
        .where("size > most")
        .select("node", "major", "size", (F.col("size") - F.col("most")).alias("minority"))
    )


def _branched(members: DataFrame) -> DataFrame:
    """The children of every node: by one token, or by two for `TWICE` of the nodes."""
    first = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(TOKENS))
    second = F.pmod(first + 1 + F.pmod(F.xxhash64("node", F.lit(2)), F.lit(TOKENS - 1)), F.lit(TOKENS))
    twice = F.pmod(F.xxhash64("node", F.lit(3)), F.lit(1000)) < round(1000 * TWICE)
    chosen = F.when(twice, F.array(first, second)).otherwise(F.array(first))
    child = F.xxhash64("node", "chosen", F.expr("substring(tokens, cast(chosen + 1 as int), 1)"))
    return members.withColumn("chosen", F.explode(chosen)).select(child.alias("node"), "id", "component", "n", "tokens")


def _close(tokens: np.ndarray, others: np.ndarray, parts: np.ndarray, other_parts: np.ndarray,
           sizes: np.ndarray, other_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rows, other rows) of different components that may reach the threshold."""
    above, below = THRESHOLD
    rows, columns = [], []
    for i in range(len(tokens)):
        fits = other_parts != parts[i]
        fits &= below * np.minimum(other_sizes, sizes[i]) >= above * np.maximum(other_sizes, sizes[i])
        where = np.flatnonzero(fits)
        if len(where):
            where = where[(others[where] == tokens[i]).sum(axis=1) >= LEAST_EQUAL]
            rows.append(np.full(len(where), i))
            columns.append(where)
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *rows]), np.concatenate([none, *columns])


def _compared_tiny(members: DataFrame) -> DataFrame:
    """Pairs (a, b) inside nodes of few members, one row per node."""
    nodes = members.groupBy("node").agg(F.collect_list(F.struct("id", "component", "n", "tokens")).alias("members"))
    kind = members.schema["id"].dataType.simpleString()

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held = batch.column(0)
            flat = held.flatten()
            if not len(flat):
                continue
            bounds = np.concatenate([[0], np.cumsum(held.value_lengths().to_numpy(False))]).astype(np.int64)
            tokens, parts, sizes = _matrix(flat.field(3)), flat.field(1).to_numpy(False), flat.field(2).to_numpy(False)
            left, right = [], []
            for a, b in zip(bounds[:-1], bounds[1:], strict=True):
                i, j = _close(tokens[a:b], tokens[a:b], parts[a:b], parts[a:b], sizes[a:b], sizes[a:b])
                left.append(a + i[i < j])
                right.append(a + j[i < j])
            ids = flat.field(0)
            taken = [ids.take(pa.array(np.concatenate(x), pa.int64())) for x in (left, right)]
            yield pa.RecordBatch.from_arrays(taken, names=["a", "b"])

    return _ordered(nodes.select("members").mapInArrow(made, f"a {kind}, b {kind}"))


def _near(members: DataFrame) -> DataFrame:
    """Of every node's minority and all its members, chunk against chunk, those that may reach the
    threshold with one of another component: one row each, however many there are."""
    spread = lambda n: F.sequence(F.lit(0), F.ceil(n / CHUNK).cast("int") - 1)
    chunk = lambda n: F.pmod(F.xxhash64("id"), F.ceil(n / CHUNK)).cast("int")
    size, minority = F.col("size"), F.col("minority")
    columns = ["node", "own", "other", "asked", "id", "component", "n", "tokens"]
    every = members.withColumns({"own": chunk(size), "other": F.explode(spread(minority)), "asked": F.lit(False)})
    asked = members.where("component <> major").withColumns(
        {"own": F.explode(spread(size)), "other": chunk(minority), "asked": F.lit(True)}
    )
    both = every.select(*columns).union(asked.select(*columns))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in both.schema.fields)

    def made(table: pa.Table) -> pa.Table:
        batch = table.combine_chunks().to_batches()[0]
        mine, others = _sides(batch)
        if not len(mine) or not len(others):
            return table.slice(0, 0)
        tokens, parts, sizes = _matrix(batch.column("tokens")), *(batch.column(c).to_numpy(False) for c in ("component", "n"))
        i, j = _close(tokens[mine], tokens[others], parts[mine], parts[others], sizes[mine], sizes[others])
        kept = np.union1d(mine[i], others[j])
        return table.take(pa.array(kept, pa.int64()))

    return both.groupBy("node", "own", "other").applyInArrow(made, kinds)


def _sides(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    asked = batch.column("asked").to_numpy(False)
    return np.flatnonzero(~asked), np.flatnonzero(asked)


def _connected(members: DataFrame) -> DataFrame:
    """Links (a, b) that reach the threshold on the full sets and connect what was not connected,
    inside each chunk; others between the same sets of components are left out."""
    kind = members.schema["id"].dataType.simpleString()
    above, below = THRESHOLD

    def made(table: pa.Table) -> pa.Table:
        batch = table.combine_chunks().to_batches()[0]
        mine, others = _sides(batch)
        ids, left, right = batch.column("id"), [], []
        if len(mine) and len(others):
            tokens, parts, sizes = _matrix(batch.column("tokens")), *(batch.column(c).to_numpy(False) for c in ("component", "n"))
            sets = [x.values.to_numpy(False) for x in batch.column("shingles")]
            words, codes = np.unique(np.concatenate([sets[k] for k in mine]), return_inverse=True)
            lengths = np.array([len(sets[k]) for k in mine])
            starts = np.cumsum(lengths) - lengths
            _, parts = np.unique(parts, return_inverse=True)
            root = np.arange(len(parts))
            for j in others:
                own = root[parts]
                _, i = _close(tokens[j : j + 1], tokens[mine], own[j : j + 1], own[mine], sizes[j : j + 1], sizes[mine])
                if not len(i):
                    continue
                held = np.zeros(len(words), np.int64)
                at = np.minimum(np.searchsorted(words, sets[j]), len(words) - 1)
                held[at[words[at] == sets[j]]] = 1
                shared = np.add.reduceat(held[codes], starts)[i]
                linked = i[below * shared >= above * (lengths[i] + len(sets[j]) - shared)]
                # one link to each component that is met
                met, first = np.unique(own[mine[linked]], return_index=True)
                left += mine[linked[first]].tolist()
                right += [j] * len(met)
                if len(met):
                    root[np.isin(root, met)] = root[parts[j]]
        take = lambda x: ids.take(pa.array(x, pa.int64()))
        return pa.table({"a": take(left), "b": take(right)})

    return _ordered(members.groupBy("node", "own", "other").applyInArrow(made, f"a {kind}, b {kind}"))


def _ordered(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = WORDS) -> DataFrame:
    """(id, n_shingles, component_id, kept) for every row."""
    own = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    join = Join(own, k, Scratch(docs.sparkSession))
    linked = join.run()
    keys = ["n", "set_a", "set_b"]
    of_set = join.sets.select(*keys, F.col("id").alias("first")).join(
        linked.select(F.col("id").alias("first"), "component"), "first", "left"
    )
    rows = join.features.select("id", *keys).join(of_set, keys, "left")
    found = rows.select(
        "id", F.col("n").alias("n_shingles"), F.coalesce("component", "first", "id").alias("component_id")
    )
    found = found.withColumn("component_id", F.when(F.col("id").isNotNull(), F.col("component_id")))
    return found.select(
        F.col("id").alias(id_col), "n_shingles", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that are the first of their group of near duplicates."""
    free = "gone" + "_" * max(map(len, docs.columns))  # longer than any column of the rows
    gone = near_duplicates(docs, id_col, text_col, **how).where("NOT kept").select(F.col(id_col).alias(free))
    return docs.join(gone, F.col(id_col) == F.col(free), "left_anti")
