"""The trie of conversation prefixes, rolled up by centroid decomposition of its parent edges.

Every distinct sequence of first turns is a node. A node's name is a SHA-256 hash of its turns, so equal
prefixes of different conversations meet by name; names are chained inside blocks of `BLOCK` turns, and
the blocks' own names are chained the same way one level up, so that a conversation of any length is
work for many tasks and no array is longer than a block.

Subtree totals come from centroid decomposition. Every node starts with the number of turns at and below
it in all conversations, a weight that a group by name gives at once. In a component the nodes
with more than half of its weight are the path from its top to its centroid. The centroid splits the
component into one piece for each child and one above it; the values of the centroid and of its child pieces
are summed once per component and added to every node of the path, whose weights shrink by the
centroid's. Every split at least halves the weight, so there are as many rounds as the weight has binary
digits, whatever the trie's depth or breadth. Components above `LARGE` are split by joins and partial
aggregations over all tasks; smaller ones are dealt out whole, and a task splits thousands of them at
once in arrays.

Scale: turns are numbered by a range sort, in which a conversation may span any number of tasks; texts
are reduced to hashes before the first shuffle. Hot prefixes are combined on the map side; joins have
one row per key on one side, written before, so that adaptive execution can split the other. The ids of
the conversations that end at a node are hashed in order, in ready-made pieces of many ids; this hash is
a stream, so the pieces of one node pass through one task, but are never held there.

Defined results: turns are ordered by number, null first, equal ones by their hash, and repeated rows
are turns of their own; null roles and texts are empty; rows without a conversation id are left out; a
conversation without turns of its own ends where its opening does, at the root if that is empty; an
empty table has no nodes, not even a root; extra columns are left out, whatever they are called.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeferry.llm.scratch import Scratch

BLOCK = 64
LARGE = 1 << 14
# Nodes of small components that a task splits at once.
CHUNK_NODES = 1 << 16
ROOT = bytes(32)


@dataclass
class Trie:
    """``nodes``: name, parent (a name), conv (smallest member), parent_conv, depth, n_convs, n_ends,
    n_children, n_leaves, saved. ``ends``: name, conv for every conversation and the node it ends at."""

    nodes: DataFrame
    ends: DataFrame


def _hash(*parts: Column) -> Column:
    return F.unhex(F.sha2(F.concat(*parts), 256))


def _turns(rows: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    size = F.length(role).cast("string")
    return rows.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
        _hash(F.encode(F.concat(size, F.lit(":"), role, text), "UTF-8")).alias("digest"),
        F.length(text).cast("long").alias("chars"),
    )


def numbered(turns: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv, place, digest, chars): turns with their places from 0, in the order of turn and digest."""
    keys = ["conv", "turn", "digest", "row"]
    rows = turns.withColumn("row", F.monotonically_increasing_id())
    dealt = rows.repartitionByRange(*keys).sortWithinPartitions(*keys).select("conv", "digest", "chars", F.spark_partition_id().alias("part"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, reached = None, 0
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            conv = batch.column(0).to_numpy(zero_copy_only=False)
            opens = np.ones(n, bool)
            opens[1:] = conv[1:] != conv[:-1]
            at = np.arange(n)
            place = at - np.maximum.accumulate(np.where(opens, at, 0))
            if last is not None and conv[0] == last:
                ends = int(np.flatnonzero(opens)[1]) if opens.sum() > 1 else n
                place[:ends] += reached
            last, reached = conv[-1], int(place[-1]) + 1
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(place, pa.int64())], names=[*batch.schema.names, "place"])

    kind = turns.schema["conv"].dataType.simpleString()
    counted = scratch.put(dealt.mapInArrow(count, f"conv {kind}, digest binary, chars bigint, part int, place bigint"), "numbered")
    # one row per task: where its first conversation stands after the tasks before
    parts = counted.groupBy("part").agg(F.min("conv").alias("first"), F.max(F.struct("conv", "place")).alias("last"))
    reached = F.sum(F.col("last.place") + 1).over(Window.partitionBy("last.conv").orderBy("part"))
    before = F.lag(F.struct(F.col("last.conv").alias("conv"), "reached")).over(Window.orderBy("part"))
    carried = (
        parts.withColumn("reached", reached).withColumn("before", before)
        .where(F.col("before.conv") == F.col("first"))
        .select("part", F.col("first").alias("conv"), F.col("before.reached").alias("carried"))
    )
    return counted.join(F.broadcast(carried), ["part", "conv"], "left").select(
        "conv", (F.col("place") + F.coalesce("carried", F.lit(0))).alias("place"), "digest", "chars"
    )


def opened(rows: DataFrame, opening: tuple[Column, Column] | None, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """(turns, conversations) after every conversation took its opening.

    ``opening`` is, for a ``conv``, another conversation and how many of its first turns replace as
    many of its own; all of them if it has fewer, none if there is no such conversation. The turns
    have the conversation's ``length``.
    """
    sizes = scratch.put(rows.groupBy("conv").agg((F.max("place") + 1).alias("n")), "sizes")
    if opening is None:
        facts = sizes.select("conv", F.col("n").alias("length"))
        return rows.join(facts, "conv"), facts
    other, head = (c.cast(k) for c, k in zip(opening, (sizes.schema["conv"].dataType, "long"), strict=True))
    heads = sizes.select("conv", "n", other.alias("other"), F.coalesce(head, F.lit(0)).alias("head"))
    known = heads.join(sizes.select(F.col("conv").alias("other"), F.col("n").alias("given")), "other", "left")
    taken = F.least("head", F.coalesce("given", F.lit(0).cast("long")))
    facts = known.withColumn("taken", taken).withColumn("length", F.col("taken") + F.greatest(F.col("n") - F.col("head"), F.lit(0)))
    facts = scratch.put(facts.drop("given"), "facts")
    own = rows.join(facts.select("conv", "head", "taken", "length"), "conv").where("place >= head").select(
        "conv", (F.col("place") - F.col("head") + F.col("taken")).alias("place"), "digest", "chars", "length"
    )
    wanted = facts.where("taken > 0").select(
        F.col("conv").alias("to"), F.col("other").alias("conv"), "length",
        F.explode(F.sequence(F.lit(0).cast("long"), F.col("taken") - 1)).alias("place"),
    )
    borrowed = rows.join(wanted, ["conv", "place"]).select(F.col("to").alias("conv"), "place", "digest", "chars", "length")
    return own.unionByName(borrowed), facts.select("conv", "length")


def prefix_names(rows: DataFrame, longest: int, scratch: Scratch, level: int = 0) -> DataFrame:
    """(conv, depth, name, parent, chars, length): a row for every turn, with the names of the prefixes
    that end with it and before it.

    At depth ``b * BLOCK + r`` with ``b`` whole blocks the name joins that of the ``b`` blocks and that of
    the ``r`` turns after them; the former is found the same way among the blocks.
    """
    zero = F.lit(ROOT)
    blocks = (
        rows.withColumn("block", F.floor(F.col("place") / BLOCK))
        .groupBy("conv", "block")
        .agg(F.array_sort(F.collect_list(F.struct("place", "digest", "chars"))).alias("items"), F.max("length").alias("length"))
        .withColumn("names", F.aggregate("items", F.array(zero), lambda names, x: F.concat(names, F.array(_hash(F.element_at(names, -1), x["digest"])))))
    )
    if longest < BLOCK:
        blocks = blocks.withColumn("before", F.lit(None).cast("binary")).withColumn("through", F.lit(None).cast("binary"))
    else:
        blocks = scratch.put(blocks, f"blocks-{level}")
        whole = F.size("items") == BLOCK
        above = blocks.where(whole).select(
            "conv", F.col("block").alias("place"), F.element_at("names", -1).alias("digest"),
            F.lit(0).cast("long").alias("chars"), F.floor(F.col("length") / BLOCK).alias("length"),
        )
        upper = scratch.put(prefix_names(above, longest // BLOCK, scratch, level + 1).select("conv", "depth", "name"), f"upper-{level}")
        before = upper.select("conv", F.col("depth").alias("block"), F.col("name").alias("before"))
        through = upper.select("conv", (F.col("depth") - 1).alias("block"), F.col("name").alias("through"))
        long = (F.col("block") > 0) | whole
        short = blocks.where(~long).withColumn("before", F.lit(None).cast("binary")).withColumn("through", F.lit(None).cast("binary"))
        blocks = blocks.where(long).join(before, ["conv", "block"], "left").join(through, ["conv", "block"], "left").select(*short.columns).union(short)

    def name(i: Column) -> Column:
        part = F.element_at("names", i + 1)
        joined = _hash(F.lit(b"blocks"), F.when(i == BLOCK, F.col("through")).otherwise(F.col("before")), F.when(i == BLOCK, zero).otherwise(part))
        return F.when((i < BLOCK) & F.col("before").isNull(), part).otherwise(joined)

    at = blocks.select("*", F.posexplode("items").alias("at", "item"))
    return at.select(
        "conv", (F.col("item.place") + 1).alias("depth"), name(F.col("at") + 1).alias("name"), name(F.col("at")).alias("parent"),
        F.col("item.chars").alias("chars"), "length",
    )


def split_all(parent: np.ndarray, depth: np.ndarray, weight: np.ndarray, values: list[np.ndarray]) -> list[np.ndarray]:
    """Subtree sums of ``values`` by centroid decomposition of all trees of a forest at once.

    ``parent`` holds places, -1 at the tops; ``weight`` is any sum of positive weights over subtrees.
    """
    n = len(parent)
    weight, live = weight.astype(np.int64), np.arange(n)
    sums = [np.zeros(n, np.int64) for _ in values]
    gone = np.zeros(n + 1, bool)
    gone[-1] = True  # the parent of tops
    top = np.arange(n)

    def follow() -> None:
        """Point every living node at the top of its piece."""
        top[live] = np.where(gone[parent[live]], live, parent[live])
        while True:
            further = top[top[live]]
            if (further == top[live]).all():
                return
            top[live] = further

    follow()
    heaviest, centroid = np.zeros(n, np.int64), np.full(n, -1)
    while len(live):
        piece = top[live]
        heaviest[piece] = weight[piece]
        path = live[2 * weight[live] > heaviest[piece]]
        path = path[np.argsort(depth[path], kind="stable")]
        centroid[top[path]] = path  # the deepest is written last
        split = centroid[np.unique(piece)]
        of_path = centroid[top[path]]
        gone[split] = True
        live = live[~gone[live]]
        old = top[live].copy()
        follow()
        under = parent[top[live]] == centroid[old]
        for value, total in zip(values, sums, strict=True):
            found = np.zeros(n, np.int64)
            found[split] = value[split]
            np.add.at(found, centroid[old[under]], value[live[under]])
            total[path] += found[of_path]
        weight[path] -= np.where(path == of_path, 0, weight[of_path])
    return sums


def _split_small(small: DataFrame, names: list[str]) -> DataFrame:
    """(name, sums) of components that fit into a task, many at a time."""

    def chunk(table: pa.Table) -> pa.RecordBatch:
        table = table.combine_chunks()
        parent = pc.fill_null(pc.index_in(table["parent"], value_set=table["name"].combine_chunks()), -1).to_numpy().astype(np.int64)
        sums = split_all(parent, table["depth"].to_numpy(), table["weight"].to_numpy(), [table[f"own_{c}"].to_numpy() for c in names])
        added = [pa.array(total + table[c].to_numpy()) for c, total in zip(names, sums, strict=True)]
        return pa.RecordBatch.from_arrays([table["name"].combine_chunks(), *added], names=["name", *names])

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) < CHUNK_NODES:
                continue
            table = pa.Table.from_batches(held)
            same = pc.equal(table["comp"], table["comp"][-1]).to_numpy()
            whole = int(np.argmax(same))  # the last component may go on
            if whole:
                yield chunk(table.slice(0, whole))
                held = table.slice(whole).combine_chunks().to_batches()
        if held and sum(b.num_rows for b in held):
            yield chunk(pa.Table.from_batches(held))

    columns = ", ".join(f"{c} bigint" for c in names)
    return small.repartition("comp").sortWithinPartitions("comp").mapInArrow(split, f"name binary, {columns}")


def rollup(nodes: DataFrame, paths: DataFrame, values: dict[str, Column], scratch: Scratch, large: int = LARGE) -> DataFrame:
    """(name, sums): ``values`` summed over the subtree of every node.

    ``nodes`` has name, parent, conv (any member), depth and weight (over the subtree), ``paths`` a row
    (conv, name, parent) for every node that a conversation passes.
    """
    names = list(values)
    zero = F.lit(0).cast("long")
    state = nodes.select(
        "name", "parent", "conv", "depth", "weight", F.lit(ROOT).alias("comp"),
        *[v.cast("long").alias(f"own_{c}") for c, v in values.items()], *[zero.alias(c) for c in names],
    )
    columns, done, step = state.columns, [], 0
    state = scratch.put(state, "state-0")
    while True:
        totals = state.groupBy("comp").agg(F.max("weight").alias("total")).where(F.col("total") > large)
        totals = scratch.put(totals, f"totals-{step}")
        if totals.isEmpty():
            break
        # kept for the end: it is read once more, with the small components of all rounds
        done.append(_split_small(state.join(totals, "comp", "left_anti"), names))
        above = state.join(totals, "comp").where(2 * F.col("weight") > F.col("total"))
        centroids = above.groupBy("comp").agg(F.max(F.struct("depth", "name", "weight", "total")).alias("c"))
        centroids = scratch.put(centroids.select("comp", *[F.col(f"c.{x}").alias(f"c_{x}") for x in ("depth", "name", "weight", "total")]), f"centroids-{step}")
        below = paths.join(centroids.select("comp", F.col("c_name").alias("parent")), "parent").select("comp", "conv", F.col("name").alias("piece"))
        below = scratch.put(below, f"below-{step}")
        under = F.col("piece").isNotNull() & (F.col("depth") > F.col("c_depth"))
        moved = (
            state.join(centroids, "comp").join(below, ["comp", "conv"], "left")
            .withColumn("under", under)
            .withColumn("split", F.col("name") == F.col("c_name"))
            .withColumn("above", 2 * F.col("weight") > F.col("c_total"))
        )
        moved = scratch.put(moved, f"moved-{step}")
        inside = moved.where("under OR split").groupBy("comp").agg(*[F.sum(f"own_{c}").alias(f"sum_{c}") for c in names])
        inside = scratch.put(inside, f"inside-{step}")
        after = moved.join(inside, "comp").select(
            "name", "parent", "conv", "depth", "split",
            F.when(F.col("above") & ~F.col("split"), F.col("weight") - F.col("c_weight")).otherwise(F.col("weight")).alias("weight"),
            F.when(F.col("under"), F.col("piece")).otherwise(F.col("comp")).alias("comp"),
            *[F.col(f"own_{c}") for c in names],
            *[F.when(F.col("above"), F.col(c) + F.col(f"sum_{c}")).otherwise(F.col(c)).alias(c) for c in names],
        )
        after = scratch.put(after, f"after-{step}")
        scratch.drop(f"moved-{step}", f"below-{step}", f"inside-{step}")
        done.append(after.where("split").select("name", *names))
        step += 1
        state = after.where("NOT split").select(*columns)
    found = _split_small(state, names)
    for part in done:
        found = found.union(part)
    return found


def prefix_trie(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text",
                opening: tuple[Column, Column] | None = None, large: int = LARGE) -> Trie:
    """The trie of all conversations; ``saved`` is what sharing a node's last text among its members
    saves, in code points, over its subtree."""
    scratch = Scratch(rows.sparkSession)
    turns = scratch.put(numbered(_turns(rows, conv_col, turn_col, role_col, text_col), scratch), "turns")
    scratch.drop("numbered")
    turns, convs = opened(turns, opening, scratch)
    longest = convs.agg(F.max("length")).first()[0] or 0
    paths = scratch.put(prefix_names(turns, longest, scratch), "paths")
    count = F.count("*").alias("n_convs")
    first = F.min("conv").alias("conv")
    nodes = paths.groupBy("name", "parent", "depth", "chars").agg(
        first, count,
        F.sum((F.col("depth") == F.col("length")).cast("long")).alias("n_ends"),
        F.sum(F.col("length") - F.col("depth") + 1).alias("weight"),
    )
    root = convs.agg(
        first, count,
        F.sum((F.col("length") == 0).cast("long")).alias("n_ends"),
        F.sum(F.col("length") + 1).alias("weight"),
    ).where("n_convs > 0")
    zero = F.lit(0).cast("long")
    root = root.select(F.lit(ROOT).alias("name"), F.lit(None).cast("binary").alias("parent"), zero.alias("depth"), zero.alias("chars"), "conv", "n_convs", "n_ends", "weight")
    nodes = scratch.put(nodes.unionByName(root), "nodes")
    sums = rollup(
        nodes, paths.select("conv", "name", "parent"),
        {"n_leaves": F.col("n_convs") == F.col("n_ends"), "saved": (F.col("n_convs") - 1) * F.col("chars")}, scratch, large,
    )
    children = scratch.put(nodes.where("parent IS NOT NULL").groupBy("parent").agg(F.count("*").alias("n_children")), "children")
    found = (
        nodes.drop("weight", "chars")
        .join(sums, "name")
        .join(children.withColumnRenamed("parent", "name"), "name", "left")
        .join(nodes.select(F.col("name").alias("parent"), F.col("conv").alias("parent_conv")), "parent", "left")
        .withColumn("n_children", F.coalesce("n_children", zero))
    )
    ends = paths.where("depth = length").select("name", "conv").union(convs.where("length = 0").select(F.lit(ROOT), "conv"))
    return Trie(found, ends)


def id_digests(ends: DataFrame) -> DataFrame:
    """(name, sha256): the hash of each name's ids, ascending and joined by commas."""
    kind = ends.schema["conv"].dataType.simpleString()

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            name = batch.column(0)
            opens = np.ones(n, bool)
            opens[1:] = ~pc.equal(name.slice(1), name.slice(0, n - 1)).to_numpy(zero_copy_only=False).astype(bool)
            starts = np.flatnonzero(opens)
            texts = pa.ListArray.from_arrays(pa.array([*starts, n], pa.int32()), batch.column(1).cast(pa.string()))
            at = pa.array(starts)
            yield pa.RecordBatch.from_arrays([name.take(at), batch.column(1).take(at), pc.binary_join(texts, ",")], names=["name", "first", "ids"])

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, state = None, None
        for batch in batches:
            names, digests = [], []
            for name, ids in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if name == last:
                    state.update(b",")
                else:
                    if last is not None:
                        names.append(last)
                        digests.append(state.hexdigest())
                    last, state = name, hashlib.sha256()
                state.update(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.binary()), pa.array(digests, pa.string())], names=["name", "sha256"])
        if last is not None:
            yield pa.RecordBatch.from_arrays([pa.array([last], pa.binary()), pa.array([state.hexdigest()])], names=["name", "sha256"])

    pieces = ends.repartitionByRange("name", "conv").sortWithinPartitions("name", "conv").mapInArrow(joined, f"name binary, first {kind}, ids string")
    return pieces.repartition("name").sortWithinPartitions("name", "first").select("name", "ids").mapInArrow(hashed, "name binary, sha256 string")
