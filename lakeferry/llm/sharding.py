"""Sharding by a permutation-filled lookup table of prime size.

Every shard ranks the slots of the table by a permutation of its own, ``(offset + j * skip) mod
size``. The shards take turns, each claiming the first slot of its ranking that is still free,
until the table is full. A document's hash picks a slot, the slot names the shard: constant time
per document, shards that differ by at most one slot, and few slots that move when a shard leaves.

The table has ``size`` rows, a fixed parameter independent of the data, so it is broadcast. The
fill is a fold in SQL over the turns; nothing here runs Python on data.

Defined results: a null id hashes like an empty text; equal ids share a shard; an empty table
gives an empty one. Other columns are never read by `placed`.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SIZE = 1021
SHARDS = tuple(f"shard-{i:02d}" for i in range(10))


def hash32(text: Column, purpose: str) -> Column:
    """The first 32 bits of an MD5, as a number."""
    return F.conv(F.substring(F.md5(F.concat(F.lit(purpose), text)), 1, 8), 16, 10).cast("long")


def lookup_table(spark: SparkSession, shards: tuple[str, ...] = SHARDS, size: int = SIZE) -> DataFrame:
    """(slot, shard): who holds each slot of the prime-sized table."""
    if len(shards) > size or any(size % d == 0 for d in range(2, int(size**0.5) + 1)):
        raise ValueError("the table needs a prime size of at least the number of shards")
    names = F.array(*[F.lit(s) for s in shards])
    base = spark.range(1).select(
        F.transform(names, lambda s: hash32(s, "offset:") % size).alias("offsets"),
        F.transform(names, lambda s: hash32(s, "skip:") % (size - 1) + 1).alias("skips"),
    )
    rankings = f"""
        transform(sequence(0, {len(shards) - 1}), i ->
            transform(sequence(0, {size - 1}), j -> cast((offsets[i] + j * skips[i]) % {size} as int)))
    """
    # state: each shard's ranking of the slots that are free, and who claimed what so far
    fold = f"""
        aggregate(
            sequence(0, {size - 1}),
            struct(rankings, cast(array() as array<struct<slot: int, who: int>>) as claims),
            (s, turn) -> transform(array(s.rankings[turn % {len(shards)}][0]), claimed -> struct(
                transform(s.rankings, r -> filter(r, slot -> slot != claimed)) as rankings,
                array_append(s.claims, named_struct('slot', claimed, 'who', turn % {len(shards)})) as claims
            ))[0],
            s -> s.claims
        )
    """
    claims = base.select(F.expr(rankings).alias("rankings")).select(F.explode(F.expr(fold)).alias("claim"))
    return claims.select("claim.slot", F.element_at(names, F.col("claim.who") + 1).alias("shard"))


def placed(docs: DataFrame, id_col: str = "doc_id", shards: tuple[str, ...] = SHARDS, size: int = SIZE) -> DataFrame:
    """(id, slot, shard) for every row."""
    slot = (hash32(F.coalesce(F.col(id_col).cast("string"), F.lit("")), "doc:") % size).cast("int")
    rows = docs.select(F.col(id_col), slot.alias("slot"))
    return rows.join(F.broadcast(lookup_table(docs.sparkSession, shards, size)), "slot").select(id_col, "slot", "shard")


def load(placed_rows: DataFrame) -> DataFrame:
    """(shard, documents): how many documents each shard holds."""
    return placed_rows.groupBy("shard").agg(F.count("*").alias("documents"))
