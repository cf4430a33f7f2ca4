"""Mixing sources to target weights along a time-varying curriculum.

Every source has a weight and a schedule: a straight line from the multiple of its weight at the
start of training to that at the end. The integral of a schedule is the source's cumulative token
demand; its documents stand in a fixed scrambled order, once per epoch, and the inverse of the
demand gives each of them the position in training at which its tokens are due. Documents whose
tokens lie beyond the source's target are not taken; range-sorting by position gives the mix.

Targets share the total size by weight, but no source is repeated more than ``cap`` times; what
capped sources can't take goes to the others by weight, until none is above its cap.

Scale: sizes are summed per source with partial aggregation. A source's order is cut into buckets
of about `ROWS_PER_BUCKET` documents by their scrambled key, so that running sums need no task that
holds a whole source: sums per bucket, running sums over those, then running sums inside a bucket.
Only the tables of sources and buckets pass through an ordering by source.

Defined results: a null text has size 0; null sources are one source that comes last; rows of equal
id, source and size are one unit, taken alike; null ids are allowed; an empty table gives an empty
one; with no words at all every target is 0.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeferry.llm.scratch import Scratch

WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (1, 2, 3)
# Multiples of the weight at the start and at the end, for each place in `WEIGHTS`; they sum to 2.
RAMPS = ((1.5, 0.5), (1.0, 1.0), (0.5, 1.5))
CAP = 3
ROWS_PER_BUCKET = 4096
SEED = "mix"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)).cast("long"), F.lit(0).cast("long"))


def _by_place(values: tuple, place: Column) -> Column:
    return F.element_at(F.array(*[F.lit(float(v)) for v in values]), (place % len(values) + 1).cast("int"))


def targets(units: DataFrame, weights: tuple = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, n, source_size, place, target): one row for each source of (source, size, copies)."""
    sources = units.groupBy("source").agg(
        F.sum(F.col("size") * F.col("copies")).alias("source_size"), F.count("*").alias("n")
    )
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    all_rows = Window.partitionBy()
    placed = (
        sources.withColumn("place", F.row_number().over(by_name) - 1)
        .withColumn("weight", _by_place(weights, F.col("place")))
        .withColumn("ratio", (F.col("source_size") * cap).cast("double") / F.col("weight"))
    )
    before = Window.orderBy("ratio", "place").rowsBetween(Window.unboundedPreceding, -1)
    total, taken = F.sum("source_size").over(all_rows), F.sum("source_size").over(before)
    weight, gone = F.sum("weight").over(all_rows), F.sum("weight").over(before)
    none = F.lit(0).cast("long")
    level = (total - F.coalesce(taken, none) * cap).cast("double") / (weight - F.coalesce(gone, F.lit(0.0)))
    leveled = placed.withColumn("level", level).withColumn(
        "level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "place", "level"))).over(all_rows)["level"]
    )
    target = F.least((F.col("source_size") * cap).cast("double"), F.col("level") * F.col("weight"))
    return leveled.select("source", "n", "source_size", "place", target.alias("target"))


def assign(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", size: Column | None = None,
           weights: tuple = WEIGHTS, cap: int = CAP, seed: str = SEED) -> DataFrame:
    """One row per unit: ``id, source, size, copies, source_size, target, place, before, times``.

    ``before`` is where the unit's tokens start in its source's order, ``times`` how many epochs
    take it.
    """
    size = n_words(F.col("text")) if size is None else size
    units = (
        docs.select(F.col(id_col).alias("id"), F.col(source_col).alias("source"), size.alias("size"))
        .groupBy("id", "source", "size")
        .agg(F.count("*").alias("copies"))
    )
    units = Scratch(docs.sparkSession).put(units, "units")  # texts are counted once
    facts = targets(units, weights, cap)
    key = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("id").cast("string"), F.lit(""))))
    share = F.conv(F.substring("key", 1, 8), 16, 10).cast("long")
    buckets = F.ceil(F.col("n") / ROWS_PER_BUCKET).cast("long")
    placed = (
        units.join(facts.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of")))
        .drop("of")
        .withColumn("key", key)
        .withColumn("bucket", (share * buckets / F.lit(2.0**32)).cast("long"))
        .withColumn("tokens", F.col("size") * F.col("copies"))
    )
    earlier = Window.partitionBy("place").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    sums = (
        placed.groupBy("place", "bucket")
        .agg(F.sum("tokens").alias("sum"))
        .select("place", "bucket", F.coalesce(F.sum("sum").over(earlier), none).alias("base"))
    )
    inside = (
        Window.partitionBy("place", "bucket").orderBy("key", "id", "size").rowsBetween(Window.unboundedPreceding, -1)
    )
    ordered = placed.withColumn("inner", F.coalesce(F.sum("tokens").over(inside), none)).join(sums, ["place", "bucket"])
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(none)
    rest = F.col("target") - whole * F.col("source_size")
    before = F.col("base") + F.col("inner")
    again = (2 * before + F.col("tokens") <= 2 * rest) & (rest > 0)
    return ordered.select(
        "id", "source", "size", "copies", "source_size", "target", "place",
        before.alias("before"),
        (whole + again.cast("long")).alias("times"),
    )


def scheduled(assigned: DataFrame, ramps: tuple = RAMPS) -> DataFrame:
    """Every unit with its ``positions`` in training, 0 to 1, one for each epoch that takes it."""
    start = _by_place(tuple(r[0] for r in ramps), F.col("place"))
    slope = _by_place(tuple((r[1] - r[0]) / 2 for r in ramps), F.col("place"))

    def due(epoch: Column) -> Column:
        middle = epoch * F.col("source_size") + F.col("before") + F.col("size") * F.col("copies") / 2
        demand = F.when(F.col("target") > 0, F.least(middle / F.col("target"), F.lit(1.0))).otherwise(F.lit(0.0))
        # demand(t) = start * t + slope * t^2; this form of its inverse also holds for slope 0
        return 2 * demand / (start + F.sqrt(F.greatest(start * start + 4 * slope * demand, F.lit(0.0))))

    epochs = F.when(F.col("times") > 0, F.sequence(F.lit(0).cast("long"), F.col("times") - 1)).otherwise(F.array().cast("array<long>"))
    return assigned.withColumn("positions", F.transform(epochs, due))


def slots(assigned: DataFrame, ramps: tuple = RAMPS) -> DataFrame:
    """One row per unit and epoch that takes it, with its ``position`` in training, 0 to 1."""
    rows = scheduled(assigned, ramps)
    each = rows.select(*assigned.columns, F.posexplode("positions").alias("epoch", "position"))
    return each.withColumn("epoch", F.col("epoch").cast("long"))


def in_training_order(rows: DataFrame, *order: str) -> DataFrame:
    """Rows sorted over all partitions, the first column being a position in training."""
    return rows.repartitionByRange(*order).sortWithinPartitions(*order)


def mixed(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", **how) -> DataFrame:
    """The documents that the mix takes, as often as it takes them, sorted by training position.

    All columns of ``docs`` are kept, whatever their names; none is added.
    """
    size = n_words(F.col(text_col))
    due = slots(assign(docs, id_col, source_col, size, **how)).select(
        F.col("id"), F.col("source"), F.col("size"), "position", "epoch"
    )
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.col(id_col).alias("own_id"), F.col(source_col).alias("own_source"), size.alias("own_size"),
    )
    same = (
        F.col("id").eqNullSafe(F.col("own_id"))
        & F.col("source").eqNullSafe(F.col("own_source"))
        & (F.col("size") == F.col("own_size"))
    )
    found = rows.join(due, same).select("row", "position", "own_id", "epoch")
    order = ["position", "own_id", "epoch"]
    return in_training_order(found, *order).select("row.*")
