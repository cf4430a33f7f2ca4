"""Upsert by key into tables whose files cannot be updated row by row.

Matched target rows take the source's values, unmatched source rows are added, other target rows
stay.  A NULL key matches nothing.  The files that hold a row to be changed are looked up first, and
only these are read in full and written anew; every other file stays as it is.
"""

from __future__ import annotations

from collections.abc import Callable
from contextlib import AbstractContextManager, nullcontext
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeferry.functions.types import align, missing_from, quote
from lakeferry.plans import store
from lakeferry.plans.commit import (
    FILE,
    FILE_NUMBER,
    FIRST_ROW,
    in_files,
    recover,
    replace_files,
    token,
    with_file,
)
from lakeferry.plans.workspace import bytes_setting, may_broadcast, session_settings, shared_root, stage
from lakeferry.sources.tables import (
    PENDING,
    ROW_LEVEL_PROVIDERS,
    Table,
    TableFacts,
    as_table,
    table_facts,
)

# Rows, and bytes as files or in a shuffle, that one partition of a shuffle of the target is to hold (rows
# of few columns take some twenty times their shuffled bytes in memory), and the most partitions.
SHUFFLED_ROWS = 2**20
SHUFFLED_BYTES = 32 * 2**20
MAX_TASKS = 100_000
_ADVISORY = "spark.sql.adaptive.advisoryPartitionSizeInBytes"

_SOURCE = "__s_"
_SPREAD = "__spread"
_HIT = "__hit"
_TOUCHED = "__touched"
_LEAST = "__least"


class DuplicateKeysError(ValueError):
    """More than one source row matches the same target row."""


@dataclass(frozen=True)
class Merge:
    """A source staged once on shared storage, and the plan over it."""

    target: DataFrame
    source: DataFrame
    keys: list[str]
    source_is_small: bool
    newer_by: tuple[str, ...] = ()
    repeats: bool = False

    def _with_keys(self, df: DataFrame) -> DataFrame:
        return df.where(_all_present(self.keys))

    def _side(self, df: DataFrame) -> DataFrame:
        """A join side from the source: beyond the measured bound it is not broadcast."""
        return df if self.source_is_small else df.hint("merge")

    def matched(self, columns: list[str] | tuple[str, ...] = ()) -> DataFrame:
        """``(*columns, *keys, n)``: the target rows whose key the source has, counted.

        A small source filters the target's key columns before anything moves.  For a large one
        the target is counted first, so a frequent key costs one row per task, not one task.
        """
        names = list(dict.fromkeys([*columns, *self.keys]))
        rows = self._with_keys(_columns(self.target, names))
        wanted = self._side(self._with_keys(_columns(self.source, self.keys)).distinct())
        if self.source_is_small:
            return _counted(rows.join(wanted, self.keys, "left_semi"), names)
        return _counted(rows, names).join(wanted, self.keys, "left_semi")

    def duplicates(self) -> DataFrame:
        """Source keys that occur more than once and match a target row, with their counts."""
        repeated = repeated_keys(self.source, self.keys)
        return repeated.join(self.matched().drop("n"), self.keys, "left_semi")

    def hits(self, within: DataFrame | None = None) -> DataFrame:
        """``(*keys, file number, changes)``: each file's keys that the source has, once.

        ``changes`` tells whether the merge changes any such row.  One search over the target's key
        columns, or over the rows ``within``, answers which files are touched and which source rows
        are new.
        """
        names = [*self.keys, FILE_NUMBER]
        rows = self._with_keys(with_file(self.target) if within is None else within)
        wanted = self._side(_columns(self._updates(), [*self.keys, *self.newer_by]))
        if self.source_is_small:  # filtered before anything moves; else combined before it moves
            rows = rows.join(_columns(wanted, self.keys), self.keys, "left_semi")
        if not self.newer_by:
            found = _columns(rows, names).distinct()
            found = found if self.source_is_small else found.join(wanted, self.keys, "left_semi")
            return found.withColumn("changes", F.lit(True))
        found = rows.groupBy(*_names(names)).agg(F.min(F.struct(*_names(self.newer_by))).alias(_LEAST))
        mine = [F.col(quote(c)).alias(_SOURCE + c) for c in self.newer_by]
        found = found.join(wanted.select(*_names(self.keys), F.struct(*mine).alias(_HIT)), self.keys)
        return found.select(*_names(names), (F.col(_HIT) > F.col(_LEAST)).alias("changes"))

    def inserts(self, known: DataFrame | None = None) -> DataFrame:
        """Source rows without a target row, those with a NULL key among them.

        ``known`` has the source's keys that the target has, if they were looked up already.
        """
        if known is None:
            known = self.matched()
            if not self.source_is_small:
                known = _counted(self._with_keys(_columns(self.target, self.keys)), self.keys)
        fresh = self._with_keys(self.source).join(_columns(known, self.keys).distinct(), self.keys, "left_anti")
        return fresh.unionByName(self.source.where(~_all_present(self.keys)))

    def _updates(self) -> DataFrame:
        """Source rows that can match: a repeated key, once it is allowed, matches nothing."""
        rows = self._with_keys(self.source)
        if self.repeats:
            repeated = self._side(repeated_keys(self.source, self.keys))
            rows = rows.join(repeated, self.keys, "left_anti")
        return rows

    def without(self, target: DataFrame, gone: DataFrame) -> DataFrame:
        """Target rows whose keys are not among ``gone``; rows without a key are dealt out evenly."""
        if self.source_is_small:
            return target.join(gone, self.keys, "left_anti")
        rows = target.withColumn(_SPREAD, _spread(self.keys))
        other = gone.withColumn(_SPREAD, _zero(self.keys))
        return rows.join(other, [*self.keys, _SPREAD], "left_anti").select(*_names(target.columns))

    def updated(self, target: DataFrame | None = None) -> DataFrame:
        """The target's rows after the merge, without the inserts.

        An outer join from the target: with a small source Catalyst broadcasts it and the target
        never moves; otherwise adaptive execution may split a frequent key on the target side.
        """
        target = self.target if target is None else target
        names = target.columns
        source = self._updates().select(
            *[F.col(quote(c)).alias(_SOURCE + c) for c in self.source.columns],
            F.lit(True).alias(_HIT),
        )
        same = [F.col(quote(k)) == F.col(quote(_SOURCE + k)) for k in self.keys]
        if not self.source_is_small:  # rows without a key match nothing: deal them out evenly
            target = target.withColumn(_SPREAD, _spread(self.keys))
            source = source.withColumn(_SOURCE + _SPREAD, _zero([_SOURCE + k for k in self.keys]))
            same.append(F.col(_SPREAD) == F.col(_SOURCE + _SPREAD))
        joined = target.join(self._side(source), same, "left")
        take = F.col(_HIT).isNotNull()
        if self.newer_by:
            take = take & _newer(self.newer_by)
        return joined.select(
            *[
                F.when(take, F.col(quote(_SOURCE + c))).otherwise(F.col(quote(c))).alias(c)
                for c in names
            ]
        )

    def result(self) -> DataFrame:
        return self.updated().unionByName(self.inserts())

    def metrics(self) -> DataFrame:
        """``(n_updated, n_inserted)``: target rows that match, source rows that do not."""
        counted = self.matched().select(F.col("n").alias("u"), F.lit(0).alias("i")).unionByName(
            self.inserts().select(F.lit(0).alias("u"), F.lit(1).alias("i"))
        )
        return counted.agg(
            F.coalesce(F.sum("u"), F.lit(0)).cast("bigint").alias("n_updated"),
            F.coalesce(F.sum("i"), F.lit(0)).cast("bigint").alias("n_inserted"),
        )


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """Non-NULL keys that occur more than once, counted with map-side combine: ``(*keys, n)``."""
    return _counted(_columns(df.where(_all_present(keys)), keys), keys).where(F.col("n") > 1)


def _counted(df: DataFrame, names: list[str]) -> DataFrame:
    return df.groupBy(*[F.col(quote(n)) for n in names]).agg(F.count("*").alias("n"))


def plan_merge(
    spark: SparkSession,
    table: str | Table,
    source: DataFrame,
    keys: str | list[str],
    *,
    newer_by: tuple[str, ...] = (),
    scratch: str | None = None,
) -> Merge:
    """Check the request, stage the source once, and return the plan."""
    ref = as_table(table)
    keys = [keys] if isinstance(keys, str) else list(keys)
    target = spark.table(ref.name)
    if not keys:
        raise ValueError("a merge needs at least one key column")
    lacking = missing_from(source, target.columns, source.columns)
    if lacking:
        raise ValueError(f"the source lacks the target's columns {lacking}")
    unknown = missing_from(target, [*keys, *newer_by], target.columns)
    if unknown:
        raise ValueError(f"{ref.identifier} has no columns {unknown}")
    rows = align(source, target.schema)
    rows = rows.select(
        *[F.col(quote(f.name)).cast(f.dataType).alias(f.name) for f in target.schema.fields]
    )
    staged, size = stage(spark, rows, scratch or f"{_scratch(spark)}/source")
    return Merge(target, staged, keys, may_broadcast(staged, size), tuple(newer_by))


def merge_table(
    spark: SparkSession,
    table: str | Table,
    source: DataFrame,
    keys: str | list[str],
    *,
    newer_by: tuple[str, ...] | list[str] = (),
) -> None:
    """Upsert ``source`` into ``table`` by ``keys``.

    The source must have every column of the table; others are dropped.  With ``newer_by`` a
    matched row changes only if the source's values of those columns are greater.  Two source rows
    for one target row raise ``DuplicateKeysError`` before anything is written.
    """
    ref = as_table(table)
    facts = table_facts(spark, ref)
    if facts.provider in ROW_LEVEL_PROVIDERS:
        _merge_natively(spark, ref, source, keys, tuple(newer_by))
        return
    recover(spark, ref)
    scratch = _scratch(spark)
    try:
        merge = plan_merge(
            spark, ref, source, keys, newer_by=tuple(newer_by), scratch=f"{scratch}/source"
        )
        with _enough_tasks(spark, facts, merge):
            rows = merged_files(spark, facts, refuse_duplicates(merge), scratch)
            replace_files(spark, ref, rows, scratch)
    finally:
        _clean(spark, ref, scratch)


def _enough_tasks(
    spark: SparkSession, facts: TableFacts, merge: Merge
) -> AbstractContextManager[None]:
    """Shuffles of so many partitions that rows and bytes of one stay bounded; adaptive execution joins
    small ones.  With a small source the target is not shuffled."""
    if merge.source_is_small:
        return nullcontext()
    have = int(spark.conf.get("spark.sql.shuffle.partitions"))
    n_rows = merge.target.count() + merge.source.count()
    wanted = max(n_rows // SHUFFLED_ROWS, store.tree_bytes(spark, facts.location) // SHUFFLED_BYTES)
    joined = min(bytes_setting(spark, _ADVISORY), SHUFFLED_BYTES)
    return session_settings(spark, {"spark.sql.shuffle.partitions": min(max(have, wanted), MAX_TASKS), _ADVISORY: joined})


def refuse_duplicates(merge: Merge) -> Merge:
    if repeated_keys(merge.source, merge.keys).isEmpty():
        return merge
    bad = merge.duplicates().take(5)
    if bad:
        raise DuplicateKeysError(f"several source rows match one target row, as for {bad}")
    return replace(merge, repeats=True)


def merged_files(spark: SparkSession, facts: TableFacts, merge: Merge, scratch: str) -> DataFrame:
    """What to add in the place of the files that change, which are staged as ``scratch/gone``.

    With the partition columns among the keys only the source's partitions are searched.
    """
    columns = list(facts.partition_columns)
    within = None
    if columns and covers(merge.keys, columns):
        touched, _ = stage(spark, _marked(_columns(merge.source, columns).distinct()), f"{scratch}/touched")
        within = only_partitions(with_file(merge.target), touched, columns)
    searched = with_file(merge.target) if within is None else within
    hits, _ = stage(spark, merge.hits(within), f"{scratch}/hits")
    files = _gone(spark, searched, hits.where("changes"), columns, scratch)
    kept = in_files(merge.target, files)
    return merge.updated(kept).unionByName(merge.inserts(hits))


def _gone(
    spark: SparkSession, searched: DataFrame, rows: DataFrame, columns: list[str], scratch: str
) -> list[str]:
    """Stage the files of some rows of those searched, with their partitions.

    The rows bring the numbers of their files; a second scan, of no column but the partitions, has the
    names.  These also go to the planner, which holds the names of all files that a scan opens.
    """
    numbers, _ = stage(spark, _columns(rows, [FILE_NUMBER]).distinct(), f"{scratch}/numbers")
    names = _columns(searched.where(FIRST_ROW), [FILE, FILE_NUMBER, *columns]).distinct()
    gone, _ = stage(spark, names.join(numbers, FILE_NUMBER, "left_semi").drop(FILE_NUMBER), f"{scratch}/gone")
    return [row[FILE] for row in gone.select(FILE).toLocalIterator()]


def covers(keys: list[str], columns: list[str]) -> bool:
    return {c.lower() for c in columns} <= {k.lower() for k in keys}


def _marked(partitions: DataFrame) -> DataFrame:
    return partitions.withColumn(_TOUCHED, F.lit(1))


def only_partitions(target: DataFrame, touched: DataFrame, columns: list[str]) -> DataFrame:
    """Rows in the touched partitions; the small join side prunes the scan's partitions.

    Spark prunes a scan by a join side only if that side has a selective filter: the one on the
    stored mark, which is 1 in every row, is there for that.
    """
    has_null = not touched.where(~_all_present(columns)).isEmpty()
    if not has_null:
        return target.join(touched.where(F.col(_TOUCHED) == 1), columns, "left_semi")
    same = [target[c].eqNullSafe(touched[c]) for c in columns]
    return target.join(touched, same, "left_semi")


def _zero(keys: list[str]) -> Column:
    """0 for every row, in a form that the optimizer takes for a column of the row."""
    return F.hash(*[F.col(quote(k)) for k in keys]).bitwiseAND(F.lit(0)).cast("bigint")


def _spread(keys: list[str]) -> Column:
    """0 for a row with all keys; a number of its own for a row without, which matches nothing."""
    return F.when(_all_present(keys), _zero(keys)).otherwise(F.monotonically_increasing_id() + 1)


def _names(columns: list[str] | tuple[str, ...]) -> list[Column]:
    return [F.col(quote(c)) for c in columns]


def replace_keys(
    spark: SparkSession, table: str | Table, source: DataFrame, keys: str | list[str]
) -> None:
    """Delete every target row whose key occurs in ``source``, then add all rows of ``source``.

    Unlike a merge, a key may have any number of rows on both sides.
    """
    ref = as_table(table)
    recover(spark, ref)
    facts = table_facts(spark, ref)
    scratch = _scratch(spark)
    try:
        merge = plan_merge(spark, ref, source, keys, scratch=f"{scratch}/source")
        keys = merge._side(merge._with_keys(_columns(merge.source, merge.keys)).distinct())
        columns = list(facts.partition_columns)
        searched = with_file(merge.target)
        rows = _columns(merge._with_keys(searched), [*merge.keys, FILE_NUMBER])
        with _enough_tasks(spark, facts, merge):
            files = _gone(spark, searched, rows.join(keys, merge.keys, "left_semi"), columns, scratch)
            kept = merge.without(in_files(merge.target, files), keys)
            replace_files(spark, ref, kept.unionByName(merge.source), scratch)
    finally:
        _clean(spark, ref, scratch)


def delete_where(spark: SparkSession, table: str | Table, condition: Column) -> None:
    """Delete the rows for which ``condition`` is true, rewriting only files that have any."""
    gone = F.coalesce(condition, F.lit(False))
    _rewrite(spark, table, lambda rows: rows.where(gone), lambda rows: rows.where(~gone))


def update_where(
    spark: SparkSession, table: str | Table, condition: Column, values: dict[str, Column]
) -> None:
    """Give columns new values where ``condition`` is true, rewriting only files with such rows."""
    hit = F.coalesce(condition, F.lit(False))

    def changed(rows: DataFrame) -> DataFrame:
        return rows.select(
            *[F.when(hit, values[c]).otherwise(F.col(quote(c))).alias(c) if c in values else F.col(quote(c)) for c in rows.columns]
        )

    _rewrite(spark, table, lambda rows: rows.where(hit), changed)


def delete_unmatched(
    spark: SparkSession, table: str | Table, keep: DataFrame, keys: list[str]
) -> None:
    """Delete the rows whose keys do not occur in ``keep``, rewriting only files that have any."""
    known = _columns(keep, keys).distinct()
    _rewrite(
        spark, table, lambda rows: rows.join(known, keys, "left_anti"), lambda rows: rows.join(known, keys, "left_semi")
    )


def _rewrite(
    spark: SparkSession,
    table: str | Table,
    hit: Callable[[DataFrame], DataFrame],
    after: Callable[[DataFrame], DataFrame],
) -> None:
    """Put ``after`` of their rows in the place of the files that have a row of ``hit``."""
    ref = as_table(table)
    recover(spark, ref)
    columns = list(table_facts(spark, ref).partition_columns)
    target = spark.table(ref.name)
    scratch = _scratch(spark)
    try:
        searched = with_file(target)
        files = _gone(spark, searched, hit(searched), columns, scratch)
        if files:
            replace_files(spark, ref, after(in_files(target, files)).select(*_names(target.columns)), scratch)
    finally:
        _clean(spark, ref, scratch)


def with_bucket(df: DataFrame, keys: list[str], buckets: int) -> DataFrame:
    """A ``bucket`` column from a hash of the keys, for a table partitioned by it.

    Merged by the keys and ``bucket``, such a table is searched and rewritten bucket by bucket.
    """
    number = F.pmod(F.xxhash64(*[F.col(quote(k)) for k in keys]), F.lit(buckets))
    return df.withColumn("bucket", number.cast("int"))


def _clean(spark: SparkSession, ref: Table, scratch: str) -> None:
    """Delete the staged rows, unless an unfinished overwrite still needs them."""
    if PENDING not in table_facts(spark, ref).properties:
        store.delete(spark, scratch)


def merge_statement(
    table: Table, source_name: str, keys: list[str], newer_by: tuple[str, ...] = ()
) -> str:
    """``MERGE INTO`` for a catalog that updates rows itself."""
    same = " AND ".join(f"s.{quote(k)} = t.{quote(k)}" for k in keys)
    newer = ""
    if newer_by:
        sides = [", ".join(f"{side}.{quote(c)}" for c in newer_by) for side in "st"]
        newer = f" AND struct({sides[0]}) > struct({sides[1]})"
    return (
        f"MERGE INTO {table.name} AS t USING {source_name} AS s ON {same} "
        f"WHEN MATCHED{newer} THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
    )


def _merge_natively(
    spark: SparkSession, ref: Table, source: DataFrame, keys, newer_by: tuple[str, ...]
) -> None:
    keys = [keys] if isinstance(keys, str) else list(keys)
    view = f"lakeferry_{token()}"
    align(source, spark.table(ref.name).schema).createOrReplaceTempView(view)
    try:
        spark.sql(merge_statement(ref, view, keys, newer_by))
    finally:
        spark.catalog.dropTempView(view)


def _newer(columns: tuple[str, ...]) -> Column:
    mine = F.struct(*[F.col(quote(_SOURCE + c)) for c in columns])
    theirs = F.struct(*[F.col(quote(c)) for c in columns])
    return mine > theirs


def _columns(df: DataFrame, names: list[str]) -> DataFrame:
    return df.select(*[F.col(quote(n)) for n in dict.fromkeys(names)])


def _all_present(names: list[str]) -> Column:
    present = F.lit(True)
    for name in names:
        present = present & F.col(quote(name)).isNotNull()
    return present


def _scratch(spark: SparkSession) -> str:
    return f"{shared_root(spark)}/lakeferry/merge-{token()}"

