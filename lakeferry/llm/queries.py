"""The registered queries of this subpackage, with SQL where it can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeferry.llm import mixing, near_dup, neighbors, packing, prefix_trie, quality_model, quality_rules, secrets, sharding, suffix_dedup, toxicity, url_filter, word_runs


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_near_dup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its group of near duplicates."""
    return near_dup.near_duplicates(table(spark, sf_dir, "documents"))


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with what is left of it without 50-byte strings of earlier documents."""
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its source's target and what the mix takes of it, in the order of training.

    A document is taken at its positions; those that are not taken come last.
    """
    units = mixing.scheduled(mixing.assign(table(spark, sf_dir, "documents")))
    each = units.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    found = each.select(
        F.col("id").alias("doc_id"), "size", "source_size", "target",
        (F.col("size") * F.size("positions")).alias("taken"),
        F.get("positions", F.lit(0)).alias("first_position"),
        F.get("positions", F.size("positions") - 1).alias("last_position"),
    )
    late = found.withColumn("due", F.coalesce("first_position", F.lit(2.0)))
    return mixing.in_training_order(late, "due", "doc_id").drop("due")


OP3_SQL = """
WITH units AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size
  FROM documents
),
sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         (row_number() OVER (ORDER BY source COLLATE "C" NULLS LAST) - 1)::BIGINT AS place
  FROM units GROUP BY source
),
weighed AS (
  SELECT *, (place % 3 + 1)::DOUBLE AS weight,
         (source_size * 3)::DOUBLE / (place % 3 + 1)::DOUBLE AS ratio
  FROM sources
),
leveled AS (
  SELECT *,
    (sum(source_size) OVER () - coalesce(sum(source_size) OVER b, 0) * 3)::DOUBLE
      / (sum(weight) OVER () - coalesce(sum(weight) OVER b, 0.0)) AS level
  FROM weighed
  WINDOW b AS (ORDER BY ratio, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
targets AS (
  SELECT source, source_size, place,
    least((source_size * 3)::DOUBLE,
          weight * (SELECT level FROM leveled WHERE level <= ratio ORDER BY ratio, place LIMIT 1)) AS target
  FROM leveled
),
ordered AS (
  SELECT u.doc_id, u.size, t.source_size, t.target, t.place,
    coalesce(sum(u.size) OVER (PARTITION BY u.source ORDER BY md5('mix:' || u.doc_id::VARCHAR), u.doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM units u JOIN targets t ON u.source IS NOT DISTINCT FROM t.source
),
parts AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS whole FROM ordered
),
counted AS (
  SELECT *, whole + CASE WHEN target - whole * source_size > 0
      AND 2 * before + size <= 2 * (target - whole * source_size) THEN 1 ELSE 0 END AS times
  FROM parts
),
demands AS (
  SELECT *, [1.5::DOUBLE, 1.0, 0.5][place % 3 + 1] AS start, [-0.5::DOUBLE, 0.0, 0.5][place % 3 + 1] AS slope,
    CASE WHEN target > 0 THEN least((before + size / 2) / target, 1.0) ELSE 0.0 END AS first_demand,
    CASE WHEN target > 0 THEN least(((times - 1) * source_size + before + size / 2) / target, 1.0) ELSE 0.0 END AS last_demand
  FROM counted
)
SELECT doc_id, size, source_size, target, (size * times)::BIGINT AS taken,
  CASE WHEN times > 0 THEN 2 * first_demand / (start + sqrt(greatest(start * start + 4 * slope * first_demand, 0.0))) END AS first_position,
  CASE WHEN times > 0 THEN 2 * last_demand / (start + sqrt(greatest(start * start + 4 * slope * last_demand, 0.0))) END AS last_position
FROM demands
"""


def op4_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document with its sequence and its place there."""
    return packing.pack(table(spark, sf_dir, "documents"))


def op5_neighbors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The five nearest vectors of every vector whose id is divisible by 50."""
    return neighbors.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its slot of the table and the shard that holds it."""
    return sharding.placed(table(spark, sf_dir, "documents"))


OP6_SQL = """
WITH RECURSIVE shards AS (
  SELECT i::INTEGER AS who, printf('shard-%02d', i) AS shard FROM range(10) t(i)
),
ranks AS (
  SELECT list(list_transform(range(1021), lambda j: (start + j * skip) % 1021) ORDER BY who) AS rankings
  FROM (SELECT who, ('0x' || substr(md5('offset:' || shard), 1, 8))::BIGINT % 1021 AS start,
          ('0x' || substr(md5('skip:' || shard), 1, 8))::BIGINT % 1020 + 1 AS skip FROM shards)
),
claims AS (
  SELECT 0 AS turn, NULL::BIGINT AS claimed, rankings FROM ranks
  UNION ALL
  SELECT turn + 1, rankings[turn % 10 + 1][1],
    list_transform(rankings, lambda r: list_filter(r, lambda s: s <> head))
  FROM (SELECT turn, rankings, rankings[turn % 10 + 1][1] AS head FROM claims WHERE turn < 1021)
),
slots AS (
  SELECT claimed::INTEGER AS slot, ((turn - 1) % 10)::INTEGER AS who FROM claims WHERE turn > 0
),
hashed AS (
  SELECT doc_id,
    (('0x' || substr(md5('doc:' || coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT % 1021)::INTEGER AS slot
  FROM documents
)
SELECT doc_id, slot, shard FROM hashed JOIN slots USING (slot) JOIN shards USING (who)
"""


def op7_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its quality by a chain over its lines."""
    return quality_model.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with the rule that fits its URL, and the verdict."""
    return url_filter.judge_urls(table(spark, sf_dir, "pages"), rules=url_filter.RULES)


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its secrets: counts and a digest of the base spans, and all spans."""
    found = secrets.secret_spans(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex",
        secrets.digest(F.col("spans")).alias("base_sha256"),
        secrets.listed(F.col("spans")).alias("spans"),
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the base counts, the fertility measures and the verdict."""
    return quality_rules.quality_rules(table(spark, sf_dir, "documents"))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct prefix of the conversations, each opened by turns of the one its id is grouped with."""
    conv = F.col("conv")
    opening = (conv - conv % 100, F.crc32(conv.cast("string").cast("binary")) % 6)
    trie = prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"), opening=opening)
    found = trie.nodes.join(prefix_trie.id_digests(trie.ends), "name", "left")
    return found.select(
        F.col("conv").alias("conv_id"), "depth", F.col("parent_conv").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


OP11_SQL = """
WITH byte_sums AS (
  SELECT list(list_reduce(list_prepend(i, range(8)),
    lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS sums
  FROM range(256) t(i)
),
turns AS (
  SELECT conv_id, length(coalesce(text, '')) AS chars,
    sha256(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS digest, turn
  FROM conversations WHERE conv_id IS NOT NULL
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, digest) - 1 AS place FROM turns
),
convs AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 100 AS base FROM placed GROUP BY conv_id
),
headed AS (
  SELECT c.conv_id, c.n, c.base, coalesce(b.n, 0) AS given,
    xor(list_reduce(list_prepend(4294967295, list_transform(string_split(c.conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
      lambda a, x: xor(a >> 8, sums[(xor(a, x) & 255) + 1])), 4294967295) % 6 AS h
  FROM convs c LEFT JOIN convs b ON b.conv_id = c.base, byte_sums
),
facts AS (
  SELECT *, least(h, given) AS taken, least(h, given) + greatest(n - h, 0) AS total FROM headed
),
rebuilt AS (
  SELECT f.conv_id, place - h + taken + 1 AS depth, digest, chars FROM facts f JOIN placed p USING (conv_id) WHERE place >= h
  UNION ALL
  SELECT f.conv_id, place + 1, digest, chars FROM facts f JOIN placed p ON p.conv_id = f.base AND place < taken
  UNION ALL
  SELECT conv_id, 0, '', 0 FROM facts
),
paths AS (
  SELECT conv_id, depth, chars,
    sha256(string_agg(digest, ',') OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING)) AS name
  FROM rebuilt
),
linked AS (
  SELECT p.*, depth = total AS ends, lag(name) OVER (PARTITION BY conv_id ORDER BY depth) AS parent
  FROM paths p JOIN facts USING (conv_id)
),
nodes AS (
  SELECT name, parent, depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM linked GROUP BY name, parent, depth
),
kids AS (SELECT parent AS name, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
sums AS (
  SELECT a.name, count(*) FILTER (k.name IS NULL) AS n_leaves, sum((n.n_convs - 1) * n.chars) AS saved
  FROM nodes n LEFT JOIN kids k ON k.name = n.name JOIN linked a ON a.conv_id = n.conv_id AND a.depth <= n.depth
  GROUP BY a.name
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs::BIGINT AS n_convs,
  coalesce(n_children, 0)::BIGINT AS n_children, n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, n.ends_sha256
FROM nodes n JOIN sums USING (name) LEFT JOIN kids USING (name) LEFT JOIN nodes p ON p.name = n.parent
"""


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its toxicity by a sparse model over word n-grams."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def _planted(docs: DataFrame) -> DataFrame:
    """(doc_id, text): texts whose id's checksum ends in 0 repeat their words from a place on, as the checksum says."""
    h = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit("([^\\x20\\x09-\\x0D]+)")))
    cut = docs.select("doc_id", "text", F.floor(h / 10).alias("g"), words.alias("words"))
    n = F.size("words")
    a = (F.col("g") % n).cast("int")
    p = 1 + F.floor((n - a) / (3 + F.col("g") % 8)).cast("int")
    again = F.array_repeat(F.slice("words", a + 1, p), F.ceil((n - a) / p).cast("int"))
    whole = F.concat(F.slice("words", 1, a), F.slice(F.flatten(again), 1, n - a))
    return cut.select("doc_id", F.when(n > 0, F.array_join(whole, " ")).otherwise(F.col("text")).alias("text"))


def op13_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its periodic runs of words, and what is left without their repeats."""
    found = word_runs.word_runs(_planted(table(spark, sf_dir, "documents")))
    key = F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period")))
    best = found.withColumn("best", F.array_max(key))
    lines = F.transform("runs", lambda r: F.concat_ws(",", r["start"], r["length"], r["period"]))
    return best.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.start")).alias("start"),
        F.col("best.length").alias("length"),
        (-F.col("best.period")).alias("period"),
        F.expr("(1000 * best.length) div -best.period").alias("exponent_milli"),
        F.sha2(F.concat_ws("", F.transform(lines, lambda x: F.concat(x, F.lit("\n")))), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_near_dup": op1_near_dup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_mixing": op3_mixing,
    "op4_packing": op4_packing,
    "op5_neighbors": op5_neighbors,
    "op6_sharding": op6_sharding,
    "op7_quality_model": op7_quality_model,
    "op8_url_filter": op8_url_filter,
    "op9_secrets": op9_secrets,
    "op10_quality_rules": op10_quality_rules,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_toxicity": op12_toxicity,
    "op13_word_runs": op13_word_runs,
}

ORACLES: dict[str, str] = {"op3_mixing": OP3_SQL, "op6_sharding": OP6_SQL, "op11_prefix_trie": OP11_SQL}
