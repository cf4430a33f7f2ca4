"""Files as data, and change logs of tags and comments."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeferry.operators.registry import record_changes, replay, tag_maps
from lakeferry.operators.volumes import (
    conflicts,
    drop_files,
    export_files,
    ingest_tree,
    list_files,
    move_files,
    put_files,
    stored_files,
    sync_plan,
)
from lakeferry.plans.workspace import Workspace
from lakeferry.sources.tables import read_table
from lakeferry.sources.trees import read_tree
from workloads.base import load
from workloads.reads import text_files

ORDER = ["ts", "event_id"]


def _documents(spark: SparkSession, sf: str, *, by_source: bool = True) -> DataFrame:
    documents = load(spark, sf, "documents")
    parts = ["lang", "source", "doc_id"] if by_source else ["lang", "doc_id"]
    columns = [F.col(c).cast("string") for c in parts]
    return text_files(documents, F.concat_ws("/", *columns), "text")


def _ingest(spark: SparkSession, sf: str) -> DataFrame:
    path = Workspace(spark).dir("documents")
    export_files(spark, _documents(spark, sf), path)
    return list_files(read_tree(spark, path))


def _files_table(spark: SparkSession, sf: str) -> str:
    table = Workspace(spark).table("documents")
    put_files(spark, table, _documents(spark, sf))
    return table


def _list_prefix(spark: SparkSession, sf: str) -> DataFrame:
    table = _files_table(spark, sf)
    return list_files(read_table(spark, table), "en/src1").select("path")


def _drop(spark: SparkSession, sf: str) -> DataFrame:
    table = _files_table(spark, sf)
    drop_files(spark, table, "en/src1")
    return list_files(read_table(spark, table)).select("path")


def _move(spark: SparkSession, sf: str) -> DataFrame:
    """A sub-tree at another place, with the content that its paths lead to."""
    table = _files_table(spark, sf)
    move_files(spark, table, "en/src1", "moved/here")
    found = stored_files(spark, table, "moved")
    return found.select("path", F.octet_length("content").cast("bigint").alias("size"), F.sha2("content", 256).alias("sha256"))


def _listing_and_manifest(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The manifest lacks one language and has other hashes for one source."""
    files = load(spark, sf, "documents").select(
        F.concat_ws("/", "lang", F.concat(F.col("doc_id").cast("string"), F.lit(".txt"))).alias("path"),
        F.sha2(F.col("text").cast("binary"), 256).alias("sha256"),
        "lang",
        "source",
    )
    hashes = F.when(F.col("source") == "src1", F.reverse("sha256")).otherwise(F.col("sha256"))
    manifest = files.where("lang <> 'de'").select("path", hashes.alias("sha256"))
    return files, manifest


def _sync_plan(spark: SparkSession, sf: str) -> DataFrame:
    return sync_plan(*_listing_and_manifest(spark, sf)).select("path", "action")


def _conflicts(spark: SparkSession, sf: str) -> DataFrame:
    return conflicts(*_listing_and_manifest(spark, sf))


def _sync(spark: SparkSession, sf: str) -> DataFrame:
    """Pages ingested twice; before the second time the secure ones get their URL as content."""
    ws = Workspace(spark)
    pages = load(spark, sf, "pages")
    secure = F.startswith("url", F.lit("https://"))
    path = F.col("page_id")
    export_files(spark, text_files(pages, path, "html", ".html"), ws.dir("pages"))
    ingest_tree(spark, ws.table("pages"), ws.dir("pages"))
    changed = text_files(pages.where(secure), path, "url", ".html")
    export_files(spark, changed, ws.dir("pages"))
    ingest_tree(spark, ws.table("pages"), ws.dir("pages"))
    return list_files(read_table(spark, ws.table("pages")))


def _export(spark: SparkSession, sf: str) -> DataFrame:
    path = Workspace(spark).dir("pages")
    pages = text_files(load(spark, sf, "pages"), F.col("page_id"), "html", ".html")
    export_files(spark, pages, path)
    return list_files(read_tree(spark, path))


def _export_parts(spark: SparkSession, sf: str) -> DataFrame:
    """Files in several parts: read in ranges of 4 KiB, written, and read again as a whole."""
    ws = Workspace(spark)
    pages = text_files(load(spark, sf, "pages"), F.col("page_id"), "html", ".html")
    export_files(spark, pages, ws.dir("whole"))
    export_files(spark, read_tree(spark, ws.dir("whole"), part_bytes=4096), ws.dir("again"), spread=False)
    return list_files(read_tree(spark, ws.dir("again")))


def _tag_changes(spark: SparkSession, sf: str) -> DataFrame:
    removed = F.col("event_type") == "error"
    return load(spark, sf, "events").select(
        "user_id",
        F.get_json_object("props", "$.k").alias("tag_name"),
        F.when(~removed, F.col("event_type")).alias("tag_value"),
        *ORDER,
    )


def _tags(spark: SparkSession, sf: str) -> DataFrame:
    return replay(_tag_changes(spark, sf), ["user_id", "tag_name"], "tag_value", ORDER)


def _tag_maps(spark: SparkSession, sf: str) -> DataFrame:
    maps = tag_maps(_tags(spark, sf), "user_id", "tag_name", "tag_value")
    shown = F.transform(F.map_entries("tags"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return maps.select("user_id", F.array_join(F.array_sort(shown), ",").alias("tags"))


def _registry_verbs(spark: SparkSession, sf: str) -> DataFrame:
    """Tags and a comment of every customer: set, changed, removed and read, a job for each step."""
    registry = Workspace(spark).table("registry")
    customers = load(spark, sf, "customer").withColumn("entity", F.col("c_custkey").cast("string"))
    steps = [
        {"key": F.lit("none"), "old": F.col("c_name")},
        {"comment": F.lower("c_name")},
        {"key": F.col("c_mktsegment")},
        {"old": F.lit(None)},
    ]
    for tags in steps:
        change = F.explode(F.array(*[F.struct(F.lit(k).alias("name"), v.cast("string").alias("value")) for k, v in tags.items()]))
        record_changes(spark, registry, customers.select("entity", change.alias("c")).select("entity", "c.*"))
    return replay(read_table(spark, registry), ["entity", "name"], "value", ["at", "seq"])


def _comments(spark: SparkSession, sf: str) -> DataFrame:
    removed = F.col("event_type") == "error"
    log = load(spark, sf, "events").select(
        "user_id", F.when(~removed, F.col("props")).alias("comment"), *ORDER
    )
    return replay(log, ["user_id"], "comment", ORDER)


QUERIES = {
    "files_ingest": _ingest,
    "files_sync_plan": _sync_plan,
    "files_sync": _sync,
    "files_conflicts": _conflicts,
    "files_list_prefix": _list_prefix,
    "files_export": _export,
    "files_export_parts": _export_parts,
    "files_drop": _drop,
    "files_move": _move,
    "tags_apply": _tags,
    "tags_as_map": _tag_maps,
    "registry_verbs": _registry_verbs,
    "comments_apply": _comments,
}

_PATH = "lang || '/' || source || '/' || doc_id || '.txt'"
_PAGES = """
    SELECT page_id || '.html' AS path, CAST(strlen(html) AS BIGINT) AS size, sha256(html) AS sha256
    FROM pages"""
TAG_LOG = """
    WITH c AS (
        SELECT user_id, json_extract_string(props, '$.k') AS tag_name,
               CASE WHEN event_type <> 'error' THEN event_type END AS tag_value,
               row_number() OVER (PARTITION BY user_id, json_extract_string(props, '$.k')
                                  ORDER BY ts DESC, event_id DESC) AS rn
        FROM events)"""

ORACLES = {
    "files_ingest": f"""
        SELECT {_PATH} AS path, CAST(strlen(text) AS BIGINT) AS size, sha256(text) AS sha256
        FROM documents""",
    "files_sync_plan": """
        SELECT lang || '/' || doc_id || '.txt' AS path,
               CASE WHEN lang = 'de' THEN 'new'
                    WHEN source = 'src1' AND reverse(sha256(text)) <> sha256(text) THEN 'changed'
                    ELSE 'same' END AS action
        FROM documents""",
    "files_sync": """
        SELECT page_id || '.html' AS path, CAST(strlen(body) AS BIGINT) AS size,
               sha256(body) AS sha256
        FROM (SELECT page_id, CASE WHEN url LIKE 'https://%' THEN url ELSE html END AS body
              FROM pages)""",
    "files_conflicts": "SELECT lang || '/' || doc_id || '.txt' AS path FROM documents WHERE lang <> 'de'",
    "files_list_prefix": f"""
        SELECT {_PATH} AS path FROM documents WHERE lang = 'en' AND source = 'src1'""",
    "files_export": _PAGES,
    "files_export_parts": _PAGES,
    "files_drop": f"""
        SELECT {_PATH} AS path FROM documents WHERE NOT (lang = 'en' AND source = 'src1')""",
    "files_move": """
        SELECT 'moved/here/' || doc_id || '.txt' AS path, CAST(strlen(text) AS BIGINT) AS size, sha256(text) AS sha256
        FROM documents WHERE lang = 'en' AND source = 'src1'""",
    "tags_apply": TAG_LOG
    + " SELECT user_id, tag_name, tag_value FROM c WHERE rn = 1 AND tag_value IS NOT NULL",
    "tags_as_map": TAG_LOG
    + """ SELECT user_id, string_agg(tag_name || '=' || tag_value, ','
                             ORDER BY tag_name || '=' || tag_value) AS tags FROM c
          WHERE rn = 1 AND tag_value IS NOT NULL AND tag_name IS NOT NULL GROUP BY user_id""",
    "registry_verbs": """
        SELECT CAST(c_custkey AS VARCHAR) AS entity, 'key' AS name, c_mktsegment AS value FROM customer
        UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'comment', lower(c_name) FROM customer""",
    "comments_apply": """
        WITH c AS (
            SELECT user_id, CASE WHEN event_type <> 'error' THEN props END AS comment,
                   row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
            FROM events)
        SELECT user_id, comment FROM c WHERE rn = 1 AND comment IS NOT NULL""",
}
