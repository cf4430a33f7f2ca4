"""The queries that SQL can express, against their SQL; all others run and keep their columns."""

from __future__ import annotations

import duckdb
import pytest
from cases import SF

from lakeferry.llm import queries
from lakeferry.plans.workspace import close_all


@pytest.mark.parametrize("key", sorted(queries.ORACLES))
def test_same_result(spark, key):
    con = duckdb.connect()
    for name in ("documents", "conversations"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    result = con.execute(queries.ORACLES[key])
    names = [c[0] for c in result.description]
    df = queries.QUERIES[key](spark, SF)
    assert sorted(df.columns) == sorted(names)
    assert sorted(map(repr, map(tuple, df.select(*names).collect()))) == sorted(map(repr, result.fetchall()))


# The columns that each query returns at least.
COLUMNS = {
    "op1_near_dup": "doc_id n_shingles component_id kept",
    "op2_suffix_dedup": "doc_id n_bytes n_removed n_spans kept_sha256",
    "op3_mixing": "doc_id size source_size target taken",
    "op4_packing": "doc_id start length ids_crc32 doc_tokens sequence_id offset",
    "op5_neighbors": "query_id rank vec_id score",
    "op6_sharding": "doc_id slot shard",
    "op7_quality_model": "doc_id held_out score predicted",
    "op8_url_filter": "page_id host path rule verdict",
    "op9_secrets": "doc_id n_assign n_access n_hex base_sha256 spans",
    "op10_quality_rules": "doc_id n_words word_chars n_symbols n_dup_lines n_repeat_words base_failed kept",
    "op11_prefix_trie": "conv_id depth parent_conv_id n_convs n_children n_leaves saved_tokens ends_sha256",
    "op12_toxicity": "doc_id held_out score predicted",
    "op13_word_runs": "doc_id n_runs start length period exponent_milli runs_sha256 collapsed_sha256",
}


@pytest.mark.parametrize("key", sorted(COLUMNS))
def test_columns(spark, key):
    df = queries.QUERIES[key](spark, SF)
    assert set(COLUMNS[key].split()) <= set(df.columns)
    close_all()
