"""Lakeferry: tables and files in and out of Spark, at scale."""

import sys

from pyspark import cloudpickle

# Task functions travel with their code, so executors need no installed copy of this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from lakeferry.functions.literals import parse_literal, render_literal  # noqa: E402
from lakeferry.functions.types import build_schema, schema_ddl, sql_type  # noqa: E402
from lakeferry.operators.conform import split_by_fit, type_fit_report, with_fit  # noqa: E402
from lakeferry.operators.export import export, save_table_to_files, sql_to_files  # noqa: E402
from lakeferry.operators.infer import infer_json, infer_schema  # noqa: E402
from lakeferry.operators.load import bulk_write_files, copy_into, read_files_as_table  # noqa: E402
from lakeferry.operators.merge import delete_where, merge_table, replace_keys  # noqa: E402
from lakeferry.operators.sql import run_sql, where_in  # noqa: E402
from lakeferry.operators.volumes import (  # noqa: E402
    drop_files,
    export_files,
    ingest_tree,
    list_files,
    move_files,
    put_files,
    stored_files,
)
from lakeferry.operators.write import (  # noqa: E402
    bulk_write_table,
    create_table,
    replace_table,
    write_table,
)
from lakeferry.sources.files import read_files, read_jdbc  # noqa: E402
from lakeferry.sources.records import from_records, records_of  # noqa: E402
from lakeferry.sources.tables import (  # noqa: E402
    Table,
    drop_table,
    read_external,
    read_table,
    table_exists,
)
from lakeferry.sources.trees import list_tree, read_tree  # noqa: E402
from lakeferry.streaming.ingest import read_file_stream, stream_ingest  # noqa: E402
from lakeferry.streaming.upsert import stream_merge, stream_tags  # noqa: E402

__all__ = [
    "Table",
    "build_schema",
    "bulk_write_files",
    "bulk_write_table",
    "copy_into",
    "create_table",
    "delete_where",
    "drop_files",
    "drop_table",
    "export",
    "export_files",
    "from_records",
    "infer_json",
    "infer_schema",
    "ingest_tree",
    "list_files",
    "list_tree",
    "merge_table",
    "move_files",
    "parse_literal",
    "put_files",
    "read_external",
    "read_file_stream",
    "read_files",
    "read_files_as_table",
    "read_jdbc",
    "read_table",
    "read_tree",
    "records_of",
    "render_literal",
    "replace_keys",
    "replace_table",
    "run_sql",
    "save_table_to_files",
    "schema_ddl",
    "split_by_fit",
    "sql_to_files",
    "sql_type",
    "stored_files",
    "stream_ingest",
    "stream_merge",
    "stream_tags",
    "table_exists",
    "type_fit_report",
    "where_in",
    "with_fit",
    "write_table",
]
