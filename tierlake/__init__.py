"""Layered tables on Spark: ingest, upsert by key, map ids between sources, publish gold views."""

from tierlake.config import DocumentJob, GoldJob, MappingJob, Output, RelationalJob
from tierlake.functions.names import qualified_name
from tierlake.functions.schema import SchemaError, conform, rejects
from tierlake.operators.gold import bridged_join_sql, direct_join_sql, preview, publish_view, read_view
from tierlake.operators.mapping import build_mapping
from tierlake.operators.publish import first_load, grow_buckets, overwrite, register_path, remove_unused, upsert
from tierlake.operators.tables import PublishError, read_table, register_external_table, table_exists
from tierlake.operators.upsert import merge_upsert
from tierlake.plans.jobs import ingest_documents, ingest_relational, map_sources, publish_gold
from tierlake.sources.documents import read_collection, read_export
from tierlake.sources.jdbc import (
    Connection,
    Ranges,
    Strides,
    discovered_strides,
    even_ranges,
    partition_bounds,
    read_jdbc,
)

__all__ = [
    "Connection",
    "DocumentJob",
    "GoldJob",
    "MappingJob",
    "Output",
    "PublishError",
    "Ranges",
    "RelationalJob",
    "SchemaError",
    "Strides",
    "bridged_join_sql",
    "build_mapping",
    "conform",
    "direct_join_sql",
    "discovered_strides",
    "even_ranges",
    "first_load",
    "grow_buckets",
    "ingest_documents",
    "ingest_relational",
    "map_sources",
    "merge_upsert",
    "overwrite",
    "partition_bounds",
    "preview",
    "publish_gold",
    "publish_view",
    "qualified_name",
    "read_collection",
    "read_export",
    "read_jdbc",
    "read_table",
    "read_view",
    "register_external_table",
    "register_path",
    "rejects",
    "remove_unused",
    "table_exists",
    "upsert",
]
