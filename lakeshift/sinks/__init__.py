"""Writes: partitioned tables, upserts and merges, schema evolution, bucketed tables."""
from lakeshift.sinks.write import (  # noqa: F401
    append_evolving, apply_changes, bronze_ddl, create_bronze_table, materialize,
    merge_into_path, merge_partitions, read_evolving, upsert, write_bucketed_table,
    write_table,
)
