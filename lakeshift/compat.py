"""Entry points under the names users of the original toolkit know, taking and
returning DataFrames. Only names whose meaning carries over are provided; where the
original took counts or row lists, these take the DataFrames the counts come from."""
from __future__ import annotations

from lakeshift.operators.bronze import (  # noqa: F401
    add_bronze_metadata, enforce_schema, ingest_batch, ingestion_stats as get_ingestion_stats,
)
from lakeshift.functions.text import record_hash as compute_record_hash  # noqa: F401
from lakeshift.operators.changes import detect_changes as detect_changed_records  # noqa: F401
from lakeshift.operators.dedup import dedup_latest as deduplicate_records  # noqa: F401
from lakeshift.operators.quality import (  # noqa: F401
    DQRule, apply_rules, date_not_future_rule, max_length_rule, not_null_rule,
    positive_numeric_rule, process_batch, silver_stats as get_silver_transform_stats,
    value_in_set_rule,
)
from lakeshift.operators.reconcile import (  # noqa: F401
    check_column_sum as check_column_sum_reconciliation,
    check_distinct_values as check_distinct_values_reconciliation,
    check_null_rate as check_null_rate_reconciliation,
    check_primary_key_completeness,
    check_row_count as check_row_count_reconciliation,
    reconcile_column_checksums, reconcile_row_counts, report_summary,
    run_full_reconciliation,
)
from lakeshift.sinks.write import bronze_ddl as generate_bronze_ddl  # noqa: F401
from lakeshift.spec import (  # noqa: F401
    BRONZE_METADATA_COLUMNS, ColumnSpec, TableSpec as TableSchema,
)
