"""Bronze, quality, dedup, change-detection, reconciliation and data-test operators.
Each takes and returns DataFrames."""
from lakeshift.operators.bronze import (  # noqa: F401
    BronzeBatch, add_bronze_metadata, enforce_schema, ingest_batch, ingestion_stats,
)
from lakeshift.operators.changes import change_counts, detect_changes, split_changes  # noqa: F401
from lakeshift.operators.datatests import (  # noqa: F401
    test_accepted_values, test_not_null, test_relationships, test_unique,
)
from lakeshift.operators.dedup import dedup_latest, duplicates_removed  # noqa: F401
from lakeshift.operators.quality import (  # noqa: F401
    DQRule, SilverBatch, apply_rules, check_rule, date_not_future_rule, max_length_rule,
    not_null_rule, positive_numeric_rule, process_batch, silver_stats, value_in_set_rule,
)
from lakeshift.operators.reconcile import (  # noqa: F401
    check_column_sum, check_distinct_values, check_null_rate, check_primary_key_completeness,
    check_row_count, reconcile_column_checksums, reconcile_row_counts, report_summary,
    run_full_reconciliation,
)
