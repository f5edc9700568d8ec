"""Source reads: extracts with high-water marks and the landing suite."""
from lakeshift.sources.extract import (  # noqa: F401
    SourceConfig, extract_full, extract_incremental, ingest_suite, land, next_watermark,
    read_source, watermark_frame,
)
