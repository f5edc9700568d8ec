"""Structured Streaming bronze ingest of landed files."""
from lakeshift.streaming.ingest import incremental_ingest, incremental_upsert, read_bronze  # noqa: F401
