"""Incremental bronze ingest of landed files with Structured Streaming.

``readStream`` over the landing folder with a declared schema + ``availableNow``
trigger processes exactly the files that arrived since the last run; the streaming
checkpoint replaces a stored high-water mark. Each micro-batch goes through the same
bronze batch logic; valid rows and quarantined rows are written to a per-batch
partition with overwrite, so a retried batch replaces its own output (idempotent).
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, types as T
from pyspark.sql.streaming import StreamingQuery

from lakeshift.operators.bronze import ingest_batch
from lakeshift.operators.dedup import one_per_key
from lakeshift.sinks.log import CommitLog, Files
from lakeshift.sinks.write import materialize, merge_partitions, write_table
from lakeshift.spec import TableSpec

QUERY_COLUMN, BATCH_COLUMN = "_query_id", "_batch_id"


def incremental_ingest(spark: SparkSession, landing_path: str, landing_schema: T.StructType,
                       spec: TableSpec, bronze_path: str, quarantine_path: str,
                       checkpoint_path: str, source_file=None, ingest_ts: str | None = None,
                       max_files_per_trigger: int | None = None,
                       wait: bool = True) -> StreamingQuery:
    reader = spark.readStream.schema(landing_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.parquet(landing_path)

    def write_batch(batch: DataFrame, batch_id: int) -> None:
        b = ingest_batch(batch, spec, source_file, ingest_ts)
        # Two outputs from one micro-batch: enforce once, into a written table.
        b.flagged = materialize(b.flagged, "stream-batch")
        # The query id lives in the checkpoint: a new checkpoint never overwrites old batches.
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        for frame, path in ((b.valid, bronze_path), (b.quarantine, quarantine_path)):
            frame.write.mode("overwrite").parquet(
                f"{path.rstrip('/')}/{QUERY_COLUMN}={query}/{BATCH_COLUMN}={batch_id}")

    q = (stream.writeStream.foreachBatch(write_batch)
         .option("checkpointLocation", checkpoint_path)
         .trigger(availableNow=True).start())
    if wait:
        q.awaitTermination()
    return q


BATCH_LOG = "_batches"


def incremental_upsert(spark: SparkSession, landing_path: str, landing_schema: T.StructType,
                       spec: TableSpec, table_path: str, quarantine_path: str, checkpoint_path: str,
                       keys: Sequence[str], partition_by: str | Sequence[str], order_by: Sequence[str] = (),
                       source_file=None, ingest_ts: str | None = None,
                       max_files_per_trigger: int | None = None, wait: bool = True) -> StreamingQuery:
    """``incremental_ingest`` into a table of one row per key: valid rows of a micro-batch update or
    join the partitioned table at ``table_path`` in place (``merge_partitions``); of several rows of a
    batch for a key the latest by ``order_by`` counts, without it they fail the batch.

    Merged batches are logged by query beside the data, so a batch that is retried after its merge is skipped;
    one that died within it is merged again, which gives the same table."""
    reader = spark.readStream.schema(landing_schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.parquet(landing_path)
    log = CommitLog(spark, f"{table_path.rstrip('/')}/{BATCH_LOG}")

    def merge_batch(batch: DataFrame, batch_id: int) -> None:
        query = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        number, merged = log.latest()
        if merged.get(query, -1) >= batch_id:
            return
        b = ingest_batch(batch, spec, source_file, ingest_ts)
        b.flagged = materialize(b.flagged, "stream-batch")
        b.quarantine.write.mode("overwrite").parquet(
            f"{quarantine_path.rstrip('/')}/{QUERY_COLUMN}={query}/{BATCH_COLUMN}={batch_id}")
        if number or any(not n.startswith("_") for n in Files(spark, table_path).names()):
            merge_partitions(batch.sparkSession, table_path, b.valid, keys, partition_by, order_by=order_by)
        else:
            write_table(one_per_key(b.valid, keys, order_by), table_path, "overwrite", partition_by=partition_by, replace="table")
        if not log.publish(number + 1, merged | {query: batch_id}):
            raise RuntimeError("another query merges into the table at the same time")

    q = (stream.writeStream.foreachBatch(merge_batch)
         .option("checkpointLocation", checkpoint_path)
         .trigger(availableNow=True).start())
    if wait:
        q.awaitTermination()
    return q


def read_bronze(spark: SparkSession, bronze_path: str) -> DataFrame:
    """All batches of a bronze folder written by ``incremental_ingest``."""
    return spark.read.parquet(bronze_path).drop(QUERY_COLUMN, BATCH_COLUMN)
