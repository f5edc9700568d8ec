"""Retry-safe landing: a load counts once it stands in the manifest of its table.

Every attempt writes a folder of its own. The manifest lists the loads that count, with their
range of marks, rows and schema; a load is added by publishing the next state of its commit log,
which at once advances the table's mark. So a run that dies before that leaves a folder nobody
reads, and its retry, on whatever date, lands the rows once; of two runs that start from one mark
one is refused. ``read_landed`` takes the loads of the manifest only and opens no file for its schema.
"""
from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakeshift.sinks.log import CommitLog, Files

DATE_COLUMN, LOAD_COLUMN = "ingestion_date", "load_id"


class LoadConflict(RuntimeError):
    """Another run has committed a load since this one read the mark."""


def manifest(spark: SparkSession, marks_path: str, table: str) -> CommitLog:
    return CommitLog(spark, f"{marks_path.rstrip('/')}/{table}")


def committed_loads(spark: SparkSession, marks_path: str, table: str) -> list[dict]:
    """The loads of a table that count, in order."""
    return manifest(spark, marks_path, table).latest()[1].get("loads", [])


def stored_marks(spark: SparkSession, marks_path: str) -> dict[str, str]:
    """The mark of every table that has a load."""
    found = {}
    for table in Files(spark, marks_path).names():
        loads = committed_loads(spark, marks_path, table)
        if loads and loads[-1]["mark"] is not None:
            found[table] = loads[-1]["mark"]
    return found


def stage_load(batch: DataFrame, path: str, ingestion_date: str) -> dict:
    """Write ``batch`` to a new folder; it does not count before ``commit_load``."""
    load = uuid.uuid4().hex[:12]
    folder = f"{DATE_COLUMN}={ingestion_date}/{LOAD_COLUMN}={load}"
    batch.write.parquet(f"{path.rstrip('/')}/{folder}")
    return {"load": load, "folder": folder, "date": ingestion_date, "schema": batch.schema.json()}


def staged(spark: SparkSession, path: str, load: dict) -> DataFrame:
    """The rows of one load."""
    return spark.read.schema(T.StructType.fromJson(json.loads(load["schema"]))).parquet(f"{path.rstrip('/')}/{load['folder']}")


def commit_load(spark: SparkSession, marks_path: str, table: str, path: str, load: dict, previous: str | None,
                mark: str | None, rows: int, number: int, loads: list[dict]) -> None:
    """Publish ``loads`` (state ``number``) with ``load`` added. Refused loads are deleted and raise."""
    entry = load | {"previous": previous, "mark": mark, "rows": rows}
    if not manifest(spark, marks_path, table).publish(number + 1, {"loads": [*loads, entry]}):
        Files(spark, path).delete(load["folder"])
        raise LoadConflict(f"{table}: another run has committed a load from {previous}; run again from the new mark")


def loads_before(loads: list[dict], mark: str | None) -> list[dict]:
    """The loads that stay if the table is loaded again from ``mark``: those before the one that began there."""
    if not loads or loads[-1]["mark"] == mark:
        return loads
    for k, load in enumerate(loads):
        if load["previous"] == mark:
            return loads[:k]
    raise ValueError(f"no load starts or ends at {mark}")


def read_landed(spark: SparkSession, path: str, marks_path: str, table: str) -> DataFrame:
    """Rows of the committed loads with ``ingestion_date`` and ``load_id``; columns that later loads
    added are null before."""
    loads = committed_loads(spark, marks_path, table)
    if not loads:
        raise ValueError(f"no load of {table} is committed")
    fields: dict[str, T.StructField] = {}
    for load in loads:
        fields |= {f.name: f for f in T.StructType.fromJson(json.loads(load["schema"])).fields}
    schema = T.StructType([*fields.values(), T.StructField(DATE_COLUMN, T.DateType()), T.StructField(LOAD_COLUMN, T.StringType())])
    root = path.rstrip("/")
    folders = [f"{root}/{load['folder']}" for load in loads if load["rows"]]
    if not folders:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).option("basePath", root).parquet(*folders)


def remove_uncommitted(spark: SparkSession, path: str, marks_path: str, table: str) -> list[str]:
    """Delete the folders of loads that do not count; call it while no run is landing the table."""
    files = Files(spark, path)
    counted = {load["folder"] for load in committed_loads(spark, marks_path, table)}
    found = [f"{d}/{n}" for d in files.names() if d.startswith(f"{DATE_COLUMN}=") for n in files.names(d) if n.startswith(f"{LOAD_COLUMN}=")]
    gone = [f for f in found if f not in counted]
    for folder in gone:
        files.delete(folder)
    return gone


def mark_rows(spark: SparkSession, entries: list[tuple]) -> DataFrame:
    """(table, column, previous mark, new mark, rows, date) of the loads of one run."""
    rows = spark.createDataFrame(entries, "table_name string, watermark_column string, previous_watermark string, new_watermark string, "
                                          "rows_extracted long, ingestion_date string")
    return rows.withColumn("ingestion_date", F.col("ingestion_date").cast("date"))
