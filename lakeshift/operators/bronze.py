"""Bronze ingestion: schema enforcement with coercion, lineage columns and a record
hash, and a valid / quarantine split in which a bad row never fails the batch.

All of it is one projection over the input (no shuffle): it scales with the scan.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lakeshift.functions.coerce import coerce, coercion_failed
from lakeshift.functions.text import record_hash
from lakeshift.spec import TableSpec

ERRORS = "_errors"
RAW = "_raw"
STATUS = "_bronze_status"
# Pass as ``source_file`` to take each row's file from the Parquet scan metadata.
FROM_SCAN = object()


def _raw_column(df: DataFrame, name: str) -> tuple[Column, T.DataType | None]:
    types = {f.name: f.dataType for f in df.schema.fields}
    if name in types:
        return F.col(f"`{name}`"), types[name]
    return F.lit(None), T.NullType()  # an absent column reads as null


def enforced_columns(df: DataFrame, spec: TableSpec) -> tuple[list[Column], Column]:
    """Declared columns (coerced, defaults filled) and the ordered error array.

    Per column, in declared order: a null required value is an error (a default does
    not rescue it); a null nullable value takes the default; a non-null value that
    does not coerce is an error. Undeclared columns are dropped.
    """
    values, errors = [], []
    for c in spec.columns:
        raw, st = _raw_column(df, c.name)
        coerced = coerce(raw, c.dtype, st)
        default = F.lit(c.default if c.nullable else None).cast(c.spark_type)
        values.append(F.when(raw.isNull(), default).otherwise(coerced)
                      .cast(c.spark_type).alias(c.name))
        coerce_err = F.when(coercion_failed(raw, coerced), F.concat(
            F.lit(f"Cannot coerce column '{c.name}' value '"), raw.cast("string"),
            F.lit(f"' to {c.dtype}")))
        if c.nullable:
            errors.append(coerce_err)
        else:
            errors.append(F.when(raw.isNull(), F.lit(
                f"Required column '{c.name}' is null in record")).otherwise(coerce_err))
    err_array = F.filter(F.array(*errors), lambda e: e.isNotNull()) if errors \
        else F.array().cast("array<string>")
    return values, err_array


def enforce_schema(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Declared columns plus ``_errors`` (array<string>, empty when the row is valid)."""
    values, err = enforced_columns(df, spec)
    return df.select(*values, err.alias(ERRORS))


def add_bronze_metadata(df: DataFrame, source_table: str, source_file=None,
                        ingest_ts: str | None = None,
                        hash_columns: list[str] | None = None) -> DataFrame:
    """Append the five lineage columns. ``ingest_ts`` fixes the ingestion time
    (reproducible runs); otherwise the query's current time in the session zone
    (UTC in every session this package builds)."""
    ts = F.current_timestamp().cast("timestamp_ntz") if ingest_ts is None \
        else F.lit(ingest_ts).cast("timestamp_ntz")
    if source_file is FROM_SCAN:
        src = F.col("_metadata.file_path")
    else:
        src = F.lit(source_file or "")
    cols = hash_columns if hash_columns is not None else df.columns
    return df.withColumns({
        "_ingestion_timestamp": ts,
        "_source_file": src,
        "_source_table": F.lit(source_table),
        "_record_hash": record_hash(cols),
        "_is_deleted": F.lit(False),
    })


@dataclass
class BronzeBatch:
    """Result of one batch: ``flagged`` holds every input row once; ``valid`` and
    ``quarantine`` are two filters over it (persist ``flagged`` if both are written)."""
    flagged: DataFrame
    spec: TableSpec
    raw_columns: list[str]

    @property
    def valid(self) -> DataFrame:
        return self.flagged.filter(F.size(ERRORS) == 0).drop(ERRORS, RAW)

    @property
    def quarantine(self) -> DataFrame:
        """Rejected rows as they arrived, with the first error (the one the row was
        rejected for) and the count of all errors."""
        return (self.flagged.filter(F.size(ERRORS) > 0)
                .select(*[F.col(f"{RAW}.`{c}`").alias(c) for c in self.raw_columns],
                        F.get(F.col(ERRORS), 0).alias("_error"),
                        F.size(ERRORS).alias("_error_count")))

    def write_split(self, path: str, mode: str = "overwrite") -> dict:
        """Write valid and quarantined rows in ONE job, as a table partitioned by
        ``_bronze_status`` (``valid`` / ``quarantine``). Valid rows carry the enforced
        columns and lineage; quarantined rows also keep ``_raw`` (the values as they
        arrived) and ``_errors``. Counts come from observed metrics of the same job."""
        from pyspark.sql import Observation
        from lakeshift.sinks.write import write_table
        obs = Observation("bronze_split")
        bad = F.size(ERRORS) > 0
        out = self.flagged.observe(obs, F.count(F.lit(1)).alias("raw_records"),
                                   F.count_if(bad).alias("error_records")).select(
            *[c for c in self.flagged.columns if c not in (RAW, ERRORS)],
            F.when(bad, F.col(RAW)).alias(RAW), F.when(bad, F.col(ERRORS)).alias(ERRORS),
            F.when(bad, F.lit("quarantine")).otherwise(F.lit("valid")).alias(STATUS))
        write_table(out, path, mode, partition_by=STATUS, replace="table", rebalance=False)
        m = obs.get
        raw, errs = int(m["raw_records"]), int(m["error_records"])
        return {"raw_records": raw, "bronze_records": raw - errs, "error_records": errs,
                "success_rate_pct": round((raw - errs) / raw * 100, 2) if raw else 0.0,
                "passed": errs == 0}

    def stats(self) -> DataFrame:
        """One-row ingestion statistics from a single aggregation."""
        agg = self.flagged.agg(F.count(F.lit(1)).alias("raw_records"),
                               F.count_if(F.size(ERRORS) == 0).alias("bronze_records"),
                               F.count_if(F.size(ERRORS) > 0).alias("error_records"))
        return ingestion_stats(agg)


def ingestion_stats(counts: DataFrame) -> DataFrame:
    """raw / bronze / error counts -> success %, 2 dp (0 raw -> 0.0); passed iff no errors."""
    raw, ok, bad = F.col("raw_records"), F.col("bronze_records"), F.col("error_records")
    return counts.select(
        raw, ok, bad,
        F.when(raw > 0, F.round(ok / raw * 100, 2)).otherwise(F.lit(0.0)).alias("success_rate_pct"),
        (bad == 0).alias("passed"))


def ingest_batch(df: DataFrame, spec: TableSpec, source_file=None,
                 ingest_ts: str | None = None) -> BronzeBatch:
    """Enforce the schema, then add lineage to the rows that passed; rows that failed
    go to the quarantine with their raw values. The hash covers the enforced record."""
    raw_columns = list(df.columns)
    values, err = enforced_columns(df, spec)
    pre = []
    if source_file is FROM_SCAN:
        pre = [F.col("_metadata.file_path").alias("__source_file")]
    flagged = df.select(F.struct(*[F.col(f"`{c}`") for c in raw_columns]).alias(RAW),
                        *values, err.alias(ERRORS), *pre)
    src = F.col("__source_file") if source_file is FROM_SCAN else F.lit(source_file or "")
    ts = F.current_timestamp().cast("timestamp_ntz") if ingest_ts is None \
        else F.lit(ingest_ts).cast("timestamp_ntz")
    flagged = flagged.withColumns({
        "_ingestion_timestamp": ts,
        "_source_file": src,
        "_source_table": F.lit(spec.table_name),
        "_record_hash": record_hash(spec.column_names()),
        "_is_deleted": F.lit(False),
    })
    if pre:
        flagged = flagged.drop("__source_file")
    return BronzeBatch(flagged, spec, raw_columns)


def bronze_table_schema(spec: TableSpec) -> T.StructType:
    """Declared columns plus lineage columns, with NOT NULL where declared."""
    from lakeshift.spec import BRONZE_METADATA_COLUMNS
    fields = [T.StructField(c.name, c.spark_type, c.nullable)
              for c in (*spec.columns, *BRONZE_METADATA_COLUMNS)]
    return T.StructType(fields)
