"""Extracts from a source system: full, incremental by a stored high-water mark,
watermark advance, and a config-driven multi-table landing suite.

A source is a Parquet/ORC/CSV location, a catalog table, a JDBC relation or an
existing DataFrame. Filters are plain DataFrame filters, so Catalyst pushes them into
the Parquet row-group filter or the JDBC ``WHERE`` clause; JDBC reads are split into
even steps of a numeric partition column or into given ``ranges`` of equal row shares.
"""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeshift.sources import loads
from lakeshift.spec import TableSpec

# The initial watermark of a first incremental load.
INITIAL_WATERMARK = "1900-01-01 00:00:00"


@dataclass
class SourceConfig:
    table: TableSpec
    kind: str = "parquet"            # parquet | orc | csv | table | jdbc | dataframe
    location: str | None = None      # path, table name or JDBC URL
    options: dict = field(default_factory=dict)
    dataframe: DataFrame | None = None
    incremental: str | None = None   # SQL expression; defaults to the spec's
    partition_column: str | None = None   # JDBC parallel read
    lower_bound: int | None = None
    upper_bound: int | None = None
    num_partitions: int | None = None
    ranges: Sequence[str] = ()            # JDBC: one connection per predicate (sources.ranges.key_ranges)

    @property
    def incremental_expr(self) -> str | None:
        return self.incremental or self.table.incremental

    @property
    def incremental_columns(self) -> tuple[str, ...]:
        return () if self.incremental else self.table.incremental_columns


def read_source(spark: SparkSession, cfg: SourceConfig) -> DataFrame:
    if cfg.kind == "dataframe":
        if cfg.dataframe is None:
            raise ValueError("kind='dataframe' needs a dataframe")
        return cfg.dataframe
    if cfg.kind == "table":
        return spark.table(cfg.location)
    if cfg.kind == "jdbc" and cfg.ranges:
        return spark.read.jdbc(cfg.location, f"{cfg.table.source_schema}.{cfg.table.table_name}",
                               predicates=list(cfg.ranges), properties={k: str(v) for k, v in cfg.options.items()})
    if cfg.kind == "jdbc":
        r = (spark.read.format("jdbc").option("url", cfg.location)
             .option("dbtable", f"{cfg.table.source_schema}.{cfg.table.table_name}")
             .options(**cfg.options))
        if cfg.partition_column:
            r = (r.option("partitionColumn", cfg.partition_column)
                 .option("lowerBound", str(cfg.lower_bound))
                 .option("upperBound", str(cfg.upper_bound))
                 .option("numPartitions", str(cfg.num_partitions or 8)))
        return r.load()
    if cfg.kind in ("parquet", "orc"):
        return spark.read.format(cfg.kind).options(**cfg.options).load(cfg.location)
    if cfg.kind == "csv":
        return (spark.read.options(header="true", **cfg.options)
                .schema(cfg.table.struct()).csv(cfg.location))
    raise ValueError(f"Unknown source kind '{cfg.kind}'")


def extract_full(spark: SparkSession, cfg: SourceConfig) -> DataFrame:
    """Every row and column of the source table."""
    return read_source(spark, cfg)


def _typed_mark(df: DataFrame, expr: Column, watermark: str) -> Column:
    t = df.select(expr.alias("x")).schema["x"].dataType
    return F.lit(watermark).cast(t)


def extract_incremental(spark: SparkSession, cfg: SourceConfig,
                        watermark: str | None = INITIAL_WATERMARK) -> DataFrame:
    """Rows whose incremental value is strictly greater than ``watermark``. With no
    watermark every row is extracted. A null incremental value never passes ``>``, so
    nullable columns should be configured as e.g. ``coalesce(updated, created)``."""
    if not cfg.incremental_expr:
        raise ValueError("incremental_column is required for incremental pipelines")
    df = read_source(spark, cfg)
    if watermark is None:
        return df
    e = F.expr(cfg.incremental_expr)
    mark = _typed_mark(df, e, watermark)
    if not cfg.incremental_columns:
        return df.filter(e > mark)
    # a > m OR (a IS NULL AND (b > m OR ...)): the first non-null column passes the mark
    passes = F.lit(False)
    for i, name in enumerate(reversed(cfg.incremental_columns)):
        c = F.col(f"`{name}`")
        passes = c > mark if i == 0 else (c > mark) | (c.isNull() & passes)
    return df.filter(passes)


def watermark_frame(batch: DataFrame, cfg: SourceConfig,
                    previous: str | None = INITIAL_WATERMARK) -> DataFrame:
    """One row for the watermark table, from one aggregation over the extracted batch:
    the new mark is the batch maximum (text), or the previous mark if the batch is
    empty or all-null."""
    e = F.expr(cfg.incremental_expr)
    prev = F.lit(previous).cast("string")
    return batch.agg(F.max(e).cast("string").alias("m"), F.count(F.lit(1)).alias("n")).select(
        F.lit(cfg.table.qualified_name).alias("table_name"),
        F.lit(cfg.incremental_expr).alias("watermark_column"),
        prev.alias("previous_watermark"),
        F.coalesce(F.col("m"), prev).alias("new_watermark"),
        F.col("n").alias("rows_extracted"))


def next_watermark(batch: DataFrame, cfg: SourceConfig,
                   previous: str | None = INITIAL_WATERMARK) -> str | None:
    """The new mark as a driver-side string (one scalar) for storing after the write."""
    return watermark_frame(batch, cfg, previous).first()["new_watermark"]


def land(df: DataFrame, path: str, ingestion_date: str, file_format: str = "parquet",
         partition_column: str = "ingestion_date", mode: str = "overwrite",
         load_id: str | None = None) -> str:
    """Write an extracted batch to the raw zone, partitioned by ingestion date.

    The default replaces only this date's partition (dynamic overwrite), so rerunning a
    day after a failure lands the same rows once; other days are untouched. With a
    ``load_id`` the load is a partition of its own within the date: rerunning it replaces
    it alone, and further loads of the day add to it."""
    from lakeshift.sinks.write import write_table
    out = df.withColumn(partition_column, F.lit(ingestion_date).cast("date"))
    parts = [partition_column]
    if load_id is not None:
        out = out.withColumn("load_id", F.lit(load_id))
        parts.append("load_id")
    return write_table(out, path, mode, file_format, parts, rebalance=False)


def ingest_suite(spark: SparkSession, configs: Sequence[SourceConfig], raw_root: str,
                 database: str, ingestion_date: str,
                 watermarks: dict[str, str] | None = None,
                 marks_path: str | None = None) -> DataFrame:
    """For each configured table: incremental extract from its stored mark (default the
    initial mark), landed as Parquet under ``raw/<database>/<table>`` partitioned by
    ``ingestion_date``. Returns one row per table read back from what was landed:
    table, rows landed, new watermark. The loop is over table configs, not rows.

    With ``marks_path`` the loads are retry-safe (``lakeshift.sources.loads``): marks come from
    each table's manifest there, and a load counts, and moves the mark, when it is published in it. A mark
    in ``watermarks`` then loads again from there: loads that began at it or later no longer count."""
    watermarks = dict(watermarks or {})
    if marks_path is not None:
        return _committed_suite(spark, configs, raw_root, database, ingestion_date, watermarks, marks_path)
    frames = []
    for cfg in configs:
        mark = watermarks.get(cfg.table.qualified_name, INITIAL_WATERMARK)
        batch = extract_incremental(spark, cfg, mark)
        path = landing_path(raw_root, database, cfg)
        # a load is known by the mark it starts from: the same load again replaces itself
        load_id = f"from {mark}"
        land(batch, path, ingestion_date, load_id=load_id)
        landed = spark.read.parquet(path).filter(
            (F.col("ingestion_date") == F.lit(ingestion_date).cast("date")) & (F.col("load_id") == load_id))
        frames.append(watermark_frame(landed, cfg, mark).withColumn(
            "ingestion_date", F.lit(ingestion_date).cast("date")))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _committed_suite(spark: SparkSession, configs: Sequence[SourceConfig], raw_root: str, database: str,
                     ingestion_date: str, watermarks: dict[str, str], marks_path: str) -> DataFrame:
    entries = []
    for cfg in configs:
        table = cfg.table.qualified_name
        path = landing_path(raw_root, database, cfg)
        number, state = loads.manifest(spark, marks_path, table).latest()
        have = state.get("loads", [])
        mark = watermarks.get(table, have[-1]["mark"] if have else INITIAL_WATERMARK)
        kept = loads.loads_before(have, mark)
        load = loads.stage_load(extract_incremental(spark, cfg, mark), path, ingestion_date)
        row = watermark_frame(loads.staged(spark, path, load), cfg, mark).first()
        loads.commit_load(spark, marks_path, table, path, load, mark, row.new_watermark, row.rows_extracted, number, kept)
        entries.append((*row, ingestion_date))
    return loads.mark_rows(spark, entries)


def landing_path(raw_root: str, database: str, cfg: SourceConfig) -> str:
    return f"{raw_root.rstrip('/')}/raw/{database}/{cfg.table.table_name}"


def read_marks(spark: SparkSession, path: str) -> dict[str, str]:
    """Latest stored mark per table."""
    return loads.stored_marks(spark, path)
