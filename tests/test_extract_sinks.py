import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from lakeshift.sinks import write as W
from lakeshift.sources import extract as X
from lakeshift.spec import CUSTOMERS, ColumnSpec, TableSpec
from tests.conftest import rows

SPEC = TableSpec("Orders", "dbo", (ColumnSpec("id", "int"), ColumnSpec("ts", "timestamp")),
                 primary_key=("id",), incremental="ts")


def src(spark, tmp_path):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2)),
                                (3, None)], "id int, ts timestamp_ntz")
    p = str(tmp_path / "src")
    df.write.parquet(p)
    return X.SourceConfig(SPEC, "parquet", p)


def test_incremental_is_strict_and_pushed_down(spark, tmp_path):
    cfg = src(spark, tmp_path)
    out = X.extract_incremental(spark, cfg, "2024-01-01 00:00:00")
    assert [r.id for r in out.collect()] == [2]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(ts), GreaterThan(ts," in plan
    assert len(X.extract_full(spark, cfg).collect()) == 3
    assert X.extract_incremental(spark, cfg, None).count() == 3


def test_incremental_requires_column(spark, tmp_path):
    cfg = src(spark, tmp_path)
    cfg.table = TableSpec("Orders", "dbo", SPEC.columns)
    with pytest.raises(ValueError, match="incremental_column is required"):
        X.extract_incremental(spark, cfg, "2024-01-01")


def test_null_trap_coalesce_expression(spark):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1), None),
                                (2, dt.datetime(2023, 1, 1), dt.datetime(2024, 2, 1))],
                               "CustomerID int, CreatedDate timestamp_ntz, UpdatedDate timestamp_ntz")
    cfg = X.SourceConfig(CUSTOMERS, "dataframe", dataframe=df)
    assert {r.CustomerID for r in X.extract_incremental(spark, cfg, "2023-06-01 00:00:00").collect()} == {1, 2}


def test_watermark_advance_and_empty_batch(spark, tmp_path):
    cfg = src(spark, tmp_path)
    batch = X.extract_incremental(spark, cfg, "2024-01-01 00:00:00")
    assert X.next_watermark(batch, cfg, "2024-01-01 00:00:00") == "2024-01-02 00:00:00"
    empty = X.extract_incremental(spark, cfg, "2030-01-01 00:00:00")
    r = X.watermark_frame(empty, cfg, "2030-01-01 00:00:00").first()
    assert r.new_watermark == "2030-01-01 00:00:00" and r.rows_extracted == 0


def test_ingest_suite_lands_partitioned(spark, tmp_path):
    cfg = src(spark, tmp_path)
    out = X.ingest_suite(spark, [cfg], str(tmp_path / "lake"), "LegacyDB", "2024-03-01")
    r = out.first()
    assert r.rows_extracted == 2 and r.new_watermark == "2024-01-02 00:00:00"
    assert os.path.isdir(tmp_path / "lake/raw/LegacyDB/Orders/ingestion_date=2024-03-01")


def test_write_modes(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "id int, v string")
    with pytest.raises(ValueError, match="Invalid write_mode"):
        W.write_table(df, str(tmp_path / "x"), "upsert")
    p = str(tmp_path / "t")
    W.write_table(df, p, "append")
    W.write_table(df, p, "append")
    assert spark.read.parquet(p).count() == 2
    W.write_table(df, p, "overwrite")
    assert spark.read.parquet(p).count() == 1
    new = W.write_table(spark.createDataFrame([(1, "b"), (2, "c")], "id int, v string"), p,
                        "merge", keys=["id"])
    assert rows(spark.read.parquet(new)) == [{"id": 1, "v": "b"}, {"id": 2, "v": "c"}]


def test_dynamic_partition_overwrite(spark, tmp_path):
    p = str(tmp_path / "p")
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "id int, d string")
    W.write_table(df, p, "overwrite", partition_by="d")
    W.write_table(spark.createDataFrame([(3, "2024-01-02")], "id int, d string"), p,
                  "overwrite", partition_by="d")
    assert sorted(r.id for r in spark.read.parquet(p).collect()) == [1, 3]


def test_schema_evolution_on_append(spark, tmp_path):
    p = str(tmp_path / "e")
    W.append_evolving(spark.createDataFrame([(1,)], "id int"), p)
    W.append_evolving(spark.createDataFrame([(2, "x")], "id int, extra string"), p)
    got = rows(W.read_evolving(spark, p))
    assert got == [{"id": 1, "extra": None}, {"id": 2, "extra": "x"}]


def test_upsert_composite_and_null_keys(spark):
    t = spark.createDataFrame([(1, None, "a"), (1, 2, "b")], "k1 int, k2 int, v string")
    u = spark.createDataFrame([(1, None, "A")], "k1 int, k2 int, v string")
    assert rows(W.upsert(t, u, ["k1", "k2"])) == [{"k1": 1, "k2": 2, "v": "b"},
                                                 {"k1": 1, "k2": None, "v": "A"}]


def test_streaming_ingest_is_incremental(spark, tmp_path):
    from lakeshift.streaming.ingest import incremental_ingest, read_bronze
    schema = "CustomerID string, CustomerName string, CustomerStatus string, CreatedDate string"
    land = str(tmp_path / "land")
    spark.createDataFrame([("1", "A", "ACTIVE", "2024-01-01 00:00:00"),
                           ("x", "B", "ACTIVE", "2024-01-01 00:00:00")], schema) \
        .coalesce(1).write.mode("append").parquet(land)
    args = dict(landing_schema=spark.read.parquet(land).schema, spec=CUSTOMERS,
                bronze_path=str(tmp_path / "b"), quarantine_path=str(tmp_path / "q"),
                checkpoint_path=str(tmp_path / "ck"))
    incremental_ingest(spark, land, **args)
    assert read_bronze(spark, str(tmp_path / "b")).count() == 1
    spark.createDataFrame([("2", "C", "ACTIVE", "2024-01-02 00:00:00")], schema) \
        .coalesce(1).write.mode("append").parquet(land)
    incremental_ingest(spark, land, **args)  # only the new file is processed
    assert sorted(r.CustomerID for r in read_bronze(spark, str(tmp_path / "b")).collect()) == [1, 2]
    assert spark.read.parquet(str(tmp_path / "q")).count() == 1


def test_create_bronze_table(spark, tmp_path):
    W.create_bronze_table(spark, "bronze_test_customers", CUSTOMERS, str(tmp_path / "bt"))
    cols = spark.table("bronze_test_customers").columns
    assert cols[:2] == ["CustomerID", "CustomerName"] and cols[-1] == "_is_deleted"


def test_dynamic_overwrite_independent_of_session_mode(spark, tmp_path):
    p = str(tmp_path / "ps")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", "static")
    try:
        W.write_table(spark.createDataFrame([(1, "a"), (2, "b")], "id int, d string"), p,
                      "overwrite", partition_by="d")
        W.write_table(spark.createDataFrame([(3, "b")], "id int, d string"), p, "overwrite",
                      partition_by="d")
        assert sorted(r.id for r in spark.read.parquet(p).collect()) == [1, 3]
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")


@pytest.mark.parametrize("strategy", ["join", "group"])
def test_merge_partitions_rewrites_only_touched(spark, tmp_path, strategy):
    p = str(tmp_path / f"mp{strategy}")
    W.write_table(spark.createDataFrame([(1, "a", "d1"), (2, "b", "d1"), (3, "c", "d2")],
                                        "id int, v string, d string"), p, "overwrite",
                  partition_by="d")
    d2_files = sorted(os.listdir(os.path.join(p, "d=d2")))
    upd = spark.createDataFrame([(2, "B", "d1"), (4, "x", "d1")], "id int, v string, d string")
    W.merge_partitions(spark, p, upd, ["id"], "d", strategy=strategy)
    assert sorted(tuple(r) for r in spark.read.parquet(p).select("id", "v", "d").collect()) == [
        (1, "a", "d1"), (2, "B", "d1"), (3, "c", "d2"), (4, "x", "d1")]
    assert sorted(os.listdir(os.path.join(p, "d=d2"))) == d2_files  # untouched partition


def test_landing_rerun_is_idempotent(spark, tmp_path):
    cfg = src(spark, tmp_path)
    root = str(tmp_path / "lake2")
    for _ in range(2):
        X.ingest_suite(spark, [cfg], root, "LegacyDB", "2024-03-01")
    X.ingest_suite(spark, [cfg], root, "LegacyDB", "2024-03-02")
    landed = spark.read.parquet(f"{root}/raw/LegacyDB/Orders")
    assert landed.count() == 4  # 2 rows per day, the rerun of 03-01 replaced itself


@pytest.mark.parametrize("fmt", ["csv", "orc"])
def test_csv_and_orc_sources(spark, tmp_path, fmt):
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1)), (2, dt.datetime(2024, 1, 2))],
                               "id int, ts timestamp_ntz")
    p = str(tmp_path / fmt)
    W.write_table(df, p, "overwrite", file_format=fmt)
    cfg = X.SourceConfig(SPEC, fmt, p)
    out = X.extract_incremental(spark, cfg, "2024-01-01 00:00:00").collect()
    assert [r.id for r in out] == [2]


def test_upsert_group_strategy_matches_join(spark):
    t = spark.createDataFrame([(1, None, "a"), (1, 2, "b"), (3, 3, "c")], "k1 int, k2 int, v string")
    u = spark.createDataFrame([(1, None, "A"), (4, 4, "d")], "k1 int, k2 int, v string")
    a = rows(W.upsert(t, u, ["k1", "k2"]))
    b = rows(W.upsert(t, u, ["k1", "k2"], strategy="group"))
    assert a == b == [{"k1": 1, "k2": 2, "v": "b"}, {"k1": 1, "k2": None, "v": "A"},
                      {"k1": 3, "k2": 3, "v": "c"}, {"k1": 4, "k2": 4, "v": "d"}]
