"""Loads, schemas and batches that are published once; rules that raise; differences by digests."""
import glob
import os

import pytest
from pyspark.sql import functions as F

from lakeshift.operators import reconcile as R
from lakeshift.operators.dedup import dedup_latest, one_per_key
from lakeshift.operators.quality import process_batch, row_rule
from lakeshift.sinks import write as W
from lakeshift.sinks.log import CommitLog
from lakeshift.sources import extract as X, loads as L
from lakeshift.spec import CUSTOMERS
from lakeshift.streaming.ingest import BATCH_LOG, incremental_upsert

TABLE = CUSTOMERS.qualified_name
COLUMNS = "CustomerID long, CreatedDate string, UpdatedDate string"


def config(spark, *rows, extra=False):
    df = spark.createDataFrame([(i, f"2024-01-{d:02d} 00:00:00", None) for i, d in rows], COLUMNS).withColumns(
        {c: F.col(c).cast("timestamp_ntz") for c in ("CreatedDate", "UpdatedDate")})
    return X.SourceConfig(CUSTOMERS, "dataframe", dataframe=df.withColumn("Extra", F.lit("e")) if extra else df)


def landed(spark, root):
    got = L.read_landed(spark, f"{root}/raw/db/Customers", f"{root}/marks", TABLE)
    return sorted((r.CustomerID, str(r.ingestion_date)) for r in got.collect())


def run(spark, root, cfg, date, **marks):
    return X.ingest_suite(spark, [cfg], str(root), "db", date, marks_path=f"{root}/marks", **marks).first()


def test_dead_run_lands_once(spark, tmp_path):
    cfg = config(spark, (1, 1), (2, 2))
    L.stage_load(X.extract_incremental(spark, cfg), f"{tmp_path}/raw/db/Customers", "2024-02-01")
    assert X.read_marks(spark, f"{tmp_path}/marks") == {}
    assert run(spark, tmp_path, cfg, "2024-02-02").rows_extracted == 2
    assert landed(spark, tmp_path) == [(1, "2024-02-02"), (2, "2024-02-02")]
    again = run(spark, tmp_path, cfg, "2024-02-02")  # nothing new: nothing lost, the mark stays
    assert (again.rows_extracted, again.previous_watermark, again.new_watermark) == (0, "2024-01-02 00:00:00", "2024-01-02 00:00:00")
    assert len(landed(spark, tmp_path)) == 2
    gone = L.remove_uncommitted(spark, f"{tmp_path}/raw/db/Customers", f"{tmp_path}/marks", TABLE)
    assert len(gone) == 1 and len(landed(spark, tmp_path)) == 2


def test_empty_source_supersedes_old_load(spark, tmp_path):
    """Loaded again from an earlier mark, what began there no longer counts, also if nothing comes."""
    run(spark, tmp_path, config(spark, (1, 1)), "2024-02-01")
    run(spark, tmp_path, config(spark, (1, 1), (2, 5)), "2024-02-02")
    mark = "2024-01-01 00:00:00"
    row = run(spark, tmp_path, config(spark, (1, 1)), "2024-02-03", watermarks={TABLE: mark})
    assert (row.rows_extracted, row.new_watermark) == (0, mark)
    assert landed(spark, tmp_path) == [(1, "2024-02-01")]
    with pytest.raises(ValueError, match="no load starts or ends"):
        run(spark, tmp_path, config(spark), "2024-02-03", watermarks={TABLE: "2020-01-01 00:00:00"})


def test_two_runs_from_one_mark(spark, tmp_path):
    path, marks = f"{tmp_path}/raw/db/Customers", f"{tmp_path}/marks"
    batch = X.extract_incremental(spark, config(spark, (1, 1)))
    a, b = (L.stage_load(batch, path, "2024-02-01") for _ in range(2))
    L.commit_load(spark, marks, TABLE, path, a, "m0", "m1", 1, 0, [])
    with pytest.raises(L.LoadConflict):
        L.commit_load(spark, marks, TABLE, path, b, "m0", "m1", 1, 0, [])
    assert landed(spark, tmp_path) == [(1, "2024-02-01")] and X.read_marks(spark, marks) == {TABLE: "m1"}
    assert not os.path.exists(f"{path}/{b['folder']}")


def test_landed_schema_grows(spark, tmp_path):
    run(spark, tmp_path, config(spark, (1, 1)), "2024-02-01")
    run(spark, tmp_path, config(spark, (1, 1), (2, 2), extra=True), "2024-02-02")
    got = L.read_landed(spark, f"{tmp_path}/raw/db/Customers", f"{tmp_path}/marks", TABLE)
    assert sorted((r.CustomerID, r.Extra) for r in got.collect()) == [(1, None), (2, "e")]


def test_commit_log_publishes_once(spark, tmp_path):
    log = CommitLog(spark, f"{tmp_path}/log")
    assert log.latest() == (0, {})
    assert log.publish(1, {"v": "é"}) and not log.publish(1, {"v": "other"})
    assert log.latest() == (1, {"v": "é"}) and log.publish(2, {"v": 2}) and log.latest()[0] == 2
    assert sorted(os.listdir(f"{tmp_path}/log"))[-2:] == ["000000000001.json", "000000000002.json"]
    assert not [n for n in os.listdir(f"{tmp_path}/log") if n.startswith(".") and not n.endswith(".crc")]


def test_appends_open_no_data_file(spark, tmp_path):
    p = f"{tmp_path}/t"
    W.append_evolving(spark.createDataFrame([(1, 1.5)], "a int, f float"), p)
    for f in glob.glob(f"{p}/part-*"):  # unreadable data files do not matter to an append
        os.rename(f, f + ".kept")
    with open(f"{p}/part-00000-broken.parquet", "wb") as out:
        out.write(b"no parquet")
    W.append_evolving(spark.createDataFrame([(1 << 40, "x")], "a long, b string"), p)
    W.append_evolving(spark.createDataFrame([(3,)], "a smallint"), p)
    os.remove(f"{p}/part-00000-broken.parquet")
    for f in glob.glob(f"{p}/*.kept"):
        os.rename(f, f.removesuffix(".kept"))
    got = W.read_evolving(spark, p)
    assert dict(got.dtypes) == {"a": "bigint", "f": "float", "b": "string"}
    assert sorted((r.a, r.f, r.b) for r in got.collect()) == [(1, 1.5, None), (3, None, None), (1 << 40, None, "x")]
    for bad in ("a string", "f int", "b int"):
        with pytest.raises(ValueError, match="column types differ"):
            W.append_evolving(spark.createDataFrame([], bad), p)


def test_schema_of_a_table_without_log(spark, tmp_path):
    p = f"{tmp_path}/old"
    spark.createDataFrame([(1,)], "a int").write.parquet(p)
    assert W.read_evolving(spark, p).columns == ["a"]
    W.append_evolving(spark.createDataFrame([(2, "b")], "a int, b string"), p)
    assert sorted((r.a, r.b) for r in W.read_evolving(spark, p).collect()) == [(1, None), (2, "b")]


def test_rules_that_raise(spark):
    """A check that raises fails its row; a fix that raises or gives a wrong type keeps the value."""
    df = spark.createDataFrame([(1, "10"), (2, "x"), (3, None), (4, "0"), (5, "-7")], "id int, v string")
    rules = [row_rule("ten", "v", lambda v: 10 / int(v) > 0, lambda v: str(abs(int(v))), "warning"),
             row_rule("id", "id", lambda v: v < 5, lambda v: "no int", "error")]
    batch = process_batch(df, rules)
    assert {r.rule: r.failures for r in batch.rule_counts().collect()} == {"ten": 4, "id": 1}
    assert sorted((r.id, r.v) for r in batch.clean.collect()) == [(1, "10"), (2, "x"), (3, None), (4, "0")]
    assert [(r.id, r.v) for r in batch.rejected.collect()] == [(5, "7")]


def test_ties_leave_the_same_row(spark):
    rows = [(1, "t", i, {"k": i}) for i in range(50)]
    df = spark.createDataFrame(rows, "id int, _ingestion_timestamp string, v int, m map<string,int>")
    for n in (1, 7):
        assert dedup_latest(df.repartition(n), ["id"]).first().v == 49


def test_one_per_key_counts_keys(spark):
    df = spark.createDataFrame([(1, "a"), (None, "b")], "id int, v string")
    assert sorted(one_per_key(df, ["id"]).collect(), key=str) == sorted(df.collect(), key=str)
    with pytest.raises(Exception, match="more than one row for a key"):
        one_per_key(df.unionByName(df.filter("id is null")), ["id"]).collect()


def test_stream_upserts_by_key(spark, tmp_path):
    schema = "CustomerID string, CustomerName string, CustomerStatus string, CreatedDate string, RegionCode string, LandedAt string"
    land = f"{tmp_path}/land"

    def arrive(*rows):
        spark.createDataFrame([(i, "N", s, "2024-01-01 00:00:00", r, at) for i, s, r, at in rows], schema).coalesce(1).write.mode("append").parquet(land)
        incremental_upsert(spark, land, spark.read.parquet(land).schema, CUSTOMERS, f"{tmp_path}/t", f"{tmp_path}/q", f"{tmp_path}/ck",
                           ["CustomerID"], "RegionCode", order_by=["CreatedDate", "CustomerStatus"])
        got = W.read_table(spark, f"{tmp_path}/t")
        return sorted((r.CustomerID, r.CustomerStatus, r.RegionCode) for r in got.collect())

    assert arrive(("1", "A", "EU", "1"), ("2", "A", "US", "1"), ("x", "A", "US", "1")) == [(1, "A", "EU"), (2, "A", "US")]
    want = [(1, "B", "EU"), (2, "C", "AP"), (3, "A", "US")]
    assert arrive(("2", "B", "EU", "2"), ("2", "C", "AP", "3"), ("1", "B", "EU", "2"), ("3", "A", "US", "2")) == want
    number, merged = CommitLog(spark, f"{tmp_path}/t/{BATCH_LOG}").latest()
    assert number == 2 and list(merged.values()) == [1]
    assert spark.read.parquet(f"{tmp_path}/q").count() == 1
    # the checkpoint loses its last commit: the batch comes again and is not merged twice
    os.remove(f"{tmp_path}/ck/commits/1")
    for crc in glob.glob(f"{tmp_path}/ck/commits/.1.crc"):
        os.remove(crc)
    assert arrive(("4", "A", "US", "4")) == want + [(4, "A", "US")]


def test_key_differences(spark):
    s = spark.createDataFrame([(1, "a"), (2, "b"), (3, None), (None, "n"), (5, "x"), (5, "y"), (7, "d")], "id int, v string")
    t = spark.createDataFrame([(1, "a"), (2, "B"), (3, ""), (4, "q"), (5, "y"), (5, "x"), (7, "d"), (7, "d")], "id long, v string")
    got = {r.id: r.difference for r in R.key_differences(s, t, "id", ["v"]).collect()}
    assert got == {2: "differs", 3: "differs", 4: "only_target", None: "only_source", 7: "differs"}
    assert {r.id: r.difference for r in R.key_differences(s, t, "id").collect()} == {4: "only_target", None: "only_source", 7: "differs"}
    assert R.key_differences(s, s.repartition(3), "id", ["v"]).count() == 0


def test_equal_tables_shuffle_no_key(spark, tmp_path):
    for name in "st":
        spark.range(20_000).repartition(3 if name == "s" else 5).write.parquet(f"{tmp_path}/{name}")
    s, t = (spark.read.parquet(f"{tmp_path}/{n}") for n in "st")
    df = R.key_differences(s, t, "id")
    assert df.collect() == []
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "hashpartitioning(__key" not in final


def test_row_count_reads_no_lines(spark):
    from lakeshift.registry import queries
    plan = queries()["recon_row_count"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "md5" not in plan and "l_orderkey" not in plan
