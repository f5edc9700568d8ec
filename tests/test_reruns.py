"""Second runs with changed input: nothing is lost and nothing stale is kept."""
import os

import pytest
from pyspark.sql import functions as F

from lakeshift.operators import reconcile as R
from lakeshift.operators.changes import detect_changes
from lakeshift.operators.quality import not_null_rule, positive_numeric_rule, process_batch, value_in_set_rule
from lakeshift.operators.reconcile import report_summary
from lakeshift.sinks import write as W
from lakeshift.sinks.write import write_table
from lakeshift.sources import extract as X
from lakeshift.sources.extract import land
from lakeshift.spec import CUSTOMERS


def test_two_loads_of_one_day_add_up(spark, tmp_path):
    path = str(tmp_path / "raw")
    land(spark.createDataFrame([(1,), (2,)], "id int"), path, "2024-01-01", load_id="from 0")
    land(spark.createDataFrame([(3,)], "id int"), path, "2024-01-01", load_id="from 2")
    land(spark.createDataFrame([(3,)], "id int"), path, "2024-01-01", load_id="from 2")
    assert sorted(r.id for r in spark.read.parquet(path).collect()) == [1, 2, 3]


def test_split_rerun_drops_old_rejects(spark, tmp_path):
    path = str(tmp_path / "split")
    rules = [not_null_rule("name")]
    process_batch(spark.createDataFrame([("a",), (None,)], "name string"), rules).write_split(path)
    process_batch(spark.createDataFrame([("b",)], "name string"), rules).write_split(path)
    got = spark.read.parquet(path)
    assert [(r.name, r["_dq_status"]) for r in got.collect()] == [("b", "clean")]


def test_replace_table_or_partitions(spark, tmp_path):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "v int, day string")
    new = spark.createDataFrame([(3, "a")], "v int, day string")
    for replace, want in (("partitions", [2, 3]), ("table", [3])):
        path = str(tmp_path / replace)
        write_table(old, path, "overwrite", partition_by="day")
        write_table(new, path, "overwrite", partition_by="day", replace=replace)
        assert sorted(r.v for r in spark.read.parquet(path).collect()) == want


def test_rules_on_nan_blank_and_allowed_null(spark):
    df = spark.createDataFrame([(float("nan"), " ", None), (1.0, "x", "A")], "v double, t string, s string")
    rules = [positive_numeric_rule("v"), not_null_rule("t"), value_in_set_rule("s", ["A", None])]
    counts = process_batch(df, rules).rule_counts()
    by = {r[0]: r[1] for r in counts.select(counts.columns[0], F.col(counts.columns[-1])).collect()}
    assert set(by) >= {"not_null_t", "positive_v"} and not by.get("allowed_values_s")


def test_empty_report_passes(spark):
    empty = spark.createDataFrame([], "table_name string, status string")
    row = report_summary(empty, "t").first()
    assert (row.passed, row.warned, row.failed, row.overall_status) == (0, 0, 0, "PASS")


@pytest.mark.parametrize("strategy", ["join", "group"])
def test_merge_partitions_moved_rows(spark, tmp_path, strategy):
    p = str(tmp_path / strategy)
    W.write_table(spark.createDataFrame([(1, "a", "01"), (2, "b", "02"), (3, "c", "02"), (5, "e", None)],
                                        "id long, v string, reg string"), p, "overwrite", partition_by="reg")
    upd = spark.createDataFrame([(1, "A0", "02", 1, 1), (1, "A", "02", 9, 2), (3, "C", "02", 8, 1),
                                 (5, "E", None, 7, 1), (1 << 40, "n", "03", 6, 1)],
                                "id long, v string, reg string, extra int, seq int")
    for _ in range(2):  # the same merge again changes nothing
        W.merge_partitions(spark, p, upd, ["id"], "reg", strategy=strategy, order_by=["seq"])
        got = W.read_table(spark, p, like=upd, partition_by=["reg"])
        assert sorted(((r.id, r.v, r.reg, r.extra) for r in got.collect()), key=str) == sorted([
            (1, "A", "02", 9), (2, "b", "02", None), (3, "C", "02", 8), (5, "E", None, 7),
            (1 << 40, "n", "03", 6)], key=str)
    assert not os.path.exists(f"{p}/reg=01")


def test_many_touched_partitions_plan(spark):
    target = spark.range(20000).selectExpr("id", "id % 7 as v", "cast(id as string) as p")
    touched = target.select("p").withColumn("__open", F.lit(0))
    assert W._in_partitions(target, touched, ["p"]).count() == 20000


@pytest.mark.parametrize("strategy", ["join", "group"])
def test_duplicate_keys_fail_or_are_settled(spark, strategy):
    t = spark.createDataFrame([(1 << 40, "a")], "id long, v string")
    u = spark.createDataFrame([(1, "x", 1), (1, "y", 2)], "id int, v string, seq int")
    with pytest.raises(Exception, match="more than one row for a key"):
        W.upsert(t, u, ["id"], strategy).collect()
    got = W.upsert(t, u, ["id"], strategy, order_by=["seq"])
    assert sorted((r.id, r.v) for r in got.collect()) == [(1, "y"), (1 << 40, "a")]
    h = u.withColumnRenamed("v", "_record_hash")
    for cur, prev in ((h, h.limit(0)), (h.limit(0), h)):
        with pytest.raises(Exception, match="more than one row for a key"):
            detect_changes(cur, prev, "id", strategy=strategy).collect()


def test_append_refuses_other_types(spark, tmp_path):
    p = str(tmp_path / "evolving")
    W.append_evolving(spark.createDataFrame([(1,)], "a int"), p)
    with pytest.raises(ValueError, match="a: int / string"):
        W.append_evolving(spark.createDataFrame([("x",)], "a string"), p)
    W.append_evolving(spark.createDataFrame([(2, "b")], "a int, b string"), p)
    assert W.read_evolving(spark, p).count() == 2


def test_csv_merge(spark, tmp_path):
    p = str(tmp_path / "csv")
    t = spark.createDataFrame([(1, "a"), (2, "b")], "id int, v string")
    W.write_table(t, p, "overwrite", "csv")
    out = W.write_table(spark.createDataFrame([(2, "B")], "id int, v string"), p, "merge", "csv", keys=["id"])
    got = W.read_table(spark, out, "csv", like=t)
    assert sorted(tuple(r) for r in got.collect()) == [(1, "a"), (2, "B")]


def test_marks_are_stored_and_read(spark, tmp_path):
    rows = [(1, "2024-01-01 00:00:00", None), (2, "2024-01-02 00:00:00", "2024-01-05 00:00:00")]
    schema = "CustomerID long, CreatedDate string, UpdatedDate string"

    def config(rows):
        df = spark.createDataFrame(rows, schema).withColumns(
            {c: F.col(c).cast("timestamp_ntz") for c in ("CreatedDate", "UpdatedDate")})
        return X.SourceConfig(CUSTOMERS, "dataframe", dataframe=df)
    root, marks = str(tmp_path), str(tmp_path / "marks")
    first = X.ingest_suite(spark, [config(rows)], root, "db", "2024-02-01", marks_path=marks).first()
    assert (first.rows_extracted, first.new_watermark) == (2, "2024-01-05 00:00:00")
    rows += [(3, "2024-01-04 00:00:00", None), (4, "2024-01-06 00:00:00", None)]
    second = X.ingest_suite(spark, [config(rows)], root, "db", "2024-02-01", marks_path=marks).first()
    assert (second.previous_watermark, second.rows_extracted, second.new_watermark) == (
        "2024-01-05 00:00:00", 1, "2024-01-06 00:00:00")
    assert spark.read.parquet(f"{root}/raw/db/Customers").count() == 3
    assert X.read_marks(spark, marks) == {"dbo.Customers": "2024-01-06 00:00:00"}


def test_nullable_incremental_columns_are_pushed(spark, tmp_path):
    p = str(tmp_path / "c")
    spark.sql("select timestamp_ntz'2024-01-01' CreatedDate, cast(null as timestamp_ntz) UpdatedDate").write.parquet(p)
    df = X.extract_incremental(spark, X.SourceConfig(CUSTOMERS, "parquet", p), "2023-01-01 00:00:00")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [Or(GreaterThan(UpdatedDate" in plan and df.count() == 1


def test_junk_numbers_fail_the_sum(spark):
    a, b = (spark.createDataFrame([(v,)], "amount string") for v in ("abc", "zzz"))
    assert R.check_column_sum(a, b, "amount", "t").first().status == "FAIL"
    assert not R.reconcile_column_checksums(a, b, ["amount"]).first().passed


def test_set_check_shuffles_values_once(spark, tmp_path):
    for name, n in (("s", 100), ("t", 90)):
        spark.range(n).write.parquet(str(tmp_path / name))
    s, t = (spark.read.parquet(str(tmp_path / n)) for n in "st")
    df = R.check_primary_key_completeness(s, t, "id", "t")
    assert df.collect()[0].missing == 10
    plan = df._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "ReusedExchange" in final and final.count("FileScan parquet") == 2


def test_large_ids(spark):
    from lakeshift.operators.bronze import enforce_schema
    df = spark.createDataFrame([("3000000000", "a", None, "active", "2024-01-01", None, None, None)],
                               ", ".join(f"{c} string" for c in CUSTOMERS.column_names()))
    assert enforce_schema(df, CUSTOMERS).first().CustomerID == 3000000000
