import pytest

from lakeshift.operators import reconcile as R
from tests.conftest import rows

DDL = "order_id int, customer_id int, total_amount double, region string"
SRC = [(1, 10, 1000.0, "EAST"), (2, 11, 500.0, "WEST"), (3, 12, 1000.0, "EAST"),
       (4, 13, None, None)]


@pytest.fixture()
def src(spark):
    return spark.createDataFrame(SRC, DDL)


def one(df):
    out = df.collect()
    assert len(out) == 1
    return out[0]


def counts_frames(spark, s, t):
    a = spark.range(s).selectExpr("cast(id as int) as order_id")
    b = spark.range(t).selectExpr("cast(id as int) as order_id")
    return a, b


@pytest.mark.parametrize("s,t,tol,status", [(100, 100, 0.0, "PASS"), (100, 95, 0.0, "FAIL"),
                                            (100, 95, 5.0, "WARN"), (100, 94, 5.0, "FAIL"),
                                            (0, 0, 0.0, "PASS"), (0, 5, 50.0, "FAIL")])
def test_row_count_check(spark, s, t, tol, status):
    a, b = counts_frames(spark, s, t)
    r = one(R.check_row_count(a, b, "orders", tol))
    assert r.status == status and r.check_name == "row_count_orders"
    assert r.source_value == s and r.target_value == t and r.discrepancy == abs(s - t)


def test_row_count_messages(spark):
    a, b = counts_frames(spark, 100, 95)
    assert one(R.check_row_count(a, b, "o", 5.0)).message == (
        "Row count within tolerance: source=100, target=95 (5.0% diff ≤ 5.0% tolerance)")
    assert one(R.check_row_count(a, a, "o")).message == "Row counts match exactly: 100"


@pytest.mark.parametrize("s,t,tol,passed,pct", [(100, 100, 0.0, True, 0.0),
                                                (100, 95, 0.0, False, 5.0),
                                                (100, 95, 5.0, True, 5.0),
                                                (0, 0, 0.0, False, 100.0)])
def test_reconcile_row_counts_simple(spark, s, t, tol, passed, pct):
    a, b = counts_frames(spark, s, t)
    r = one(R.reconcile_row_counts(a, b, tol))
    assert r.passed is passed and r.count_match is passed and r.discrepancy_pct == pct
    assert r.source_count == s and r.target_count == t and r.discrepancy == abs(s - t)


def test_column_sum_null_as_zero(spark, src):
    r = one(R.check_column_sum(src, src, "total_amount", "orders"))
    assert r.status == "PASS" and r.source_value == 2500.0
    assert r.message == "Column SUM matches: total_amount = 2500.0000"


@pytest.mark.parametrize("delta,status", [(0.01, "PASS"), (0.02, "FAIL")])
def test_column_sum_tolerance_edge(spark, delta, status):
    from decimal import Decimal
    a = spark.createDataFrame([(Decimal("10.00"),)], "v decimal(18,2)")
    b = spark.createDataFrame([(Decimal("10.00") + Decimal(str(delta)),)], "v decimal(18,2)")
    assert one(R.check_column_sum(a, b, "v", "t")).status == status


def test_checksums_strict_less_than(spark):
    from decimal import Decimal
    a = spark.createDataFrame([(Decimal("10.00"),), (None,)], "v decimal(18,2)")
    b = spark.createDataFrame([(Decimal("10.01"),)], "v decimal(18,2)")
    r = one(R.reconcile_column_checksums(a, b, ["v"]))
    assert r.passed is False and r.difference == 0.01
    assert r.message == "FAIL: sum mismatch (0.0100 difference)"
    r = one(R.reconcile_column_checksums(a, a, ["v"]))
    assert r.passed is True and r.source_sum == 10.0 and r.message == "PASS"


def test_null_rate(spark, src):
    r = one(R.check_null_rate(src, src, "region", "orders"))
    assert r.status == "PASS" and r.source_value == 25.0 and r.target_value == 25.0


def test_null_rate_more_nulls_fails(spark):
    a = spark.createDataFrame([(1, "E"), (2, "W"), (3, "E"), (4, None)], "order_id int, region string")
    b = spark.createDataFrame([(1, None), (2, None), (3, None), (4, "E")], "order_id int, region string")
    r = one(R.check_null_rate(a, b, "region", "orders"))
    assert r.status == "FAIL" and r.discrepancy == 50.0
    r = one(R.check_null_rate(b, a, "region", "orders"))
    assert r.status == "PASS"


def test_null_rate_warn_and_edge(spark):
    a = spark.createDataFrame([(i, "x") for i in range(20)], "order_id int, region string")
    b = spark.createDataFrame([(0, None)] + [(i, "x") for i in range(1, 20)],
                              "order_id int, region string")
    r = one(R.check_null_rate(a, b, "region", "orders"))
    assert r.status == "WARN" and r.discrepancy == 5.0  # exactly the tolerance


def test_distinct_values(spark, src):
    assert one(R.check_distinct_values(src, src, "region", "orders")).status == "PASS"
    lost = src.filter("region is null or region <> 'WEST'")
    r = one(R.check_distinct_values(src, lost, "region", "orders"))
    assert r.status == "FAIL" and r.missing == 1
    assert r.message == "Lost distinct values in region: ['WEST'] (total=1 missing)"
    more = src.unionByName(src.sparkSession.createDataFrame([(5, 14, 1.0, "NORTH")], DDL))
    r = one(R.check_distinct_values(src, more, "region", "orders"))
    assert r.status == "WARN" and r.extra == 1
    assert r.message == "New distinct values in target region: ['NORTH'] (not in source)"


def test_pk_completeness(spark, src):
    three = src.filter("order_id <= 3")
    r = one(R.check_primary_key_completeness(src, three, "order_id", "orders"))
    assert r.status == "FAIL" and r.missing == 1
    assert r.message == "Missing PKs in target: 1 keys absent. Sample: [4]"
    r = one(R.check_primary_key_completeness(three, src, "order_id", "orders"))
    assert r.status == "PASS" and r.extra == 1
    assert r.message == "All 3 source PKs present in target"


def test_null_keys_excluded(spark):
    a = spark.createDataFrame([(1,), (None,)], "id int")
    b = spark.createDataFrame([(1,)], "id int")
    r = one(R.check_primary_key_completeness(a, b, "id", "t"))
    assert r.status == "PASS" and r.source_value == 1


def test_full_reconciliation_order_and_layer(spark, src):
    rep = R.run_full_reconciliation(src, src, "orders", "order_id", ["total_amount"],
                                    ["region"], ["region"], layer="gold")
    got = [(r.check_name, r.status, r.layer) for r in rep.orderBy("check_order").collect()]
    assert got == [("row_count_orders", "PASS", "gold"),
                   ("pk_completeness_order_id_orders", "PASS", "gold"),
                   ("col_sum_total_amount_orders", "PASS", "gold"),
                   ("null_rate_region_orders", "PASS", "gold"),
                   ("distinct_values_region_orders", "PASS", "gold")]
    s = one(R.report_summary(rep))
    assert s.overall_status == "PASS" and s.summary == (
        "Reconciliation [orders]: 5 PASS / 0 WARN / 0 FAIL — Overall: PASS")


def test_full_reconciliation_skips_pk_on_empty_or_absent(spark, src):
    empty = src.limit(0)
    rep = R.run_full_reconciliation(src, empty, "orders", "order_id")
    assert [r.check_name for r in rep.collect()] == ["row_count_orders"]
    rep = R.run_full_reconciliation(src, src.drop("order_id"), "orders", "order_id")
    assert [r.check_name for r in rep.collect()] == ["row_count_orders"]


def test_summary_worst_status(spark, src):
    rep = R.run_full_reconciliation(src, src.filter("order_id < 4"), "orders", "order_id",
                                    distinct_columns=["region"], row_count_tolerance_pct=50.0)
    s = one(R.report_summary(rep))
    assert (s.passed, s.warned, s.failed, s.overall_status) == (1, 1, 1, "FAIL")


def test_absent_numeric_column_sums_zero(spark, src):
    r = one(R.check_column_sum(src, src.drop("total_amount"), "total_amount", "orders"))
    assert r.status == "FAIL" and r.target_value == 0.0


def test_sum_of_text_column_with_junk(spark):
    a = spark.createDataFrame([("1.5",), ("abc",), (None,)], "v string")
    r = one(R.check_column_sum(a, a, "v", "t"))
    assert r.status == "FAIL" and r.source_value == 1.5 and "2 values" in r.message


def test_all_checks_on_empty_inputs(spark):
    e = spark.createDataFrame([], "v int")
    assert one(R.check_row_count(e, e, "t")).status == "PASS"
    r = one(R.reconcile_row_counts(e, e))
    assert r.passed is False and r.discrepancy_pct == 100.0  # the silver-layer rule
    assert one(R.check_column_sum(e, e, "v", "t")).status == "PASS"
    r = one(R.check_null_rate(e, e, "v", "t"))
    assert r.status == "PASS" and r.source_value == 0.0
    r = one(R.check_distinct_values(e, e, "v", "t"))
    assert r.status == "PASS" and r.message == "Distinct values match: v (0 values)"
    r = one(R.check_primary_key_completeness(e, e, "v", "t"))
    assert r.status == "PASS" and r.message == "All 0 source PKs present in target"
    rep = R.run_full_reconciliation(e, e, "t", "v", ["v"], ["v"], ["v"])
    assert sorted(x.check_name for x in rep.collect()) == [
        "col_sum_v_t", "distinct_values_v_t", "null_rate_v_t", "row_count_t"]
    assert one(R.report_summary(rep)).overall_status == "PASS"


def test_set_check_plan_is_bounded(spark):
    a = spark.range(5000).selectExpr("id as k")
    b = spark.range(10, 5010).selectExpr("id as k")
    df = R.check_primary_key_completeness(a, b, "k", "t")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert plan.count("WindowGroupLimit") >= 2          # top-n per flag, limited map-side
    assert "partial_bit_or" in plan                     # flags combined before the shuffle
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    assert one(df).message == "Missing PKs in target: 10 keys absent. Sample: [0, 1, 2]"


def test_set_checks_compare_mixed_numeric_types_by_value(spark):
    from decimal import Decimal
    a = spark.createDataFrame([(1,), (2,)], "k int")
    b = spark.createDataFrame([(1,), (2,)], "k bigint")
    assert one(R.check_primary_key_completeness(a, b, "k", "t")).status == "PASS"
    c = spark.createDataFrame([(Decimal("1.00"),), (Decimal("2.50"),)], "k decimal(18,2)")
    d = spark.createDataFrame([(Decimal("1"),), (Decimal("3"),)], "k decimal(10,0)")
    r = one(R.check_distinct_values(c, d, "k", "t"))
    assert (r.missing, r.extra, r.status) == (1, 1, "FAIL")
    e = spark.createDataFrame([("x",)], "k string")
    assert one(R.check_distinct_values(e, e.drop("k"), "k", "t")).missing == 1
