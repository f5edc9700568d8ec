from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeshift.operators import quality as Q
from tests.conftest import rows


def check(spark, rule, values, ddl="v string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, {ddl}")
    out = Q.check_rule(df, rule).orderBy("i").collect()
    return [r.passed for r in out], [r.v for r in out]


def test_rule_name_and_column():
    r = Q.not_null_rule("customer_name")
    assert r.name == "not_null_customer_name" and r.column == "customer_name"
    assert r.severity == "error"
    assert Q.positive_numeric_rule("a").name == "positive_a"
    assert Q.max_length_rule("a", 3).name == "max_length_a"
    assert Q.value_in_set_rule("a", {"X"}).name == "allowed_values_a"
    assert Q.date_not_future_rule("a").name == "not_future_a"


def test_invalid_severity():
    with pytest.raises(ValueError):
        Q.DQRule("x", "c", lambda c: c.isNotNull(), severity="fatal")


def test_not_null(spark):
    passed, _ = check(spark, Q.not_null_rule("v"), ["value", None, "", "  ", "\t\n"])
    assert passed == [True, False, False, False, False]


def test_positive_numeric_and_fix(spark):
    passed, fixed = check(spark, Q.positive_numeric_rule("v"),
                          [100.0, -50.0, 0.0, None], "v double")
    assert passed == [True, False, False, False]
    assert fixed == [100.0, 50.0, 0.0, 0.0]


def test_positive_numeric_text(spark):
    passed, fixed = check(spark, Q.positive_numeric_rule("v"), ["12", "-3.5", "abc", None])
    assert passed == [True, False, False, False]
    assert fixed == ["12", "3.5", "abc", "0.0"]


def test_positive_keeps_decimal_type(spark):
    df = spark.createDataFrame([(Decimal("-5.25"),)], "v decimal(18,2)")
    out = Q.check_rule(df, Q.positive_numeric_rule("v"))
    assert dict(out.dtypes)["v"] == "decimal(18,2)" and out.first().v == Decimal("5.25")


def test_max_length(spark):
    passed, fixed = check(spark, Q.max_length_rule("v", 5),
                          ["Short", "Very Long Name", None])
    assert passed == [True, False, True]
    assert fixed == ["Short", "Very ", None]


def test_value_in_set(spark):
    passed, _ = check(spark, Q.value_in_set_rule("v", {"ACTIVE", "INACTIVE"}),
                      ["ACTIVE", "UNKNOWN", None])
    assert passed == [True, False, False]


def test_date_not_future_text_and_typed(spark):
    passed, _ = check(spark, Q.date_not_future_rule("v"),
                      ["2020-01-01T00:00:00", "2099-12-31T00:00:00", None])
    assert passed == [True, False, True]
    df = spark.createDataFrame([(0, "2020-01-01"), (1, "2099-12-31")], "i int, v string") \
        .withColumn("v", F.col("v").cast("date"))
    out = Q.check_rule(df, Q.date_not_future_rule("v")).orderBy("i").collect()
    assert [r.passed for r in out] == [True, False]
    pinned = Q.date_not_future_rule("v", now="2019-06-01T00:00:00")
    out = Q.check_rule(df, pinned).orderBy("i").collect()
    assert [r.passed for r in out] == [False, False]


def test_custom_rule_null_result_fails(spark):
    rule = Q.DQRule("pos", "v", lambda c: c > 0, lambda c: F.lit(100.0), severity="warning")
    passed, fixed = check(spark, rule, [5.0, -1.0, None], "v double")
    assert passed == [True, False, False]
    assert fixed == [5.0, 100.0, 100.0]


def test_rules_chain_on_same_column(spark):
    """A later rule sees the fixed value; passed is the verdict before the fix."""
    rules = [Q.DQRule("std", "s", lambda c: c == F.upper(F.trim(c)), lambda c: F.upper(F.trim(c)),
                      severity="warning"),
             Q.value_in_set_rule("s", {"ACTIVE"})]
    df = spark.createDataFrame([(1, " active ")], "id int, s string")
    b = Q.process_batch(df, rules)
    res = rows(b.results("id"))
    assert [(r["rule"], r["passed"], r["value"]) for r in res] == [
        ("allowed_values_s", True, "ACTIVE"), ("std", False, " active ")]
    assert b.clean.first().s == "ACTIVE"


ORDERS = [(1, 100.0, "COMPLETED"), (2, -50.0, "PENDING"), (3, 10.0, "BOGUS"), (4, None, None)]
ORDER_DDL = "order_id int, total_amount double, order_status string"
RULES = [Q.positive_numeric_rule("total_amount"),
         Q.value_in_set_rule("order_status", {"COMPLETED", "PENDING"}),
         Q.not_null_rule("order_status")]


def test_process_batch_split(spark):
    b = Q.process_batch(spark.createDataFrame(ORDERS, ORDER_DDL), RULES)
    clean = rows(b.clean)
    assert [r["order_id"] for r in clean] == [1, 2]
    assert clean[1]["total_amount"] == 50.0  # warning fixed, row kept
    rej = rows(b.rejected)
    assert [r["order_id"] for r in rej] == [3, 4]
    e4 = [e.asDict() for e in rej[1]["_dq_errors"]]
    assert e4 == [{"rule": "allowed_values_order_status", "column": "order_status", "value": "None"},
                  {"rule": "not_null_order_status", "column": "order_status", "value": "None"}]
    assert rej[1]["total_amount"] == 0.0  # rejected rows carry the transformed record


def test_rule_counts_all_severities_only_failures(spark):
    b = Q.process_batch(spark.createDataFrame(ORDERS, ORDER_DDL),
                        RULES + [Q.max_length_rule("order_status", 50)])
    got = {r["rule"]: r["failures"] for r in rows(b.rule_counts())}
    assert got == {"positive_total_amount": 2, "allowed_values_order_status": 2,
                   "not_null_order_status": 1}


def test_error_rule_with_fix_still_rejects(spark):
    rule = Q.DQRule("fixable", "v", lambda c: c > 0, lambda c: F.lit(1.0), severity="error")
    b = Q.process_batch(spark.createDataFrame([(1, -1.0)], "i int, v double"), [rule])
    assert b.clean.count() == 0 and b.rejected.first().v == 1.0


def test_fix_on_absent_column_creates_it(spark):
    rule = Q.DQRule("fill", "newcol", lambda c: c.isNotNull(), lambda c: F.lit("x"),
                    severity="warning")
    b = Q.process_batch(spark.createDataFrame([(1,)], "i int"), [rule])
    assert b.clean.first().newcol == "x"


@pytest.mark.parametrize("clean,rej,removed,rate,passed", [(10, 0, 5, 0.0, True),
                                                           (8, 2, 0, 20.0, False),
                                                           (0, 0, 0, 0.0, True)])
def test_silver_stats(spark, clean, rej, removed, rate, passed):
    c = spark.createDataFrame([(clean, rej)], "clean_records long, rejected_records long")
    s = Q.silver_stats(c, removed).first()
    assert s.input_records == clean + rej and s.deduplication_removed == removed
    assert s.rejection_rate_pct == rate and s.passed is passed


def test_value_in_set_text_column_numeric_values(spark):
    passed, _ = check(spark, Q.value_in_set_rule("v", {1, 2}), ["1", "abc", None])
    assert passed == [True, False, False]


def test_write_split_one_pass(spark, tmp_path):
    import os
    b = Q.process_batch(spark.createDataFrame(ORDERS, ORDER_DDL), RULES)
    p = str(tmp_path / "split")
    m = b.write_split(p)
    assert m == {"input_records": 4, "rejected_records": 2, "clean_records": 2,
                 "rule_failures": {"positive_total_amount": 2,
                                   "allowed_values_order_status": 2,
                                   "not_null_order_status": 1}}
    assert sorted(x for x in os.listdir(p) if x.startswith("_dq")) == [
        "_dq_status=clean", "_dq_status=rejected"]
    back = spark.read.parquet(p)
    assert back.filter("_dq_status = 'rejected'").count() == 2
    assert back.filter("_dq_status = 'clean' and _dq_errors is null").count() == 2
