from pyspark.sql import functions as F

from lakeshift.operators.changes import change_counts, detect_changes
from lakeshift.operators.dedup import dedup_latest, dedup_removed
from lakeshift.sinks.write import apply_changes
from tests.conftest import rows

DDL = "order_id int, amount int, _ingestion_timestamp string"


def test_dedup_exact_duplicate(spark):
    df = spark.createDataFrame([(1, 100, "2024-01-01"), (1, 100, "2024-01-01"),
                                (2, 200, "2024-01-01")], DDL)
    assert dedup_latest(df, ["order_id"]).count() == 2


def test_dedup_keeps_latest(spark):
    df = spark.createDataFrame([(1, 100, "2024-01-01"), (1, 150, "2024-01-02")], DDL)
    out = dedup_latest(df, ["order_id"]).collect()
    assert len(out) == 1 and out[0].amount == 150


def test_dedup_composite_key(spark):
    df = spark.createDataFrame([(1, 10, 1, "2024-01-01"), (1, 10, 2, "2024-01-02"),
                                (1, 20, 1, "2024-01-01")],
                               "customer_id int, product_id int, qty int, _ingestion_timestamp string")
    assert dedup_latest(df, ["customer_id", "product_id"]).count() == 2


def test_dedup_no_duplicates_unchanged(spark):
    df = spark.createDataFrame([(i, i, "2024-01-01") for i in range(3)], DDL)
    assert dedup_latest(df, ["order_id"]).count() == 3


def test_dedup_null_key_is_one_group_and_null_order_lowest(spark):
    df = spark.createDataFrame([(None, 1, "2024-01-01"), (None, 2, None),
                                (5, 3, None), (5, 4, "2023-01-01")], DDL)
    got = rows(dedup_latest(df, ["order_id"]), "order_id", "amount")
    assert got == [{"order_id": 5, "amount": 4}, {"order_id": None, "amount": 1}]


def test_dedup_tie_breakers_are_deterministic(spark):
    df = spark.createDataFrame([(1, 10, "2024-01-01"), (1, 30, "2024-01-01"),
                                (1, 20, "2024-01-01")], DDL)
    assert dedup_latest(df, ["order_id"], tie_breakers=["amount"]).first().amount == 30


def test_dedup_removed(spark):
    df = spark.createDataFrame([(1, 100, "a"), (1, 150, "b")], DDL)
    assert dedup_removed(df, dedup_latest(df, ["order_id"])).first()[0] == 1


def test_dedup_plan_limits_before_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = dedup_latest(df, ["k"], "v")._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


SNAP = "id int, name string, _record_hash string"


def test_detect_changes_all_kinds(spark):
    prev = spark.createDataFrame([(1, "a", "h1"), (2, "b", "h2"), (3, "c", "h3"),
                                  (None, "n", "hn")], SNAP)
    cur = spark.createDataFrame([(1, "a", "h1"), (2, "B", "h2x"), (4, "d", "h4"),
                                 (None, "n", "hn")], SNAP)
    got = {(r["id"], r["_change_type"], r["_is_deleted"])
           for r in rows(detect_changes(cur, prev, "id"))}
    assert got == {(1, "unchanged", False), (2, "updated", False), (4, "new", False),
                   (3, "deleted", True), (None, "unchanged", False)}
    counts = {r["_change_type"]: r["records"] for r in rows(change_counts(detect_changes(cur, prev, "id")))}
    assert counts == {"unchanged": 2, "updated": 1, "new": 1, "deleted": 1}


def test_updated_emits_current_row_and_null_hashes_equal(spark):
    prev = spark.createDataFrame([(1, "old", "h"), (2, "x", None)], SNAP)
    cur = spark.createDataFrame([(1, "new", "h2"), (2, "x", None)], SNAP)
    got = {r["id"]: r for r in rows(detect_changes(cur, prev, "id"))}
    assert got[1]["name"] == "new" and got[1]["_change_type"] == "updated"
    assert got[2]["_change_type"] == "unchanged"


def test_detect_changes_dedups_when_order_given(spark):
    prev = spark.createDataFrame([(1, "a", "h1", 1)], SNAP + ", v int")
    cur = spark.createDataFrame([(1, "a", "h1", 1), (1, "b", "h2", 2)], SNAP + ", v int")
    out = detect_changes(cur, prev, "id", order_column="v").collect()
    assert len(out) == 1 and out[0]._change_type == "updated" and out[0].name == "b"


def test_apply_changes_soft_deletes(spark):
    prev = spark.createDataFrame([(1, "a", "h1", False), (2, "b", "h2", False)],
                                 SNAP + ", _is_deleted boolean")
    cur = spark.createDataFrame([(1, "A", "h1x", False), (3, "c", "h3", False)],
                                SNAP + ", _is_deleted boolean")
    merged = {r["id"]: r for r in rows(apply_changes(prev, detect_changes(cur, prev, "id"), ["id"]))}
    assert merged[1]["name"] == "A" and merged[2]["_is_deleted"] is True
    assert merged[3]["name"] == "c" and len(merged) == 3


def test_duplicates_removed_matches_dedup(spark):
    from lakeshift.operators.dedup import duplicates_removed
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b"), (None, 3, "c"), (None, 4, "d"),
                                (2, 5, "e")], DDL)
    assert duplicates_removed(df, ["order_id"]).first()[0] == 2
    assert dedup_removed(df, dedup_latest(df, ["order_id"])).first()[0] == 2
    assert duplicates_removed(df.limit(0), ["order_id"]).first()[0] == 0


def test_group_strategy_equals_join_strategy(spark):
    prev = spark.createDataFrame([(1, "a", "h1", False), (2, "b", "h2", False), (3, "c", "h3", False),
                                  (None, "n", "hn", False)], SNAP + ", _is_deleted boolean")
    cur = spark.createDataFrame([(1, "a", "h1", False), (2, "B", "h2x", False), (4, "d", "h4", False),
                                 (None, "n", "hn", False)], SNAP + ", _is_deleted boolean")
    a = rows(detect_changes(cur, prev, "id", strategy="join"))
    b = rows(detect_changes(cur, prev, "id", strategy="group"))
    assert a == b and len(a) == 5
