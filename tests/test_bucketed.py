"""Tables bucketed on the business key: the key-based operators plan without shuffles."""
import uuid

from lakeshift.operators import reconcile as R
from lakeshift.operators.changes import detect_changes
from lakeshift.operators.dedup import dedup_latest
from lakeshift.sinks.write import write_bucketed_table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_bucketed_key_operators_do_not_shuffle(spark):
    prev_bc = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force the large-table plan
    try:
        sfx = uuid.uuid4().hex[:6]
        base = spark.range(20000).selectExpr("cast(id as int) as k", "cast(id % 5 as string) as _record_hash",
                                             "id as v")
        src = write_bucketed_table(base, f"src_{sfx}", ["k"], 8)
        tgt = write_bucketed_table(base.filter("k % 50 <> 0"), f"tgt_{sfx}", ["k"], 8)
        flags = R.value_flags(src, tgt, "k")
        assert "Exchange" not in plan(flags)
        r = R.check_primary_key_completeness(src, tgt, "k", "t").first()
        assert r.missing == 400 and r.status == "FAIL"
        assert "Exchange" not in plan(detect_changes(src, tgt, "k", strategy="group"))
        assert "Exchange" not in plan(dedup_latest(src, ["k"], "v"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev_bc)


def test_bucketed_upsert_group_strategy_does_not_shuffle(spark):
    from lakeshift.sinks.write import upsert
    prev_bc = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        sfx = uuid.uuid4().hex[:6]
        t = write_bucketed_table(spark.range(1000).selectExpr("cast(id as int) as k", "'old' as v"),
                                 f"t_{sfx}", ["k"], 4)
        u = write_bucketed_table(spark.range(990, 1010).selectExpr("cast(id as int) as k", "'new' as v"),
                                 f"u_{sfx}", ["k"], 4)
        m = upsert(t, u, ["k"], strategy="group")
        assert "Exchange" not in plan(m)
        assert m.count() == 1010 and m.filter("v = 'new'").count() == 20
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev_bc)
