"""Incremental refresh of the daily fact: equal to a rebuild, reading and writing the touched days alone."""
import datetime as dt
import glob
import os
from decimal import Decimal

from pyspark.sql import functions as F

from lakeshift.plans import fct_daily_sales, int_order_enriched, stg_customers, stg_orders, stg_products
from lakeshift.plans.refresh import refresh_daily_sales, touched_days
from lakeshift.sinks.write import write_table
from tests.test_gold import CUS, ORD, PRO, T

FIRST = dt.date(2024, 1, 1)


def day(n):
    return None if n is None else FIRST + dt.timedelta(days=n)


def orders(spark, rows):
    """(order, customer, product, day or None, amount, status)"""
    return stg_orders(spark.createDataFrame(
        [(o, c, p, day(n), None, s, Decimal(a), "gbp", 1, "online") for o, c, p, n, a, s in rows], ORD))


def customers(spark, region):
    return stg_customers(spark.createDataFrame(
        [(c, f"c{c}", None, "active", T, None, r, 1) for c, r in region.items()], CUS))


def products(spark, category):
    return stg_products(spark.createDataFrame(
        [(p, f"p{p}", f"x{p}", k, Decimal(10), 1, True, T) for p, k in category.items()], PRO))


BEFORE = [(1, 10, 100, 0, 5, "ok"), (2, 11, 101, 1, 6, "ok"), (3, 12, 100, 2, 7, "ok"), (4, 10, 101, 3, 8, "ok"),
          (5, 11, 100, 4, 9, "ok"), (6, 11, 100, None, 3, "ok"), (7, 13, 102, 5, 4, "ok"), (8, 11, 101, 6, 4, "ok")]


def stored(df, path):
    write_table(df, str(path), "overwrite", partition_by="order_date")
    return df.sparkSession.read.schema(df.schema).parquet(str(path))


def fact(spark, o, c, p):
    return fct_daily_sales(int_order_enriched(o, c, p))


def same(a, b):
    cols = sorted(a.columns)
    return a.select(cols).exceptAll(b.select(cols)).count() == 0 and b.select(cols).exceptAll(a.select(cols)).count() == 0


def ids(spark, name, values):
    return spark.createDataFrame([(v,) for v in values], f"{name} int")


def run(spark, tmp_path, after, changed, region=None, category=None, moved=(), recast=()):
    o0 = orders(spark, BEFORE)
    c0, p0 = customers(spark, {10: "E", 11: "W", 12: "E", 13: "N"}), products(spark, {100: 1, 101: 2, 102: 3})
    o1 = stored(orders(spark, after), tmp_path / "orders")
    c1 = customers(spark, {10: "E", 11: "W", 12: "E", 13: "N"} | (region or {}))
    p1 = products(spark, {100: 1, 101: 2, 102: 3} | (category or {}))
    old = stored(fact(spark, o0, c0, p0), tmp_path / "fact")
    days = touched_days(o0, o1, ids(spark, "order_id", changed), ids(spark, "customer_id", moved), ids(spark, "product_id", recast))
    refresh_daily_sales(spark, str(tmp_path / "fact"), o1, c1, p1, days)
    now = spark.read.schema(old.schema).parquet(str(tmp_path / "fact"))
    assert same(now, fact(spark, orders(spark, after), c1, p1))
    return days, o1, c1, p1


def test_moved_changed_gone_and_new_orders(spark, tmp_path):
    after = [r for r in BEFORE if r[0] not in (1, 2, 3)]
    after += [(1, 10, 100, 4, 5, "ok"), (2, 11, 101, 1, 60, "ok"), (9, 12, 100, 7, 1, "ok")]  # moved, amended, new; 3 gone
    days, *_ = run(spark, tmp_path, after, [1, 2, 3, 9])
    assert {r[0] for r in days.collect()} == {day(n) for n in (0, 1, 2, 4, 7)}
    left = {os.path.basename(p) for p in glob.glob(f"{tmp_path}/fact/order_date=*")}
    assert "order_date=2024-01-01" not in left and "order_date=2024-01-03" not in left  # days without sales go


def test_null_day_and_cancelled_last_order(spark, tmp_path):
    after = [r for r in BEFORE if r[0] not in (6, 7)] + [(6, 11, 100, None, 30, "ok"), (7, 13, 102, 5, 4, "cancelled")]
    days, *_ = run(spark, tmp_path, after, [6, 7])
    assert {r[0] for r in days.collect()} == {None, day(5)}
    assert not glob.glob(f"{tmp_path}/fact/order_date=2024-01-06")


def test_null_day_emptied(spark, tmp_path):
    run(spark, tmp_path, [r for r in BEFORE if r[0] != 6], [6])
    assert not glob.glob(f"{tmp_path}/fact/order_date=__HIVE*")


def test_changed_dimensions(spark, tmp_path):
    days, *_ = run(spark, tmp_path, BEFORE, [], {12: "NEW"}, {102: 9}, moved=[12], recast=[102])
    assert {r[0] for r in days.collect()} == {day(2), day(5)}


def test_nothing_changed_writes_nothing(spark, tmp_path):
    run(spark, tmp_path, BEFORE, [])


def test_rerun_gives_the_same(spark, tmp_path):
    after = [r for r in BEFORE if r[0] != 3] + [(3, 12, 100, 6, 7, "ok")]
    days, o, c, p = run(spark, tmp_path, after, [3])
    refresh_daily_sales(spark, str(tmp_path / "fact"), o, c, p, days)
    assert same(spark.read.schema(fact(spark, o, c, p).schema).parquet(str(tmp_path / "fact")), fact(spark, o, c, p))


def test_reads_and_writes_only_the_touched_days(spark, tmp_path):
    """Files of other days hold junk: a job that opened one would fail; their fact files stay as they are."""
    o0 = orders(spark, BEFORE)
    c, p = customers(spark, {10: "E", 11: "W", 12: "E", 13: "N"}), products(spark, {100: 1, 101: 2, 102: 3})
    o1 = stored(orders(spark, BEFORE), tmp_path / "orders")
    schema = stored(fact(spark, o0, c, p), tmp_path / "fact").schema
    before = {f: os.stat(f).st_mtime_ns for f in glob.glob(f"{tmp_path}/fact/*/*.parquet")}
    for folder in glob.glob(f"{tmp_path}/orders/order_date=*"):
        if not folder.endswith(("2024-01-02", "2024-01-04")):
            with open(f"{folder}/junk.parquet", "wb") as f:
                f.write(b"no parquet file")
    o1 = spark.read.schema(o0.schema).parquet(str(tmp_path / "orders"))
    days = spark.createDataFrame([(day(1),), (day(3),), (day(3),)], "order_date date")
    refresh_daily_sales(spark, str(tmp_path / "fact"), o1, c, p, days)
    same_files = {f for f in glob.glob(f"{tmp_path}/fact/*/*.parquet") if before.get(f) == os.stat(f).st_mtime_ns}
    assert {f for f in before if not ("2024-01-02" in f or "2024-01-04" in f)} == same_files
    assert spark.read.schema(schema).parquet(str(tmp_path / "fact")).agg(F.sum("order_count")).first()[0] == len(BEFORE)
