"""Key ranges of equal row shares: every row in one range, under skew, nulls and rows that came later."""
import random

import pytest
from pyspark.sql import functions as F

from lakeshift.sources.extract import SourceConfig, read_source
from lakeshift.sources.ranges import RANGE, key_ranges, with_range
from lakeshift.spec import ORDERS


def held(df, ranges):
    """How many ranges hold each row."""
    hits = sum((F.coalesce(F.expr(p), F.lit(False)).cast("int") for p in ranges), F.lit(0))
    return {r[0] for r in df.select(hits).distinct().collect()}


def shares(df, ranges):
    return {r[0]: r[1] for r in with_range(df, ranges).groupBy(RANGE).count().collect()}


def skewed(spark, n=6000):
    rng = random.Random(5)
    rows = [(i, None if i % 20 == 0 else 7 if i % 3 == 0 else 8 if i % 7 == 0 else int(rng.paretovariate(0.3)) % 10**9) for i in range(n)]
    return spark.createDataFrame(rows, "id long, k long")


def test_even_under_skew(spark):
    df = skewed(spark)
    ranges = key_ranges(df, "k", 10, tie="id")
    assert held(df, ranges) == {1}
    nulls = df.filter("k is null").count()
    sizes = shares(df, ranges)
    assert sum(sizes.values()) == 6000 and sizes[len(ranges) - 1] == nulls
    assert max(n for r, n in sizes.items() if r != len(ranges) - 1) <= 1.5 * 6000 / 10


def test_hot_value_stays_whole_without_a_second_column(spark):
    df = skewed(spark)
    ranges = key_ranges(df, "k", 10)
    assert held(df, ranges) == {1} and "`k` = 7" in ranges


def test_later_rows_have_a_range(spark):
    ranges = key_ranges(skewed(spark), "k", 10, tie="id")
    later = spark.createDataFrame([(None, 7), (-5, 7), (10**12, 7), (None, None), (1, -10**15), (1, 10**15), (2, 8), (3, 9)], "id long, k long")
    assert held(later, ranges) == {1}


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "decimal(18,2)", "double", "int"])
def test_kinds_of_keys(spark, kind):
    base = spark.range(1000)
    at = F.timestamp_seconds(F.lit(1_600_000_000) + F.col("id") * 50_000)
    key = at.cast(kind) if kind[:4] in ("date", "time") else (F.col("id") / 7).cast(kind)
    df = base.select("id", key.alias("k"))
    ranges = key_ranges(df, "k", 8, tie="id")
    assert held(df, ranges) == {1}
    assert max(shares(df, ranges).values()) <= 1000 / 8 * 1.5


def test_small_tables(spark):
    none = spark.createDataFrame([], "id long, k long")
    some = spark.createDataFrame([(1, None), (2, 5)], "id long, k long")
    assert held(some, key_ranges(none, "k", 4)) == {1}
    assert held(some, key_ranges(some.filter("k is null"), "k", 4, tie="id")) == {1}
    assert held(some, key_ranges(some, "k", 1)) == {1} and held(some, key_ranges(some, "k", 9, tie="id")) == {1}
    same = spark.createDataFrame([(i, 3) for i in range(40)], "id long, k long")
    assert max(shares(same, key_ranges(same, "k", 4, tie="id")).values()) <= 15
    tied = spark.createDataFrame([(None, 3)] * 5 + [(1, 3)] * 30, "id long, k long")
    assert held(tied, key_ranges(tied, "k", 4, tie="id")) == {1}


def test_refused(spark):
    with pytest.raises(ValueError):
        key_ranges(spark.range(3), "id", 0)
    with pytest.raises(ValueError):
        key_ranges(spark.createDataFrame([(float("nan"),)] * 9, "k double"), "k", 3)


def test_pushed_to_the_scan(spark, tmp_path):
    skewed(spark).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    plan = df.filter(F.expr(key_ranges(df, "k", 10)[1])).select("id")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(k)" in plan


def test_jdbc_takes_one_connection_a_range(spark, monkeypatch):
    """The reader is replaced: no database may be started here."""
    seen = {}
    monkeypatch.setattr(type(spark.read), "jdbc", lambda self, url, table, **kw: seen.update(url=url, table=table, **kw))
    ranges = key_ranges(spark.range(100).withColumnRenamed("id", "OrderID"), "OrderID", 4, quote='"')
    read_source(spark, SourceConfig(ORDERS, "jdbc", "jdbc:x", {"fetchsize": 1000}, ranges=ranges))
    assert seen["predicates"] == ranges and len(ranges) == 5 and seen["properties"] == {"fetchsize": "1000"}
    assert ranges[0] == f'"OrderID" < {ranges[1].split(" ")[2]}'
