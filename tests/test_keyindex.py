"""Merges through the key index: the rows a plain merge gives, with no file of other partitions opened."""
import glob
import random

import pytest
from pyspark.sql import functions as F

from lakeshift.sinks import keyindex, write as W

SCHEMA = "k long, v long, p string"


def table(spark, tmp_path, rows, schema=SCHEMA):
    path = str(tmp_path / "t")
    W.write_table(spark.createDataFrame(rows, schema), path, "overwrite", partition_by="p")
    return path


def content(spark, path):
    return {tuple(r) for r in W.read_evolving(spark, path).select("k", "v", "p").collect()}


def merge(spark, path, rows, schema=SCHEMA, **more):
    W.merge_partitions(spark, path, spark.createDataFrame(rows, schema), ["k"], "p", indexed=True, **more)


def test_random_merges_equal_a_plain_dictionary(spark, tmp_path):
    rng = random.Random(3)
    parts = ["a", "b", "c", "d", None]
    have = {k: (k, rng.randrange(100), rng.choice(parts)) for k in [None, *range(60)]}
    path = table(spark, tmp_path, list(have.values()))
    for _ in range(3):
        new = {k: (k, rng.randrange(100), rng.choice(parts)) for k in rng.sample([None, *range(80)], 12)}
        merge(spark, path, list(new.values()))
        have |= new
        assert content(spark, path) == set(have.values())


def test_partitions_without_a_key_stay_unread(spark, tmp_path):
    path = table(spark, tmp_path, [(i, i, "abcdefgh"[i // 100]) for i in range(800)])
    merge(spark, path, [(5, -1, "a")])  # builds the index
    for p in "cdefgh":
        with open(f"{path}/p={p}/junk.parquet", "wb") as f:
            f.write(b"no parquet file")
    merge(spark, path, [(6, -2, "a"), (7, -3, "b"), (150, -4, "b"), (9000, -5, "new")])
    got = {tuple(r) for p in ("a", "b", "new") for r in spark.read.parquet(*glob.glob(f"{path}/p={p}/part*")).collect()}
    assert {(6, -2), (7, -3), (150, -4), (9000, -5), (5, -1)} <= got and len(got) == 201


def test_candidates_hold_every_partition_of_a_key_and_few_more(spark, tmp_path):
    rows = spark.range(40_000).select(F.col("id").alias("k"), (F.col("id") % 20).cast("string").alias("p"))
    path = str(tmp_path / "t")
    slices = keyindex.build_key_index(spark, rows, path, ["k"], ["p"], keys_per_slice=500)
    assert slices == 4
    index = keyindex.read_key_index(spark, path)
    assert index.count() == 80
    for asked in ([3], [7, 27, 39_999], list(range(0, 40_000, 400))):
        found = {r[0] for r in keyindex.candidate_partitions(index, spark.createDataFrame([(k,) for k in asked], "k long"), ["k"], ["p"]).collect()}
        assert {str(k % 20) for k in asked} <= found
    strangers = spark.range(10**6, 10**6 + 200).select(F.col("id").alias("k"))
    probes = keyindex.candidate_partitions(index, strangers.filter("k % 20 = 0"), ["k"], ["p"]).count()
    assert probes <= 4  # 10 strangers x 20 partitions


def test_composite_and_null_keys(spark, tmp_path):
    rows = spark.createDataFrame([("x", None, "a"), (None, "x", "b"), (None, None, "c"), ("x", "x", "d")], "k1 string, k2 string, p string")
    keyindex.build_key_index(spark, rows, str(tmp_path / "t"), ["k1", "k2"], ["p"])
    index = keyindex.read_key_index(spark, str(tmp_path / "t"))
    for r in rows.collect():
        one = spark.createDataFrame([(r.k1, r.k2)], "k1 string, k2 string")
        assert {x[0] for x in keyindex.candidate_partitions(index, one, ["k1", "k2"], ["p"]).collect()} == {r.p}


def test_a_merge_that_died_is_mended_by_the_same_merge(spark, tmp_path, monkeypatch):
    path = table(spark, tmp_path, [(1, 1, "a"), (2, 2, "b"), (3, 3, "c")])
    merge(spark, path, [(1, 10, "a")])
    with monkeypatch.context() as m:
        m.setattr(W, "write_table", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("died")))
        with pytest.raises(RuntimeError):
            merge(spark, path, [(2, 20, "c"), (4, 40, "d")])
    merge(spark, path, [(2, 20, "c"), (4, 40, "d")])
    assert content(spark, path) == {(1, 10, "a"), (2, 20, "c"), (3, 3, "c"), (4, 40, "d")}
    merge(spark, path, [(2, 21, "a")])  # the old version is found where the last merge put it
    assert content(spark, path) == {(1, 10, "a"), (2, 21, "a"), (3, 3, "c"), (4, 40, "d")}


def test_new_columns_and_several_updates_of_a_key(spark, tmp_path):
    path = table(spark, tmp_path, [(1, 1, "01"), (2, 2, "02")])
    merge(spark, path, [(2, 5, "01", 1), (2, 6, "01", 2)], SCHEMA + ", seq int", order_by=["seq"])
    got = {tuple(r) for r in W.read_evolving(spark, path).select("k", "v", "p", "seq").collect()}
    assert got == {(1, 1, "01", None), (2, 6, "01", 2)} and not glob.glob(f"{path}/p=02")


def test_empty_updates_and_refusals(spark, tmp_path):
    path = table(spark, tmp_path, [(1, 1, "a")])
    merge(spark, path, [])
    assert content(spark, path) == {(1, 1, "a")}
    with pytest.raises(ValueError):
        W.merge_partitions(spark, path, spark.createDataFrame([(1, 1, "a")], SCHEMA), ["k"], "p", "csv", indexed=True)
    with pytest.raises(ValueError):
        keyindex.build_key_index(spark, spark.createDataFrame([(1.0, "a")], "k double, p string"), path, ["k"], ["p"])
