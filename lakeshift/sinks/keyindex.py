"""A key index of a partitioned table: per partition, Bloom bits of the keys it holds.

A merge asks it for the partitions that can hold an old version of an updated row, and then reads
the keys of those alone. The index is a small Parquet table beside the data (in a folder that readers
of the table skip): rows of (partition values, slice, bits). A key falls into one of ``slices`` slices by its
hash and sets ``PROBES`` of the 32,768 bits there; with ``KEYS_PER_SLICE`` keys a slice that is 16 bits a
key, and about one probe in 400 meets a partition that does not hold the key.

Bits are only ever added, before the rows are written. So a run that dies leaves an index that covers
the table, in whichever state, and two entries for a partition and slice mean the union of both.
Keys that left a partition stay in its bits: that costs reading, never rows. ``build_key_index`` starts anew.
An indexed table must be written by indexed merges only; rows appended past the index are not found.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.errors import AnalysisException

KEY_INDEX = "_key_index"
PROBES = 4
KEYS_PER_SLICE = 2048
_BITS = 15  # a bitmap of Spark's holds 2 ** 15 bits


def index_path(table: str) -> str:
    return f"{table.rstrip('/')}/{KEY_INDEX}"


def _hash(keys: Sequence[str]) -> Column:
    """64 bits of the key; a null counts as a value of its own."""
    return F.xxhash64(*[x for k in keys for x in (F.col(f"`{k}`"), F.col(f"`{k}`").isNull())])


def _spots(h: Column) -> Column:
    """The bits that a key sets in its slice."""
    again = F.xxhash64(h, F.lit(1))
    return F.array(*[F.shiftright(again, _BITS * i).bitwiseAND((1 << _BITS) - 1) for i in range(PROBES)])


def _names(parts: Sequence[str]) -> list[str]:
    return [f"p{i}" for i in range(len(parts))]


def _entries(rows: DataFrame, keys: Sequence[str], parts: Sequence[str], slices: int) -> DataFrame:
    """One row per partition and slice: bits are combined map-side."""
    h = rows.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(parts, _names(parts))], _hash(keys).alias("h"))
    spots = h.select(*_names(parts), F.pmod("h", F.lit(slices)).cast("int").alias("slice"), F.explode(_spots(F.col("h"))).alias("spot"))
    return (spots.groupBy(*_names(parts), "slice").agg(F.bitmap_construct_agg("spot").alias("bits"))
            .withColumn("slices", F.lit(slices)))


def build_key_index(spark: SparkSession, table: DataFrame, path: str, keys: Sequence[str],
                    parts: Sequence[str], keys_per_slice: int = KEYS_PER_SLICE) -> int:
    """Index the rows of ``table``, stored at ``path``; returns the number of slices, from its largest
    partition. Reads the partition columns (to count) and then the keys, once each. Keys that are
    floating point numbers are refused: equal ones (0.0 and -0.0) can differ in their hash."""
    if any(table.schema[k].dataType.typeName() in ("float", "double") for k in keys):
        raise ValueError("a key index needs keys that are no floating point numbers")
    largest = table.groupBy(*parts).count().agg(F.max("count")).first()[0] or 0
    slices = max(1, -(-largest // keys_per_slice))
    _entries(table, keys, parts, slices).write.mode("overwrite").parquet(index_path(path))
    return slices


def read_key_index(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(index_path(path))
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return None


def add_keys(spark: SparkSession, path: str, rows: DataFrame, keys: Sequence[str], parts: Sequence[str]) -> None:
    """Make the index cover ``rows`` too; to be called before they are written."""
    slices = _slices(read_key_index(spark, path))
    _entries(rows, keys, parts, slices).write.mode("append").parquet(index_path(path))


def _slices(index: DataFrame) -> int:
    return index.agg(F.max("slices")).first()[0] or 1


def candidate_partitions(index: DataFrame, rows: DataFrame, keys: Sequence[str], parts: Sequence[str]) -> DataFrame:
    """Distinct partitions that may hold one of the keys of ``rows``: an equi-join by slice, a test of the bits of
    each key there, combined map-side. Its work is keys x partitions of bit tests, its reading the index."""
    probes = rows.select(_hash(keys).alias("h")).distinct().select(
        F.pmod("h", F.lit(_slices(index))).cast("int").alias("slice"), _spots(F.col("h")).alias("spots"))
    # bits of a partition and slice may stand in several entries
    whole = index.groupBy(*_names(parts), "slice").agg(F.bitmap_or_agg("bits").alias("bits"))
    return (whole.join(probes, "slice").filter(_all_set(F.col("bits"), F.col("spots")))
            .select(*[F.col(n).alias(c) for n, c in zip(_names(parts), parts)]).distinct())


def _all_set(bits: Column, spots: Column) -> Column:
    out = F.lit(True)
    for i in range(PROBES):
        spot = F.get(spots, F.lit(i))
        byte = F.conv(F.hex(F.substring(bits, (F.shiftright(spot, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
        at = F.element_at(F.array(*[F.lit(1 << b) for b in range(8)]), (spot.bitwiseAND(7) + 1).cast("int"))
        out = out & (byte.bitwiseAND(at) != 0)
    return out
