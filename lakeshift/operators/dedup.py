"""Latest-version deduplication."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T


def dedup_latest(df: DataFrame, keys: Sequence[str], order_column: str = "_ingestion_timestamp",
                 tie_breakers: Sequence[str] | None = None) -> DataFrame:
    """Keep one row per (composite) key: the greatest ``order_column`` (typed
    comparison, nulls lowest), then the greatest ``tie_breakers`` in order. Without
    tie-breakers all other columns that have an order break ties, by name, so the same row stays
    in every run; name cheap ones where ties can only be between equal rows. Null keys
    form one group of their own.

    Plan: ``row_number() == 1`` lets Spark insert a WindowGroupLimit before the
    exchange, so each map task forwards at most one row per key; a hot key (even a
    third of the table) is cut down map-side instead of landing whole in one task.
    An absent order column counts as empty (lowest) for every row.
    """
    if not keys:
        raise ValueError("dedup_latest needs at least one key column")
    order = F.col(order_column) if order_column in df.columns else F.lit("")
    if tie_breakers is None:
        tie_breakers = sorted(f.name for f in df.schema.fields if f.name not in {*keys, order_column} and _ordered(f.dataType))
    spec = [order.desc_nulls_last()] + [F.col(f"`{c}`").desc_nulls_last() for c in tie_breakers]
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*spec)
    return (df.withColumn("__rn", F.row_number().over(w))
            .filter(F.col("__rn") == 1).drop("__rn"))


def _ordered(kind: T.DataType) -> bool:
    if isinstance(kind, T.StructType):
        return all(_ordered(f.dataType) for f in kind.fields)
    if isinstance(kind, T.ArrayType):
        return _ordered(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType, T.CalendarIntervalType))


def one_per_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """``df`` with one row per key: the latest by ``order_by``, or, without it, ``df`` itself,
    failing the job on a key held twice."""
    if order_by:
        return dedup_latest(df, keys, order_by[0], order_by[1:])
    # keys are counted on their own, combined map-side; the count adds no row, it only fails
    held = df.groupBy(*[F.col(f"`{k}`") for k in keys]).agg(F.count(F.lit(1)).alias("__n"))
    bad = held.filter(F.when(F.col("__n") > 1, duplicate_key(keys)).otherwise(F.lit(False)))
    return df.unionByName(bad.select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in df.schema.fields]))


def duplicate_key(keys: Sequence[str]) -> Column:
    """A boolean that fails the job when it is evaluated."""
    return F.raise_error(F.lit(f"more than one row for a key ({', '.join(keys)}); "
                               "give order columns to keep the latest")).cast("boolean")


def dedup_removed(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows removed, as a one-row frame (two counts, no join)."""
    return (before.select(F.lit(1).alias("s")).unionByName(after.select(F.lit(-1).alias("s")))
            .agg(F.sum("s").cast("bigint").alias("deduplication_removed")))


def duplicates_removed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many rows ``dedup_latest(df, keys, ...)`` removes, without running it: the
    sum over key groups of (rows - 1), null keys forming one group. One aggregation
    with map-side combining; returns a one-row frame."""
    g = df.groupBy(*[F.col(k) for k in keys]).agg(F.count(F.lit(1)).alias("n"))
    return g.agg(F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).cast("bigint")
                 .alias("deduplication_removed"))
