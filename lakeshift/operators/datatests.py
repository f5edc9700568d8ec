"""Data tests over model outputs. Each returns the failing rows (empty = test passes)."""
from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, functions as F


def test_unique(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Key values seen more than once, with their count. Null keys are ignored (SQL
    UNIQUE semantics). Partial aggregation map-side keeps a hot key to one row per
    map task before the shuffle."""
    keys = list(keys)
    nn = F.lit(True)
    for k in keys:
        nn = nn & F.col(k).isNotNull()
    return (df.filter(nn).groupBy(*keys).agg(F.count(F.lit(1)).alias("occurrences"))
            .filter(F.col("occurrences") > 1))


def test_relationships(child: DataFrame, fk: str, parent: DataFrame, pk: str) -> DataFrame:
    """Child rows whose non-null ``fk`` has no parent ``pk`` (orphans). A left anti
    join: AQE broadcasts the parent keys only when their measured size allows, and
    splits a skewed child key otherwise."""
    keys = parent.select(F.col(pk).alias("__pk")).filter(F.col("__pk").isNotNull())
    return (child.filter(F.col(fk).isNotNull())
            .join(keys, F.col(fk) == F.col("__pk"), "left_anti"))


def test_not_null(df: DataFrame, column: str) -> DataFrame:
    return df.filter(F.col(column).isNull())


def test_accepted_values(df: DataFrame, column: str, values: Iterable) -> DataFrame:
    """Rows whose non-null value is outside ``values`` (nulls are the not_null test)."""
    return df.filter(F.col(column).isNotNull() & ~F.col(column).isin(*list(values)))


# keep pytest from collecting these as tests when imported into a test module
for _f in (test_unique, test_relationships, test_not_null, test_accepted_values):
    _f.__test__ = False
