"""Snapshot change detection (new / updated / deleted / unchanged)."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from lakeshift.operators.dedup import dedup_latest, duplicate_key

NEW, UPDATED, DELETED, UNCHANGED = "new", "updated", "deleted", "unchanged"
CHANGE_TYPE = "_change_type"


def detect_changes(current: DataFrame, previous: DataFrame, key: str,
                   hash_column: str = "_record_hash",
                   order_column: str | None = None, tie_breakers=(),
                   strategy: str = "join") -> DataFrame:
    """Compare two snapshots on ``key`` (a null key matches a null key).

    new       key only in current          -> current row
    updated   both, hashes differ          -> current row
    unchanged both, hashes equal (or both null) -> current row
    deleted   key only in previous         -> previous row with ``_is_deleted`` true

    Each snapshot must hold one row per key: a key held twice fails the job, by either
    strategy; pass ``order_column`` to keep the latest version per key first.

    ``strategy="join"`` (default): one null-safe full outer sort-merge join, each side
    shuffled once on the key, the output row taken whole from one side.
    ``strategy="group"``: union both sides tagged by side and group by the key (null
    keys group together, so no key rewrite). Use it for tables bucketed by the key:
    the union keeps the bucket partitioning and the comparison runs with no shuffle at
    all, whereas a null-safe join rewrites its keys and shuffles anyway.
    """
    if strategy not in ("join", "group"):
        raise ValueError("strategy must be 'join' or 'group'")
    if order_column is not None:
        current = dedup_latest(current, [key], order_column, tie_breakers)
        previous = dedup_latest(previous, [key], order_column, tie_breakers)
    if strategy == "group":
        return _changes_by_group(current, previous, key, hash_column)
    return _changes_by_join(current, previous, key, hash_column)


def _kind(in_cur: Column, in_prev: Column, cur_hash: Column, prev_hash: Column) -> Column:
    return (F.when(in_cur & ~in_prev, F.lit(NEW))
            .when(~in_cur & in_prev, F.lit(DELETED))
            .when(~cur_hash.eqNullSafe(prev_hash), F.lit(UPDATED))
            .otherwise(F.lit(UNCHANGED)))


def _changes_by_join(current: DataFrame, previous: DataFrame, key: str,
                     hash_column: str) -> DataFrame:
    cols = list(current.columns)
    if "_is_deleted" not in cols:
        cols.append("_is_deleted")
    cur = current.select(*[F.col(f"`{c}`").alias(f"c__{c}") for c in current.columns],
                         F.lit(True).alias("c__present"))
    prev = previous.select(*[F.col(f"`{c}`").alias(f"p__{c}") for c in previous.columns],
                           F.lit(True).alias("p__present"))
    # A struct key is never null, so null keys meet under plain equality and the check for
    # duplicates uses the join's own exchange and sort.
    cur, prev = _unique(cur, f"c__{key}", "c__on", key), _unique(prev, f"p__{key}", "p__on", key)
    j = cur.join(prev, F.col("c__on") == F.col("p__on"), "full_outer")
    in_cur = F.col("c__present").isNotNull()
    in_prev = F.col("p__present").isNotNull()
    kind = _kind(in_cur, in_prev, F.col(f"c__{hash_column}"), F.col(f"p__{hash_column}"))

    def pick(c: str):
        cv = F.col(f"c__{c}") if c in current.columns else F.lit(None)
        pv = F.col(f"p__{c}") if c in previous.columns else F.lit(None)
        if c == "_is_deleted":
            return F.when(in_cur, F.coalesce(cv, F.lit(False))).otherwise(F.lit(True)).alias(c)
        return F.when(in_cur, cv).otherwise(pv).alias(c)

    return j.select(*[pick(c) for c in cols], kind.alias(CHANGE_TYPE))


def _unique(df: DataFrame, column: str, on: str, key: str) -> DataFrame:
    n = F.count(F.lit(1)).over(Window.partitionBy(on))
    return (df.withColumn(on, F.struct(F.col(f"`{column}`").alias("k"))).withColumn("__n", n)
            .filter(F.when(F.col("__n") > 1, duplicate_key([key])).otherwise(F.lit(True))).drop("__n"))


def _changes_by_group(current: DataFrame, previous: DataFrame, key: str,
                      hash_column: str) -> DataFrame:
    types = dict(current.dtypes)
    cols = [c for c in current.columns if c != "_is_deleted"]
    has_flag = "_is_deleted" in current.columns

    def side(df: DataFrame, tag: int) -> DataFrame:
        fields = [(F.col(f"`{c}`") if c in df.columns else F.lit(None)).cast(types[c]).alias(c)
                  for c in cols]
        if has_flag:
            fields.append((F.col("_is_deleted") if "_is_deleted" in df.columns
                           else F.lit(None)).cast("boolean").alias("_is_deleted"))
        return df.select(F.col(f"`{key}`").cast(types[key]).alias("__k"),
                         F.lit(tag).alias("__side"), F.struct(*fields).alias("__row"))

    g = (side(current, 1).unionByName(side(previous, 2)).groupBy("__k")
         .agg(F.bit_or("__side").alias("__present"),
              F.greatest(F.count_if(F.col("__side") == 1), F.count_if(F.col("__side") == 2)).alias("__n"),
              F.first(F.when(F.col("__side") == 1, F.col("__row")), ignorenulls=True).alias("__cur"),
              F.first(F.when(F.col("__side") == 2, F.col("__row")), ignorenulls=True).alias("__prev"))
         .filter(F.when(F.col("__n") > 1, duplicate_key([key])).otherwise(F.lit(True))))
    in_cur = (F.col("__present") % 2) == 1
    in_prev = F.col("__present") >= 2
    kind = _kind(in_cur, in_prev, F.col(f"__cur.`{hash_column}`"), F.col(f"__prev.`{hash_column}`"))
    row = F.when(in_cur, F.col("__cur")).otherwise(F.col("__prev"))
    deleted_flag = F.col("__row._is_deleted") if has_flag else F.lit(None).cast("boolean")
    return (g.select(row.alias("__row"), in_cur.alias("__in_cur"), kind.alias(CHANGE_TYPE))
            .select(*[F.col(f"__row.`{c}`").alias(c) for c in cols],
                    F.when(F.col("__in_cur"), F.coalesce(deleted_flag, F.lit(False)))
                     .otherwise(F.lit(True)).alias("_is_deleted"),
                    CHANGE_TYPE))


def change_counts(changes: DataFrame) -> DataFrame:
    return changes.groupBy(CHANGE_TYPE).agg(F.count(F.lit(1)).alias("records"))


def split_changes(changes: DataFrame) -> dict[str, DataFrame]:
    """The four change sets as separate (lazy) frames."""
    return {k: changes.filter(F.col(CHANGE_TYPE) == k).drop(CHANGE_TYPE)
            for k in (NEW, UPDATED, DELETED, UNCHANGED)}
