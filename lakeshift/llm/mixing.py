"""Mixing sources to target weights by a time-varying curriculum (operator 1), native.

1. *Targets.* Sources by code point (null last) weigh 5, 2, 1, repeating, and share 150 % of
   all words. A target stops at twice its source's words; what is over is shared again by
   weight. That is one water level L with target = min(2 * size, L * weight), found from the
   sources in order of 2 * size / weight with running sums.
2. *Demand.* At training time t in [0, 1] a source is asked for target * (1 + c * (1 - 2t)) words
   a unit of time (c in ``SLOPES``, by weight class: heavy sources early, light ones late). The
   integral is target * (t + c * (t - t * t)), which ends at target, so the schedule never
   changes what is taken in all.
3. *Positions.* A source's documents stand in a seeded hash order; a second round follows the
   first. A copy is taken while it starts below the target and counts with its words up to the
   target; its position is the time at which cumulative demand reaches the middle of those
   words: the inverse of the integral, in closed form.
4. *Order.* Copies are range-sorted by position. The mixed set holds whole documents, also the
   one per source at which the target is reached.

Running sums over a source are split: documents fall into hash bins of about ``BIN_ROWS`` rows
(so a hot source has many), sums of bins are accumulated per source, and only rows within one
bin are numbered in one window. All of it is DataFrame code.

Defined results: a null or empty text has size 0, is taken 0 words and, as it uses no demand,
stands in the mix with one copy if it comes before the target of its source; sources that
hold no words have target 0; a null source is a source of its own, last; rows with equal
doc_id are ordered by size and text digest, and repeated rows are rows of their own; an empty table gives no
rows; extra columns with any names do not matter.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshift.llm.shared import empty_text, id_key, load, stored, text_digest

#: The repeating weights, the share of all words, the greatest repetition.
WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2
#: Slope of the demand of each weight class over training time, within [-1, 1].
SLOPES = (0.5, 0.0, -0.75)
BIN_ROWS = 2_000
SEED = 17

WORD = r"[^\x20\x09-\x0D]+"


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, size) per document -> source, source_size, n_docs, weight, slope, target per source."""
    by = sizes.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("n_docs"))
    place = (F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(WEIGHTS)
    by = by.withColumn("_class", place)
    for name, values in (("weight", WEIGHTS), ("slope", SLOPES)):
        by = by.withColumn(name, F.element_at(F.array(*map(F.lit, values)), F.col("_class") + 1).cast("double"))
    # Sources full below the water level come first in this order; a row's level is the one
    # that holds if all rows before it are full.
    order = Window.orderBy(F.col("source_size") * MOST / F.col("weight"), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy()
    total = F.sum("source_size").over(everything)
    level = ((total * SHARE - F.coalesce(F.sum(F.col("source_size") * MOST).over(before), F.lit(0)))
             / F.sum("weight").over(rest))
    by = by.withColumn("_level", level)
    cap = (F.col("source_size") * MOST).cast("double")
    by = by.withColumn("_open", F.col("_level") * F.col("weight") < cap)
    # the first open row's level is the water level; levels of later rows do not count
    water = F.min(F.when(F.col("_open"), F.struct(
        cap / F.col("weight"), F.col("source").isNull(), F.coalesce("source", F.lit("")), F.col("_level").alias("level")))).over(everything)["level"]
    return (by.withColumn("_water", water)
            .withColumn("target", F.when(F.col("_water").isNull(), cap)
                        .otherwise(F.least(cap, F.col("_water") * F.col("weight"))))
            .select("source", "source_size", "n_docs", "weight", "slope", "target"))


def demand_time(words: Column, target: Column, slope: Column) -> Column:
    """Time at which the integral of the demand reaches ``words``."""
    y = F.when(target > 0, F.least(F.greatest(words / target, F.lit(0.0)), F.lit(1.0))).otherwise(F.lit(0.0))
    a = slope + 1
    root = F.sqrt(F.greatest(a * a - 4 * slope * y, F.lit(0.0)))
    return F.when(F.abs(slope) < 1e-9, y).otherwise(2 * y / (a + root))


def positions(docs: DataFrame) -> DataFrame:
    """Size, target, words taken and training positions of each row of ``docs`` (doc_id, text, source)."""
    sizes = stored(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"),
        n_words(F.col("text").cast("string")).alias("size"), text_digest(empty_text()).alias("_text")), "mix-sizes")
    return _positioned(sizes, stored(source_targets(sizes), "mix-targets"))


def _positioned(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Positions of rows of (doc_id, source, size, _text)."""
    # (the join key is never null, so Spark may split a hot source if it does not broadcast)
    key = F.concat(F.when(F.col("source").isNull(), "n").otherwise("s"), F.coalesce("source", F.lit("")))
    rows = sizes.withColumn("_key", key).join(targets.withColumn("_key", key).drop("source"), "_key")
    draw = F.xxhash64("doc_id", F.lit(SEED))
    bins = F.ceil(F.col("n_docs") / BIN_ROWS)
    rows = rows.withColumn("_draw", draw).withColumn("_bin", F.pmod(F.shiftright("_draw", 20), bins))
    # running size of the bins before, per source: one row for each bin
    per_bin = rows.groupBy("_key", "_bin").agg(F.sum("size").alias("_words"))
    ahead = Window.partitionBy("_key").orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)
    per_bin = per_bin.select("_key", "_bin", F.coalesce(F.sum("_words").over(ahead), F.lit(0)).alias("_base"))
    inside = (Window.partitionBy("_key", "_bin").orderBy("_draw", F.col("doc_id").asc_nulls_last(), "size", "_text")
              .rowsBetween(Window.unboundedPreceding, -1))
    rows = rows.withColumn("_in", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rows = rows.join(per_bin, ["_key", "_bin"])
    start = F.col("_base") + F.col("_in")
    # words of each copy that lie below the target; the copy at the target is the last and counts in part
    left = [F.floor("target") - start - F.lit(k) * F.col("source_size") for k in range(MOST)]
    words = [F.least(F.greatest(x, F.lit(0)), F.col("size")) for x in left]
    taken = [F.when(F.col("size") > 0, w > 0).otherwise(x >= 0 if not k else F.lit(False))
             for k, (w, x) in enumerate(zip(words, left))]
    times = [F.when(t, demand_time(F.floor("target") - x + w / 2, F.col("target"), F.col("slope")))
             for t, w, x in zip(taken, words, left)]
    return rows.select(
        "doc_id", "size", "source_size", "target",
        sum(words[1:], words[0]).cast("long").alias("taken"),
        F.array_compact(F.array(*times)).alias("positions"),
        "_text")


def mix(docs: DataFrame) -> DataFrame:
    """The mixed set itself: the rows of ``docs``, once for each copy taken, range-sorted by training position.

    Positions are found on slim rows and meet the documents by (doc_id, text digest); the
    k-th of equal rows takes the k-th list of positions.
    """
    key = ["_id", "_hash"]
    slim = positions(docs).select(id_key().alias("_id"), F.col("_text").alias("_hash"), F.struct("positions").alias("_p"))
    lists = slim.groupBy(*key).agg(F.sort_array(F.collect_list("_p")).alias("_lists"))
    keyed = docs.select(F.struct("*").alias("_row"), id_key().alias("_id"), text_digest(empty_text()).alias("_hash"))
    nth = F.row_number().over(Window.partitionBy(*key).orderBy("_id"))
    rows = keyed.withColumn("_nth", nth).join(lists, key)
    rows = rows.withColumn("_at", F.explode(F.get("_lists", F.col("_nth") - 1)["positions"]))
    return rows.orderBy("_at", "_id").select("_row.*")


def op1_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document, range-sorted by the first position (documents not taken come last)."""
    placed = positions(load(spark, sf_dir, "documents"))
    return placed.drop("_text").orderBy(F.get("positions", F.lit(0)).asc_nulls_last(), "doc_id")
