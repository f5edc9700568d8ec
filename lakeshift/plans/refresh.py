"""Refresh of the daily sales fact: the days a change touches are computed again, the others stay.

A fact row depends on the orders of its day and on the customers and products these name, so a day
must be computed again if an order of it came, went, moved or changed, or if it holds an order of a
changed customer or product.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeshift.plans.audit import Audit
from lakeshift.plans.intermediate import int_order_enriched
from lakeshift.plans.marts import fct_daily_sales
from lakeshift.sinks.write import drop_folders, _in_partitions, listed_partitions, materialize, write_table

DAY = "order_date"


def touched_days(previous: DataFrame, current: DataFrame, orders: DataFrame | None = None,
                 customers: DataFrame | None = None, products: DataFrame | None = None) -> DataFrame:
    """Distinct days (null included) that changes touch. ``previous`` and ``current`` are the staged orders
    before and after; ``orders``, ``customers`` and ``products`` hold the ids that changed, each in its
    staging column (``order_id``, ``customer_id``, ``product_id``). An order counts on its old and its new
    day. Semi-joins on the id alone: of the order tables only the ids and the day are read."""
    days = current.select(DAY).limit(0)
    for frame, ids, name in ((previous, orders, "order_id"), (current, orders, "order_id"),
                             (current, customers, "customer_id"), (current, products, "product_id")):
        if ids is not None:
            days = days.unionByName(frame.select(name, DAY).join(ids.select(name), name, "left_semi").select(DAY))
    return days.distinct()


def refresh_daily_sales(spark: SparkSession, fact_path: str, orders: DataFrame, customers: DataFrame,
                        products: DataFrame, days: DataFrame, audit: Audit | None = None) -> str:
    """Compute the fact of ``days`` again from the staged tables and replace just those days in the
    table at ``fact_path`` (partitioned by day). With ``orders`` partitioned by day too, only the
    folders of those days are read (pruned at run time). Days without sales leave the fact. A run
    that dies is mended by running it again: it depends on the staged tables and the days alone."""
    days = listed_partitions(days, [DAY], "refresh-days")
    fresh = fct_daily_sales(int_order_enriched(_in_partitions(orders, days, [DAY]), customers, products), audit)
    fresh = materialize(fresh, "refresh-fact")
    write_table(fresh, fact_path, "overwrite", partition_by=DAY)
    there = spark.read.schema(fresh.schema).parquet(fact_path)  # listed after the write
    now = fresh.select(F.struct(DAY).alias("__now")).distinct()
    there = _in_partitions(there.select(DAY, F.col("_metadata.file_path").alias("__file")), days, [DAY])
    drop_folders(spark, there.join(now, F.struct(DAY).eqNullSafe(F.col("__now")), "left_anti"), "__file")
    return fact_path
