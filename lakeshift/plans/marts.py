"""Mart models: the daily sales fact and the customer dimension (type-1)."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakeshift.plans.audit import Audit, with_audit

# Order statuses that do not count as sales, and segment thresholds.
EXCLUDED_STATUSES = ("CANCELLED", "RETURNED")
GOLD_MIN_REVENUE = 10000
SILVER_MIN_REVENUE = 1000

FCT_DAILY_SALES_KEYS = ("order_date", "region_code", "channel_code", "category_id",
                        "customer_status")


def exclude_statuses(df: DataFrame, column: str = "order_status",
                     statuses=EXCLUDED_STATUSES) -> DataFrame:
    """``column NOT IN (...)`` with SQL three-valued logic: a null status is dropped too."""
    return df.filter(~F.col(column).isin(*statuses))


def fct_daily_sales(enriched: DataFrame, audit: Audit | None = None) -> DataFrame:
    """Five-key daily aggregate. The three exact distinct counts make Catalyst expand
    rows once per distinct group and aggregate twice; partial aggregation runs map-side
    before each exchange, so hot keys are combined before they shuffle."""
    sales = exclude_statuses(enriched)
    out = (sales.groupBy(*FCT_DAILY_SALES_KEYS)
           .agg(F.count_distinct("order_id").alias("order_count"),
                F.count_distinct("customer_id").alias("unique_customers"),
                F.count_distinct("product_id").alias("unique_products"),
                F.sum("total_amount").alias("gross_revenue"),
                F.avg("total_amount").alias("avg_order_value"),
                F.max("total_amount").alias("max_order_value"),
                F.min("total_amount").alias("min_order_value"),
                F.sum(F.when(F.col("is_shipped"), 1).otherwise(0)).alias("shipped_orders"),
                F.avg("days_to_ship").alias("avg_days_to_ship")))
    return with_audit(out, audit)


def customer_order_stats(orders: DataFrame) -> DataFrame:
    """Per-customer lifetime figures over sales orders (aggregate before any join)."""
    return (exclude_statuses(orders).groupBy("customer_id")
            .agg(F.count_distinct("order_id").alias("lifetime_orders"),
                 F.sum("total_amount").alias("lifetime_revenue"),
                 F.max("order_date").alias("last_order_date"),
                 F.min("order_date").alias("first_order_date")))


def dim_customer(customers: DataFrame, orders: DataFrame, audit: Audit | None = None,
                 gold_min=GOLD_MIN_REVENUE, silver_min=SILVER_MIN_REVENUE) -> DataFrame:
    """Customers left-joined to their pre-aggregated order stats (one row per customer,
    no fan-out). Customers without sales get 0 orders, 0.00 revenue, Bronze."""
    stats = customer_order_stats(orders).alias("s")
    c = customers.alias("c")
    revenue = F.coalesce(F.col("s.lifetime_revenue"), F.lit(0))
    out = (c.join(stats, F.col("c.customer_id") == F.col("s.customer_id"), "left")
           .select("c.customer_id", "c.customer_name", "c.customer_email", "c.customer_status",
                   "c.region_code", "c.account_manager_id", "c.created_date", "c.updated_at",
                   F.coalesce(F.col("s.lifetime_orders"), F.lit(0)).alias("lifetime_orders"),
                   F.coalesce(F.col("s.lifetime_revenue"),
                              F.lit(0).cast("decimal(18,2)")).alias("lifetime_revenue"),
                   F.col("s.last_order_date"), F.col("s.first_order_date"),
                   F.when(revenue >= gold_min, F.lit("Gold"))
                    .when(revenue >= silver_min, F.lit("Silver"))
                    .otherwise(F.lit("Bronze")).alias("customer_segment")))
    return with_audit(out, audit)
