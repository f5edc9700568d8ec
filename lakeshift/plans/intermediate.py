"""Intermediate model: orders enriched with customer and product context."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from lakeshift.plans.audit import Audit, with_audit

# Order size buckets.
MULTI_UNIT, SINGLE_UNIT, BELOW_UNIT_PRICE = "multi_unit", "single_unit", "below_unit_price"


def order_size_category(amount: Column, unit_price: Column) -> Column:
    """Bucket an order by how many unit prices it covers. A null comparison (no
    product) falls through to ``below_unit_price``."""
    return (F.when(amount >= unit_price * 2, F.lit(MULTI_UNIT))
            .when(amount >= unit_price, F.lit(SINGLE_UNIT))
            .otherwise(F.lit(BELOW_UNIT_PRICE)))


def int_order_enriched(orders: DataFrame, customers: DataFrame, products: DataFrame,
                       audit: Audit | None = None) -> DataFrame:
    """Left joins keep orphan orders. The dimensions are not hinted: AQE broadcasts a
    side only after measuring it under ``autoBroadcastJoinThreshold``; above that the
    joins stay shuffled sort-merge joins, with skewed keys split by AQE."""
    o, c, p = orders.alias("o"), customers.alias("c"), products.alias("p")
    out = (o.join(c, F.col("o.customer_id") == F.col("c.customer_id"), "left")
           .join(p, F.col("o.product_id") == F.col("p.product_id"), "left")
           .select(
               "o.order_id", "o.customer_id", "o.product_id", "o.sales_rep_id",
               "o.order_date", "o.ship_date", "o.order_status", "o.total_amount",
               "o.currency_code", "o.channel_code", "o.is_shipped",
               "c.customer_name", "c.customer_email", "c.customer_status", "c.region_code",
               "p.product_name", "p.product_code", "p.category_id", "p.unit_price",
               F.datediff(F.col("o.ship_date"), F.col("o.order_date")).alias("days_to_ship"),
               order_size_category(F.col("o.total_amount"), F.col("p.unit_price"))
               .alias("order_size_category")))
    return with_audit(out, audit)
