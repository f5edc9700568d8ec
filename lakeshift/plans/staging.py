"""Staging models: rename to snake_case, trim / case-fold text, cast, default, and drop
rows without keys. These are lazy views; Catalyst prunes their columns and pushes their
filters into the source scan."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from lakeshift.functions.text import truthy
from lakeshift.plans.audit import Audit, with_audit

# Currency when the source has none.
DEFAULT_CURRENCY = "GBP"


def stg_orders(orders: DataFrame, audit: Audit | None = None) -> DataFrame:
    out = (orders
           .filter(F.col("OrderID").isNotNull() & F.col("CustomerID").isNotNull())
           .select(
               F.col("OrderID").alias("order_id"),
               F.col("CustomerID").alias("customer_id"),
               F.col("ProductID").alias("product_id"),
               F.col("OrderDate").cast("date").alias("order_date"),
               F.col("ShipDate").cast("date").alias("ship_date"),
               F.upper(F.trim(F.col("OrderStatus"))).alias("order_status"),
               F.coalesce(F.col("TotalAmount").cast("decimal(18,2)"),
                          F.lit(0).cast("decimal(18,2)")).alias("total_amount"),
               F.coalesce(F.upper(F.trim(F.col("CurrencyCode"))),
                          F.lit(DEFAULT_CURRENCY)).alias("currency_code"),
               F.col("SalesRepID").alias("sales_rep_id"),
               F.upper(F.trim(F.col("ChannelCode"))).alias("channel_code"),
               F.col("ShipDate").isNotNull().alias("is_shipped")))
    return with_audit(out, audit)


def stg_customers(customers: DataFrame, audit: Audit | None = None) -> DataFrame:
    # updated_at stays a zone-less timestamp (the source DATETIME has no zone), so the
    # model does not depend on the session time zone.
    out = (customers
           .filter(F.col("CustomerID").isNotNull())
           .select(
               F.col("CustomerID").alias("customer_id"),
               F.trim(F.col("CustomerName")).alias("customer_name"),
               F.lower(F.trim(F.col("CustomerEmail"))).alias("customer_email"),
               F.upper(F.trim(F.col("CustomerStatus"))).alias("customer_status"),
               F.col("CreatedDate").cast("date").alias("created_date"),
               F.col("UpdatedDate").cast("timestamp_ntz").alias("updated_at"),
               F.col("RegionCode").alias("region_code"),
               F.col("AccountManagerID").alias("account_manager_id")))
    return with_audit(out, audit)


def stg_products(products: DataFrame, audit: Audit | None = None) -> DataFrame:
    out = (products
           .filter(F.col("ProductID").isNotNull())
           .select(
               F.col("ProductID").alias("product_id"),
               F.trim(F.col("ProductName")).alias("product_name"),
               F.upper(F.trim(F.col("ProductCode"))).alias("product_code"),
               F.col("CategoryID").alias("category_id"),
               F.coalesce(F.col("UnitPrice"), F.lit(0)).cast("decimal(18,2)").alias("unit_price"),
               F.coalesce(F.col("StockQuantity").cast("int"), F.lit(0)).alias("stock_quantity"),
               truthy(F.col("IsActive")).alias("is_active"),
               F.col("CreatedDate").cast("date").alias("created_date")))
    return with_audit(out, audit)
