"""Model materialisation, as the model configs declare it: staging models are views,
the intermediate model and the marts are tables, the daily fact partitioned by
order date. Also registers every model as a temp view for SQL users."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from lakeshift.plans.audit import Audit
from lakeshift.plans.intermediate import int_order_enriched
from lakeshift.plans.marts import dim_customer, fct_daily_sales
from lakeshift.plans.staging import stg_customers, stg_orders, stg_products


@dataclass
class GoldTables:
    stg_orders: DataFrame
    stg_customers: DataFrame
    stg_products: DataFrame
    int_order_enriched: DataFrame
    fct_daily_sales: DataFrame
    dim_customer: DataFrame

    def register_views(self, prefix: str = "") -> None:
        for name, df in self.__dict__.items():
            df.createOrReplaceTempView(prefix + name)


def model_views(orders: DataFrame, customers: DataFrame, products: DataFrame,
                audit: Audit | None = None) -> GoldTables:
    """All six models as lazy DataFrames (one Catalyst plan each, nothing written)."""
    so, sc, sp = (stg_orders(orders, audit), stg_customers(customers, audit),
                  stg_products(products, audit))
    bare = (stg_orders(orders), stg_customers(customers), stg_products(products))
    enriched = int_order_enriched(*bare, audit=audit)
    return GoldTables(so, sc, sp, enriched,
                      fct_daily_sales(int_order_enriched(*bare), audit),
                      dim_customer(bare[1], bare[0], audit))


def build_gold(spark: SparkSession, orders: DataFrame, customers: DataFrame,
               products: DataFrame, root: str, audit: Audit | None = None) -> GoldTables:
    """Materialise: the intermediate table once, then both marts from it / from the
    staging views; the fact partitioned by ``order_date`` and replaced whole, so days that
    have vanished from the source vanish from it. Returns scans of the written tables."""
    from lakeshift.sinks.write import write_table
    base = root.rstrip("/")
    so, sc, sp = stg_orders(orders), stg_customers(customers), stg_products(products)
    write_table(int_order_enriched(so, sc, sp, audit), f"{base}/int_order_enriched", "overwrite")
    enriched = spark.read.parquet(f"{base}/int_order_enriched")
    cols = [c for c in enriched.columns if not c.startswith("_")]
    write_table(fct_daily_sales(enriched.select(*cols), audit), f"{base}/fct_daily_sales",
                "overwrite", partition_by="order_date", replace="table")
    write_table(dim_customer(sc, so, audit), f"{base}/dim_customer", "overwrite")
    return GoldTables(stg_orders(orders, audit), stg_customers(customers, audit),
                      stg_products(products, audit), enriched,
                      spark.read.parquet(f"{base}/fct_daily_sales"),
                      spark.read.parquet(f"{base}/dim_customer"))
