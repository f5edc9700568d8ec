"""Derive the three legacy source tables (Customers, Orders, Products) from the
driver's star-schema tables, deterministically, with the dirty cases the pipeline
exists for: padded and mixed-case text, null and blank values, orphan keys, nulls in
nullable columns, two snapshots with changes, and a landed text batch with bad values.

Everything is a DataFrame derivation of the given tables, so the work grows with them.
The same derivation is written once more as a DuckDB CTE prefix in ``lakeshift.oracle``.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from lakeshift.functions.text import record_hash

# When the two order snapshots were ingested.
SNAPSHOT_PREVIOUS_TS = "2024-01-01 00:00:00"
SNAPSHOT_CURRENT_TS = "2024-02-01 00:00:00"
SNAPSHOT_CUTOFF = "2001-01-01"
LANDED_FILE = "raw/LegacyDB/Customers/part-0000.parquet"


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _ts_days_hours(base: str, days: Column, hours: Column) -> Column:
    d = F.date_add(F.lit(base).cast("date"), days.cast("int")).cast("timestamp_ntz")
    return F.timestamp_add("HOUR", hours.cast("int"), d)


def orders_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dbo.Orders: one row per TPC-H order; product and ship date from its lines
    (orders without lines get null product and ship date)."""
    o = _read(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
        "o_orderpriority")
    # Aggregate lines before the join (partial aggregation map-side, then one shuffle
    # whose hash partitioning on the order key is reused by the join).
    li = (_read(spark, sf_dir, "lineitem")
          .groupBy(F.col("l_orderkey").alias("o_orderkey"))
          .agg(F.min("l_partkey").alias("first_part"), F.min("l_shipdate").alias("first_ship")))
    k = F.col("o_orderkey")
    status = (F.when(k % 37 == 0, F.lit(None).cast("string"))
              .when(F.col("o_orderstatus") == "F", F.lit(" completed"))
              .when((F.col("o_orderstatus") == "O") & (k % 3 == 0), F.lit(" Shipped"))
              .when(F.col("o_orderstatus") == "O", F.lit("pending "))
              .when(k % 2 == 0, F.lit("Cancelled"))
              .otherwise(F.lit("RETURNED")))
    channel = (F.when(k % 9 == 0, F.lit(None).cast("string"))
               .when(F.col("o_orderpriority") == "1-URGENT", F.lit(" online"))
               .when(F.col("o_orderpriority") == "2-HIGH", F.lit("phone "))
               .when(F.col("o_orderpriority") == "3-MEDIUM", F.lit("Direct"))
               .when(F.col("o_orderpriority") == "4-NOT SPECIFIED", F.lit(" partner "))
               .otherwise(F.lit("ONLINE")))
    amount = (F.col("o_totalprice").cast("decimal(18,2)")
              * F.lit("0.005").cast("decimal(4,3)")).cast("decimal(18,2)")
    return (o.join(li, "o_orderkey", "left")
            .select(k.cast("long").alias("OrderID"),
                    F.col("o_custkey").cast("long").alias("CustomerID"),
                    F.col("first_part").cast("long").alias("ProductID"),
                    F.col("o_orderdate").cast("date").alias("OrderDate"),
                    F.col("first_ship").cast("date").alias("ShipDate"),
                    status.alias("OrderStatus"),
                    amount.alias("TotalAmount"),
                    F.when(k % 5 == 0, F.lit(None).cast("string"))
                     .otherwise(F.lit(" gbp")).alias("CurrencyCode"),
                    (F.col("o_custkey") % 10).cast("int").alias("SalesRepID"),
                    channel.alias("ChannelCode")))


def customers_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dbo.Customers: region name through nation -> region (tiny dimensions)."""
    c = _read(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey",
                                                "c_mktsegment")
    n = _read(spark, sf_dir, "nation").select("n_nationkey", "n_regionkey")
    r = _read(spark, sf_dir, "region").select("r_regionkey", "r_name")
    k = F.col("c_custkey")
    status = (F.when(F.col("c_mktsegment") == "AUTOMOBILE", F.lit("active"))
              .when(F.col("c_mktsegment") == "BUILDING", F.lit(" Active "))
              .when(F.col("c_mktsegment") == "FURNITURE", F.lit("inactive"))
              .when(F.col("c_mktsegment") == "HOUSEHOLD", F.lit("SUSPENDED"))
              .otherwise(F.lit("pending")))
    email = (F.when(k % 10 == 0, F.lit(None).cast("string"))
             .when(k % 10 == 5, F.lit("  "))
             .otherwise(F.concat(F.lit(" Cust"), k.cast("string"), F.lit("@Example.COM "))))
    created = _ts_days_hours("2022-01-01", k % 365, k % 24)
    updated = F.when(k % 3 == 0, F.lit(None).cast("timestamp_ntz")).otherwise(
        F.timestamp_add("DAY", (k % 200).cast("int"), created))
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .join(r, F.col("n_regionkey") == r.r_regionkey, "left")
            .select(k.cast("long").alias("CustomerID"),
                    F.concat(F.lit("  "), F.col("c_name"), F.lit(" ")).alias("CustomerName"),
                    email.alias("CustomerEmail"),
                    status.alias("CustomerStatus"),
                    created.alias("CreatedDate"),
                    updated.alias("UpdatedDate"),
                    F.col("r_name").alias("RegionCode"),
                    F.col("c_nationkey").cast("int").alias("AccountManagerID")))


def products_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = _read(spark, sf_dir, "part").select("p_partkey", "p_name", "p_size", "p_retailprice")
    k = F.col("p_partkey")
    return p.select(
        k.cast("long").alias("ProductID"),
        F.concat(F.lit(" "), F.col("p_name"), F.lit("  ")).alias("ProductName"),
        F.concat(F.lit("prod-"), k.cast("string")).alias("ProductCode"),
        (F.col("p_size") % 5 + 1).cast("int").alias("CategoryID"),
        F.col("p_retailprice").cast("decimal(18,2)").alias("UnitPrice"),
        F.col("p_size").cast("int").alias("StockQuantity"),
        (k % 10 != 0).alias("IsActive"),
        _ts_days_hours("2021-06-01", k % 200, F.lit(0)).alias("CreatedDate"))


def _with_lineage(df: DataFrame, ts: str) -> DataFrame:
    return df.withColumns({
        "_record_hash": record_hash(df.columns),
        "_ingestion_timestamp": F.lit(ts).cast("timestamp_ntz"),
        "_is_deleted": F.lit(False),
    })


def orders_previous(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Earlier snapshot of Orders, taken before 2001: later orders are new since."""
    o = orders_source(spark, sf_dir)
    return _with_lineage(o.filter(F.col("OrderDate") < F.lit(SNAPSHOT_CUTOFF).cast("date")),
                         SNAPSHOT_PREVIOUS_TS)


def orders_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Later snapshot: cancelled orders were purged from the source system, and the
    amount of every pending order was amended by +1.00 since the earlier snapshot."""
    o = orders_source(spark, sf_dir)
    o = o.filter(F.coalesce(F.col("OrderStatus") != "Cancelled", F.lit(True)))
    o = o.withColumn("TotalAmount", F.when(
        F.col("OrderStatus") == "pending ",
        (F.col("TotalAmount") + F.lit(1).cast("decimal(18,2)")).cast("decimal(18,2)"),
    ).otherwise(F.col("TotalAmount")))
    return _with_lineage(o, SNAPSHOT_CURRENT_TS)


def orders_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Append-only bronze history: both snapshots, so most keys carry two versions."""
    return orders_previous(spark, sf_dir).unionByName(orders_current(spark, sf_dir))


def orders_dq_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze order history with feed defects for the silver rules: negative amounts
    (every 17th order), missing amounts (every 19th) and a far-future ship date
    (every 41st)."""
    h = orders_history(spark, sf_dir)
    k = F.col("OrderID")
    return h.withColumns({
        "TotalAmount": F.when(k % 19 == 0, F.lit(None).cast("decimal(18,2)"))
                        .when(k % 17 == 0, -F.col("TotalAmount"))
                        .otherwise(F.col("TotalAmount")),
        "ShipDate": F.when(k % 41 == 0, F.lit("2099-12-31").cast("date"))
                     .otherwise(F.col("ShipDate")),
    })


def customers_landed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers as landed text (every column a string) with bad values and one
    undeclared column, the input of bronze schema enforcement."""
    c = customers_source(spark, sf_dir)
    k = F.col("CustomerID")
    s = lambda name: F.col(name).cast("string")
    return c.select(
        F.when(k % 50 == 7, F.concat(F.lit("x"), s("CustomerID")))
         .when(k % 50 == 13, F.lit(None).cast("string"))
         .otherwise(F.concat(F.lit(" "), s("CustomerID"), F.lit(" "))).alias("CustomerID"),
        F.when(k % 60 == 1, F.lit(None).cast("string"))
         .otherwise(F.col("CustomerName")).alias("CustomerName"),
        F.col("CustomerEmail"),
        F.col("CustomerStatus"),
        F.when(k % 45 == 11, F.lit("not a date")).otherwise(s("CreatedDate")).alias("CreatedDate"),
        s("UpdatedDate").alias("UpdatedDate"),
        F.col("RegionCode"),
        F.when(k % 40 == 3, F.lit("2.5")).otherwise(s("AccountManagerID")).alias("AccountManagerID"),
        F.lit("Y").alias("LegacyFlag"),
    )


def products_landed_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products as landed text, exercising every coercion rule."""
    p = products_source(spark, sf_dir)
    k = F.col("ProductID")
    s = lambda name: F.col(name).cast("string")
    active = (F.when(k % 10 == 0, F.lit("0")).when(k % 10 == 1, F.lit("Yes"))
              .when(k % 10 == 2, F.lit("TRUE")).when(k % 10 == 3, F.lit("n"))
              .when(k % 10 == 4, F.lit(None).cast("string")).otherwise(F.lit("1")))
    return p.select(
        F.concat(F.lit(" "), s("ProductID")).alias("ProductID"),
        F.col("ProductName"),
        F.col("ProductCode"),
        F.when(k % 33 == 4, F.lit("n/a")).otherwise(s("CategoryID")).alias("CategoryID"),
        F.when(k % 29 == 5, F.lit("1,234.00"))
         .when(k % 29 == 6, F.concat(s("UnitPrice"), F.lit("5")))
         .otherwise(s("UnitPrice")).alias("UnitPrice"),
        F.when(k % 31 == 7, F.lit("1.5")).otherwise(s("StockQuantity")).alias("StockQuantity"),
        active.alias("IsActive"),
        F.when(k % 27 == 8, F.lit("2021-13-45")).otherwise(s("CreatedDate")).alias("CreatedDate"),
    )
