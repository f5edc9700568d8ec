import datetime as dt
from decimal import Decimal

from lakeshift.plans import (dim_customer, fct_daily_sales, int_order_enriched, stg_customers,
                             stg_orders, stg_products)
from tests.conftest import rows

ORD = ("OrderID int, CustomerID int, ProductID int, OrderDate date, ShipDate date, "
       "OrderStatus string, TotalAmount decimal(18,2), CurrencyCode string, SalesRepID int, "
       "ChannelCode string")
CUS = ("CustomerID int, CustomerName string, CustomerEmail string, CustomerStatus string, "
       "CreatedDate timestamp_ntz, UpdatedDate timestamp_ntz, RegionCode string, "
       "AccountManagerID int")
PRO = ("ProductID int, ProductName string, ProductCode string, CategoryID int, "
       "UnitPrice decimal(18,2), StockQuantity int, IsActive boolean, CreatedDate timestamp_ntz")
D = dt.date(2024, 1, 1)
T = dt.datetime(2023, 5, 1, 8, 30)


def orders(spark):
    return spark.createDataFrame([
        (1, 10, 100, D, dt.date(2024, 1, 3), " completed", Decimal("2500.00"), " gbp", 1, " online"),
        (2, 10, 100, D, None, "pending ", Decimal("1000.00"), None, 1, "Online "),
        (3, 11, 999, D, None, None, Decimal("50.00"), "usd", 2, None),        # orphan product, null status
        (4, 99, 100, D, dt.date(2023, 12, 30), "Cancelled", None, "gbp", 2, "direct"),  # orphan customer
        (None, 10, 100, D, None, "PENDING", Decimal("1.00"), "gbp", 1, "x"),   # no key -> dropped
    ], ORD)


def customers(spark):
    return spark.createDataFrame([
        (10, "  Acme ", " A@X.COM ", " active", T, None, "EAST", 7),
        (11, "Beta", None, "inactive", T, T, "WEST", 8),
        (12, "Gamma", "g@x", "PENDING", T, None, None, None),
        (None, "NoKey", None, "ACTIVE", T, None, None, None),
    ], CUS)


def products(spark):
    return spark.createDataFrame([
        (100, " Widget ", "prod-100", 1, Decimal("1000.00"), None, True, T),
        (101, "Gadget", "prod-101", 2, None, 5, False, T),
    ], PRO)


def test_stg_orders(spark):
    got = {r["order_id"]: r for r in rows(stg_orders(orders(spark)))}
    assert set(got) == {1, 2, 3, 4}
    assert got[1]["order_status"] == "COMPLETED" and got[1]["currency_code"] == "GBP"
    assert got[2]["currency_code"] == "GBP" and got[2]["is_shipped"] is False
    assert got[4]["total_amount"] == Decimal("0.00") and got[1]["channel_code"] == "ONLINE"
    assert got[3]["currency_code"] == "USD" and got[3]["order_status"] is None


def test_stg_customers_and_products(spark):
    c = {r["customer_id"]: r for r in rows(stg_customers(customers(spark)))}
    assert set(c) == {10, 11, 12}
    assert c[10]["customer_name"] == "Acme" and c[10]["customer_email"] == "a@x.com"
    assert c[10]["customer_status"] == "ACTIVE" and c[10]["created_date"] == dt.date(2023, 5, 1)
    p = {r["product_id"]: r for r in rows(stg_products(products(spark)))}
    assert p[100]["product_code"] == "PROD-100" and p[100]["stock_quantity"] == 0
    assert p[101]["unit_price"] == Decimal("0.00") and p[101]["is_active"] is False


def enriched(spark):
    return int_order_enriched(stg_orders(orders(spark)), stg_customers(customers(spark)),
                              stg_products(products(spark)))


def test_enriched_left_joins_and_buckets(spark):
    e = {r["order_id"]: r for r in rows(enriched(spark))}
    assert e[1]["order_size_category"] == "multi_unit" and e[1]["days_to_ship"] == 2
    assert e[2]["order_size_category"] == "single_unit" and e[2]["days_to_ship"] is None
    assert e[3]["product_name"] is None and e[3]["order_size_category"] == "below_unit_price"
    assert e[4]["customer_name"] is None and e[4]["days_to_ship"] == -2


def test_fct_daily_sales_excludes_statuses_and_null(spark):
    f = rows(fct_daily_sales(enriched(spark)))
    # order 3 has a null status: NOT IN drops it; order 4 is CANCELLED
    assert len(f) == 1
    r = f[0]
    assert (r["order_count"], r["unique_customers"], r["unique_products"]) == (2, 1, 1)
    assert r["gross_revenue"] == Decimal("3500.00") and r["shipped_orders"] == 1
    assert r["max_order_value"] == Decimal("2500.00") and r["avg_days_to_ship"] == 2.0
    assert r["avg_order_value"] == Decimal("1750.000000")


def test_dim_customer_segments(spark):
    d = {r["customer_id"]: r for r in rows(dim_customer(stg_customers(customers(spark)),
                                                        stg_orders(orders(spark))))}
    assert d[10]["lifetime_orders"] == 2 and d[10]["customer_segment"] == "Silver"
    assert d[11]["lifetime_orders"] == 0 and d[11]["lifetime_revenue"] == Decimal("0.00")
    assert d[11]["customer_segment"] == "Bronze" and d[11]["last_order_date"] is None


def test_segment_thresholds_inclusive(spark):
    o = spark.createDataFrame([(1, 10, 1, D, None, "COMPLETED", Decimal("10000.00"), "GBP", 1, "x"),
                               (2, 11, 1, D, None, "COMPLETED", Decimal("1000.00"), "GBP", 1, "x"),
                               (3, 12, 1, D, None, "COMPLETED", Decimal("999.99"), "GBP", 1, "x")],
                              ORD)
    d = {r["customer_id"]: r["customer_segment"]
         for r in rows(dim_customer(stg_customers(customers(spark)), stg_orders(o)))}
    assert d == {10: "Gold", 11: "Silver", 12: "Bronze"}


def test_audit_columns_injectable(spark):
    from lakeshift.plans import Audit
    r = stg_products(products(spark), Audit("run-1", "2024-01-01 00:00:00")).first()
    assert r._run_id == "run-1" and r._loaded_at is not None


def test_build_gold_and_views(spark, tmp_path):
    from lakeshift.plans.build import build_gold, model_views
    g = build_gold(spark, orders(spark), customers(spark), products(spark), str(tmp_path / "gold"))
    assert g.fct_daily_sales.count() == 1 and g.dim_customer.count() == 3
    assert (tmp_path / "gold/fct_daily_sales/order_date=2024-01-01").is_dir()
    v = model_views(orders(spark), customers(spark), products(spark))
    v.register_views("t_")
    assert spark.sql("select count(*) c from t_int_order_enriched").first().c == 4
