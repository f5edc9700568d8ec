"""DuckDB oracle SQL for every registered query.

``ADAPTER`` restates ``lakeshift.sources.adapter`` as CTEs over the driver's views
(orders, lineitem, customer, nation, region, part). Each query string is
``ADAPTER + <query>``; column names match the Spark query exactly.
"""
from __future__ import annotations

ADAPTER = r"""
WITH
li_first AS (
  SELECT l_orderkey AS o_orderkey, min(l_partkey) AS first_part, min(l_shipdate) AS first_ship
  FROM lineitem GROUP BY l_orderkey
),
orders_src AS (
  SELECT
    CAST(o.o_orderkey AS BIGINT) AS OrderID,
    CAST(o.o_custkey AS BIGINT) AS CustomerID,
    CAST(l.first_part AS BIGINT) AS ProductID,
    CAST(o.o_orderdate AS DATE) AS OrderDate,
    CAST(l.first_ship AS DATE) AS ShipDate,
    CASE WHEN o.o_orderkey % 37 = 0 THEN NULL
         WHEN o.o_orderstatus = 'F' THEN ' completed'
         WHEN o.o_orderstatus = 'O' AND o.o_orderkey % 3 = 0 THEN ' Shipped'
         WHEN o.o_orderstatus = 'O' THEN 'pending '
         WHEN o.o_orderkey % 2 = 0 THEN 'Cancelled'
         ELSE 'RETURNED' END AS OrderStatus,
    CAST(CAST(o.o_totalprice AS DECIMAL(18,2)) * CAST(0.005 AS DECIMAL(4,3)) AS DECIMAL(18,2)) AS TotalAmount,
    CASE WHEN o.o_orderkey % 5 = 0 THEN NULL ELSE ' gbp' END AS CurrencyCode,
    CAST(o.o_custkey % 10 AS INTEGER) AS SalesRepID,
    CASE WHEN o.o_orderkey % 9 = 0 THEN NULL
         WHEN o.o_orderpriority = '1-URGENT' THEN ' online'
         WHEN o.o_orderpriority = '2-HIGH' THEN 'phone '
         WHEN o.o_orderpriority = '3-MEDIUM' THEN 'Direct'
         WHEN o.o_orderpriority = '4-NOT SPECIFIED' THEN ' partner '
         ELSE 'ONLINE' END AS ChannelCode
  FROM orders o LEFT JOIN li_first l ON o.o_orderkey = l.o_orderkey
),
customers_src AS (
  SELECT
    CAST(c.c_custkey AS BIGINT) AS CustomerID,
    '  ' || c.c_name || ' ' AS CustomerName,
    CASE WHEN c.c_custkey % 10 = 0 THEN NULL
         WHEN c.c_custkey % 10 = 5 THEN '  '
         ELSE ' Cust' || CAST(c.c_custkey AS VARCHAR) || '@Example.COM ' END AS CustomerEmail,
    CASE c.c_mktsegment WHEN 'AUTOMOBILE' THEN 'active' WHEN 'BUILDING' THEN ' Active '
         WHEN 'FURNITURE' THEN 'inactive' WHEN 'HOUSEHOLD' THEN 'SUSPENDED'
         ELSE 'pending' END AS CustomerStatus,
    CAST(DATE '2022-01-01' + CAST(c.c_custkey % 365 AS INTEGER) AS TIMESTAMP)
      + to_hours(CAST(c.c_custkey % 24 AS INTEGER)) AS CreatedDate,
    CASE WHEN c.c_custkey % 3 = 0 THEN NULL
         ELSE CAST(DATE '2022-01-01' + CAST(c.c_custkey % 365 AS INTEGER) AS TIMESTAMP)
              + to_hours(CAST(c.c_custkey % 24 AS INTEGER))
              + to_days(CAST(c.c_custkey % 200 AS INTEGER)) END AS UpdatedDate,
    r.r_name AS RegionCode,
    CAST(c.c_nationkey AS INTEGER) AS AccountManagerID
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
products_src AS (
  SELECT
    CAST(p_partkey AS BIGINT) AS ProductID,
    ' ' || p_name || '  ' AS ProductName,
    'prod-' || CAST(p_partkey AS VARCHAR) AS ProductCode,
    CAST(p_size % 5 + 1 AS INTEGER) AS CategoryID,
    CAST(p_retailprice AS DECIMAL(18,2)) AS UnitPrice,
    CAST(p_size AS INTEGER) AS StockQuantity,
    (p_partkey % 10 <> 0) AS IsActive,
    CAST(DATE '2021-06-01' + CAST(p_partkey % 200 AS INTEGER) AS TIMESTAMP) AS CreatedDate
  FROM part
),
stg_orders AS (
  SELECT OrderID AS order_id, CustomerID AS customer_id, ProductID AS product_id,
         CAST(OrderDate AS DATE) AS order_date, CAST(ShipDate AS DATE) AS ship_date,
         upper(trim(OrderStatus)) AS order_status,
         coalesce(CAST(TotalAmount AS DECIMAL(18,2)), CAST(0 AS DECIMAL(18,2))) AS total_amount,
         coalesce(upper(trim(CurrencyCode)), 'GBP') AS currency_code,
         SalesRepID AS sales_rep_id, upper(trim(ChannelCode)) AS channel_code,
         ShipDate IS NOT NULL AS is_shipped
  FROM orders_src WHERE OrderID IS NOT NULL AND CustomerID IS NOT NULL
),
stg_customers AS (
  SELECT CustomerID AS customer_id, trim(CustomerName) AS customer_name,
         lower(trim(CustomerEmail)) AS customer_email, upper(trim(CustomerStatus)) AS customer_status,
         CAST(CreatedDate AS DATE) AS created_date, CAST(UpdatedDate AS TIMESTAMP) AS updated_at,
         RegionCode AS region_code, AccountManagerID AS account_manager_id
  FROM customers_src WHERE CustomerID IS NOT NULL
),
stg_products AS (
  SELECT ProductID AS product_id, trim(ProductName) AS product_name,
         upper(trim(ProductCode)) AS product_code, CategoryID AS category_id,
         CAST(coalesce(UnitPrice, 0) AS DECIMAL(18,2)) AS unit_price,
         coalesce(CAST(StockQuantity AS INTEGER), 0) AS stock_quantity,
         coalesce(lower(CAST(IsActive AS VARCHAR)) IN ('1', 'true'), false) AS is_active,
         CAST(CreatedDate AS DATE) AS created_date
  FROM products_src WHERE ProductID IS NOT NULL
),
int_order_enriched AS (
  SELECT o.order_id, o.customer_id, o.product_id, o.sales_rep_id, o.order_date, o.ship_date,
         o.order_status, o.total_amount, o.currency_code, o.channel_code, o.is_shipped,
         c.customer_name, c.customer_email, c.customer_status, c.region_code,
         p.product_name, p.product_code, p.category_id, p.unit_price,
         CAST(datediff('day', o.order_date, o.ship_date) AS INTEGER) AS days_to_ship,
         CASE WHEN o.total_amount >= p.unit_price * 2 THEN 'multi_unit'
              WHEN o.total_amount >= p.unit_price THEN 'single_unit'
              ELSE 'below_unit_price' END AS order_size_category
  FROM stg_orders o
  LEFT JOIN stg_customers c ON o.customer_id = c.customer_id
  LEFT JOIN stg_products p ON o.product_id = p.product_id
)
"""

GOLD = {
    "stg_orders": "SELECT * FROM stg_orders",
    "stg_customers": "SELECT * FROM stg_customers",
    "stg_products": "SELECT * FROM stg_products",
    "int_order_enriched": "SELECT * FROM int_order_enriched",
    "fct_daily_sales": """
SELECT order_date, region_code, channel_code, category_id, customer_status,
       count(DISTINCT order_id) AS order_count,
       count(DISTINCT customer_id) AS unique_customers,
       count(DISTINCT product_id) AS unique_products,
       CAST(sum(total_amount) AS DECIMAL(28,2)) AS gross_revenue,
       CAST(avg(total_amount) AS DECIMAL(22,6)) AS avg_order_value,
       max(total_amount) AS max_order_value,
       min(total_amount) AS min_order_value,
       CAST(sum(CASE WHEN is_shipped THEN 1 ELSE 0 END) AS BIGINT) AS shipped_orders,
       avg(days_to_ship) AS avg_days_to_ship
FROM int_order_enriched
WHERE order_status NOT IN ('CANCELLED', 'RETURNED')
GROUP BY order_date, region_code, channel_code, category_id, customer_status""",
    "agg_customer_orders": """
SELECT customer_id,
       count(DISTINCT order_id) AS lifetime_orders,
       CAST(sum(total_amount) AS DECIMAL(28,2)) AS lifetime_revenue,
       max(order_date) AS last_order_date,
       min(order_date) AS first_order_date
FROM stg_orders WHERE order_status NOT IN ('CANCELLED', 'RETURNED')
GROUP BY customer_id""",
    "dim_customer": """
, s AS (
  SELECT customer_id, count(DISTINCT order_id) AS lifetime_orders,
         CAST(sum(total_amount) AS DECIMAL(28,2)) AS lifetime_revenue,
         max(order_date) AS last_order_date, min(order_date) AS first_order_date
  FROM stg_orders WHERE order_status NOT IN ('CANCELLED', 'RETURNED')
  GROUP BY customer_id
)
SELECT c.customer_id, c.customer_name, c.customer_email, c.customer_status, c.region_code,
       c.account_manager_id, c.created_date, c.updated_at,
       coalesce(s.lifetime_orders, 0) AS lifetime_orders,
       coalesce(s.lifetime_revenue, CAST(0 AS DECIMAL(28,2))) AS lifetime_revenue,
       s.last_order_date, s.first_order_date,
       CASE WHEN coalesce(s.lifetime_revenue, 0) >= 10000 THEN 'Gold'
            WHEN coalesce(s.lifetime_revenue, 0) >= 1000 THEN 'Silver'
            ELSE 'Bronze' END AS customer_segment
FROM stg_customers c LEFT JOIN s ON c.customer_id = s.customer_id""",
    "filter_not_in": """
SELECT order_id, customer_id, order_status, total_amount
FROM stg_orders WHERE order_status NOT IN ('CANCELLED', 'RETURNED')""",
    "case_order_size": """
SELECT order_size_category, count(*) AS orders,
       CAST(sum(total_amount) AS DECIMAL(28,2)) AS total_amount,
       count(*) FILTER (WHERE product_id IS NULL OR unit_price IS NULL) AS without_price
FROM int_order_enriched GROUP BY order_size_category""",
}


def _with_adapter(body: str) -> str:
    body = body.strip()
    if body.startswith(","):
        # the body continues the WITH list, then ends in its own SELECT
        return ADAPTER.rstrip() + "\n" + body
    return ADAPTER.rstrip() + "\n" + body


# ── helpers generating repeated oracle SQL ─────────────────────────────────
def _hash_sql(columns, alias=""):
    """md5 over sorted business columns rendered name=value (null -> None), joined by &."""
    a = f"{alias}." if alias else ""
    names = sorted(c for c in columns if not c.startswith("_"))
    parts = ", ".join(f"'{n}=' || coalesce(CAST({a}{n} AS VARCHAR), 'None')" for n in names)
    return f"md5(concat_ws('&', {parts}))"


ORDER_COLS = ["OrderID", "CustomerID", "ProductID", "OrderDate", "ShipDate", "OrderStatus",
              "TotalAmount", "CurrencyCode", "SalesRepID", "ChannelCode"]
CUSTOMER_COLS = ["CustomerID", "CustomerName", "CustomerEmail", "CustomerStatus",
                 "CreatedDate", "UpdatedDate", "RegionCode", "AccountManagerID"]
PRODUCT_COLS = ["ProductID", "ProductName", "ProductCode", "CategoryID", "UnitPrice",
                "StockQuantity", "IsActive", "CreatedDate"]
SNAP = ", ".join(ORDER_COLS)
INGEST_TS = "2024-03-01 06:00:00"
LANDED_FILE = "raw/LegacyDB/Customers/part-0000.parquet"
INT_GUARD = r"regexp_matches({x}, '^\s*[+-]?[0-9]+\s*$')"


def _int_sql(x, sql_type="INTEGER"):
    return f"(CASE WHEN {INT_GUARD.format(x=x)} THEN TRY_CAST(trim({x}) AS {sql_type}) END)"


SILVER = rf"""
, orders_prev AS (
  SELECT {SNAP}, {_hash_sql(ORDER_COLS)} AS _record_hash,
         TIMESTAMP '2024-01-01 00:00:00' AS _ingestion_timestamp, false AS _is_deleted
  FROM orders_src WHERE OrderDate < DATE '2001-01-01'
),
cur_base AS (
  SELECT OrderID, CustomerID, ProductID, OrderDate, ShipDate, OrderStatus,
         CASE WHEN OrderStatus = 'pending ' THEN CAST(TotalAmount + CAST(1 AS DECIMAL(18,2)) AS DECIMAL(18,2))
              ELSE TotalAmount END AS TotalAmount,
         CurrencyCode, SalesRepID, ChannelCode
  FROM orders_src WHERE coalesce(OrderStatus <> 'Cancelled', true)
),
orders_cur AS (
  SELECT {SNAP}, {_hash_sql(ORDER_COLS)} AS _record_hash,
         TIMESTAMP '2024-02-01 00:00:00' AS _ingestion_timestamp, false AS _is_deleted
  FROM cur_base
),
orders_hist AS (SELECT * FROM orders_prev UNION ALL SELECT * FROM orders_cur),
orders_dq AS (
  SELECT OrderID, CustomerID, ProductID, OrderDate,
         CASE WHEN OrderID % 41 = 0 THEN DATE '2099-12-31' ELSE ShipDate END AS ShipDate,
         OrderStatus,
         CASE WHEN OrderID % 19 = 0 THEN NULL WHEN OrderID % 17 = 0 THEN -TotalAmount
              ELSE TotalAmount END AS TotalAmount,
         CurrencyCode, SalesRepID, ChannelCode, _record_hash, _ingestion_timestamp, _is_deleted
  FROM orders_hist
),
dq0 AS (
  SELECT *, coalesce(OrderStatus = upper(trim(OrderStatus)), false) AS p0,
         coalesce(CAST(OrderStatus AS VARCHAR), 'None') AS v0
  FROM orders_dq
),
dq1 AS (
  SELECT * REPLACE (CASE WHEN p0 THEN OrderStatus ELSE upper(trim(OrderStatus)) END AS OrderStatus)
  FROM dq0
),
dq2 AS (
  SELECT *, coalesce(regexp_matches(OrderStatus, '\S'), false) AS p1,
         coalesce(OrderStatus, 'None') AS v1,
         coalesce(OrderStatus IN ('CANCELLED', 'COMPLETED', 'PENDING', 'RETURNED', 'SHIPPED'), false) AS p2,
         coalesce(OrderStatus, 'None') AS v2,
         coalesce(TotalAmount > 0, false) AS p3,
         coalesce(CAST(TotalAmount AS VARCHAR), 'None') AS v3
  FROM dq1
),
dq3 AS (
  SELECT * REPLACE (CASE WHEN p3 THEN TotalAmount
                         ELSE coalesce(abs(TotalAmount), CAST(0 AS DECIMAL(18,2))) END AS TotalAmount)
  FROM dq2
),
dq4 AS (
  SELECT *, coalesce(ChannelCode IS NULL OR length(ChannelCode) <= 6, false) AS p4,
         coalesce(ChannelCode, 'None') AS v4
  FROM dq3
),
dq5 AS (
  SELECT * REPLACE (CASE WHEN p4 THEN ChannelCode ELSE substring(ChannelCode, 1, 6) END AS ChannelCode)
  FROM dq4
),
dq AS (
  SELECT *, coalesce(ShipDate IS NULL OR ShipDate <= CAST(now() AS DATE), false) AS p5,
         coalesce(CAST(ShipDate AS VARCHAR), 'None') AS v5,
         (NOT p1 OR NOT p2) AS has_error
  FROM dq5
),
dq_clean AS (
  SELECT {SNAP}, _record_hash, _ingestion_timestamp, _is_deleted FROM dq WHERE NOT has_error
),
silver_orders AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY OrderID ORDER BY _ingestion_timestamp DESC NULLS LAST) AS rn
    FROM dq_clean) WHERE rn = 1
)
"""

LANDED = rf"""
, cust_text AS (
  SELECT
    CASE WHEN CustomerID % 50 = 7 THEN 'x' || CAST(CustomerID AS VARCHAR)
         WHEN CustomerID % 50 = 13 THEN NULL
         ELSE ' ' || CAST(CustomerID AS VARCHAR) || ' ' END AS CustomerID,
    CASE WHEN CustomerID % 60 = 1 THEN NULL ELSE CustomerName END AS CustomerName,
    CustomerEmail, CustomerStatus,
    CASE WHEN CustomerID % 45 = 11 THEN 'not a date' ELSE CAST(CreatedDate AS VARCHAR) END AS CreatedDate,
    CAST(UpdatedDate AS VARCHAR) AS UpdatedDate,
    RegionCode,
    CASE WHEN CustomerID % 40 = 3 THEN '2.5' ELSE CAST(AccountManagerID AS VARCHAR) END AS AccountManagerID,
    'Y' AS LegacyFlag
  FROM customers_src
),
cust_typed AS (
  SELECT *,
    {_int_sql('CustomerID', 'BIGINT')} AS t_id,
    TRY_CAST(CreatedDate AS TIMESTAMP) AS t_created,
    TRY_CAST(UpdatedDate AS TIMESTAMP) AS t_updated,
    {_int_sql('AccountManagerID')} AS t_mgr
  FROM cust_text
),
cust_enf AS (
  SELECT
    t_id AS e_CustomerID, CustomerName AS e_CustomerName,
    coalesce(CustomerEmail, 'unknown@example.com') AS e_CustomerEmail,
    CustomerStatus AS e_CustomerStatus, t_created AS e_CreatedDate, t_updated AS e_UpdatedDate,
    RegionCode AS e_RegionCode, t_mgr AS e_AccountManagerID,
    [CASE WHEN CustomerID IS NULL THEN 'Required column ''CustomerID'' is null in record'
          WHEN t_id IS NULL THEN 'Cannot coerce column ''CustomerID'' value ''' || CustomerID || ''' to long' END,
     CASE WHEN CustomerName IS NULL THEN 'Required column ''CustomerName'' is null in record' END,
     NULL,
     CASE WHEN CustomerStatus IS NULL THEN 'Required column ''CustomerStatus'' is null in record' END,
     CASE WHEN CreatedDate IS NULL THEN 'Required column ''CreatedDate'' is null in record'
          WHEN t_created IS NULL THEN 'Cannot coerce column ''CreatedDate'' value ''' || CreatedDate || ''' to timestamp' END,
     CASE WHEN UpdatedDate IS NOT NULL AND t_updated IS NULL
          THEN 'Cannot coerce column ''UpdatedDate'' value ''' || UpdatedDate || ''' to timestamp' END,
     NULL,
     CASE WHEN AccountManagerID IS NOT NULL AND t_mgr IS NULL
          THEN 'Cannot coerce column ''AccountManagerID'' value ''' || AccountManagerID || ''' to int' END
    ] AS errs_all,
    CustomerID AS r_CustomerID, CustomerName AS r_CustomerName, CustomerEmail AS r_CustomerEmail,
    CustomerStatus AS r_CustomerStatus, CreatedDate AS r_CreatedDate, UpdatedDate AS r_UpdatedDate,
    RegionCode AS r_RegionCode, AccountManagerID AS r_AccountManagerID, LegacyFlag AS r_LegacyFlag
  FROM cust_typed
),
cust_flag AS (
  SELECT *, list_filter(errs_all, lambda x: x IS NOT NULL) AS errs FROM cust_enf
),
bronze_valid AS (
  SELECT e_CustomerID AS CustomerID, e_CustomerName AS CustomerName, e_CustomerEmail AS CustomerEmail,
         e_CustomerStatus AS CustomerStatus, e_CreatedDate AS CreatedDate, e_UpdatedDate AS UpdatedDate,
         e_RegionCode AS RegionCode, e_AccountManagerID AS AccountManagerID,
         TIMESTAMP '{INGEST_TS}' AS _ingestion_timestamp, '{LANDED_FILE}' AS _source_file,
         'Customers' AS _source_table,
         {_hash_sql(['e_' + c for c in CUSTOMER_COLS]).replace("'e_", "'")} AS _record_hash,
         false AS _is_deleted
  FROM cust_flag WHERE len(errs) = 0
)
"""


BRONZE = {
    "type_coerce": rf"""
, prod_text AS (
  SELECT ' ' || CAST(ProductID AS VARCHAR) AS ProductID, ProductName, ProductCode,
         CASE WHEN ProductID % 33 = 4 THEN 'n/a' ELSE CAST(CategoryID AS VARCHAR) END AS CategoryID,
         CASE WHEN ProductID % 29 = 5 THEN '1,234.00'
              WHEN ProductID % 29 = 6 THEN CAST(UnitPrice AS VARCHAR) || '5'
              ELSE CAST(UnitPrice AS VARCHAR) END AS UnitPrice,
         CASE WHEN ProductID % 31 = 7 THEN '1.5' ELSE CAST(StockQuantity AS VARCHAR) END AS StockQuantity,
         CASE ProductID % 10 WHEN 0 THEN '0' WHEN 1 THEN 'Yes' WHEN 2 THEN 'TRUE' WHEN 3 THEN 'n'
              WHEN 4 THEN NULL ELSE '1' END AS IsActive,
         CASE WHEN ProductID % 27 = 8 THEN '2021-13-45' ELSE CAST(CreatedDate AS VARCHAR) END AS CreatedDate
  FROM products_src
),
prod_typed AS (
  SELECT ProductID AS raw_id,
         {_int_sql('ProductID', 'BIGINT')} AS t_ProductID, ProductName AS t_ProductName,
         ProductCode AS t_ProductCode, {_int_sql('CategoryID')} AS t_CategoryID,
         TRY_CAST(UnitPrice AS DECIMAL(18,2)) AS t_UnitPrice, {_int_sql('StockQuantity')} AS t_StockQuantity,
         lower(IsActive) IN ('true', '1', 'yes') AS t_IsActive,
         TRY_CAST(CreatedDate AS TIMESTAMP) AS t_CreatedDate,
         ProductID AS r_ProductID, CategoryID AS r_CategoryID, UnitPrice AS r_UnitPrice,
         StockQuantity AS r_StockQuantity, CreatedDate AS r_CreatedDate
  FROM prod_text
)
SELECT raw_id, t_ProductID AS ProductID, t_ProductName AS ProductName, t_ProductCode AS ProductCode,
       t_CategoryID AS CategoryID, t_UnitPrice AS UnitPrice, t_StockQuantity AS StockQuantity,
       t_IsActive AS IsActive, t_CreatedDate AS CreatedDate,
       concat_ws(',',
         CASE WHEN r_ProductID IS NOT NULL AND t_ProductID IS NULL THEN 'ProductID' END,
         CASE WHEN r_CategoryID IS NOT NULL AND t_CategoryID IS NULL THEN 'CategoryID' END,
         CASE WHEN r_UnitPrice IS NOT NULL AND t_UnitPrice IS NULL THEN 'UnitPrice' END,
         CASE WHEN r_StockQuantity IS NOT NULL AND t_StockQuantity IS NULL THEN 'StockQuantity' END,
         CASE WHEN r_CreatedDate IS NOT NULL AND t_CreatedDate IS NULL THEN 'CreatedDate' END
       ) AS failed_columns
FROM prod_typed""",
    "schema_enforce": LANDED + """
SELECT e_CustomerID AS CustomerID, e_CustomerName AS CustomerName, e_CustomerEmail AS CustomerEmail,
       e_CustomerStatus AS CustomerStatus, e_CreatedDate AS CreatedDate, e_UpdatedDate AS UpdatedDate,
       e_RegionCode AS RegionCode, e_AccountManagerID AS AccountManagerID,
       errs[1] AS _error, CAST(len(errs) AS INTEGER) AS _error_count
FROM cust_flag""",
    "record_hash": LANDED + "SELECT CustomerID, _record_hash FROM bronze_valid",
    "bronze_metadata": f"""
SELECT *, TIMESTAMP '{INGEST_TS}' AS _ingestion_timestamp, '{LANDED_FILE}' AS _source_file,
       'Customers' AS _source_table, {_hash_sql(CUSTOMER_COLS)} AS _record_hash, false AS _is_deleted
FROM customers_src""",
    "bronze_ingest": LANDED + "SELECT * FROM bronze_valid",
    "bronze_quarantine": LANDED + """
SELECT r_CustomerID AS CustomerID, r_CustomerName AS CustomerName, r_CustomerEmail AS CustomerEmail,
       r_CustomerStatus AS CustomerStatus, r_CreatedDate AS CreatedDate, r_UpdatedDate AS UpdatedDate,
       r_RegionCode AS RegionCode, r_AccountManagerID AS AccountManagerID, r_LegacyFlag AS LegacyFlag,
       errs[1] AS _error, CAST(len(errs) AS INTEGER) AS _error_count
FROM cust_flag WHERE len(errs) > 0""",
    "ingestion_stats": LANDED + """
, c AS (SELECT count(*) AS raw_records, count(*) FILTER (WHERE len(errs) = 0) AS bronze_records,
               count(*) FILTER (WHERE len(errs) > 0) AS error_records FROM cust_flag)
SELECT raw_records, bronze_records, error_records,
       CASE WHEN raw_records > 0 THEN round(bronze_records / raw_records * 100, 2) ELSE 0.0 END AS success_rate_pct,
       error_records = 0 AS passed
FROM c""",
    "test_relationships": LANDED + """
SELECT o.order_id, o.customer_id FROM stg_orders o
WHERE o.customer_id IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM bronze_valid b WHERE b.CustomerID = o.customer_id)""",
}

DQ_ID = "OrderID, _ingestion_timestamp"
_RULES = [("standard_order_status", "OrderStatus", "warning"),
          ("not_null_OrderStatus", "OrderStatus", "error"),
          ("allowed_values_OrderStatus", "OrderStatus", "error"),
          ("positive_TotalAmount", "TotalAmount", "warning"),
          ("max_length_ChannelCode", "ChannelCode", "warning"),
          ("not_future_ShipDate", "ShipDate", "warning")]

QUALITY = {
    "dq_not_null": SILVER + f"""
SELECT {DQ_ID}, OrderStatus, coalesce(regexp_matches(OrderStatus, '\\S'), false) AS passed FROM orders_dq""",
    "dq_positive": SILVER + f"""
SELECT {DQ_ID},
       CASE WHEN coalesce(TotalAmount > 0, false) THEN TotalAmount
            ELSE coalesce(abs(TotalAmount), CAST(0 AS DECIMAL(18,2))) END AS TotalAmount,
       coalesce(TotalAmount > 0, false) AS passed FROM orders_dq""",
    "dq_max_length": SILVER + f"""
SELECT {DQ_ID},
       CASE WHEN ChannelCode IS NULL OR length(ChannelCode) <= 6 THEN ChannelCode
            ELSE substring(ChannelCode, 1, 6) END AS ChannelCode,
       coalesce(ChannelCode IS NULL OR length(ChannelCode) <= 6, false) AS passed FROM orders_dq""",
    "dq_in_set": SILVER + f"""
SELECT {DQ_ID}, OrderStatus,
       coalesce(OrderStatus IN ('CANCELLED', 'COMPLETED', 'PENDING', 'RETURNED', 'SHIPPED'), false) AS passed
FROM orders_dq""",
    "dq_not_future": SILVER + f"""
SELECT {DQ_ID}, ShipDate, coalesce(ShipDate IS NULL OR ShipDate <= CAST(now() AS DATE), false) AS passed
FROM orders_dq""",
    "dq_custom_rule": SILVER + f"""
SELECT {DQ_ID},
       CASE WHEN coalesce(OrderStatus = upper(trim(OrderStatus)), false) THEN OrderStatus
            ELSE upper(trim(OrderStatus)) END AS OrderStatus,
       coalesce(OrderStatus = upper(trim(OrderStatus)), false) AS passed FROM orders_dq""",
    "dq_apply_rules": SILVER + "\n UNION ALL ".join(
        f"SELECT {DQ_ID}, '{n}' AS rule, '{c}' AS \"column\", p{i} AS passed, '{s}' AS severity, v{i} AS value FROM dq"
        for i, (n, c, s) in enumerate(_RULES)),
    "dq_clean": SILVER + "SELECT * FROM dq_clean",
    "dq_split_written": SILVER + "SELECT * FROM dq_clean",
    "dq_split_rerun": SILVER + f"""
SELECT {DQ_ID}, CASE WHEN has_error THEN 'rejected' ELSE 'clean' END AS _dq_status FROM dq""",
    "dq_rejected": SILVER + f"""
SELECT {DQ_ID}, OrderStatus, 'not_null_OrderStatus' AS rule, 'OrderStatus' AS "column", v1 AS value
FROM dq WHERE NOT p1
UNION ALL
SELECT {DQ_ID}, OrderStatus, 'allowed_values_OrderStatus' AS rule, 'OrderStatus' AS "column", v2 AS value
FROM dq WHERE NOT p2""",
    "dq_rule_counts": SILVER + "SELECT * FROM (" + "\n UNION ALL ".join(
        f"SELECT '{n}' AS rule, count(*) FILTER (WHERE NOT p{i}) AS failures FROM dq"
        for i, (n, c, s) in enumerate(_RULES)) + ") WHERE failures > 0",
    "silver_stats": SILVER + """
, c AS (SELECT count(*) FILTER (WHERE NOT has_error) AS clean_records,
               count(*) FILTER (WHERE has_error) AS rejected_records FROM dq),
d AS (SELECT (SELECT count(*) FROM dq_clean) - (SELECT count(*) FROM silver_orders) AS removed)
SELECT clean_records + rejected_records AS input_records, clean_records, rejected_records,
       CAST(d.removed AS BIGINT) AS deduplication_removed,
       CASE WHEN clean_records + rejected_records > 0
            THEN round(rejected_records / (clean_records + rejected_records) * 100, 2) ELSE 0.0 END
         AS rejection_rate_pct,
       rejected_records = 0 AS passed
FROM c, d""",
}

_CHANGE_COLS = ORDER_COLS + ["_record_hash", "_ingestion_timestamp"]
CHANGES = {
    "dedup_latest": """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC NULLS LAST, l_extendedprice DESC NULLS LAST,
             l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST) AS rn
  FROM lineitem) WHERE rn = 1""",
    "detect_changes": SILVER + """
, chg AS (
  SELECT """ + ", ".join(f"CASE WHEN c.OrderID IS NOT NULL THEN c.{x} ELSE p.{x} END AS {x}"
                         for x in _CHANGE_COLS) + """,
    CASE WHEN c.OrderID IS NOT NULL THEN coalesce(c._is_deleted, false) ELSE true END AS _is_deleted,
    CASE WHEN c.OrderID IS NOT NULL AND p.OrderID IS NULL THEN 'new'
         WHEN c.OrderID IS NULL THEN 'deleted'
         WHEN c._record_hash IS DISTINCT FROM p._record_hash THEN 'updated'
         ELSE 'unchanged' END AS _change_type
  FROM orders_cur c FULL OUTER JOIN orders_prev p ON c.OrderID IS NOT DISTINCT FROM p.OrderID
)
SELECT * FROM chg""",
    "test_unique": """
SELECT l_orderkey, l_linenumber, count(*) AS occurrences FROM lineitem
WHERE l_orderkey IS NOT NULL AND l_linenumber IS NOT NULL
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
}
CHANGES["test_not_null"] = """
SELECT order_id, order_status FROM stg_orders WHERE order_status IS NULL"""
CHANGES["test_accepted_values"] = """
SELECT customer_id, customer_status FROM stg_customers
WHERE customer_status IS NOT NULL AND customer_status NOT IN ('ACTIVE', 'INACTIVE', 'SUSPENDED')"""
CHANGES["change_counts"] = CHANGES["detect_changes"].replace(
    "SELECT * FROM chg", "SELECT _change_type, count(*) AS records FROM chg GROUP BY _change_type")


def _fmt(x, d):
    return f"printf('%.{d}f', round(CAST({x} AS DOUBLE), {d}))"


def _row_count_sql(table, tol, order, cte="cnt"):
    pct = "(CASE WHEN s > 0 THEN abs(s - t) / s * 100 ELSE 100.0 END)"
    return f"""
SELECT '{table}' AS table_name, 'row_count_{table}' AS check_name, 'silver' AS layer,
  CASE WHEN s = t THEN 'PASS' WHEN {pct} <= {tol} THEN 'WARN' ELSE 'FAIL' END AS status,
  CAST(s AS DOUBLE) AS source_value, CAST(t AS DOUBLE) AS target_value,
  CAST(abs(s - t) AS DOUBLE) AS discrepancy, CAST(NULL AS BIGINT) AS missing, CAST(NULL AS BIGINT) AS extra,
  CASE WHEN s = t THEN 'Row counts match exactly: ' || s
       WHEN {pct} <= {tol} THEN 'Row count within tolerance: source=' || s || ', target=' || t
            || ' (' || {_fmt(pct, 1)} || '% diff ≤ {tol}% tolerance)'
       ELSE 'Row count mismatch: source=' || s || ', target=' || t
            || ' (' || {_fmt(pct, 1)} || '% diff > {tol}% tolerance)' END AS message,
  {order} AS check_order
FROM {cte}"""


def _sum_sql(table, col, order, cte="sums"):
    s, t = f"s_{col}", f"t_{col}"
    diff = f"abs({s} - {t})"
    return f"""
SELECT '{table}' AS table_name, 'col_sum_{col}_{table}' AS check_name, 'silver' AS layer,
  CASE WHEN {diff} <= 0.01 THEN 'PASS' ELSE 'FAIL' END AS status,
  round(CAST({s} AS DOUBLE), 4) AS source_value, round(CAST({t} AS DOUBLE), 4) AS target_value,
  round(CAST({diff} AS DOUBLE), 4) AS discrepancy, CAST(NULL AS BIGINT) AS missing, CAST(NULL AS BIGINT) AS extra,
  CASE WHEN {diff} <= 0.01 THEN 'Column SUM matches: {col} = ' || {_fmt(s, 4)}
       ELSE 'Column SUM mismatch: {col} — source=' || {_fmt(s, 4)} || ', target=' || {_fmt(t, 4)}
            || ', diff=' || {_fmt(diff, 4)} END AS message,
  {order} AS check_order
FROM {cte}"""


def _null_sql(table, col, order, tol=5.0, cte="nulls"):
    s = f"(CASE WHEN sr > 0 THEN sn_{col} / sr * 100 ELSE 0.0 END)"
    t = f"(CASE WHEN tr > 0 THEN tn_{col} / tr * 100 ELSE 0.0 END)"
    diff = f"({t} - {s})"
    body = f"'{col} source=' || {_fmt(s, 1)} || '%, target=' || {_fmt(t, 1)} || '%'"
    return f"""
SELECT '{table}' AS table_name, 'null_rate_{col}_{table}' AS check_name, 'silver' AS layer,
  CASE WHEN {diff} <= 0 THEN 'PASS' WHEN {diff} <= {tol} THEN 'WARN' ELSE 'FAIL' END AS status,
  round({s}, 2) AS source_value, round({t}, 2) AS target_value, round({diff}, 2) AS discrepancy,
  CAST(NULL AS BIGINT) AS missing, CAST(NULL AS BIGINT) AS extra,
  CASE WHEN {diff} <= 0 THEN 'Null rate OK: ' || {body}
       WHEN {diff} <= {tol} THEN 'Null rate slightly higher in target: ' || {body}
            || ' (diff=' || {_fmt(diff, 1)} || '%)'
       ELSE 'Null rate significantly higher in target: ' || {body}
            || ' (diff=' || {_fmt(diff, 1)} || '% > {tol}% tolerance)' END AS message,
  {order} AS check_order
FROM {cte}"""


def _flags_cte(name, col, src, tgt, n, sample_flag=1):
    other = 3 - sample_flag
    return f"""
, {name}_f AS (
  SELECT v, bit_or(f) AS f, count(*) FILTER (WHERE f = 1) AS n1, count(*) FILTER (WHERE f = 2) AS n2
  FROM (SELECT {col} AS v, 1 AS f FROM {src} UNION ALL SELECT {col} AS v, 2 AS f FROM {tgt})
  GROUP BY v
),
{name} AS (
  SELECT sum(n1) AS src_rows, sum(n2) AS tgt_rows,
    count(*) FILTER (WHERE v IS NOT NULL AND f % 2 = 1) AS src_distinct,
    count(*) FILTER (WHERE v IS NOT NULL AND f >= 2) AS tgt_distinct,
    count(*) FILTER (WHERE v IS NOT NULL AND f = 1) AS only_src,
    count(*) FILTER (WHERE v IS NOT NULL AND f = 2) AS only_tgt,
    coalesce((list(v ORDER BY v) FILTER (WHERE v IS NOT NULL AND f = {sample_flag}))[1:{n}], []) AS sample,
    coalesce((list(v ORDER BY v) FILTER (WHERE v IS NOT NULL AND f = {other}))[1:{n}], []) AS sample_other
  FROM {name}_f
)"""


def _list_sql(x, quote):
    item = "'''' || CAST(e AS VARCHAR) || ''''" if quote else "CAST(e AS VARCHAR)"
    return f"('[' || array_to_string(list_transform({x}, lambda e: {item}), ', ') || ']')"


def _distinct_sql(table, col, order, cte, quote):
    return f"""
SELECT '{table}' AS table_name, 'distinct_values_{col}_{table}' AS check_name, 'silver' AS layer,
  CASE WHEN only_src = 0 AND only_tgt = 0 THEN 'PASS' WHEN only_src > 0 THEN 'FAIL' ELSE 'WARN' END AS status,
  CAST(src_distinct AS DOUBLE) AS source_value, CAST(tgt_distinct AS DOUBLE) AS target_value,
  CAST(NULL AS DOUBLE) AS discrepancy, only_src AS missing, only_tgt AS extra,
  CASE WHEN only_src = 0 AND only_tgt = 0 THEN 'Distinct values match: {col} (' || src_distinct || ' values)'
       WHEN only_src > 0 THEN 'Lost distinct values in {col}: ' || {_list_sql('sample', quote)}
            || ' (total=' || only_src || ' missing)'
       ELSE 'New distinct values in target {col}: ' || {_list_sql('sample_other', quote)}
            || ' (not in source)' END AS message,
  {order} AS check_order
FROM {cte}"""


def _pk_sql(table, col, order, cte, quote, require_rows=False):
    where = " WHERE src_rows > 0 AND tgt_rows > 0" if require_rows else ""
    return f"""
SELECT '{table}' AS table_name, 'pk_completeness_{col}_{table}' AS check_name, 'silver' AS layer,
  CASE WHEN only_src = 0 THEN 'PASS' ELSE 'FAIL' END AS status,
  CAST(src_distinct AS DOUBLE) AS source_value, CAST(tgt_distinct AS DOUBLE) AS target_value,
  CAST(NULL AS DOUBLE) AS discrepancy, only_src AS missing, only_tgt AS extra,
  CASE WHEN only_src = 0 THEN 'All ' || src_distinct || ' source PKs present in target'
       ELSE 'Missing PKs in target: ' || only_src || ' keys absent. Sample: ' || {_list_sql('sample', quote)}
       END AS message,
  {order} AS check_order
FROM {cte}{where}"""


RECON_BASE = SILVER + """
, cnt AS (SELECT (SELECT count(*) FROM orders_cur) AS s, (SELECT count(*) FROM silver_orders) AS t),
sums AS (
  SELECT (SELECT coalesce(sum(CAST(TotalAmount AS DECIMAL(38,2))), 0) FROM orders_cur) AS s_TotalAmount,
         (SELECT coalesce(sum(CAST(TotalAmount AS DECIMAL(38,2))), 0) FROM silver_orders) AS t_TotalAmount,
         (SELECT coalesce(sum(CAST(SalesRepID AS DECIMAL(38,0))), 0) FROM orders_cur) AS s_SalesRepID,
         (SELECT coalesce(sum(CAST(SalesRepID AS DECIMAL(38,0))), 0) FROM silver_orders) AS t_SalesRepID
),
nulls AS (
  SELECT (SELECT count(*) FROM orders_cur) AS sr, (SELECT count(*) FROM silver_orders) AS tr,
    (SELECT count(*) FILTER (WHERE OrderStatus IS NULL) FROM orders_cur) AS sn_OrderStatus,
    (SELECT count(*) FILTER (WHERE OrderStatus IS NULL) FROM silver_orders) AS tn_OrderStatus,
    (SELECT count(*) FILTER (WHERE ShipDate IS NULL) FROM orders_cur) AS sn_ShipDate,
    (SELECT count(*) FILTER (WHERE ShipDate IS NULL) FROM silver_orders) AS tn_ShipDate,
    (SELECT count(*) FILTER (WHERE CurrencyCode IS NULL) FROM orders_cur) AS sn_CurrencyCode,
    (SELECT count(*) FILTER (WHERE CurrencyCode IS NULL) FROM silver_orders) AS tn_CurrencyCode
)""" + _flags_cte("pk", "OrderID", "orders_cur", "silver_orders", 3) \
    + _flags_cte("dch", "ChannelCode", "orders_cur", "silver_orders", 5) \
    + _flags_cte("dcu", "CurrencyCode", "orders_cur", "silver_orders", 5)

_FULL = "\nUNION ALL\n".join([
    _row_count_sql("orders", 5.0, 0),
    _pk_sql("orders", "OrderID", 1, "pk", False, require_rows=True),
    _sum_sql("orders", "TotalAmount", 2),
    _sum_sql("orders", "SalesRepID", 3),
    _null_sql("orders", "OrderStatus", 4),
    _null_sql("orders", "ShipDate", 5),
    _null_sql("orders", "CurrencyCode", 6),
    _distinct_sql("orders", "ChannelCode", 7, "dch", True),
    _distinct_sql("orders", "CurrencyCode", 8, "dcu", True),
])

_PCT_SIMPLE = "(CASE WHEN s > 0 THEN abs(s - t) / s * 100 ELSE 100.0 END)"
RECON = {
    "recon_row_count_simple": RECON_BASE + f"""
SELECT s AS source_count, t AS target_count, {_PCT_SIMPLE} <= 5.0 AS count_match,
       abs(s - t) AS discrepancy, round({_PCT_SIMPLE}, 2) AS discrepancy_pct,
       {_PCT_SIMPLE} <= 5.0 AS passed,
       CASE WHEN {_PCT_SIMPLE} <= 5.0
            THEN 'PASS: row counts match within 5.0% tolerance (source=' || s || ', target=' || t || ')'
            ELSE 'FAIL: row count mismatch — source=' || s || ', target=' || t || ', discrepancy='
                 || abs(s - t) || ' (' || {_fmt(_PCT_SIMPLE, 1)} || '%)' END AS message
FROM cnt""",
    "recon_row_count": RECON_BASE + _row_count_sql("orders", 5.0, 0),
    "recon_checksums": RECON_BASE + "\nUNION ALL\n".join(f"""
SELECT '{c}' AS "column", round(CAST(s_{c} AS DOUBLE), 4) AS source_sum,
       round(CAST(t_{c} AS DOUBLE), 4) AS target_sum,
       round(CAST(abs(s_{c} - t_{c}) AS DOUBLE), 4) AS difference,
       abs(s_{c} - t_{c}) < 0.01 AS passed,
       CASE WHEN abs(s_{c} - t_{c}) < 0.01 THEN 'PASS'
            ELSE 'FAIL: sum mismatch (' || {_fmt(f'abs(s_{c} - t_{c})', 4)} || ' difference)' END AS message
FROM sums""" for c in ("TotalAmount", "SalesRepID")),
    "recon_column_sum": RECON_BASE + _sum_sql("orders", "TotalAmount", 0),
    "recon_null_rate": RECON_BASE + _null_sql("orders", "ShipDate", 0),
    "recon_distinct_values": RECON_BASE + _distinct_sql("orders", "ChannelCode", 0, "dch", True),
    "recon_pk_completeness": RECON_BASE + _pk_sql("orders", "OrderID", 0, "pk", False),
    "recon_full": RECON_BASE + _FULL,
    "recon_report_summary": RECON_BASE + f"""
, rep AS ({_FULL}),
g AS (SELECT table_name, count(*) FILTER (WHERE status = 'PASS') AS passed,
             count(*) FILTER (WHERE status = 'WARN') AS warned,
             count(*) FILTER (WHERE status = 'FAIL') AS failed FROM rep GROUP BY table_name)
SELECT table_name, passed, warned, failed,
       CASE WHEN failed > 0 THEN 'FAIL' WHEN warned > 0 THEN 'WARN' ELSE 'PASS' END AS overall_status,
       'Reconciliation [' || table_name || ']: ' || passed || ' PASS / ' || warned || ' WARN / '
         || failed || ' FAIL — Overall: '
         || CASE WHEN failed > 0 THEN 'FAIL' WHEN warned > 0 THEN 'WARN' ELSE 'PASS' END AS summary
FROM g""",
}


def _wm_sql(table, expr, prev, src, ingestion_date=None):
    extra = f", DATE '{ingestion_date}' AS ingestion_date" if ingestion_date else ""
    return f"""
SELECT 'dbo.{table}' AS table_name, '{expr}' AS watermark_column, '{prev}' AS previous_watermark,
       coalesce(CAST(max({expr}) AS VARCHAR), '{prev}') AS new_watermark,
       count(*) AS rows_extracted{extra}
FROM {src}_src WHERE {expr} > CAST('{prev}' AS {{t}})"""


_WM = [("Orders", "OrderDate", "orders", "DATE"),
       ("Customers", "coalesce(UpdatedDate, CreatedDate)", "customers", "TIMESTAMP"),
       ("Products", "CreatedDate", "products", "TIMESTAMP")]

EXTRACT = {
    "extract_full": "SELECT * FROM orders_src",
    "extract_incremental": "SELECT * FROM orders_src WHERE OrderDate > DATE '1998-06-30'",
    "extract_incremental_customers": """
SELECT * FROM customers_src WHERE coalesce(UpdatedDate, CreatedDate) > TIMESTAMP '2022-06-01 00:00:00'""",
    "ingest_suite_two_loads": "SELECT * FROM orders_src WHERE OrderDate IS NOT NULL",
    "merge_partitions_moved": """
, m AS (SELECT *, OrderStatus IS NOT DISTINCT FROM 'pending ' AS p, month(OrderDate) AS mon FROM orders_src)
SELECT OrderID, CAST(TotalAmount + CASE WHEN p THEN 2 ELSE 0 END AS DECIMAL(18,2)) AS TotalAmount,
       lpad(CAST(CASE WHEN p THEN mon % 12 + 1 ELSE mon END AS VARCHAR), 2, '0') AS slot,
       CASE WHEN p THEN true END AS moved, CASE WHEN p THEN 2 END AS seq
FROM m""",
    "watermark_advance": "\nUNION ALL\n".join(
        _wm_sql(t, e, m, s).replace("{t}", ty) for (t, e, s, ty), m in
        zip(_WM, ["1998-06-30", "2022-06-01 00:00:00", "2021-09-01 00:00:00"])),
    "ingest_suite": "\nUNION ALL\n".join(
        _wm_sql(t, e, "1900-01-01 00:00:00", s, "2024-03-01").replace("{t}", ty)
        for (t, e, s, ty) in _WM),
    "write_partitioned": GOLD["fct_daily_sales"],
    "fct_refresh": """
, o AS (
  SELECT order_id, customer_id, product_id, order_status, channel_code, ship_date, is_shipped, order_date AS old_date,
         coalesce(order_status, '') AS st,
         CAST(CASE WHEN order_status = 'COMPLETED' AND year(order_date) = 1997 AND month(order_date) = 5
              THEN order_date + INTERVAL 12 MONTH ELSE order_date END AS DATE) AS order_date,
         CAST(CASE WHEN order_status = 'COMPLETED' AND year(order_date) = 1996 AND month(order_date) = 2
              THEN total_amount + 1 ELSE total_amount END AS DECIMAL(18,2)) AS total_amount
  FROM stg_orders
),
e AS (
  SELECT o.*, c.customer_status,
         CASE WHEN c.customer_id % 500 = 0 THEN 'MOVED' ELSE c.region_code END AS region_code,
         CAST(CASE WHEN p.product_id % 700 = 0 THEN 9 ELSE p.category_id END AS INTEGER) AS category_id,
         CAST(datediff('day', o.order_date, o.ship_date) AS INTEGER) AS days_to_ship
  FROM o LEFT JOIN stg_customers c ON o.customer_id = c.customer_id
  LEFT JOIN stg_products p ON o.product_id = p.product_id
  WHERE coalesce(NOT (year(old_date) = 1995 AND st = 'PENDING'), false)
)""" + GOLD["fct_daily_sales"].replace("FROM int_order_enriched", "FROM e"),
    "extract_ranges": """
SELECT count(*) AS landed, count(*) FILTER (WHERE ProductID IS NULL AND OrderID % 3 <> 0) AS null_keys,
       CAST(sum(OrderID) AS DECIMAL(38,0)) AS id_sum, CAST(0 AS BIGINT) AS rows_without_range, true AS even
FROM orders_src""",
    "merge_upsert": CHANGES["detect_changes"].replace("SELECT * FROM chg", f"""
SELECT {SNAP}, _record_hash, _ingestion_timestamp, _is_deleted FROM orders_prev p
WHERE NOT EXISTS (SELECT 1 FROM chg WHERE chg._change_type <> 'unchanged'
                  AND chg.OrderID IS NOT DISTINCT FROM p.OrderID)
UNION ALL
SELECT {SNAP}, _record_hash, _ingestion_timestamp, _is_deleted FROM chg
WHERE _change_type <> 'unchanged'"""),
    "merge_partitions": CHANGES["detect_changes"].replace("SELECT * FROM chg", f"""
SELECT {SNAP}, _record_hash, _ingestion_timestamp, _is_deleted,
       CAST(year(OrderDate) AS INTEGER) AS order_year FROM orders_prev p
WHERE NOT EXISTS (SELECT 1 FROM chg WHERE chg._change_type <> 'unchanged'
                  AND chg.OrderID IS NOT DISTINCT FROM p.OrderID)
UNION ALL
SELECT {SNAP}, _record_hash, _ingestion_timestamp, _is_deleted,
       CAST(year(OrderDate) AS INTEGER) AS order_year FROM chg
WHERE _change_type <> 'unchanged'"""),
    "audit_columns": """
SELECT product_id, '2024-03-01 06:00:00' AS loaded_at, 'run-1' AS run_id, CAST(NULL AS BIGINT) AS load_times,
       CAST(NULL AS BOOLEAN) AS loaded_now
FROM stg_products
UNION ALL SELECT NULL, NULL, 'run-2', CAST(1 AS BIGINT), true""",
    "merge_indexed": CHANGES["detect_changes"].replace("SELECT * FROM chg", """
, merged AS (
  SELECT OrderID, TotalAmount, OrderDate, _is_deleted FROM orders_prev p
  WHERE NOT EXISTS (SELECT 1 FROM chg WHERE chg._change_type <> 'unchanged'
                    AND chg.OrderID IS NOT DISTINCT FROM p.OrderID)
  UNION ALL
  SELECT OrderID, TotalAmount, OrderDate, _is_deleted FROM chg WHERE _change_type <> 'unchanged'),
moved AS (SELECT OrderID, TotalAmount, CAST(OrderDate + INTERVAL 12 MONTH AS DATE) AS OrderDate, _is_deleted
          FROM orders_cur WHERE year(OrderDate) = 1996 AND month(OrderDate) = 3),
both_merges AS (
  SELECT * FROM merged WHERE OrderID NOT IN (SELECT OrderID FROM moved) UNION ALL SELECT * FROM moved)
SELECT *, CAST(year(OrderDate) AS INTEGER) AS order_year FROM both_merges"""),
    "merge_schema_evolution": """
SELECT order_id, order_date, total_amount,
       CASE WHEN order_date < DATE '1998-01-01' THEN NULL ELSE channel_code END AS channel_code
FROM stg_orders""",
    "bronze_table": BRONZE["bronze_ingest"],
    "bronze_split_written": BRONZE["bronze_ingest"],
    "stream_bronze_ingest": BRONZE["bronze_ingest"],
    "stream_bronze_quarantine": BRONZE["bronze_quarantine"],
    "ingest_suite_retry": """
SELECT *, CASE WHEN OrderDate < DATE '1998-01-01' THEN DATE '2024-03-02' ELSE DATE '2024-03-03' END AS ingestion_date
FROM orders_src WHERE OrderDate IS NOT NULL""",
    "stream_upsert": LANDED + """
SELECT CustomerID, CASE WHEN AccountManagerID % 2 = 0 THEN 'moved' ELSE CustomerStatus END AS CustomerStatus,
       CASE WHEN AccountManagerID % 2 = 0 THEN 'NEW ' || RegionCode ELSE RegionCode END AS RegionCode, AccountManagerID
FROM bronze_valid""",
    "dq_raising_rule": SILVER + f"""
SELECT {DQ_ID}, CASE WHEN upper(trim(ChannelCode)) = 'DIRECT' THEN 'DIR' ELSE ChannelCode END AS ChannelCode,
       coalesce(upper(trim(ChannelCode)) IN ('ONLINE', 'PHONE'), false) AS passed FROM orders_dq""",
    "dq_not_future_text": SILVER + f"""
SELECT {DQ_ID}, CAST(ShipDate AS VARCHAR) AS ShipDate,
       ShipDate IS NULL OR CAST(ShipDate AS VARCHAR) <= '1998-06-01T00:00:00.000000' AS passed FROM orders_dq""",
    "recon_key_drilldown": SILVER + """
SELECT * FROM (
  SELECT coalesce(s.OrderID, t.OrderID) AS OrderID,
    CASE WHEN t.OrderID IS NULL THEN 'only_source' WHEN s.OrderID IS NULL THEN 'only_target'
         WHEN s.TotalAmount IS DISTINCT FROM t.TotalAmount OR s.CurrencyCode IS DISTINCT FROM t.CurrencyCode THEN 'differs' END AS difference
  FROM orders_cur s FULL OUTER JOIN silver_orders t ON s.OrderID = t.OrderID)
WHERE difference IS NOT NULL""",
}


def oracle_sql() -> dict[str, str]:
    out = {}
    for group in (GOLD, BRONZE, QUALITY, CHANGES, RECON, EXTRACT):
        for k, body in group.items():
            out[k] = _with_adapter(body)
    return out
