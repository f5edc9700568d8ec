"""Gold-layer models (staging -> intermediate -> marts) as DataFrame functions."""
from lakeshift.plans.staging import stg_orders, stg_customers, stg_products  # noqa: F401
from lakeshift.plans.intermediate import int_order_enriched, order_size_category  # noqa: F401
from lakeshift.plans.marts import (  # noqa: F401
    fct_daily_sales, dim_customer, customer_order_stats, exclude_statuses,
    EXCLUDED_STATUSES,
)
from lakeshift.plans.audit import Audit, with_audit  # noqa: F401
