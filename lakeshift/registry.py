"""Registered queries: one callable ``(spark, sf_dir) -> DataFrame`` per operator.

Each query reads the driver's tables (through ``lakeshift.sources.adapter``) in full;
computed columns carry the same names as the DuckDB oracle in ``lakeshift.oracle``.
"""
from __future__ import annotations

from collections.abc import Callable
from dataclasses import replace as _replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from lakeshift.functions.coerce import coerce, coercion_failed
from lakeshift.operators import bronze as B
from lakeshift.operators import quality as Q
from lakeshift.operators import reconcile as R
from lakeshift.operators.changes import change_counts, detect_changes
from lakeshift.operators.datatests import (test_accepted_values, test_not_null,
                                           test_relationships, test_unique)
from lakeshift.operators.dedup import dedup_latest, duplicates_removed
from lakeshift.plans import (
    stg_orders, stg_customers, stg_products, int_order_enriched, fct_daily_sales,
    dim_customer, customer_order_stats, exclude_statuses,
)
from lakeshift.plans.audit import Audit
from lakeshift.plans.refresh import refresh_daily_sales, touched_days
from lakeshift.session import scratch_path
from lakeshift.sinks import write as W
from lakeshift.sources import adapter as A
from lakeshift.sources import extract as X
from lakeshift.sources import loads as L
from lakeshift.sources import ranges as K
from lakeshift.spec import CUSTOMERS, ORDERS, PRODUCTS, ColumnSpec
from lakeshift.streaming.ingest import incremental_ingest, incremental_upsert, read_bronze

Query = Callable[[SparkSession, str], DataFrame]


# ── gold ────────────────────────────────────────────────────────────────────
def q_stg_orders(spark, d):
    return stg_orders(A.orders_source(spark, d))


def q_stg_customers(spark, d):
    return stg_customers(A.customers_source(spark, d))


def q_stg_products(spark, d):
    return stg_products(A.products_source(spark, d))


def q_int_order_enriched(spark, d):
    return int_order_enriched(q_stg_orders(spark, d), q_stg_customers(spark, d),
                              q_stg_products(spark, d))


def q_fct_daily_sales(spark, d):
    return fct_daily_sales(q_int_order_enriched(spark, d))


def q_dim_customer(spark, d):
    return dim_customer(q_stg_customers(spark, d), q_stg_orders(spark, d))


def q_agg_customer_orders(spark, d):
    return customer_order_stats(q_stg_orders(spark, d))


def q_filter_not_in(spark, d):
    return exclude_statuses(q_stg_orders(spark, d)).select(
        "order_id", "customer_id", "order_status", "total_amount")


def q_case_order_size(spark, d):
    e = q_int_order_enriched(spark, d)
    return e.groupBy("order_size_category").agg(
        F.count(F.lit(1)).alias("orders"),
        F.sum("total_amount").alias("total_amount"),
        F.count_if(F.col("product_id").isNull() | F.col("unit_price").isNull())
        .alias("without_price"))


QUERIES: dict[str, Query] = {
    "stg_orders": q_stg_orders,
    "stg_customers": q_stg_customers,
    "stg_products": q_stg_products,
    "int_order_enriched": q_int_order_enriched,
    "fct_daily_sales": q_fct_daily_sales,
    "dim_customer": q_dim_customer,
    "agg_customer_orders": q_agg_customer_orders,
    "filter_not_in": q_filter_not_in,
    "case_order_size": q_case_order_size,
}


def queries() -> dict[str, Query]:
    return dict(QUERIES)


# ── bronze ──────────────────────────────────────────────────────────────────


# Ingestion time used by the registered bronze queries (reproducible).
INGEST_TS = "2024-03-01 06:00:00"
# The bronze spec for landed customers: a default for a missing email.
CUSTOMERS_BRONZE = _replace(CUSTOMERS, columns=tuple(
    ColumnSpec(c.name, c.dtype, c.nullable, "unknown@example.com")
    if c.name == "CustomerEmail" else c for c in CUSTOMERS.columns))


def q_type_coerce(spark, d):
    raw = A.products_landed_text(spark, d)
    types = dict((f.name, f.dataType) for f in raw.schema.fields)
    cols, failed = [], []
    for c in PRODUCTS.columns:
        v = coerce(F.col(c.name), c.dtype, types[c.name])
        cols.append(v.alias(c.name))
        failed.append(F.when(coercion_failed(F.col(c.name), v), F.lit(c.name)))
    return raw.select(F.col("ProductID").alias("raw_id"), *cols,
                      F.concat_ws(",", *failed).alias("failed_columns"))


def q_schema_enforce(spark, d):
    e = B.enforce_schema(A.customers_landed_text(spark, d), CUSTOMERS_BRONZE)
    return e.select(*CUSTOMERS_BRONZE.column_names(),
                    F.get(F.col(B.ERRORS), 0).alias("_error"), F.size(B.ERRORS).alias("_error_count"))


def _bronze_batch(spark, d):
    return B.ingest_batch(A.customers_landed_text(spark, d), CUSTOMERS_BRONZE,
                          A.LANDED_FILE, INGEST_TS)


def q_record_hash(spark, d):
    return _bronze_batch(spark, d).valid.select("CustomerID", "_record_hash")


def q_bronze_metadata(spark, d):
    return B.add_bronze_metadata(A.customers_source(spark, d), "Customers", A.LANDED_FILE,
                                 INGEST_TS)


def q_bronze_ingest(spark, d):
    return _bronze_batch(spark, d).valid


def q_bronze_quarantine(spark, d):
    return _bronze_batch(spark, d).quarantine


def q_ingestion_stats(spark, d):
    return _bronze_batch(spark, d).stats()


# ── silver: quality rules ───────────────────────────────────────────────────
# The order status domain and the channel code length limit.
ORDER_STATUSES = ("COMPLETED", "PENDING", "SHIPPED", "CANCELLED", "RETURNED")
CHANNEL_MAX_LEN = 6
DQ_ID = ("OrderID", "_ingestion_timestamp")


def standard_status_rule() -> Q.DQRule:
    """User rule: status text must be trimmed upper case; the fix standardises it."""
    return Q.DQRule("standard_order_status", "OrderStatus",
                    lambda c: c == F.upper(F.trim(c)), lambda c: F.upper(F.trim(c)),
                    severity=Q.WARNING)


def silver_order_rules() -> list[Q.DQRule]:
    return [standard_status_rule(),
            Q.not_null_rule("OrderStatus"),
            Q.value_in_set_rule("OrderStatus", ORDER_STATUSES),
            Q.positive_numeric_rule("TotalAmount"),
            Q.max_length_rule("ChannelCode", CHANNEL_MAX_LEN),
            Q.date_not_future_rule("ShipDate")]


def _one_rule(rule_fn, column):
    def q(spark, d):
        out = Q.check_rule(A.orders_dq_input(spark, d), rule_fn())
        return out.select(*DQ_ID, F.col(column), "passed")
    return q


def _silver_batch(spark, d):
    return Q.process_batch(A.orders_dq_input(spark, d), silver_order_rules())


def q_dq_apply_rules(spark, d):
    return _silver_batch(spark, d).results(*DQ_ID)


def q_dq_clean(spark, d):
    return _silver_batch(spark, d).clean


def q_dq_rejected(spark, d):
    r = _silver_batch(spark, d).rejected
    return (r.select(*DQ_ID, "OrderStatus", F.explode(Q.DQ_ERRORS).alias("e"))
            .select(*DQ_ID, "OrderStatus", F.col("e.rule").alias("rule"),
                    F.col("e.column").alias("column"), F.col("e.value").alias("value")))


def q_dq_rule_counts(spark, d):
    return _silver_batch(spark, d).rule_counts()


def silver_orders(spark, d):
    """Silver Orders: clean rows of the bronze history, latest version per order. (An order is once in a
    snapshot, so a stored column settles ties; the record hash would have to be computed for every check.)"""
    return dedup_latest(_silver_batch(spark, d).clean, ["OrderID"], "_ingestion_timestamp", ["TotalAmount"])


def q_silver_stats(spark, d):
    b = _silver_batch(spark, d)
    removed = duplicates_removed(b.clean, ["OrderID"])
    counts = R._combine_rows([b.counts(), removed])
    return Q.silver_stats(counts, F.col("deduplication_removed"))


# ── dedup / change detection ────────────────────────────────────────────────
def q_dedup_latest(spark, d):
    li = A._read(spark, d, "lineitem")
    return dedup_latest(li, ["l_orderkey", "l_linenumber"], "l_shipdate",
                        ["l_extendedprice", "l_partkey", "l_suppkey"])


def _changes(spark, d):
    return detect_changes(A.orders_current(spark, d), A.orders_previous(spark, d), "OrderID")


def q_detect_changes(spark, d):
    return _changes(spark, d)


def q_change_counts(spark, d):
    return change_counts(_changes(spark, d))


# ── reconciliation: source snapshot vs silver orders ───────────────────────
RECON_NUMERIC = ["TotalAmount", "SalesRepID"]
RECON_NULLABLE = ["OrderStatus", "ShipDate", "CurrencyCode"]
RECON_DISTINCT = ["ChannelCode", "CurrencyCode"]


def _pair(spark, d, materialized: bool = False):
    """Source snapshot and silver target. Single-pass checks read the lazy plans (one
    job computes both sides once). The full suite makes four independent passes (scalar
    profile, key flags, two value-flag aggregations), so there both sides are written
    once to the shared folder, as pipeline tables are, and each pass scans only the
    columns it needs instead of recomputing the quality + dedup lineage."""
    s, t = A.orders_current(spark, d), silver_orders(spark, d)
    if not materialized:
        return s, t
    from lakeshift.sinks.write import materialize
    return materialize(s, "recon/source_orders"), materialize(t, "recon/silver_orders")


def q_recon_row_count_simple(spark, d):
    s, t = _pair(spark, d)
    return R.reconcile_row_counts(s, t, 5.0)


def q_recon_row_count(spark, d):
    s, t = _pair(spark, d)
    return R.check_row_count(s, t, "orders", 5.0)


def q_recon_checksums(spark, d):
    s, t = _pair(spark, d)
    return R.reconcile_column_checksums(s, t, RECON_NUMERIC)


def q_recon_column_sum(spark, d):
    s, t = _pair(spark, d)
    return R.check_column_sum(s, t, "TotalAmount", "orders")


def q_recon_null_rate(spark, d):
    s, t = _pair(spark, d)
    return R.check_null_rate(s, t, "ShipDate", "orders")


def q_recon_distinct_values(spark, d):
    s, t = _pair(spark, d)
    return R.check_distinct_values(s, t, "ChannelCode", "orders")


def q_recon_pk_completeness(spark, d):
    s, t = _pair(spark, d)
    return R.check_primary_key_completeness(s, t, "OrderID", "orders")


def q_recon_full(spark, d):
    s, t = _pair(spark, d, materialized=True)
    return R.run_full_reconciliation(s, t, "orders", "OrderID", RECON_NUMERIC, RECON_NULLABLE,
                                     RECON_DISTINCT, 5.0)


def q_recon_report_summary(spark, d):
    return R.report_summary(q_recon_full(spark, d))


# ── data tests ──────────────────────────────────────────────────────────────
def q_test_unique(spark, d):
    return test_unique(A._read(spark, d, "lineitem"), ["l_orderkey", "l_linenumber"])


def q_test_relationships(spark, d):
    """Orders whose customer did not make it into bronze (quarantined rows)."""
    return test_relationships(q_stg_orders(spark, d), "customer_id", q_bronze_ingest(spark, d),
                              "CustomerID").select("order_id", "customer_id")


QUERIES.update({
    "type_coerce": q_type_coerce,
    "schema_enforce": q_schema_enforce,
    "record_hash": q_record_hash,
    "bronze_metadata": q_bronze_metadata,
    "bronze_ingest": q_bronze_ingest,
    "bronze_quarantine": q_bronze_quarantine,
    "ingestion_stats": q_ingestion_stats,
    "dq_not_null": _one_rule(lambda: Q.not_null_rule("OrderStatus"), "OrderStatus"),
    "dq_positive": _one_rule(lambda: Q.positive_numeric_rule("TotalAmount"), "TotalAmount"),
    "dq_max_length": _one_rule(lambda: Q.max_length_rule("ChannelCode", CHANNEL_MAX_LEN),
                               "ChannelCode"),
    "dq_in_set": _one_rule(lambda: Q.value_in_set_rule("OrderStatus", ORDER_STATUSES),
                           "OrderStatus"),
    "dq_not_future": _one_rule(lambda: Q.date_not_future_rule("ShipDate"), "ShipDate"),
    "dq_custom_rule": _one_rule(standard_status_rule, "OrderStatus"),
    "dq_apply_rules": q_dq_apply_rules,
    "dq_clean": q_dq_clean,
    "dq_rejected": q_dq_rejected,
    "dq_rule_counts": q_dq_rule_counts,
    "silver_stats": q_silver_stats,
    "dedup_latest": q_dedup_latest,
    "detect_changes": q_detect_changes,
    "change_counts": q_change_counts,
    "recon_row_count_simple": q_recon_row_count_simple,
    "recon_row_count": q_recon_row_count,
    "recon_checksums": q_recon_checksums,
    "recon_column_sum": q_recon_column_sum,
    "recon_null_rate": q_recon_null_rate,
    "recon_distinct_values": q_recon_distinct_values,
    "recon_pk_completeness": q_recon_pk_completeness,
    "recon_full": q_recon_full,
    "recon_report_summary": q_recon_report_summary,
    "test_unique": q_test_unique,
    "test_relationships": q_test_relationships,
})


# ── extract / sinks / streaming (write, then read back) ─────────────────────

# Marks and dates used by the registered extract queries.
ORDERS_MARK = "1998-06-30"
CUSTOMERS_MARK = "2022-06-01 00:00:00"
PRODUCTS_MARK = "2021-09-01 00:00:00"
INGESTION_DATE = "2024-03-01"
SOURCE_DB = "LegacyDB"


def _landed_source(spark, d, spec, frame) -> X.SourceConfig:
    """Materialise a derived source table as Parquet in the shared folder (the
    'source system'), and describe it as an extract source."""
    path = scratch_path(spark, f"source/{spec.table_name}")
    frame.write.mode("overwrite").parquet(path)
    return X.SourceConfig(spec, "parquet", path)


def q_extract_full(spark, d):
    return X.extract_full(spark, _landed_source(spark, d, ORDERS, A.orders_source(spark, d)))


def q_extract_incremental(spark, d):
    cfg = _landed_source(spark, d, ORDERS, A.orders_source(spark, d))
    return X.extract_incremental(spark, cfg, ORDERS_MARK)


def q_watermark_advance(spark, d):
    frames = []
    for spec, frame, mark in ((ORDERS, A.orders_source(spark, d), ORDERS_MARK),
                              (CUSTOMERS, A.customers_source(spark, d), CUSTOMERS_MARK),
                              (PRODUCTS, A.products_source(spark, d), PRODUCTS_MARK)):
        cfg = _landed_source(spark, d, spec, frame)
        frames.append(X.watermark_frame(X.extract_incremental(spark, cfg, mark), cfg, mark))
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def q_ingest_suite(spark, d):
    cfgs = [X.SourceConfig(ORDERS, "dataframe", dataframe=A.orders_source(spark, d)),
            X.SourceConfig(CUSTOMERS, "dataframe", dataframe=A.customers_source(spark, d)),
            X.SourceConfig(PRODUCTS, "dataframe", dataframe=A.products_source(spark, d))]
    return X.ingest_suite(spark, cfgs, scratch_path(spark, "landing"), SOURCE_DB, INGESTION_DATE)


def q_write_partitioned(spark, d):
    fct = q_fct_daily_sales(spark, d)
    path = scratch_path(spark, "gold/fct_daily_sales")
    W.write_table(fct, path, "overwrite", partition_by="order_date")
    # Rerun for the latest year only: dynamic partition overwrite replaces just those days.
    W.write_table(fct.filter(F.col("order_date") >= F.lit("2001-01-01").cast("date")),
                  path, "overwrite", partition_by="order_date")
    return spark.read.schema(fct.schema).parquet(path)


def q_merge_upsert(spark, d):
    target_path = scratch_path(spark, "silver/orders")
    W.write_table(A.orders_previous(spark, d), target_path, "overwrite")
    target = spark.read.parquet(target_path)
    changes = detect_changes(A.orders_current(spark, d), target, "OrderID")
    out_path = scratch_path(spark, "silver/orders_v2")
    W.write_table(W.apply_changes(target, changes, ["OrderID"]), out_path, "overwrite")
    return spark.read.parquet(out_path)


def q_merge_schema_evolution(spark, d):
    stg = q_stg_orders(spark, d)
    path = scratch_path(spark, "bronze/orders_evolving")
    cut = F.lit("1998-01-01").cast("date")
    W.append_evolving(stg.filter(F.col("order_date") < cut)
                      .select("order_id", "order_date", "total_amount"), path)
    W.append_evolving(stg.filter(F.col("order_date") >= cut)
                      .select("order_id", "order_date", "total_amount", "channel_code"), path)
    return W.read_evolving(spark, path).select("order_id", "order_date", "total_amount",
                                               "channel_code")


def q_bronze_table(spark, d):
    import uuid
    name = f"bronze_customers_{uuid.uuid4().hex[:8]}"
    path = scratch_path(spark, f"bronze/{name}")
    W.create_bronze_table(spark, name, CUSTOMERS_BRONZE, path)
    valid = _bronze_batch(spark, d).valid
    valid.select(*spark.table(name).columns).write.insertInto(name)
    return spark.table(name)


def q_stream_bronze_ingest(spark, d):
    raw = A.customers_landed_text(spark, d)
    landing = scratch_path(spark, "landing/customers")
    raw.write.mode("overwrite").parquet(landing)
    bronze, quarantine = scratch_path(spark, "bronze/customers"), scratch_path(spark, "quarantine")
    incremental_ingest(spark, landing, raw.schema, CUSTOMERS_BRONZE, bronze, quarantine,
                       scratch_path(spark, "checkpoints/customers"), A.LANDED_FILE, INGEST_TS)
    return read_bronze(spark, bronze)


QUERIES.update({
    "extract_full": q_extract_full,
    "extract_incremental": q_extract_incremental,
    "watermark_advance": q_watermark_advance,
    "ingest_suite": q_ingest_suite,
    "write_partitioned": q_write_partitioned,
    "merge_upsert": q_merge_upsert,
    "merge_schema_evolution": q_merge_schema_evolution,
    "bronze_table": q_bronze_table,
    "stream_bronze_ingest": q_stream_bronze_ingest,
})


def q_merge_partitions(spark, d):
    """Soft-delete change set merged into a year-partitioned silver table in place:
    only the years the changes touch are rewritten."""
    year = F.year("OrderDate").alias("order_year")
    path = scratch_path(spark, "silver/orders_by_year")
    prev = A.orders_previous(spark, d)
    W.write_table(prev.select("*", year), path, "overwrite", partition_by="order_year")
    changes = detect_changes(A.orders_current(spark, d), prev, "OrderID")
    delta = (changes.filter(F.col("_change_type") != "unchanged").drop("_change_type")
             .select("*", year))
    W.merge_partitions(spark, path, delta, ["OrderID"], "order_year")
    return spark.read.parquet(path)


QUERIES["merge_partitions"] = q_merge_partitions


# Customer statuses accepted by the dimension's data test.
ACCEPTED_CUSTOMER_STATUSES = ("ACTIVE", "INACTIVE", "SUSPENDED")


def q_test_not_null(spark, d):
    return test_not_null(q_stg_orders(spark, d), "order_status").select(
        "order_id", "order_status")


def q_test_accepted_values(spark, d):
    return test_accepted_values(q_stg_customers(spark, d), "customer_status",
                                ACCEPTED_CUSTOMER_STATUSES).select(
        "customer_id", "customer_status")


QUERIES["test_not_null"] = q_test_not_null
QUERIES["test_accepted_values"] = q_test_accepted_values


def q_dq_split_written(spark, d):
    """Clean rows read back from the one-pass split write (partition ``clean``)."""
    path = scratch_path(spark, "silver/orders_dq")
    _silver_batch(spark, d).write_split(path)
    return (spark.read.parquet(path).filter(F.col(Q.DQ_STATUS) == "clean")
            .drop(Q.DQ_STATUS, Q.DQ_ERRORS))


QUERIES["dq_split_written"] = q_dq_split_written


def q_bronze_split_written(spark, d):
    """Valid rows read back from the one-pass valid / quarantine write."""
    path = scratch_path(spark, "bronze/customers_split")
    _bronze_batch(spark, d).write_split(path)
    return (spark.read.parquet(path).filter(F.col(B.STATUS) == "valid")
            .drop(B.STATUS, B.RAW, B.ERRORS))


QUERIES["bronze_split_written"] = q_bronze_split_written


def q_dq_split_rerun(spark, d):
    """Both sides of the split table after a second, different batch replaced the first."""
    path = scratch_path(spark, "silver/orders_dq_rerun")
    Q.process_batch(A.orders_dq_input(spark, d).withColumn("OrderStatus", F.lit(None).cast("string")),
                    silver_order_rules()).write_split(path)
    _silver_batch(spark, d).write_split(path)
    return spark.read.parquet(path).select(*DQ_ID, Q.DQ_STATUS)


def q_extract_incremental_customers(spark, d):
    cfg = _landed_source(spark, d, CUSTOMERS, A.customers_source(spark, d))
    return X.extract_incremental(spark, cfg, CUSTOMERS_MARK)


def q_ingest_suite_two_loads(spark, d):
    """Orders landed by two loads of one day, the second from the mark the first stored."""
    root = scratch_path(spark, "landing")
    orders = A.orders_source(spark, d)
    for batch in (orders.filter(F.col("OrderDate") < F.lit("1998-01-01").cast("date")), orders):
        cfg = X.SourceConfig(ORDERS, "dataframe", dataframe=batch)
        X.ingest_suite(spark, [cfg], root, SOURCE_DB, INGESTION_DATE, marks_path=f"{root}/marks")
    return L.read_landed(spark, f"{root}/raw/{SOURCE_DB}/Orders", f"{root}/marks", ORDERS.qualified_name).select(*orders.columns)


def q_merge_partitions_moved(spark, d):
    """Pending orders move to the next month's text partition, gain columns and come twice."""
    path = scratch_path(spark, "silver/orders_by_slot")
    orders = A.orders_source(spark, d)
    slot = lambda m: F.lpad(m.cast("string"), 2, "0").alias("slot")
    month = F.month("OrderDate")
    W.write_table(orders.select("OrderID", "TotalAmount", slot(month)), path, "overwrite", partition_by="slot")
    pending = orders.filter(F.col("OrderStatus") == "pending ")
    updates = pending.select(
        "OrderID", "TotalAmount", slot(month % 12 + 1), F.lit(True).alias("moved"),
        F.explode(F.array(F.lit(1), F.lit(2))).alias("seq"))
    updates = updates.withColumn("TotalAmount", (F.col("TotalAmount") + F.col("seq")).cast("decimal(18,2)"))
    W.merge_partitions(spark, path, updates, ["OrderID"], "slot", order_by=["seq"])
    return W.read_table(spark, path, like=updates, partition_by=["slot"])


QUERIES.update({
    "dq_split_rerun": q_dq_split_rerun,
    "extract_incremental_customers": q_extract_incremental_customers,
    "ingest_suite_two_loads": q_ingest_suite_two_loads,
    "merge_partitions_moved": q_merge_partitions_moved,
})


def q_stream_bronze_quarantine(spark, d):
    """The rows that the streaming ingest put aside."""
    raw = A.customers_landed_text(spark, d)
    landing = scratch_path(spark, "landing/customers")
    raw.write.mode("overwrite").parquet(landing)
    quarantine = scratch_path(spark, "quarantine")
    incremental_ingest(spark, landing, raw.schema, CUSTOMERS_BRONZE, scratch_path(spark, "bronze/customers"),
                       quarantine, scratch_path(spark, "checkpoints/customers"), A.LANDED_FILE, INGEST_TS)
    return read_bronze(spark, quarantine)


QUERIES["stream_bronze_quarantine"] = q_stream_bronze_quarantine


def q_ingest_suite_retry(spark, d):
    """Orders landed by a run that dies before its commit, its retry on the next date, a run that finds
    nothing new and one that finds the rest: every order once, with the date of the load that counts."""
    root = scratch_path(spark, "landing")
    marks, orders = f"{root}/marks", A.orders_source(spark, d)
    early = orders.filter(F.col("OrderDate") < F.lit("1998-01-01").cast("date"))
    config = lambda df: X.SourceConfig(ORDERS, "dataframe", dataframe=df)
    path = X.landing_path(root, SOURCE_DB, config(early))
    L.stage_load(X.extract_incremental(spark, config(early), X.INITIAL_WATERMARK), path, "2024-03-01")  # and dies
    for batch, date in ((early, "2024-03-02"), (early, "2024-03-02"), (orders, "2024-03-03")):
        X.ingest_suite(spark, [config(batch)], root, SOURCE_DB, date, marks_path=marks)
    return L.read_landed(spark, path, marks, ORDERS.qualified_name).drop("load_id")


def q_stream_upsert(spark, d):
    """Landed customers streamed into a table of one row per customer; a second batch moves some to
    other regions (partitions) and changes their status."""
    raw = A.customers_landed_text(spark, d)
    landing, table = scratch_path(spark, "landing/customers"), scratch_path(spark, "silver/customers")
    checkpoint, quarantine = scratch_path(spark, "checkpoints/customers"), scratch_path(spark, "quarantine")
    moved = raw.filter(F.col("AccountManagerID").rlike("^[0-9]*[02468]$")).withColumns(
        {"CustomerStatus": F.lit("moved"), "RegionCode": F.concat(F.lit("NEW "), "RegionCode")})
    for batch in (raw, moved):
        batch.write.mode("append").parquet(landing)
        incremental_upsert(spark, landing, raw.schema, CUSTOMERS_BRONZE, table, quarantine, checkpoint, ["CustomerID"],
                           "RegionCode", source_file=A.LANDED_FILE, ingest_ts=INGEST_TS)
    return W.read_table(spark, table).select("CustomerID", "CustomerStatus", "RegionCode", "AccountManagerID")


# Codes of the channels that the raising rule knows.
CHANNEL_CODES = {"ONLINE": "ONL", "PHONE": "PHN", "DIRECT": "DIR"}


def raising_channel_rule() -> Q.DQRule:
    """User rule in plain Python that raises on null and unknown channels, in its check and in its fix."""
    codes = CHANNEL_CODES
    return Q.row_rule("channel_code", "ChannelCode", lambda v: codes[v.strip().upper()] != "DIR",
                      lambda v: codes[v.strip().upper()], severity=Q.WARNING)


def q_recon_key_drilldown(spark, d):
    """Orders that differ between the source snapshot and silver, found through digests of key buckets."""
    s, t = _pair(spark, d)
    return R.key_differences(s, t, "OrderID", ["TotalAmount", "CurrencyCode"])


def q_dq_not_future_text(spark, d):
    """The not-in-future rule on ISO text, compared as text."""
    rows = A.orders_dq_input(spark, d).withColumn("ShipDate", F.col("ShipDate").cast("string"))
    out = Q.check_rule(rows, Q.date_not_future_rule("ShipDate", "1998-06-01T00:00:00"))
    return out.select(*DQ_ID, "ShipDate", "passed")


QUERIES.update({
    "ingest_suite_retry": q_ingest_suite_retry,
    "stream_upsert": q_stream_upsert,
    "dq_raising_rule": _one_rule(raising_channel_rule, "ChannelCode"),
    "recon_key_drilldown": q_recon_key_drilldown,
    "dq_not_future_text": q_dq_not_future_text,
})


def _orders_after(orders: DataFrame) -> DataFrame:
    """Stand-in for a later snapshot of the staged orders: pending ones of 1995 are gone, completed ones of
    1996-02 were shipped with an amendment of 1.00, those of 1997-05 moved to the next year."""
    year, month, status = F.year("order_date"), F.month("order_date"), F.coalesce(F.col("order_status"), F.lit(""))
    done = status == "COMPLETED"
    return orders.filter(~((year == 1995) & (status == "PENDING"))).withColumns({
        "total_amount": F.when(done & (year == 1996) & (month == 2), F.col("total_amount") + 1)
        .otherwise(F.col("total_amount")).cast("decimal(18,2)"),
        "order_date": F.when(done & (year == 1997) & (month == 5), F.add_months("order_date", 12)).otherwise(F.col("order_date"))})


def q_fct_refresh(spark, d):
    """Daily fact of an earlier snapshot, brought up to a later one by computing only the days that
    changed orders, customers (regions) and products (categories) touch."""
    before, customers, products = q_stg_orders(spark, d), q_stg_customers(spark, d), q_stg_products(spark, d)
    root = scratch_path(spark, "gold")
    after = W.materialize(_orders_after(before), "gold/orders")
    W.write_table(fct_daily_sales(int_order_enriched(before, customers, products)), f"{root}/fact", "overwrite",
                  partition_by="order_date")
    moved, recast = F.col("customer_id") % 500 == 0, F.col("product_id") % 700 == 0
    new_customers = customers.withColumn("region_code", F.when(moved, F.lit("MOVED")).otherwise(F.col("region_code")))
    new_products = products.withColumn("category_id", F.when(recast, F.lit(9)).otherwise(F.col("category_id")))
    version = F.xxhash64("order_date", "total_amount").alias("_record_hash")
    ids = lambda df: df.select(F.col("order_id"), version)
    changed = detect_changes(ids(after), ids(before), "order_id").filter(F.col("_change_type") != "unchanged")
    days = touched_days(before, after, changed, customers.filter(moved), products.filter(recast))
    refresh_daily_sales(spark, f"{root}/fact", after, new_customers, new_products, days)
    return spark.read.schema(fct_daily_sales(int_order_enriched(before, customers, products)).schema).parquet(f"{root}/fact")


def q_merge_indexed(spark, d):
    """Orders by year with a key index: the changes between two snapshots are merged, then orders of
    1996-03 once more, into another year; old versions are found through the index."""
    path = scratch_path(spark, "silver/orders_indexed")
    prev, cur = A.orders_previous(spark, d), A.orders_current(spark, d)
    year = F.year("OrderDate").alias("order_year")
    W.write_table(prev.select("*", year), path, "overwrite", partition_by="order_year")
    delta = detect_changes(cur, prev, "OrderID").filter(F.col("_change_type") != "unchanged").drop("_change_type").select("*", year)
    W.merge_partitions(spark, path, delta, ["OrderID"], "order_year", indexed=True)
    moved = (cur.filter((F.year("OrderDate") == 1996) & (F.month("OrderDate") == 3))
             .withColumn("OrderDate", F.add_months("OrderDate", 12).cast("date")).select("*", year))
    W.merge_partitions(spark, path, moved, ["OrderID"], "order_year", indexed=True)
    return W.read_evolving(spark, path).select("OrderID", "TotalAmount", "OrderDate", "_is_deleted", "order_year")


def q_audit_columns(spark, d):
    """Products staged with audit columns: a given run and time, and the time of the query itself."""
    given = stg_products(A.products_source(spark, d), Audit("run-1", "2024-03-01 06:00:00"))
    now = stg_products(A.products_source(spark, d), Audit("run-2"))
    fresh = F.abs(F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("_loaded_at")) <= 3600
    now = now.groupBy("_run_id").agg(F.count_distinct("_loaded_at").alias("load_times"), F.every(fresh).alias("loaded_now"))
    return (given.select("product_id", F.col("_loaded_at").cast("string").alias("loaded_at"), F.col("_run_id").alias("run_id"),
                         F.lit(None).cast("bigint").alias("load_times"), F.lit(None).cast("boolean").alias("loaded_now"))
            .unionByName(now.select(F.lit(None).cast("bigint").alias("product_id"), F.lit(None).cast("string").alias("loaded_at"),
                                    F.col("_run_id").alias("run_id"), "load_times", "loaded_now")))


RANGE_PARTS = 16


def q_extract_ranges(spark, d):
    """Orders landed by ranges of the (skewed) product key, bounds from quantiles of the landed copy: every row
    once, as landed, and whether each range kept to one and a half equal shares."""
    cfg = _landed_source(spark, d, ORDERS, A.orders_source(spark, d))
    source = X.extract_full(spark, cfg)
    hot = source.withColumn("ProductID", F.when(F.col("OrderID") % 3 == 0, F.lit(1)).otherwise(F.col("ProductID")).cast("long"))
    ranges = K.key_ranges(hot, "ProductID", RANGE_PARTS, tie="OrderID")
    path = W.write_table(K.with_range(hot, ranges), scratch_path(spark, "landing/by_range"), "overwrite", partition_by=K.RANGE)
    landed = spark.read.schema(K.with_range(hot, ranges).schema).parquet(path)
    sizes = landed.groupBy(K.RANGE).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("ProductID").isNull()).alias("nulls"),
                                        F.sum("OrderID").alias("ids"))
    share = F.max(F.when(F.col("nulls") == 0, F.col("n"))) <= F.sum("n") * 1.5 / RANGE_PARTS
    return sizes.agg(F.sum("n").alias("landed"), F.sum("nulls").alias("null_keys"), F.sum("ids").cast("decimal(38,0)").alias("id_sum"),
                     F.count_if(F.col(K.RANGE).isNull()).alias("rows_without_range"), share.alias("even"))


QUERIES.update({"fct_refresh": q_fct_refresh, "extract_ranges": q_extract_ranges, "merge_indexed": q_merge_indexed,
                "audit_columns": q_audit_columns})
