import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from lakeshift.operators import bronze as B
from lakeshift.spec import (BRONZE_METADATA_COLUMNS, CUSTOMERS, ColumnSpec, TableSpec,
                            spark_type)
from tests.conftest import rows

CUST = TableSpec("customers", "dbo", (
    ColumnSpec("customer_id", "int", nullable=False),
    ColumnSpec("customer_name", "string", nullable=False),
    ColumnSpec("customer_email", "string"),
    ColumnSpec("customer_status", "string", nullable=False, default="ACTIVE"),
))
SCHEMA = "customer_id string, customer_name string, customer_email string, customer_status string"


def test_column_spec_defaults():
    c = ColumnSpec("id", "int")
    assert c.nullable is True and c.default is None


def test_unknown_dtype_rejected():
    with pytest.raises(ValueError):
        ColumnSpec("x", "varchar")


def test_spec_columns_and_required():
    assert CUST.column_names() == ["customer_id", "customer_name", "customer_email",
                                   "customer_status"]
    assert CUST.required_columns() == ["customer_id", "customer_name", "customer_status"]
    assert CUST.table_name == "customers" and CUST.source_schema == "dbo"


def test_metadata_columns():
    names = [c.name for c in BRONZE_METADATA_COLUMNS]
    assert names == ["_ingestion_timestamp", "_source_file", "_source_table", "_record_hash",
                     "_is_deleted"]
    assert BRONZE_METADATA_COLUMNS[-1].default is False


def test_enforce_valid_record_and_coerce_int(spark):
    df = spark.createDataFrame([(" 10 ", "Acme Corp", None, "ACTIVE")], SCHEMA)
    r = B.enforce_schema(df, CUST).first()
    assert r.customer_id == 10 and r.customer_name == "Acme Corp"
    assert r.customer_email is None and r._errors == []


def test_enforce_required_null_is_error(spark):
    df = spark.createDataFrame([(None, "Acme", None, "ACTIVE")], SCHEMA)
    r = B.enforce_schema(df, CUST).first()
    assert r._errors == ["Required column 'customer_id' is null in record"]


def test_default_fills_nullable_but_not_required(spark):
    spec = TableSpec("t", "dbo", (ColumnSpec("a", "string", default="X"),
                                  ColumnSpec("b", "string", nullable=False, default="Y")))
    df = spark.createDataFrame([(None, None)], "a string, b string")
    r = B.enforce_schema(df, spec).first()
    assert r.a == "X" and r.b is None
    assert r._errors == ["Required column 'b' is null in record"]


def test_drops_undeclared_columns(spark):
    df = spark.createDataFrame([("1", "A", None, "ACTIVE", "junk")],
                               SCHEMA + ", extra_column string")
    out = B.enforce_schema(df, CUST)
    assert "extra_column" not in out.columns


def test_absent_declared_column_reads_null(spark):
    df = spark.createDataFrame([("1", "A", "ACTIVE")],
                               "customer_id string, customer_name string, customer_status string")
    r = B.enforce_schema(df, CUST).first()
    assert r.customer_email is None and r._errors == []


@pytest.mark.parametrize("text,ok,value", [
    (" 10 ", True, 10), ("1.5", False, None), ("abc", False, None),
    ("99999999999", False, None), ("-3", True, -3)])
def test_int_coercion(spark, text, ok, value):
    spec = TableSpec("t", "dbo", (ColumnSpec("a", "int"),))
    r = B.enforce_schema(spark.createDataFrame([(text,)], "a string"), spec).first()
    assert r.a == value and (r._errors == []) == ok


def test_fractional_number_truncates_to_int(spark):
    spec = TableSpec("t", "dbo", (ColumnSpec("a", "int"),))
    r = B.enforce_schema(spark.createDataFrame([(1.9,), (-1.9,)], "a double"), spec).collect()
    assert sorted(x.a for x in r) == [-1, 1]


@pytest.mark.parametrize("text,value", [("true", True), ("TRUE", True), ("1", True),
                                        ("yes", True), ("y", False), ("t", False),
                                        ("no", False), ("junk", False)])
def test_boolean_coercion(spark, text, value):
    spec = TableSpec("t", "dbo", (ColumnSpec("a", "boolean"),))
    r = B.enforce_schema(spark.createDataFrame([(text,)], "a string"), spec).first()
    assert r.a is value and r._errors == []


def test_decimal_timestamp_date_coercion(spark):
    spec = TableSpec("t", "dbo", (ColumnSpec("m", "decimal"), ColumnSpec("ts", "timestamp"),
                                  ColumnSpec("d", "date"), ColumnSpec("x", "double")))
    df = spark.createDataFrame([("12.345", "2024-01-05 10:00:00", "2024-01-05", "1e3"),
                                ("n/a", "not a date", "2024-13-01", "x")],
                               "m string, ts string, d string, x string")
    good, bad = sorted(B.enforce_schema(df, spec).collect(), key=lambda r: len(r._errors))
    assert good.m == Decimal("12.35") and str(good.ts) == "2024-01-05 10:00:00"
    assert str(good.d) == "2024-01-05" and good.x == 1000.0
    assert len(bad._errors) == 4
    assert bad._errors[0] == "Cannot coerce column 'm' value 'n/a' to decimal"
    assert spark_type("decimal").simpleString() == "decimal(18,2)"


def test_hash_matches_reference_format(spark):
    df = spark.createDataFrame([(1, "Acme", None)], "b int, a string, c string")
    h = df.select(B.record_hash(df.columns).alias("h")).first().h
    assert h == hashlib.md5(b"a=Acme&b=1&c=None").hexdigest() and len(h) == 32


def test_hash_excludes_metadata_and_is_consistent(spark):
    df = spark.createDataFrame([(1, "A", "x"), (1, "A", "y")], "id int, name string, _meta string")
    hs = [r.h for r in df.select(B.record_hash(df.columns).alias("h")).collect()]
    assert hs[0] == hs[1]


def test_different_records_different_hash(spark):
    df = spark.createDataFrame([(1, "A"), (2, "B")], "id int, name string")
    hs = {r.h for r in df.select(B.record_hash(df.columns).alias("h")).collect()}
    assert len(hs) == 2


def test_add_bronze_metadata(spark):
    df = spark.createDataFrame([(1, "Acme")], "customer_id int, customer_name string")
    r = B.add_bronze_metadata(df, "customers", "raw/customers.parquet").first()
    assert r._source_table == "customers" and r._source_file == "raw/customers.parquet"
    assert r._is_deleted is False and r._ingestion_timestamp is not None
    assert r.customer_id == 1 and len(r._record_hash) == 32
    r2 = B.add_bronze_metadata(df, "customers").first()
    assert r2._source_file == ""


def test_ingest_batch_skips_invalid_and_quarantines(spark):
    df = spark.createDataFrame([(None, "Bad", None, "ACTIVE"), ("2", "Good", "g@x", "ACTIVE")],
                               SCHEMA)
    b = B.ingest_batch(df, CUST, ingest_ts="2024-01-01 00:00:00")
    valid = b.valid.collect()
    assert len(valid) == 1 and valid[0].customer_id == 2
    assert {"_ingestion_timestamp", "_record_hash"} <= set(b.valid.columns)
    q = b.quarantine.collect()
    assert len(q) == 1 and q[0].customer_name == "Bad"
    assert q[0]._error == "Required column 'customer_id' is null in record"
    s = b.stats().first()
    assert (s.raw_records, s.bronze_records, s.error_records) == (2, 1, 1)
    assert s.success_rate_pct == 50.0 and s.passed is False


def test_ingest_batch_source_file_from_scan(spark, tmp_path):
    spark.createDataFrame([("1", "A", None, "ACTIVE")], SCHEMA).write.parquet(str(tmp_path / "l"))
    b = B.ingest_batch(spark.read.parquet(str(tmp_path / "l")), CUST, source_file=B.FROM_SCAN)
    assert b.valid.first()._source_file.endswith(".parquet")


@pytest.mark.parametrize("raw,ok,bad,rate,passed", [(100, 100, 0, 100.0, True),
                                                    (100, 80, 20, 80.0, False),
                                                    (0, 0, 0, 0.0, True),
                                                    (3, 2, 1, 66.67, False)])
def test_ingestion_stats(spark, raw, ok, bad, rate, passed):
    c = spark.createDataFrame([(raw, ok, bad)], "raw_records long, bronze_records long, "
                                                "error_records long")
    s = B.ingestion_stats(c).first()
    assert s.success_rate_pct == rate and s.passed is passed


def test_bronze_table_schema_has_lineage_not_null():
    s = B.bronze_table_schema(CUSTOMERS)
    f = {x.name: x for x in s.fields}
    assert f["_record_hash"].nullable is False and f["CustomerEmail"].nullable is True
    assert f["CustomerID"].nullable is False


def test_write_split_one_pass(spark, tmp_path):
    df = spark.createDataFrame([(None, "Bad", None, "ACTIVE"), ("2", "Good", "g@x", "ACTIVE")],
                               SCHEMA)
    p = str(tmp_path / "bs")
    m = B.ingest_batch(df, CUST).write_split(p)
    assert m == {"raw_records": 2, "bronze_records": 1, "error_records": 1,
                 "success_rate_pct": 50.0, "passed": False}
    back = spark.read.parquet(p)
    v = back.filter("_bronze_status = 'valid'").first()
    assert v.customer_id == 2 and v._raw is None and v._errors is None
    q = back.filter("_bronze_status = 'quarantine'").first()
    assert q._raw.customer_name == "Bad" and q._errors[0].startswith("Required column")


def test_bronze_ddl_and_compat_names():
    from lakeshift import compat
    ddl = compat.generate_bronze_ddl(CUSTOMERS, "/lake/bronze/customers")
    assert ddl.startswith("CREATE TABLE IF NOT EXISTS bronze.Customers (")
    assert "  CustomerID BIGINT NOT NULL" in ddl and "_record_hash STRING NOT NULL" in ddl
    assert "USING PARQUET" in ddl and "DECIMAL(18,2)" not in ddl  # customers has none
    for name in ("enforce_schema", "ingest_batch", "deduplicate_records",
                 "detect_changed_records", "run_full_reconciliation", "not_null_rule"):
        assert callable(getattr(compat, name))
