"""Declared table specifications: the source OLTP tables and the bronze lineage columns."""
from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import types as T

# Declared dtype vocabulary -> Spark type. ``decimal`` means the source DECIMAL(18,2);
# ``timestamp`` is a source DATETIME, which has no zone, so it maps to TIMESTAMP_NTZ.
DTYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "int": T.IntegerType(),
    "long": T.LongType(),
    "double": T.DoubleType(),
    "float": T.DoubleType(),
    "decimal": T.DecimalType(18, 2),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampNTZType(),
    "date": T.DateType(),
}


def spark_type(dtype: str) -> T.DataType:
    try:
        return DTYPES[dtype]
    except KeyError:
        raise ValueError(f"Unknown dtype '{dtype}'. Known: {sorted(DTYPES)}") from None


@dataclass(frozen=True)
class ColumnSpec:
    """One declared column. ``default`` fills a null in a nullable column only."""
    name: str
    dtype: str
    nullable: bool = True
    default: Any = None

    def __post_init__(self):
        spark_type(self.dtype)  # reject unknown dtypes when the spec is built

    @property
    def spark_type(self) -> T.DataType:
        return spark_type(self.dtype)


@dataclass(frozen=True)
class TableSpec:
    """A declared table: columns in order, primary key and the incremental expression
    (SQL text over source columns) used for high-water-mark extracts."""
    table_name: str
    source_schema: str = "dbo"
    columns: tuple[ColumnSpec, ...] = field(default_factory=tuple)
    primary_key: tuple[str, ...] = ()
    incremental: str | None = None
    #: Columns whose first non-null value is ``incremental``; the extract then filters
    #: column by column, which reaches the scan where a ``coalesce`` does not.
    incremental_columns: tuple[str, ...] = ()

    def column_names(self) -> list[str]:
        return [c.name for c in self.columns]

    def required_columns(self) -> list[str]:
        return [c.name for c in self.columns if not c.nullable]

    def struct(self) -> T.StructType:
        return T.StructType([T.StructField(c.name, c.spark_type, c.nullable)
                             for c in self.columns])

    @property
    def qualified_name(self) -> str:
        return f"{self.source_schema}.{self.table_name}"


# Bronze lineage columns appended to every bronze table (fixed names and types).
BRONZE_METADATA_COLUMNS: tuple[ColumnSpec, ...] = (
    ColumnSpec("_ingestion_timestamp", "timestamp", nullable=False),
    ColumnSpec("_source_file", "string", nullable=True),
    ColumnSpec("_source_table", "string", nullable=False),
    ColumnSpec("_record_hash", "string", nullable=False),
    ColumnSpec("_is_deleted", "boolean", nullable=False, default=False),
)

C = ColumnSpec

CUSTOMERS = TableSpec(
    "Customers", "dbo",
    (C("CustomerID", "long", False), C("CustomerName", "string", False),
     C("CustomerEmail", "string"), C("CustomerStatus", "string", False),
     C("CreatedDate", "timestamp", False), C("UpdatedDate", "timestamp"),
     C("RegionCode", "string"), C("AccountManagerID", "int")),
    primary_key=("CustomerID",),
    # UpdatedDate is nullable: a never-updated row must still be picked up once.
    incremental="coalesce(UpdatedDate, CreatedDate)",
    incremental_columns=("UpdatedDate", "CreatedDate"),
)

ORDERS = TableSpec(
    "Orders", "dbo",
    (C("OrderID", "long", False), C("CustomerID", "long", False), C("ProductID", "long", False),
     C("OrderDate", "date", False), C("ShipDate", "date"), C("OrderStatus", "string", False),
     C("TotalAmount", "decimal", False), C("CurrencyCode", "string", False),
     C("SalesRepID", "int"), C("ChannelCode", "string")),
    primary_key=("OrderID",),
    incremental="OrderDate",
)

PRODUCTS = TableSpec(
    "Products", "dbo",
    (C("ProductID", "long", False), C("ProductName", "string", False),
     C("ProductCode", "string", False), C("CategoryID", "int"),
     C("UnitPrice", "decimal", False), C("StockQuantity", "int", False),
     C("IsActive", "boolean", False), C("CreatedDate", "timestamp", False)),
    primary_key=("ProductID",),
    incremental="CreatedDate",
)

SOURCE_TABLES: tuple[TableSpec, ...] = (CUSTOMERS, ORDERS, PRODUCTS)
