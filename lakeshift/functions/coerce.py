"""Type coercion of raw values to a declared dtype.

Rules (per declared dtype):
  string          -> text form of the value
  int / long      -> integer; text must be an integer literal ('1.5' fails, ' 10 ' is 10);
                     fractional numbers truncate toward zero; overflow fails
  double / float  -> double
  boolean         -> real booleans pass; otherwise lower-cased text in {true, 1, yes} is
                     true and everything else is false (never a failure)
  decimal         -> DECIMAL(18,2), exact
  timestamp/date  -> typed value; unparsable text fails
A coercion failure is: input not null and the coerced value null.
"""
from __future__ import annotations

from pyspark.sql import Column, functions as F, types as T

from lakeshift.spec import spark_type

# Text accepted as boolean true on ingest.
TRUE_TEXT = ("true", "1", "yes")


def coerce(c: Column, dtype: str, source_type: T.DataType | None = None) -> Column:
    """Coerce column ``c`` (of ``source_type`` if known) to the declared ``dtype``."""
    target = spark_type(dtype)
    if dtype == "boolean":
        if isinstance(source_type, T.BooleanType):
            return c
        return F.lower(c.cast("string")).isin(*TRUE_TEXT)
    if source_type is not None and source_type == target:
        return c
    if dtype == "string":
        return c.cast("string")
    if dtype in ("int", "long") and isinstance(source_type, T.StringType):
        # Text must be an integer literal: try_cast to an integral type already
        # rejects '1.5' and trims blanks.
        return c.try_cast(target)
    return c.try_cast(target)


def coercion_failed(raw: Column, coerced: Column) -> Column:
    return raw.isNotNull() & coerced.isNull()
