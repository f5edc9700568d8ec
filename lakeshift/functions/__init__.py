"""Column builders: every function here maps Columns to a Column and stays inside
whole-stage codegen (no Python UDFs)."""
from lakeshift.functions.coerce import coerce, coercion_failed  # noqa: F401
from lakeshift.functions.text import (  # noqa: F401
    is_blank, has_text, truthy, text_or_none, record_hash, py_list_text, fmt_fixed,
)
