"""Text helpers: blank tests, truthiness, the record hash and message formatting."""
from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, functions as F

# The text a null prints as inside hashes and messages, and the
# separators of the record-hash content ("k=v" pairs joined by "&").
NONE_TEXT = "None"
HASH_PAIR_SEP = "&"
HASH_KV_SEP = "="


def has_text(c: Column) -> Column:
    """True when the value is non-null and has a non-whitespace character."""
    return F.coalesce(c.cast("string").rlike(r"(?U)\S"), F.lit(False))


def is_blank(c: Column) -> Column:
    return ~has_text(c)


def truthy(c: Column) -> Column:
    """Bit-or-text truth test: 1 / true (any case) -> true, anything else -> false."""
    return F.coalesce(F.lower(c.cast("string")).isin("1", "true"), F.lit(False))


def text_or_none(c: Column) -> Column:
    """Text form of a value, with null printed as ``None``."""
    return F.coalesce(c.cast("string"), F.lit(NONE_TEXT))


def record_hash(columns: Iterable[str], exclude_prefix: str = "_") -> Column:
    """MD5 hex of the business fields: names not starting with ``exclude_prefix``,
    sorted by name, rendered ``name=value`` and joined by ``&``; null renders ``None``.

    The column list is resolved at plan time, so the hash is a plain expression.
    Separators are not escaped, so a value containing ``&`` or ``=`` can collide.
    """
    names = sorted(c for c in columns if not c.startswith(exclude_prefix))
    parts = [F.concat(F.lit(f"{n}{HASH_KV_SEP}"), text_or_none(F.col(f"`{n}`"))) for n in names]
    if not parts:
        return F.md5(F.lit(""))
    return F.md5(F.concat_ws(HASH_PAIR_SEP, *parts))


def py_list_text(arr: Column, quote: bool) -> Column:
    """Render an array like a Python list: ``['a', 'b']`` or ``[1, 2]``."""
    items = F.transform(arr, lambda x: F.concat(F.lit("'"), x.cast("string"), F.lit("'"))) \
        if quote else F.transform(arr, lambda x: x.cast("string"))
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))


def fmt_fixed(x: Column, digits: int) -> Column:
    """Fixed-point text with ``digits`` decimals, rounded half-up first so the text is
    the same in every engine (printf-style formatters differ on exact ties)."""
    return F.format_string(f"%.{digits}f", F.round(x.cast("double"), digits))
