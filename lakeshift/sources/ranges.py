"""Ranges of a key with about equal numbers of rows, for extracts read by several connections at once.

Bounds given by hand, or even steps between the least and the greatest key, leave most ranges
empty when the key is skewed. Here the bounds are quantiles of the key, taken from a copy of the table that
Spark can read (as a rule the last landed one): the first and the last range are open, so rows that
came since belong to a range too. Null keys have a range of their own, and a value that fills more than
a range is split by the quantiles of a second column among its rows.
"""
from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from collections.abc import Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T

RANGE = "_range"
FINE = 16


def _literal(value) -> str:
    if isinstance(value, dt.datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, dt.date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, (int, float, Decimal)) and not isinstance(value, bool) and math.isfinite(value):
        return str(value)
    raise ValueError(f"no range bound {value!r}: use a column of numbers, dates or timestamps")


def _cuts(name: str, bounds: Sequence) -> list[str]:
    """Adjoining predicates that hold every non-null value once, cut below each bound."""
    marks = [_literal(b) for b in sorted(set(bounds))]
    if not marks:
        return [f"{name} IS NOT NULL"]
    inner = [f"{name} >= {a} AND {name} < {b}" for a, b in zip(marks, marks[1:])]
    return [f"{name} < {marks[0]}", *inner, f"{name} >= {marks[-1]}"]


def _plain(copy: DataFrame, column: str) -> Column:
    """The column; of a timestamp its wall time in the session's zone, in which a literal is read too."""
    key = F.col(f"`{column}`")
    zoned = isinstance(copy.select(key).schema[0].dataType, T.TimestampType)
    return key.cast("timestamp_ntz") if zoned else key


def _quantiles(copy: DataFrame, column: str, shares: Sequence[float]) -> Column:
    return F.percentile_approx(_plain(copy, column), list(shares), max(10000, 8 * len(shares))).alias("q")


def key_ranges(copy: DataFrame, column: str, parts: int, tie: str | None = None, quote: str = "`") -> list[str]:
    """SQL predicates on ``column`` (and ``tie``), each row of any table in exactly one of them.

    ``copy`` is read for the one column by an aggregation of quantile sketches, ``FINE`` marks to a share of
    1 / ``parts`` rows. Neighbouring marks are joined to ranges of at most a share. A value that fills half a
    share is hot: it gets a range of its own, cut by quantiles of ``tie`` (a unique key, best) into
    shares; without ``tie`` it stays one range. At most 2 x ``parts`` values can be hot, and there are
    at most about twice as many ranges as ``parts``. An empty copy gives one open range and that of nulls.
    ``quote`` stands around names: that of the database, for a JDBC source."""
    if parts < 1:
        raise ValueError("parts must be at least 1")
    marks = [i / (FINE * parts) for i in range(1, FINE * parts)]
    found = Counter(copy.agg(_quantiles(copy, column, marks)).first()["q"] or [])
    hot = {v: -(-n // FINE) for v, n in sorted(found.items()) if 2 * n >= FINE} if parts > 1 else {}
    bounds, filled = [], 0
    for value, n in sorted(found.items()) if parts > 1 else ():
        n = 1 if value in hot else n  # of a hot value only the rest of the mark before it counts
        if value not in hot and filled + n > FINE:
            bounds, filled = [*bounds, value], 0
        filled += n
    name = f"{quote}{column}{quote}"
    out = _hot_ranges(copy, column, hot, tie, quote) if hot else []
    apart = "".join(f" AND {name} <> {_literal(v)}" for v in hot)
    return [*out, *[p + apart for p in _cuts(name, bounds)], f"{name} IS NULL"]


def _hot_ranges(copy: DataFrame, column: str, hot: dict, tie: str | None, quote: str) -> list[str]:
    """Ranges of the values in ``hot``, each cut into the number of pieces given there."""
    name, second = f"{quote}{column}{quote}", f"{quote}{tie}{quote}"
    cuts = {v: [i / n for i in range(1, n)] for v, n in hot.items()}
    points = sorted({s for shares in cuts.values() for s in shares})
    if tie is None or not points:
        return [f"{name} = {_literal(v)}" for v in hot]
    rows = (copy.filter(F.expr(f"`{column}` IN ({', '.join(_literal(v) for v in hot)})"))
            .groupBy(_plain(copy, column).alias("v")).agg(_quantiles(copy, tie, points)).collect())
    at = {r["v"]: dict(zip(points, r["q"] or [])) for r in rows}
    out = []
    for v in hot:
        bounds = [at[v][s] for s in cuts[v] if s in at.get(v, {})]
        if bounds:
            out += [f"{name} = {_literal(v)} AND {p}" for p in [*_cuts(second, bounds), f"{second} IS NULL"]]
        else:
            out.append(f"{name} = {_literal(v)}")
    return out


def with_range(df: DataFrame, ranges: Sequence[str]) -> DataFrame:
    """``df`` with the number of each row's range, in one pass: a table written with
    ``partition_by=RANGE`` has one folder a range."""
    number = F.lit(None).cast("int")
    for i, predicate in enumerate(ranges):
        number = F.when(F.expr(predicate), F.lit(i)).otherwise(number)
    return df.withColumn(RANGE, number)
