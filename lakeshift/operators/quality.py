"""Data-quality rules and the silver rule engine.

A rule checks one column and may fix it. Rules run in order; a later rule on the same
column sees the value an earlier rule fixed, and ``passed`` is always the verdict on
the value before this rule's fix. A row is rejected iff an error-severity rule failed
(warnings are fixed and kept). Everything is Column expressions inside one stage;
each rule adds one projection so chained fixes never duplicate expression trees.
"""
from __future__ import annotations

import inspect
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F, types as T

from lakeshift.functions.text import has_text, text_or_none

ERROR, WARNING = "error", "warning"
DQ_ERRORS = "_dq_errors"
DQ_STATUS = "_dq_status"


def _call(fn: Callable, c: Column, dtype: T.DataType) -> Column:
    n = len(inspect.signature(fn).parameters)
    return fn(c, dtype) if n >= 2 else fn(c)


@dataclass(frozen=True)
class DQRule:
    """``check_fn`` / ``fix_fn`` map a Column (optionally with its type) to a Column.
    A null check result counts as a failure."""
    name: str
    column: str
    check_fn: Callable[..., Column]
    fix_fn: Callable[..., Column] | None = None
    severity: str = ERROR

    def __post_init__(self):
        if self.severity not in (ERROR, WARNING):
            raise ValueError(f"severity must be '{ERROR}' or '{WARNING}', got {self.severity!r}")

    def check(self, c: Column, dtype: T.DataType = T.StringType()) -> Column:
        return F.coalesce(_call(self.check_fn, c, dtype), F.lit(False))

    def fix(self, c: Column, dtype: T.DataType = T.StringType()) -> Column:
        return c if self.fix_fn is None else _call(self.fix_fn, c, dtype)


def _numeric(c: Column, dtype: T.DataType) -> Column:
    return c if isinstance(dtype, T.NumericType) else c.try_cast("double")


# ── standard rules ─────────────────────────────────────────────────────────
def not_null_rule(column: str) -> DQRule:
    """Fails on null and on text that is empty after stripping whitespace."""
    return DQRule(f"not_null_{column}", column, lambda c: has_text(c), severity=ERROR)


def positive_numeric_rule(column: str) -> DQRule:
    """Passes when the value is a number > 0. Fix: absolute value; null -> 0;
    text that is not a number is kept. Numeric columns keep their type."""
    def fix(c: Column, dtype: T.DataType) -> Column:
        if isinstance(dtype, T.NumericType):
            return F.coalesce(F.abs(c), F.lit(0).cast(dtype))
        return F.when(c.isNull(), F.lit("0.0")).otherwise(
            F.coalesce(F.abs(c.try_cast("double")).cast("string"), c))
    return DQRule(f"positive_{column}", column,
                  lambda c, t: (_numeric(c, t) > 0) & ~F.isnan(_numeric(c, t).cast("double")),
                  fix, severity=WARNING)


def max_length_rule(column: str, max_len: int) -> DQRule:
    """Passes on null or text of at most ``max_len`` characters; fix truncates."""
    return DQRule(f"max_length_{column}", column,
                  lambda c: c.isNull() | (F.length(c.cast("string")) <= max_len),
                  lambda c, t: F.substring(c, 1, max_len) if isinstance(t, T.StringType) else c,
                  severity=WARNING)


def value_in_set_rule(column: str, allowed: Iterable) -> DQRule:
    """Passes when the value is one of ``allowed``; null fails unless None is allowed."""
    allowed = list(allowed)
    none_passes = any(v is None for v in allowed)
    values = sorted((v for v in allowed if v is not None), key=str)

    def check(c: Column, dtype: T.DataType) -> Column:
        if isinstance(dtype, T.StringType) and any(not isinstance(v, str) for v in values):
            # compare text forms: an ANSI implicit cast of the text would fail the job
            found = c.isin(*[str(v) for v in values])
        else:
            found = c.isin(*values)
        return c.isNull() | found if none_passes else found
    return DQRule(f"allowed_values_{column}", column, check, severity=ERROR)


def date_not_future_rule(column: str, now: str | None = None) -> DQRule:
    """Passes on null or a value not after ``now``. Text is compared as ISO text
    (``yyyy-MM-ddTHH:mm:ss.ffffff``); date and timestamp values compare typed.
    ``now`` (ISO text) pins the clock; default is the query's current time."""
    def check(c: Column, dtype: T.DataType) -> Column:
        ts = F.current_timestamp().cast("timestamp_ntz") if now is None \
            else F.lit(now).cast("timestamp_ntz")
        if isinstance(dtype, T.StringType):
            return c.isNull() | (c <= F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"))
        if isinstance(dtype, T.DateType):
            return c.isNull() | (c <= ts.cast("date"))
        if isinstance(dtype, (T.TimestampType, T.TimestampNTZType)):
            return c.isNull() | (c.cast("timestamp_ntz") <= ts)
        return c.isNull()
    return DQRule(f"not_future_{column}", column, check, severity=WARNING)


def row_rule(name: str, column: str, check_fn: Callable, fix_fn: Callable | None = None,
             severity: str = ERROR) -> DQRule:
    """A user rule of plain Python callables on single values, which may raise: a check that raises
    fails its row, a fix that raises (or returns what the column's type cannot hold) keeps the value.
    Values move in Arrow batches; write rules as Column expressions where they allow it."""
    def check(c: Column, dtype: T.DataType) -> Column:
        def safe(value):
            try:
                return bool(check_fn(value))
            except Exception:  # noqa: BLE001 - the rule's own failure is the row's
                return False
        return F.udf(safe, "boolean", useArrow=True)(c)

    def fix(c: Column, dtype: T.DataType) -> Column:
        def safe(value):
            import pyarrow as pa
            from pyspark.sql.pandas.types import to_arrow_type
            try:
                new = fix_fn(value)
                pa.array([new], to_arrow_type(dtype))
                return new
            except Exception:  # noqa: BLE001
                return value
        return F.udf(safe, dtype, useArrow=True)(c)
    return DQRule(name, column, check, fix if fix_fn is not None else None, severity)


# ── engine ─────────────────────────────────────────────────────────────────
def _p(i):
    return f"__dq_p{i}"


def _v(i):
    return f"__dq_v{i}"


def apply_rules(df: DataFrame, rules: list[DQRule]) -> DataFrame:
    """Annotate every row: per rule a pass flag and the value text it checked; the
    rule columns are fixed in place. Rule i's columns are ``__dq_p{i}``/``__dq_v{i}``."""
    out = df
    for i, r in enumerate(rules):
        types = {f.name: f.dataType for f in out.schema.fields}
        if r.column not in types:  # a fix on an absent column creates it
            out = out.withColumn(r.column, F.lit(None).cast("string"))
            types[r.column] = T.StringType()
        c, t = F.col(f"`{r.column}`"), types[r.column]
        out = out.withColumns({_p(i): r.check(c, t), _v(i): text_or_none(c)})
        if r.fix_fn is not None:
            out = out.withColumn(r.column, F.when(F.col(_p(i)), c).otherwise(r.fix(c, t)))
    return out


def _results_array(rules: list[DQRule], only_failed_errors: bool) -> Column:
    items = []
    for i, r in enumerate(rules):
        if only_failed_errors:
            if r.severity != ERROR:
                continue
            items.append(F.when(~F.col(_p(i)), F.struct(
                F.lit(r.name).alias("rule"), F.lit(r.column).alias("column"),
                F.col(_v(i)).alias("value"))))
        else:
            items.append(F.struct(
                F.lit(r.name).alias("rule"), F.lit(r.column).alias("column"),
                F.col(_p(i)).alias("passed"), F.lit(r.severity).alias("severity"),
                F.col(_v(i)).alias("value")))
    if not items:
        return F.array().cast("array<struct<rule:string,column:string,value:string>>")
    arr = F.array(*items)
    return F.filter(arr, lambda x: x.isNotNull()) if only_failed_errors else arr


@dataclass
class SilverBatch:
    """Outcome of running rules over a batch. ``annotated`` carries every row once;
    ``clean`` and ``rejected`` are disjoint filters of it."""
    annotated: DataFrame
    rules: list[DQRule]
    columns: list[str]

    @property
    def _internal(self) -> list[str]:
        return [n for i in range(len(self.rules)) for n in (_p(i), _v(i))]

    @property
    def has_error(self) -> Column:
        errs = [~F.col(_p(i)) for i, r in enumerate(self.rules) if r.severity == ERROR]
        if not errs:
            return F.lit(False)
        out = errs[0]
        for e in errs[1:]:
            out = out | e
        return out

    @property
    def clean(self) -> DataFrame:
        return self.annotated.filter(~self.has_error).select(*[f"`{c}`" for c in self.columns])

    @property
    def rejected(self) -> DataFrame:
        """Rejected rows (after warning fixes) with ``_dq_errors``: the failed
        error-severity rules, each with the value it saw as text."""
        return (self.annotated.filter(self.has_error)
                .select(*[f"`{c}`" for c in self.columns],
                        _results_array(self.rules, True).alias(DQ_ERRORS)))

    def results(self, *id_columns: str) -> DataFrame:
        """Long form: one row per (input row, rule)."""
        return (self.annotated
                .select(*id_columns, F.explode(_results_array(self.rules, False)).alias("r"))
                .select(*id_columns, "r.rule", "r.column", "r.passed", "r.severity", "r.value"))

    def rule_counts(self) -> DataFrame:
        """Failures per rule (all severities) from one aggregation; only rules that
        failed at least once appear."""
        if not self.rules:
            return self.annotated.sparkSession.createDataFrame([], "rule string, failures bigint")
        agg = self.annotated.agg(*[F.count_if(~F.col(_p(i))).alias(f"c{i}")
                                   for i in range(len(self.rules))])
        pairs = F.array(*[F.struct(F.lit(r.name).alias("rule"), F.col(f"c{i}").alias("failures"))
                          for i, r in enumerate(self.rules)])
        # Two rules may share a name: sum their failures.
        return (agg.select(F.explode(pairs).alias("x")).select("x.rule", "x.failures")
                .groupBy("rule").agg(F.sum("failures").cast("bigint").alias("failures"))
                .filter(F.col("failures") > 0))

    def write_split(self, path: str, mode: str = "overwrite") -> dict:
        """Write clean and rejected rows in ONE job: a table partitioned by
        ``_dq_status`` (``clean`` / ``rejected``; ``_dq_errors`` is null on clean rows).
        Row counts and failures per rule are collected as observed metrics of that
        same job (no second pass) and returned as a small dict."""
        from pyspark.sql import Observation
        from lakeshift.sinks.write import write_table
        obs = Observation("dq_split")
        metrics = [F.count(F.lit(1)).alias("input_records"),
                   F.count_if(self.has_error).alias("rejected_records")]
        metrics += [F.count_if(~F.col(_p(i))).alias(f"failed_{i}") for i in range(len(self.rules))]
        err = self.has_error
        out = self.annotated.observe(obs, *metrics).select(
            *[f"`{c}`" for c in self.columns],
            F.when(err, _results_array(self.rules, True)).alias(DQ_ERRORS),
            F.when(err, F.lit("rejected")).otherwise(F.lit("clean")).alias(DQ_STATUS))
        write_table(out, path, mode, partition_by=DQ_STATUS, replace="table", rebalance=False)
        m = obs.get
        failures: dict[str, int] = {}
        for i, r in enumerate(self.rules):
            failures[r.name] = failures.get(r.name, 0) + int(m[f"failed_{i}"])
        return {"input_records": int(m["input_records"]),
                "rejected_records": int(m["rejected_records"]),
                "clean_records": int(m["input_records"]) - int(m["rejected_records"]),
                "rule_failures": {k: v for k, v in failures.items() if v > 0}}

    def counts(self) -> DataFrame:
        """clean / rejected counts in one aggregation."""
        return self.annotated.agg(F.count_if(~self.has_error).alias("clean_records"),
                                  F.count_if(self.has_error).alias("rejected_records"))


def process_batch(df: DataFrame, rules: list[DQRule]) -> SilverBatch:
    return SilverBatch(apply_rules(df, rules), list(rules), list(df.columns) +
                       [r.column for r in rules if r.column not in df.columns])


def check_rule(df: DataFrame, rule: DQRule) -> DataFrame:
    """One rule on its own: the input with ``passed`` and the column fixed in place."""
    out = apply_rules(df, [rule])
    return out.withColumnRenamed(_p(0), "passed").drop(_v(0))


def silver_stats(counts: DataFrame, dedup_removed: Column | int = 0) -> DataFrame:
    """clean / rejected counts -> input, rejection % (2 dp, 0 input -> 0.0), passed
    iff nothing was rejected."""
    clean, rej = F.col("clean_records"), F.col("rejected_records")
    total = clean + rej
    removed = dedup_removed if isinstance(dedup_removed, Column) else F.lit(dedup_removed)
    return counts.select(
        total.alias("input_records"), clean, rej,
        removed.cast("bigint").alias("deduplication_removed"),
        F.when(total > 0, F.round(rej / total * 100, 2)).otherwise(F.lit(0.0))
        .alias("rejection_rate_pct"),
        (rej == 0).alias("passed"))
