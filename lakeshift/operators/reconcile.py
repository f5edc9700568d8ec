"""Source-to-target reconciliation.

Plan shape, independent of data size:
* all scalar checks (row count, column sums, null rates) come from ONE aggregation
  over ``source UNION ALL target`` tagged by side -- one scan per side, partial
  aggregation map-side, a single tiny final merge;
* each key-completeness / distinct-values check is ONE flag aggregation:
  ``source.select(v, 1) UNION ALL target.select(v, 2)`` grouped by ``v`` with
  ``bit_or`` -- 1 = only in source, 2 = only in target, 3 = both. Map-side combine
  collapses hot values before the shuffle, so a value holding a third of all rows
  costs one row per map task. Samples for messages are the smallest n values of each
  one-sided set, from one ``row_number() <= n`` window per flag that Spark limits
  map-side (WindowGroupLimit) -- bounded, never a collected set;
* single-row results are combined by union + aggregate, never by a join.

Report row schema: table_name, check_name, layer, status, source_value, target_value,
discrepancy (double), missing, extra (bigint), message, check_order (int).
"""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from lakeshift.functions.text import fmt_fixed, py_list_text

PASS, WARN, FAIL, SKIP = "PASS", "WARN", "FAIL", "SKIP"
SEVERITY = {PASS: 0, SKIP: 0, WARN: 1, FAIL: 2}
REPORT_COLUMNS = ("table_name", "check_name", "layer", "status", "source_value",
                  "target_value", "discrepancy", "missing", "extra", "message", "check_order")


def _num(x) -> str:
    """Python's text for a parameter (e.g. 5.0 -> '5.0'), as messages print it."""
    return str(x)


def _combine_rows(frames: Sequence[DataFrame]) -> DataFrame:
    """Merge single-row frames with disjoint columns into one row (union + max)."""
    u = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return u.agg(*[F.max(F.col(f"`{c}`")).alias(c) for c in u.columns])


def _check_row(name: Column | str, status: Column, src: Column, tgt: Column,
               disc: Column | None, missing: Column | None, extra: Column | None,
               message: Column, order: int) -> Column:
    lit_or = lambda x, t: F.lit(None).cast(t) if x is None else x.cast(t)
    return F.struct(
        (F.lit(name) if isinstance(name, str) else name).alias("check_name"),
        status.alias("status"),
        src.cast("double").alias("source_value"),
        tgt.cast("double").alias("target_value"),
        lit_or(disc, "double").alias("discrepancy"),
        lit_or(missing, "bigint").alias("missing"),
        lit_or(extra, "bigint").alias("extra"),
        message.alias("message"),
        F.lit(order).alias("check_order"))


def _finish(rows: DataFrame, table_name: str, layer: str) -> DataFrame:
    return rows.select(F.lit(table_name).alias("table_name"), "check_name",
                       F.lit(layer).alias("layer"), "status", "source_value", "target_value",
                       "discrepancy", "missing", "extra", "message", "check_order")


# ── scalar profile ──────────────────────────────────────────────────────────
def _has(df: DataFrame, c: str) -> bool:
    return c in df.columns


def _sum_type(source: DataFrame, target: DataFrame, c: str) -> T.DataType:
    ts = [f.dataType for df in (source, target) for f in df.schema.fields if f.name == c]
    if ts and all(isinstance(t, (T.DecimalType, T.IntegralType)) for t in ts):
        return T.DecimalType(38, max([t.scale for t in ts if isinstance(t, T.DecimalType)] or [0]))
    return T.DoubleType()


def profile(source: DataFrame, target: DataFrame, numeric: Sequence[str] = (),
            nullable: Sequence[str] = ()) -> DataFrame:
    """One row: rows per side, per-column sums (null and absent -> 0; decimal and
    integer sums are exact), per-column counts of values that are no numbers
    (``junk``, both sides) and per-column null counts (absent column -> all null)."""
    def side(df: DataFrame, tag: int) -> DataFrame:
        cols = [F.lit(tag).alias("__side")]
        for i, c in enumerate(numeric):
            t = _sum_type(source, target, c)
            # try_cast: a value that is no number is counted instead of failing the job
            v = F.col(f"`{c}`").try_cast(t) if _has(df, c) else F.lit(None).cast(t)
            bad = F.col(f"`{c}`").isNotNull() & v.isNull() if _has(df, c) else F.lit(False)
            cols += [v.alias(f"__n{i}"), bad.alias(f"__j{i}")]
        for i, c in enumerate(nullable):
            v = F.col(f"`{c}`").isNull() if _has(df, c) else F.lit(True)
            cols.append(v.alias(f"__z{i}"))
        return df.select(*cols)

    u = side(source, 1).unionByName(side(target, 2))
    s1, s2 = F.col("__side") == 1, F.col("__side") == 2
    aggs = [F.count_if(s1).alias("src_rows"), F.count_if(s2).alias("tgt_rows")]
    for i, c in enumerate(numeric):
        t = _sum_type(source, target, c)
        zero = F.lit(0).cast(t)
        aggs += [F.coalesce(F.sum(F.when(s1, F.col(f"__n{i}"))), zero).alias(f"src_sum{i}"),
                 F.coalesce(F.sum(F.when(s2, F.col(f"__n{i}"))), zero).alias(f"tgt_sum{i}"),
                 F.count_if(F.col(f"__j{i}")).alias(f"junk{i}")]
    for i, _ in enumerate(nullable):
        aggs += [F.count_if(s1 & F.col(f"__z{i}")).alias(f"src_null{i}"),
                 F.count_if(s2 & F.col(f"__z{i}")).alias(f"tgt_null{i}")]
    return u.agg(*aggs)


# ── set comparison via flags ────────────────────────────────────────────────
def value_flags(source: DataFrame, target: DataFrame, column: str) -> DataFrame:
    """``v, f`` per distinct value (null included): f = bit_or of 1 (source) and 2 (target)."""
    def side(df, tag):
        v = F.col(f"`{column}`") if _has(df, column) else F.lit(None)
        return df.select(v.alias("v"), F.lit(tag).alias("f"))
    src, tgt = side(source, 1), side(target, 2)
    ts, tt = src.schema["v"].dataType, tgt.schema["v"].dataType
    if ts != tt:
        common = _common_type(ts, tt)
        src = src.select(F.col("v").cast(common).alias("v"), "f")
        tgt = tgt.select(F.col("v").cast(common).alias("v"), "f")
    return (src.unionByName(tgt).groupBy("v")
            .agg(F.bit_or("f").alias("f")))


def _common_type(a: T.DataType, b: T.DataType) -> T.DataType:
    """Type both sides of a set comparison are compared in: the absent side takes the
    other's type; integers widen to bigint; decimals to the widest scale; other numeric
    mixes to double; anything else compares as text."""
    if isinstance(a, T.NullType):
        return b
    if isinstance(b, T.NullType):
        return a
    if isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType):
        return T.LongType()
    if isinstance(a, (T.DecimalType, T.IntegralType)) and isinstance(b, (T.DecimalType, T.IntegralType)):
        scale = max(x.scale for x in (a, b) if isinstance(x, T.DecimalType))
        return T.DecimalType(38, scale)
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    return T.StringType()


def _set_summary(flags: DataFrame, sample_flag: int, sample_n: int) -> DataFrame:
    nn = F.col("v").isNotNull()
    f = F.col("f")
    summary = flags.agg(
        F.count_if((f % 2) == 1).alias("src_values"), F.count_if(f >= 2).alias("tgt_values"),
        F.count_if(nn & ((f % 2) == 1)).alias("src_distinct"),
        F.count_if(nn & (f >= 2)).alias("tgt_distinct"),
        F.count_if(nn & (f == 1)).alias("only_src"),
        F.count_if(nn & (f == 2)).alias("only_tgt"))
    # Smallest n values of each one-sided set in one pass: row_number() <= n per flag
    # lets Spark keep at most n rows per flag in every map task (WindowGroupLimit)
    # before the tiny exchange, so the collected lists are bounded by n.
    # Both passes consume the same columns of ``flags`` and the sample's filter stays above
    # its aggregation, so Spark scans and shuffles the values once and reuses the exchange.
    other = 3 - sample_flag
    w = Window.partitionBy("f").orderBy("v")
    top = (flags.filter(F.when(nn, f).isin(sample_flag, other))
           .withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= sample_n))
    samples = top.agg(
        F.sort_array(F.collect_list(F.when(f == sample_flag, F.col("v")))).alias("sample"),
        F.sort_array(F.collect_list(F.when(f == other, F.col("v")))).alias("sample_other"))
    return _combine_rows([summary, samples])


def _is_text(df: DataFrame, column: str) -> bool:
    return any(f.name == column and isinstance(f.dataType, T.StringType)
               for f in df.schema.fields)


# ── individual checks ──────────────────────────────────────────────────────
def row_count_check_row(src: Column, tgt: Column, table_name: str, tolerance_pct: float,
                        order: int = 0) -> Column:
    d = F.abs(src - tgt)
    pct = F.when(src > 0, d / src * 100).otherwise(F.lit(100.0))
    tol = float(tolerance_pct)
    status = (F.when(src == tgt, F.lit(PASS)).when(pct <= tol, F.lit(WARN)).otherwise(F.lit(FAIL)))
    ps = fmt_fixed(pct, 1)
    msg = (F.when(src == tgt, F.concat(F.lit("Row counts match exactly: "), src.cast("string")))
           .when(pct <= tol, F.concat(
               F.lit("Row count within tolerance: source="), src.cast("string"),
               F.lit(", target="), tgt.cast("string"), F.lit(" ("), ps,
               F.lit(f"% diff ≤ {_num(tolerance_pct)}% tolerance)")))
           .otherwise(F.concat(
               F.lit("Row count mismatch: source="), src.cast("string"),
               F.lit(", target="), tgt.cast("string"), F.lit(" ("), ps,
               F.lit(f"% diff > {_num(tolerance_pct)}% tolerance)"))))
    return _check_row(f"row_count_{table_name}", status, src, tgt, d, None, None, msg, order)


def _sum_check_row(column: str, table_name: str, s: Column, t: Column, junk: Column,
                   tolerance: float, order: int) -> Column:
    diff = F.abs(s - t)
    ok = (junk == 0) & (diff <= F.lit(tolerance))
    msg = F.when(junk > 0, F.concat(F.lit(f"Column SUM not comparable: {column} has "), junk.cast("string"),
                                    F.lit(" values that are no numbers"))) \
        .when(ok, F.concat(F.lit(f"Column SUM matches: {column} = "), fmt_fixed(s, 4))) \
        .otherwise(F.concat(F.lit(f"Column SUM mismatch: {column} — source="), fmt_fixed(s, 4),
                            F.lit(", target="), fmt_fixed(t, 4), F.lit(", diff="),
                            fmt_fixed(diff, 4)))
    r4 = lambda x: F.round(x.cast("double"), 4)
    return _check_row(f"col_sum_{column}_{table_name}",
                      F.when(ok, F.lit(PASS)).otherwise(F.lit(FAIL)),
                      r4(s), r4(t), r4(diff), None, None, msg, order)


def _null_rate_check_row(column: str, table_name: str, sn: Column, sr: Column, tn: Column,
                         tr: Column, tolerance_pct: float, order: int) -> Column:
    s = F.when(sr > 0, sn / sr * 100).otherwise(F.lit(0.0))
    t = F.when(tr > 0, tn / tr * 100).otherwise(F.lit(0.0))
    diff = t - s
    tol = float(tolerance_pct)
    status = F.when(diff <= 0, F.lit(PASS)).when(diff <= tol, F.lit(WARN)).otherwise(F.lit(FAIL))
    body = [F.lit(f"{column} source="), fmt_fixed(s, 1), F.lit("%, target="), fmt_fixed(t, 1),
            F.lit("%")]
    msg = (F.when(diff <= 0, F.concat(F.lit("Null rate OK: "), *body))
           .when(diff <= tol, F.concat(F.lit("Null rate slightly higher in target: "), *body,
                                       F.lit(" (diff="), fmt_fixed(diff, 1), F.lit("%)")))
           .otherwise(F.concat(F.lit("Null rate significantly higher in target: "), *body,
                               F.lit(" (diff="), fmt_fixed(diff, 1),
                               F.lit(f"% > {_num(tolerance_pct)}% tolerance)"))))
    r2 = lambda x: F.round(x, 2)
    return _check_row(f"null_rate_{column}_{table_name}", status, r2(s), r2(t), r2(diff),
                      None, None, msg, order)


def _distinct_check_frame(source: DataFrame, target: DataFrame, column: str,
                          table_name: str, order: int, sample_n: int = 5) -> DataFrame:
    s = _set_summary(value_flags(source, target, column), 1, sample_n)
    quote = _is_text(source, column) or _is_text(target, column)
    lost, new = F.col("only_src"), F.col("only_tgt")
    status = (F.when((lost == 0) & (new == 0), F.lit(PASS))
              .when(lost > 0, F.lit(FAIL)).otherwise(F.lit(WARN)))
    msg = (F.when((lost == 0) & (new == 0), F.concat(
               F.lit(f"Distinct values match: {column} ("), F.col("src_distinct").cast("string"),
               F.lit(" values)")))
           .when(lost > 0, F.concat(
               F.lit(f"Lost distinct values in {column}: "), py_list_text(F.col("sample"), quote),
               F.lit(" (total="), lost.cast("string"), F.lit(" missing)")))
           .otherwise(F.concat(
               F.lit(f"New distinct values in target {column}: "),
               py_list_text(F.col("sample_other"), quote), F.lit(" (not in source)"))))
    return s.select(_check_row(f"distinct_values_{column}_{table_name}", status,
                               F.col("src_distinct"), F.col("tgt_distinct"), None, lost, new,
                               msg, order).alias("r")).select("r.*")


def _pk_check_frame(source: DataFrame, target: DataFrame, pk: str, table_name: str,
                    order: int, sample_n: int = 3, require_rows: bool = False) -> DataFrame:
    s = _set_summary(value_flags(source, target, pk), 1, sample_n)
    if require_rows:
        s = s.filter((F.col("src_values") > 0) & (F.col("tgt_values") > 0))
    quote = _is_text(source, pk) or _is_text(target, pk)
    missing, extra = F.col("only_src"), F.col("only_tgt")
    status = F.when(missing == 0, F.lit(PASS)).otherwise(F.lit(FAIL))
    msg = F.when(missing == 0, F.concat(F.lit("All "), F.col("src_distinct").cast("string"),
                                        F.lit(" source PKs present in target"))) \
        .otherwise(F.concat(F.lit("Missing PKs in target: "), missing.cast("string"),
                            F.lit(" keys absent. Sample: "), py_list_text(F.col("sample"), quote)))
    return s.select(_check_row(f"pk_completeness_{pk}_{table_name}", status,
                               F.col("src_distinct"), F.col("tgt_distinct"), None, missing, extra,
                               msg, order).alias("r")).select("r.*")


# ── drill-down by digests ───────────────────────────────────────────────────
BUCKETS = 4096
ONLY_SOURCE, ONLY_TARGET, DIFFERS = "only_source", "only_target", "differs"


def differing_buckets(source: DataFrame, target: DataFrame, key: str, compare: Sequence[str] = (),
                      buckets: int = BUCKETS) -> DataFrame:
    """``__bucket`` of the key hashes whose rows differ: an order-free digest per bucket (rows, sum and
    exclusive or of row hashes), at most ``buckets`` rows, combined map-side."""
    rows = _signed(source, target, key, compare, buckets)
    digest = rows.groupBy("__bucket").agg(F.sum("__sign").alias("n"), F.sum(F.col("__sign") * F.col("__row").cast("decimal(38,0)")).alias("s"),
                                          F.bit_xor("__row").alias("x"))
    return digest.filter("n <> 0 or s <> 0 or x <> 0").select("__bucket")


def _signed(source: DataFrame, target: DataFrame, key: str, compare: Sequence[str], buckets: int) -> DataFrame:
    """Both sides with their key, bucket, sign (1 source, -1 target) and row hash, in common types."""
    def kind(c: str) -> T.DataType:
        a, b = (df.schema[c].dataType for df in (source, target))
        return a if a == b else _common_type(a, b)

    def side(df: DataFrame, sign: int) -> DataFrame:
        k = F.col(f"`{key}`").cast(kind(key))
        # an absent value is told from every present one by the flag beside it
        values = [x for c in compare for x in (F.col(f"`{c}`").isNull(), F.col(f"`{c}`").cast(kind(c)))]
        return df.select(k.alias("__key"), F.pmod(F.xxhash64(k), F.lit(buckets)).alias("__bucket"), F.lit(sign).alias("__sign"),
                         F.xxhash64(k, *values).alias("__row"))
    return side(source, 1).unionByName(side(target, -1))


def key_differences(source: DataFrame, target: DataFrame, key: str, compare: Sequence[str] = (),
                    buckets: int = BUCKETS) -> DataFrame:
    """``key``, ``difference`` of the keys (null included) that one side lacks or whose rows differ in the
    ``compare`` columns or their number. Only rows of buckets whose digests differ are shuffled by key;
    the list of those has at most ``buckets`` rows and is broadcast. Equal tables shuffle no key."""
    rows = _signed(source, target, key, compare, buckets)
    wanted = F.broadcast(differing_buckets(source, target, key, compare, buckets))
    keys = rows.join(wanted, "__bucket", "left_semi").groupBy("__key").agg(
        F.count_if(F.col("__sign") > 0).alias("a"), F.count_if(F.col("__sign") < 0).alias("b"),
        F.sum(F.col("__sign") * F.col("__row").cast("decimal(38,0)")).alias("s"), F.bit_xor("__row").alias("x"))
    kind = (F.when(F.col("b") == 0, ONLY_SOURCE).when(F.col("a") == 0, ONLY_TARGET)
            .when((F.col("a") != F.col("b")) | (F.col("s") != 0) | (F.col("x") != 0), DIFFERS))
    return keys.select(F.col("__key").alias(key), kind.alias("difference")).filter("difference is not null")


# ── public API ─────────────────────────────────────────────────────────────
def check_row_count(source: DataFrame, target: DataFrame, table_name: str,
                    tolerance_pct: float = 0.0, layer: str = "silver") -> DataFrame:
    """Equal -> PASS (0 vs 0 passes); within tolerance % of source -> WARN; else FAIL.
    Source 0 with target > 0 is a 100% difference."""
    p = profile(source, target)
    return _finish(p.select(row_count_check_row(F.col("src_rows"), F.col("tgt_rows"),
                                                table_name, tolerance_pct).alias("r"))
                   .select("r.*"), table_name, layer)


def check_column_sum(source: DataFrame, target: DataFrame, column: str, table_name: str,
                     tolerance: float = 0.01, layer: str = "silver") -> DataFrame:
    """SUM with null -> 0; PASS iff |diff| <= tolerance and every value is a number."""
    p = profile(source, target, numeric=[column])
    return _finish(p.select(_sum_check_row(column, table_name, F.col("src_sum0"),
                                           F.col("tgt_sum0"), F.col("junk0"), tolerance, 0).alias("r"))
                   .select("r.*"), table_name, layer)


def check_null_rate(source: DataFrame, target: DataFrame, column: str, table_name: str,
                    tolerance_pct: float = 5.0, layer: str = "silver") -> DataFrame:
    """Signed target-minus-source null % : <= 0 PASS, <= tolerance WARN, else FAIL."""
    p = profile(source, target, nullable=[column])
    return _finish(p.select(_null_rate_check_row(
        column, table_name, F.col("src_null0"), F.col("src_rows"), F.col("tgt_null0"),
        F.col("tgt_rows"), tolerance_pct, 0).alias("r")).select("r.*"), table_name, layer)


def check_distinct_values(source: DataFrame, target: DataFrame, column: str, table_name: str,
                          layer: str = "silver") -> DataFrame:
    """Nulls ignored. Any lost value -> FAIL; only new values -> WARN; else PASS."""
    return _finish(_distinct_check_frame(source, target, column, table_name, 0),
                   table_name, layer)


def check_primary_key_completeness(source: DataFrame, target: DataFrame, pk_column: str,
                                   table_name: str, layer: str = "silver") -> DataFrame:
    """Nulls ignored. Any source key missing from target -> FAIL; extra keys pass."""
    return _finish(_pk_check_frame(source, target, pk_column, table_name, 0),
                   table_name, layer)


def run_full_reconciliation(source: DataFrame, target: DataFrame, table_name: str,
                            pk_column: str | None, numeric_columns: Sequence[str] = (),
                            nullable_columns: Sequence[str] = (),
                            distinct_columns: Sequence[str] = (),
                            row_count_tolerance_pct: float = 0.0,
                            layer: str = "silver") -> DataFrame:
    """All checks in reference order: row count, PK completeness (only when both sides
    have the column and at least one row), column sums, null rates, distinct values."""
    numeric_columns, nullable_columns = list(numeric_columns or []), list(nullable_columns or [])
    p = profile(source, target, numeric_columns, nullable_columns)
    order = 0
    rows = [row_count_check_row(F.col("src_rows"), F.col("tgt_rows"), table_name,
                                row_count_tolerance_pct, order)]
    pk_frames = []
    if pk_column and _has(source, pk_column) and _has(target, pk_column):
        order += 1
        pk_frames.append(_pk_check_frame(source, target, pk_column, table_name, order,
                                         require_rows=True))
    for i, c in enumerate(numeric_columns):
        order += 1
        rows.append(_sum_check_row(c, table_name, F.col(f"src_sum{i}"), F.col(f"tgt_sum{i}"), F.col(f"junk{i}"),
                                   0.01, order))
    for i, c in enumerate(nullable_columns):
        order += 1
        rows.append(_null_rate_check_row(c, table_name, F.col(f"src_null{i}"), F.col("src_rows"),
                                         F.col(f"tgt_null{i}"), F.col("tgt_rows"), 5.0, order))
    scalar = p.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    frames = [scalar, *pk_frames]
    for c in distinct_columns or []:
        order += 1
        frames.append(_distinct_check_frame(source, target, c, table_name, order))
    return _finish(reduce(DataFrame.unionByName, frames), table_name, layer)


def report_summary(report: DataFrame, table_name: str = "") -> DataFrame:
    """Per table: PASS / WARN / FAIL counts, overall status (FAIL > WARN > PASS) and
    the summary line. An empty report is one PASS row of zero counts for ``table_name``."""
    st = F.col("status")
    g = report.groupBy("table_name").agg(F.count_if(st == PASS).alias("passed"),
                                         F.count_if(st == WARN).alias("warned"),
                                         F.count_if(st == FAIL).alias("failed"))
    zero = F.lit(0).cast("long")
    none = report.agg(F.count(F.lit(1)).alias("n")).filter("n = 0").select(
        F.lit(table_name).alias("table_name"), zero.alias("passed"), zero.alias("warned"), zero.alias("failed"))
    g = g.unionByName(none)
    overall = (F.when(F.col("failed") > 0, F.lit(FAIL))
               .when(F.col("warned") > 0, F.lit(WARN)).otherwise(F.lit(PASS)))
    return g.select("table_name", "passed", "warned", "failed", overall.alias("overall_status"),
                    F.concat(F.lit("Reconciliation ["), F.col("table_name"), F.lit("]: "),
                             F.col("passed").cast("string"), F.lit(" PASS / "),
                             F.col("warned").cast("string"), F.lit(" WARN / "),
                             F.col("failed").cast("string"), F.lit(" FAIL — Overall: "),
                             overall).alias("summary"))


# ── silver-layer variants (different zero and tolerance rules) ─────────────
def reconcile_row_counts(source: DataFrame, target: DataFrame,
                         tolerance_pct: float = 0.0) -> DataFrame:
    """pct = |diff| / source * 100, and source 0 -> 100% even when target is 0;
    passes iff pct <= tolerance."""
    p = profile(source, target)
    s, t = F.col("src_rows"), F.col("tgt_rows")
    d = F.abs(s - t)
    pct = F.when(s > 0, d / s * 100).otherwise(F.lit(100.0))
    ok = pct <= float(tolerance_pct)
    msg = F.when(ok, F.concat(F.lit(f"PASS: row counts match within {_num(tolerance_pct)}% "
                                    "tolerance (source="), s.cast("string"), F.lit(", target="),
                              t.cast("string"), F.lit(")"))) \
        .otherwise(F.concat(F.lit("FAIL: row count mismatch — source="), s.cast("string"),
                            F.lit(", target="), t.cast("string"), F.lit(", discrepancy="),
                            d.cast("string"), F.lit(" ("), fmt_fixed(pct, 1), F.lit("%)")))
    return p.select(s.alias("source_count"), t.alias("target_count"), ok.alias("count_match"),
                    d.alias("discrepancy"), F.round(pct, 2).alias("discrepancy_pct"),
                    ok.alias("passed"), msg.alias("message"))


def reconcile_column_checksums(source: DataFrame, target: DataFrame,
                               numeric_columns: Sequence[str]) -> DataFrame:
    """Per column: sums (nulls skipped), |diff| rounded to 4 dp; passes iff diff < 0.01 and
    no value of either side fails to be a number."""
    numeric_columns = list(numeric_columns)
    p = profile(source, target, numeric=numeric_columns)
    rows = []
    for i, c in enumerate(numeric_columns):
        s, t = F.col(f"src_sum{i}"), F.col(f"tgt_sum{i}")
        diff = F.abs(s - t)
        junk = F.col(f"junk{i}")
        ok = (junk == 0) & (diff < F.lit(0.01))
        rows.append(F.struct(
            F.lit(c).alias("column"),
            F.round(s.cast("double"), 4).alias("source_sum"),
            F.round(t.cast("double"), 4).alias("target_sum"),
            F.round(diff.cast("double"), 4).alias("difference"),
            ok.alias("passed"),
            F.when(ok, F.lit("PASS")).when(junk > 0, F.concat(
                F.lit("FAIL: "), junk.cast("string"), F.lit(" values are no numbers"))).otherwise(F.concat(
                F.lit("FAIL: sum mismatch ("), fmt_fixed(diff, 4), F.lit(" difference)")))
            .alias("message")))
    return p.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
