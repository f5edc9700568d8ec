"""Quality rules with adaptive thresholds from mergeable quantile sketches (operator 10), native.

1. Per document, from array functions alone: words, characters in words, symbols, duplicate
   lines, words inside repeated 3-word windows. Windows are found by one sort of packed longs
   (hash of the window above its position; whole hash beside its position in texts of more than
   ``LONG_TEXT`` words) and confirmed by their words, so no row leaves its document.
2. Per (lang, source), a quantile sketch of each rate: values fall into buckets of ratio
   ``GAMMA`` above ``LEAST`` (relative error under 5 %); a sketch is its bucket counts, so
   sketches merge by addition, in any order, with the same result every time. Counting is a
   partial aggregation before the shuffle; a hot source costs one row per bucket and task.
3. Thresholds, from the documents that pass the base rule: two quantiles lo, hi are read off the
   running counts; a rate fails above max(FLOOR, hi + spread * (hi - lo)). Symbols are foreign to a
   text unless its group has them (quartiles, so that a tenth of junk does not move the limit);
   duplicate lines and repeats stand in few but sound documents (upper quantiles). Groups of
   fewer than ``LEAST_DOCS`` documents, or whose upper quantile is 0 and says nothing, use the
   sketch of their language over all sources, or else of all documents; ``CUTOFFS`` hold only
   where that says nothing either.
4. Joined filtering: documents meet their group's thresholds by an ordinary equi-join
   (broadcast only if Spark's size limit allows, else split by skew handling).

Defined results: null, empty or blank text has no words and fails the base rule; null lang and
null source are groups of their own; repeated rows are judged row by row and each counts; an
empty table gives no rows; extra columns with any names do not matter.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshift.llm.shared import load, stored

#: Word and white-space characters, symbols, base limits.
BETWEEN = r"[\x20\x09-\x0D]+"
SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
TRIPLE = 3
LONG_TEXT = 1 << 16

GAMMA = 1.1
LEAST = 1e-4
LEAST_DOCS = 200
#: Smallest threshold: rates below it are noise of single characters or words.
FLOOR = 0.01
#: Shares of documents at lo and hi, and the spread, of each rate.
LIMITS = {"symbol_rate": (0.5, 0.75, 6.0), "dup_line_rate": (0.9, 0.99, 2.0), "repeat_rate": (0.9, 0.99, 2.0)}
#: Thresholds of rates with an upper quantile of 0 over all documents.
CUTOFFS = {"dup_line_rate": 0.5, "repeat_rate": 0.4}


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, BETWEEN), lambda w: w != "")


def window_hash(words: Column, i: Column) -> Column:
    return F.xxhash64(*[F.get(words, i + k) for k in range(TRIPLE)])


def repeated_at(words: Column, windows: Column, key, place) -> Column:
    """Positions, in order, of windows that equal a neighbour among the sorted ``windows``."""
    rest = F.greatest(F.size(windows) - 1, F.lit(0))

    def pair(a: Column, b: Column) -> Column:
        equal = key(a) == key(b)
        for k in range(TRIPLE):
            equal = equal & (F.get(words, place(a).cast("int") + k) == F.get(words, place(b).cast("int") + k))
        return F.when(equal, F.array(place(a), place(b)))

    same = F.zip_with(F.slice(windows, F.lit(1), rest), F.slice(windows, F.lit(2), rest), pair)
    return F.sort_array(F.array_distinct(F.flatten(F.filter(same, lambda x: x.isNotNull()))))


def with_repeats(base: DataFrame) -> DataFrame:
    """``base`` with ``_at``: positions of the 3-word windows of ``_words`` that occur twice or more.

    A window's long holds its hash above its position (as many low bits as the number of words
    needs), so one sort brings equal windows together in order of position. In long texts
    that would leave too few bits of the hash: they sort pairs of hash and position.
    """
    words, n, bits = F.col("_words"), F.size("_words"), F.col("_bits")
    base = base.withColumn("_bits", F.ceil(F.log2(n.cast("double"))).cast("int"))
    places = F.sequence(F.lit(0), n - TRIPLE)
    packed = F.transform(places, lambda i: F.call_function("shiftleft", window_hash(words, i), bits).bitwiseOR(i.cast("long")))
    pairs = F.transform(places, lambda i: F.struct(window_hash(words, i).alias("hash"), i.cast("long").alias("place")))
    base = base.withColumn("_sorted", F.sort_array(F.when((n >= TRIPLE) & (n <= LONG_TEXT), packed)))
    base = base.withColumn("_pairs", F.sort_array(F.when((n >= TRIPLE) & (n > LONG_TEXT), pairs)))
    mask = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
    return base.withColumn("_at", F.when(
        n > LONG_TEXT, repeated_at(words, F.col("_pairs"), lambda x: x["hash"], lambda x: x["place"])).otherwise(
        repeated_at(words, F.col("_sorted"), lambda x: F.call_function("shiftright", x, bits), lambda x: x.bitwiseAND(mask))))


def document_rates(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source and the base counts of each row of ``docs``."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("lang").cast("string").alias("lang"),
                       F.col("source").cast("string").alias("source"), text.alias("_text"))
    base = base.withColumn("_words", words_of(F.col("_text")))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.length(F.translate(x, SPACES, "")) > 0)
    base = base.withColumn("_lines", lines)
    base = with_repeats(base)
    # windows in order: each adds the words that the one before does not cover
    covered = F.aggregate("_at", F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("to")),
                          lambda a, p: F.struct((a["n"] + p + TRIPLE - F.greatest(a["to"], p)).alias("n"), (p + TRIPLE).alias("to")),
                          lambda a: a["n"])
    return base.select(
        "doc_id", "lang", "source", F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("_lines").cast("long").alias("n_lines"))


def rates() -> dict[str, Column]:
    part = lambda a, b: F.when(F.col(b) > 0, F.col(a) / F.col(b)).otherwise(F.lit(0.0))
    return {"symbol_rate": part("n_symbols", "word_chars"), "dup_line_rate": part("n_dup_lines", "n_lines"),
            "repeat_rate": part("n_repeat_words", "n_words")}


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def bucket(value: Column) -> Column:
    """Bucket 0 holds values up to LEAST; bucket k those up to LEAST * GAMMA ** k."""
    return F.when(value <= LEAST, F.lit(0)).otherwise(F.ceil(F.log(value / LEAST) / F.log(F.lit(GAMMA)))).cast("int")


def sketches(documents: DataFrame, by: list[str]) -> DataFrame:
    """Bucket counts per group and rate: (by..., rate, bucket, n), of documents that pass the base
    rule; groups without any are there with n = 0. Counts of parts add up."""
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("rate"), bucket(v).alias("bucket")) for k, v in rates().items()]))
    one = F.when(base_failed(), F.lit(0)).otherwise(F.lit(1)).alias("_one")
    return documents.select(*by, one, pairs.alias("_p")).groupBy(*by, "_p.rate", "_p.bucket").agg(F.sum("_one").alias("n"))


def merged(parts: DataFrame, by: list[str]) -> DataFrame:
    return parts.groupBy(*by, "rate", "bucket").agg(F.sum("n").alias("n"))


def quantiles(sketch: DataFrame, by: list[str], shares: dict[str, float]) -> DataFrame:
    """Upper bounds of the buckets in which the given shares are reached, per group and rate."""
    whole = Window.partitionBy(*by, "rate")
    running = sketch.withColumn("_upto", F.sum("n").over(whole.orderBy("bucket"))).withColumn("_all", F.sum("n").over(whole))
    bound = F.when(F.col("bucket") == 0, F.lit(0.0)).otherwise(LEAST * F.pow(F.lit(GAMMA), F.col("bucket")))
    return running.groupBy(*by, "rate").agg(
        F.first("_all").alias("n_docs"),
        *[F.min(F.when(F.col("_upto") >= F.col("_all") * q, bound)).alias(name) for name, q in shares.items()])


def share_name(share: float) -> str:
    return f"q{share:g}".replace(".", "_")


def limit_of(rate: Column) -> Column:
    """The limit that a sketch gives, null if its upper quantile says nothing."""
    out = F.lit(None).cast("double")
    for name, (a, b, spread) in LIMITS.items():
        lo, hi = F.col(share_name(a)), F.col(share_name(b))
        limit = F.greatest(F.lit(FLOOR), hi + spread * (hi - lo))
        out = F.when(rate == name, F.when(hi > 0, limit) if name in CUTOFFS else limit).otherwise(out)
    return out


def thresholds(documents: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """One row per (lang, source): the limit of each rate, from the smallest group that is large enough."""
    shares = {share_name(q): q for a, b, _ in LIMITS.values() for q in (a, b)}
    fine = stored(sketches(documents, ["lang", "source"]), "quality-sketches")
    limits = lambda sketch, by: quantiles(sketch, by, shares).select(*by, "rate", "n_docs", limit_of(F.col("rate")).alias("limit"))
    own = limits(fine, ["lang", "source"])
    tongue = limits(merged(fine, ["lang"]), ["lang"]).select(F.col("lang").alias("_lang"), F.col("rate").alias("_r1"), F.col("n_docs").alias("_n1"), F.col("limit").alias("_l1"))
    world = limits(merged(fine, []), []).select(F.col("rate").alias("_r2"), F.col("limit").alias("_l2"))
    joined = (own.join(tongue, own["lang"].eqNullSafe(F.col("_lang")) & (F.col("rate") == F.col("_r1")))
              .join(world, F.col("rate") == F.col("_r2")))
    cutoff = F.element_at(F.create_map(*[F.lit(x) for kv in CUTOFFS.items() for x in kv]), F.col("rate"))
    limit = F.coalesce(F.when(F.col("n_docs") >= least_docs, F.col("limit")), F.when(F.col("_n1") >= least_docs, F.col("_l1")), F.col("_l2"), cutoff)
    return joined.groupBy("lang", "source").agg(
        *[F.max(F.when(F.col("rate") == k, limit)).alias(f"{k}_limit") for k in LIMITS])


def judge(docs: DataFrame, least_docs: int = LEAST_DOCS) -> DataFrame:
    """Counts, thresholds and verdict of each row of ``docs`` (doc_id, text, lang, source)."""
    documents = stored(document_rates(docs), "quality-rates")
    group = F.concat_ws("", F.when(F.col("lang").isNull(), "0").otherwise("1"), F.length("lang").cast("string"), F.lit(":"),
                        "lang", F.when(F.col("source").isNull(), "0").otherwise("1"), "source")
    limits = thresholds(documents, least_docs).withColumn("_group", group).drop("lang", "source")
    rows = documents.withColumn("_group", group).join(limits, "_group")
    failed = base_failed()
    passes = None
    for name, value in rates().items():
        ok = value <= F.col(f"{name}_limit")
        passes = ok if passes is None else passes & ok
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                       failed.alias("base_failed"), (~failed & passes).alias("kept"),
                       *[f"{k}_limit" for k in LIMITS])


def op10_adaptive_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(load(spark, sf_dir, "documents"))
