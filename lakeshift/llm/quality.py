"""Quality classifier: regularised quadratic discriminant (operator 5).

*Statistics.* One vectorised pass per batch turns each whole text into ``len(FEATURES)`` numbers:
rates of symbols, capitals, marks and bars, distinct words, repeats of the word before, repeated
lines, word lengths, function-word-like short words. Rates are smoothed by a pseudo-count, so
short texts are not extreme, and transformed by logit or log.

*Fit.* Count, sum and cross products per class are summed over all training rows by Spark
(2 x (1 + d + d * d) numbers, whatever the input). Each class covariance is shrunk twice:
towards the pooled one (``POOL``) and towards its own diagonal plus ``RIDGE``. Its Cholesky
factor is computed once and cached in the model.

*Score.* log N(x; mean 1, S1) - log N(x; mean 0, S0) + log prior odds, from Mahalanobis distances
by triangular solves; divided by ``TEMPERATURE`` and passed through the logistic function.

Labels of rows whose crc32(doc_id as text) mod ``FOLDS`` is ``HELD`` are never read; lang, source and
doc_id are no inputs. Defined results: a null or empty text has the statistics of no words and is scored
by them; labels that are null or not 0/1 are ignored, of repeated labels of one doc_id the least holds;
with no rows or one class only in training, every score is the share of class 1 (1.0 without
any); repeated rows score alike; extra columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.llm.shared import empty_text, load, with_workers
from lakeshift.llm.textkit import Words, rolling, slices

FOLDS, HELD = 4, 2
CUT = 0.7
POOL, RIDGE, TEMPERATURE = 0.1, 0.05, 4.0
FEATURES = ("symbols", "capitals", "marks", "bars", "digits", "other", "distinct", "doubled", "pairs", "long", "short", "length", "sentences")
SYMBOL_BYTES, MARK_BYTES = b"#*$%&<>@~^=+_{}[]\\/", b"!?"


def _flags(chars: bytes) -> np.ndarray:
    t = np.zeros(256, bool)
    t[list(chars)] = True
    return t


_KINDS = {"symbols": _flags(SYMBOL_BYTES), "capitals": _flags(bytes(range(65, 91))), "marks": _flags(MARK_BYTES), "bars": _flags(b"|"),
          "digits": _flags(b"0123456789"), "other": _flags(bytes(range(32)) + b"\x7f")}


def statistics(buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Transformed statistics [rows, features] of the texts of a slice."""
    words = Words(buf, offsets)
    rows = words.rows
    n = np.diff(words.first).astype(float)
    hashes = words.hashes()
    doc = words.doc
    size = words.end - words.start

    def per_doc(flags: np.ndarray, of: np.ndarray) -> np.ndarray:
        return np.bincount(of, flags, rows) if len(flags) else np.zeros(rows)

    def rate(part: np.ndarray, whole: np.ndarray, pseudo: float = 0.5) -> np.ndarray:
        p = (part + pseudo * 0.1) / (whole + pseudo * 2)
        p = np.clip(p, 1e-4, 1 - 1e-4)
        return np.log(p / (1 - p))

    def distinct(values: np.ndarray, of: np.ndarray) -> np.ndarray:
        if not len(values):
            return np.zeros(rows)
        order = np.lexsort((values, of))
        v, o = values[order], of[order]
        new = np.ones(len(v), bool)
        new[1:] = (v[1:] != v[:-1]) | (o[1:] != o[:-1])
        return np.bincount(o[new], minlength=rows).astype(float)

    out = np.empty((rows, len(FEATURES)))
    for k, name in enumerate(("symbols", "capitals", "marks", "bars", "digits", "other")):
        sums = np.concatenate([[0], np.cumsum(_KINDS[name][buf])])
        part = (sums[offsets[1:]] - sums[offsets[:-1]]).astype(float)
        out[:, k] = rate(part, n, 4.0)
    same = np.zeros(len(hashes), bool)
    same[1:] = (hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])
    pairs = rolling(hashes, 2)
    inside = doc[1:] == doc[:-1] if len(doc) else np.zeros(0, bool)
    pairs, pair_doc = pairs[inside], doc[1:][inside]
    out[:, 6] = np.log((distinct(hashes, doc) + 4) / (np.power(n, 0.75) + 4))
    out[:, 7] = rate(per_doc(same, doc), n, 2.0)
    out[:, 8] = rate(np.maximum(n - 1, 0) - distinct(pairs, pair_doc), n, 4.0)
    out[:, 9] = rate(per_doc(size > 9, doc), n, 4.0)
    out[:, 10] = rate(per_doc(size <= 3, doc), n, 4.0)
    out[:, 11] = np.log1p(n)
    stop = np.isin(buf[words.end - 1], np.frombuffer(b".", np.uint8)) if len(size) else np.zeros(0, bool)
    out[:, 12] = rate(per_doc(stop, doc), n, 4.0)
    return out


@dataclass
class Model:
    """Per class: log prior, mean, Cholesky factor of the shrunk covariance, its log determinant."""

    prior: np.ndarray
    mean: np.ndarray
    factor: np.ndarray
    logdet: np.ndarray
    constant: float | None = None

    def scores(self, x: np.ndarray) -> np.ndarray:
        if self.constant is not None:
            return np.full(len(x), self.constant)
        log = []
        for c in (0, 1):
            z = np.linalg.solve(self.factor[c], (x - self.mean[c]).T)
            log.append(self.prior[c] - 0.5 * (np.einsum("ij,ij->j", z, z) + self.logdet[c]))
        return 1 / (1 + np.exp(-np.clip((log[1] - log[0]) / TEMPERATURE, -30, 30)))


def model_of(count: np.ndarray, total: np.ndarray, cross: np.ndarray) -> Model:
    """The model from count [2], sums [2, d] and cross products [2, d, d] of the training rows."""
    if (count < 2).any():
        share = float(count[1] / count.sum()) if count.sum() else 1.0
        return Model(*(np.zeros(0),) * 4, constant=share)
    mean = total / count[:, None]
    cov = cross / count[:, None, None] - mean[:, :, None] * mean[:, None, :]
    pooled = (cov * count[:, None, None]).sum(0) / count.sum()
    factor, logdet = [], []
    for c in (0, 1):
        s = (1 - POOL) * cov[c] + POOL * pooled
        s = (1 - RIDGE) * s + RIDGE * np.diag(np.diag(s)) + 1e-3 * np.eye(len(s))
        factor.append(np.linalg.cholesky(s))
        logdet.append(2 * np.log(np.diag(factor[-1])).sum())
    return Model(np.log(count / count.sum()), mean, np.array(factor), np.array(logdet))


def statistic_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) -> doc_id and the statistics of the text."""
    for batch in batches:
        for first, buf, offsets in slices(batch.column(1)):
            x = statistics(buf, offsets)
            starts = pa.array(np.arange(len(x) + 1, dtype=np.int32) * len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, len(x)), pa.ListArray.from_arrays(starts, pa.array(x.ravel()))], ["doc_id", "x"])


def moment_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(label, statistics) -> one row per class of this task: count, sums, cross products."""
    d = len(FEATURES)
    total = np.zeros((2, 1 + d + d * d))
    for batch in batches:
        y = batch.column(0).to_numpy()
        x = batch.column(1).flatten().to_numpy().reshape(-1, d)
        for c in (0, 1):
            v = x[y == c]
            total[c] += np.concatenate([[len(v)], v.sum(0), (v.T @ v).ravel()])
    yield pa.RecordBatch.from_arrays(
        [pa.array(np.repeat([0, 1], total.shape[1]).astype(np.int32)), pa.array(np.tile(np.arange(total.shape[1]), 2).astype(np.int32)), pa.array(total.ravel())],
        ["label", "slot", "value"])


def fold_of(doc_id: str = "doc_id") -> Column:
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Train on the labelled rows of ``docs`` outside the held-out fold.

    Texts become statistics before they meet the labels: the join moves numbers, however many labels there are.
    """
    with_workers(docs.sparkSession)
    known = (labels.select(F.col("doc_id").cast("long").alias("_id"), F.col("quality").cast("int").alias("_label"))
             .filter(F.col("_label").isin(0, 1) & F.col("_id").isNotNull() & (fold_of("_id") != HELD))
             .groupBy("_id").agg(F.min("_label").alias("_label")))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), empty_text().alias("text")).filter(fold_of() != HELD)
    rows = rows.mapInArrow(statistic_batches, "doc_id long, x array<double>").join(known, F.col("doc_id") == F.col("_id"))
    moments = (rows.select("_label", "x").mapInArrow(moment_batches, "label int, slot int, value double")
               .groupBy("label", "slot").agg(F.sum("value").alias("value")).collect())  # 2 * (1 + d + d * d) numbers
    d = len(FEATURES)
    total = np.zeros((2, 1 + d + d * d))
    for label, slot, value in moments:
        total[label, slot] = value
    return model_of(total[:, 0], total[:, 1:1 + d], total[:, 1 + d:].reshape(2, d, d))


def score_batches(batches: Iterator[pa.RecordBatch], model: Model) -> Iterator[pa.RecordBatch]:
    """(..., text) -> the other columns and the score of the text."""
    for batch in batches:
        names, last = batch.schema.names, batch.num_columns - 1
        for first, buf, offsets in slices(batch.column(last)):
            score = model.scores(statistics(buf, offsets))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(k).slice(first, len(score)) for k in range(last)), pa.array(score)], [*names[:last], "score"])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score and predicted of each row of ``docs`` (doc_id, text). No shuffle."""
    with_workers(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold_of() == HELD).alias("held_out"), empty_text().alias("text"))
    scored = rows.mapInArrow(lambda batches: score_batches(batches, model), "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= CUT).cast("int"))


def keep_good(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that the classifier does not reject, all columns kept."""
    with_workers(docs.sparkSession)
    schema = docs.schema

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place = schema.names.index("text")
        for batch in batches:
            for first, buf, offsets in slices(batch.column(place).cast(pa.string())):
                good = model.scores(statistics(buf, offsets)) >= CUT
                yield batch.slice(first, len(good)).filter(pa.array(good))

    return docs.mapInArrow(kept, schema)


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return score(docs, fit(docs, load(spark, sf_dir, "labels")))
