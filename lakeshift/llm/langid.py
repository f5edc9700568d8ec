"""Language identification by a bidirectional gated recurrent network over bytes (operator 6).

*Network.* Each direction is a gated recurrent layer of ``HIDDEN`` units over the bytes of a
segment; input weights are one row per byte value. Gates and candidate are piecewise linear
(clipped), which keeps a step to a few cheap array passes. The states of both directions at a
position give its language probabilities; a document's probabilities are their mean over all its
bytes.

*Training* is numpy back-propagation through time with Adam, in the driver, on a bounded sample:
at most ``DOCS_PER_LANG`` excerpts of ``EXCERPT`` characters for each language, one a document, in hash
order and each from a hash-chosen place of the whole text,
from rows whose crc32(doc_id as text) mod ``FOLDS`` is not ``HELD``. lang, source and doc_id are no
inputs of a prediction.

*Prediction* reads every byte of every text: texts are cut into segments of ``SEGMENT`` bytes that run
side by side in one lane each, so memory does not depend on the length of a text.

Defined results: a null text and one without a letter is ``und`` with score 1.0; with no labelled row
everything is ``und``; ties go to the language first by code point; repeated rows are
predicted alike; extra columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshift.llm.shared import load, with_workers
from lakeshift.llm.textkit import WIDE_SLICE, slices

FOLDS, HELD = 3, 1
DOCS_PER_LANG, EXCERPT = 250, 400
HIDDEN, SEGMENT, LANES = 12, 256, 2048
TRAIN_SEGMENT, BATCH, EPOCHS, RATE, SEED = 64, 128, 4, 0.01, 11
NONE = "und"

_LETTER = regex.compile(r"\p{L}")
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[65:91] = _ASCII_LETTER[97:123] = True


@dataclass
class Network:
    """Per direction: input rows [256, 3H] (update, reset, candidate) and state weights [H, 3H]; output [2H, L]."""

    langs: list[str]
    inputs: list[np.ndarray]
    states: list[np.ndarray]
    out: np.ndarray
    bias: np.ndarray

    def weights(self) -> list[np.ndarray]:
        return [*self.inputs, *self.states, self.out, self.bias]


def new_network(langs: list[str]) -> Network:
    r = np.random.default_rng(SEED)
    h = HIDDEN

    def inputs() -> np.ndarray:
        w = r.normal(0, 0.3, (256, 3 * h))
        w[:, :2 * h] += 0.5
        return w.astype(np.float32)

    return Network(langs, [inputs(), inputs()], [(r.normal(0, 0.3, (h, 3 * h)) / np.sqrt(h)).astype(np.float32) for _ in range(2)],
                   r.normal(0, 0.1, (2 * h, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32))


def step(h: np.ndarray, a: np.ndarray, u: np.ndarray) -> np.ndarray:
    """One time step for all lanes: state [H, N], input columns [3H, N] (overwritten), weights [3H, H] -> new state."""
    k = len(h)
    s = u @ h
    gates, n = a[:2 * k], s[2 * k:]
    gates += s[:2 * k]
    np.clip(gates, 0, 1, out=gates)
    n *= gates[k:]
    n += a[2 * k:]
    np.clip(n, -1, 1, out=n)
    h -= n
    h *= gates[:k]
    h += n
    return h


def probabilities(net: Network, grid: np.ndarray, width: np.ndarray) -> np.ndarray:
    """Sums over positions of the language probabilities of each lane.

    grid: bytes [steps, lanes]; width: bytes in each lane (the rest of a lane is padding).
    """
    steps, lanes = grid.shape
    k = HIDDEN
    live = (np.arange(steps)[:, None] < width).astype(np.float32)
    logits = np.empty((steps, len(net.langs), lanes), np.float32)
    inputs = [np.ascontiguousarray(w.T) for w in net.inputs]
    states = [np.ascontiguousarray(u.T) for u in net.states]
    ahead, behind, bias = net.out[:k].T.copy(), net.out[k:].T.copy(), net.bias[:, None]
    h = np.zeros((k, lanes), np.float32)
    for t in range(steps):
        h = step(h, inputs[0].take(grid[t], 1), states[0])
        np.matmul(ahead, h, out=logits[t])
    total = np.zeros((len(net.langs), lanes), np.float32)
    h = np.zeros((k, lanes), np.float32)
    full = int(width.min()) if lanes else 0
    for t in range(steps - 1, -1, -1):
        h = step(h, inputs[1].take(grid[t], 1), states[1])
        if t >= full:
            h *= live[t]  # behind its end a lane keeps the empty state
        z = logits[t]
        z += behind @ h
        z += bias
        z -= z.max(0)
        np.exp(z, out=z)
        z /= z.sum(0)
        if t >= full:
            z *= live[t]
        total += z
    return total.T


def _forward(x: np.ndarray, w: np.ndarray, u: np.ndarray):
    """States and what the way back needs, for bytes [T, N]."""
    k, h, kept, states = HIDDEN, np.zeros((x.shape[1], HIDDEN), np.float32), [], []
    for row in x:
        a, s = w[row], h @ u
        az, ar, m = a[:, :k] + s[:, :k], a[:, k:2 * k] + s[:, k:2 * k], s[:, 2 * k:]
        z, r = np.clip(az, 0, 1), np.clip(ar, 0, 1)
        an = a[:, 2 * k:] + r * m
        n = np.clip(an, -1, 1)
        kept.append((h, az, ar, an, z, r, n, m))
        h = n + z * (h - n)
        states.append(h)
    return np.array(states), kept


def _backward(x: np.ndarray, u: np.ndarray, kept: list, outer: np.ndarray):
    """Gradients of input rows and state weights from the gradients at all states [T, N, H]."""
    du = np.zeros_like(u)
    inner = np.empty((*x.shape, 3 * HIDDEN), np.float32)
    back = np.zeros_like(outer[0])
    for t in range(len(x) - 1, -1, -1):
        h, az, ar, an, z, r, n, m = kept[t]
        back = back + outer[t]
        dan = back * (1 - z) * (np.abs(an) < 1)
        daz = back * (h - n) * ((az > 0) & (az < 1))
        dar = dan * m * ((ar > 0) & (ar < 1))
        inner[t] = np.concatenate([daz, dar, dan], 1)
        ds = np.concatenate([daz, dar, dan * r], 1)
        du += h.T @ ds
        back = back * z + ds @ u.T
    flat, rows = x.reshape(-1), inner.reshape(-1, 3 * HIDDEN)
    hot = np.zeros((256, len(flat)), np.float32)
    hot[flat, np.arange(len(flat))] = 1
    return hot @ rows, du


def gradients(net: Network, x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean loss over all positions of bytes [T, N] with lane languages y, and its gradients."""
    k = HIDDEN
    ahead, kept_ahead = _forward(x, net.inputs[0], net.states[0])
    behind, kept_behind = _forward(x[::-1], net.inputs[1], net.states[1])
    both = np.concatenate([ahead, behind[::-1]], 2)
    z = both @ net.out + net.bias
    z -= z.max(2, keepdims=True)
    p = np.exp(z)
    p /= p.sum(2, keepdims=True)
    lanes = np.arange(x.shape[1])
    loss = float(-np.log(p[:, lanes, y] + 1e-9).mean())
    p[:, lanes, y] -= 1
    p /= x.size
    flat = p.reshape(-1, p.shape[2])
    dout, dbias = both.reshape(-1, 2 * k).T @ flat, flat.sum(0)
    dboth = p @ net.out.T
    dw0, du0 = _backward(x, net.states[0], kept_ahead, dboth[:, :, :k])
    dw1, du1 = _backward(x[::-1], net.states[1], kept_behind, dboth[::-1, :, k:])
    return loss, [dw0, dw1, du0, du1, dout, dbias]


def train(texts: list[bytes], langs: list[str]) -> Network | None:
    """Train on texts and their languages; None without rows."""
    names = sorted(set(langs))
    if not names:
        return None
    net = new_network(names)
    place = {name: i for i, name in enumerate(names)}
    parts, of = [], []
    for text, lang in zip(texts, langs):
        for at in range(0, len(text), TRAIN_SEGMENT):
            piece = text[at:at + TRAIN_SEGMENT]
            if len(piece) >= 8:
                parts.append(np.resize(np.frombuffer(piece, np.uint8), TRAIN_SEGMENT))
                of.append(place[lang])
    if not parts:
        return net
    x, y = np.array(parts), np.array(of)
    r = np.random.default_rng(SEED)
    weights = net.weights()
    first, second = [np.zeros_like(w) for w in weights], [np.zeros_like(w) for w in weights]
    n = 0
    for _ in range(EPOCHS):
        order = r.permutation(len(x))
        for at in range(0, len(x), BATCH):
            rows = order[at:at + BATCH]
            _, grads = gradients(net, x[rows].T, y[rows])
            n += 1
            for w, g, m, v in zip(weights, grads, first, second):
                g = np.clip(g, -1, 1)
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                w -= RATE * (m / (1 - 0.9 ** n)) / (np.sqrt(v / (1 - 0.99 ** n)) + 1e-8)
    return net


def pooled(net: Network, buf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Mean language probabilities [rows, languages] of the texts of a slice."""
    size = np.diff(offsets)
    segments = -(-size // SEGMENT)
    row = np.repeat(np.arange(len(size)), segments)
    nth = np.arange(len(row)) - np.repeat(np.cumsum(segments) - segments, segments)
    start = offsets[:-1][row] + nth * SEGMENT
    width = np.minimum(size[row] - nth * SEGMENT, SEGMENT)
    total = np.zeros((len(size), len(net.langs)))
    order = np.argsort(-width, kind="stable")  # lanes of one group are about equally long
    padded = np.concatenate([buf, np.zeros(SEGMENT, np.uint8)])
    for at in range(0, len(order), LANES):
        lanes = order[at:at + LANES]
        w = width[lanes]
        grid = padded[start[lanes][None, :] + np.arange(int(w.max()))[:, None]]
        np.add.at(total, row[lanes], probabilities(net, grid, w))
    return total / np.maximum(size, 1)[:, None]


def predict_batches(batches: Iterator[pa.RecordBatch], net: Network | None) -> Iterator[pa.RecordBatch]:
    """(doc_id, held_out, text) -> doc_id, held_out, lang_pred, score."""
    for batch in batches:
        for first, buf, offsets in slices(batch.column(2), WIDE_SLICE):
            rows = len(offsets) - 1
            sums = np.concatenate([[0], np.cumsum(_ASCII_LETTER[buf])])
            letters = sums[offsets[1:]] > sums[offsets[:-1]]
            for d in np.flatnonzero(~letters).tolist():
                letters[d] = bool(_LETTER.search(buf[offsets[d]:offsets[d + 1]].tobytes().decode()))
            if net is None:
                names, score = [NONE] * rows, np.ones(rows)
            else:
                p = pooled(net, buf, offsets)
                best = p.argmax(1)
                names = [net.langs[b] if ok else NONE for b, ok in zip(best.tolist(), letters.tolist())]
                score = np.where(letters, np.clip(p[np.arange(rows), best], 0, 1), 1.0)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, rows), batch.column(1).slice(first, rows), pa.array(names, pa.string()), pa.array(score)],
                ["doc_id", "held_out", "lang_pred", "score"])


def fold_of() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % FOLDS


def excerpt(text: Column) -> Column:
    """``EXCERPT`` characters from a place of the text that its hash chooses, each place alike; a shorter text whole."""
    places = F.greatest(F.length(text) - EXCERPT, F.lit(0)) + 1
    return F.substring(text, (F.pmod(F.xxhash64(text), places) + 1).cast("int"), F.lit(EXCERPT))


def fit(docs: DataFrame) -> Network | None:
    """Train on the bounded sample of ``docs`` (doc_id, text, lang)."""
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), excerpt(F.col("text").cast("string")).alias("text"),
                        F.col("lang").cast("string").alias("lang"))
            .filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & (fold_of() != HELD)))
    draw = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "text")
    sample = (rows.withColumn("_r", F.row_number().over(draw)).filter(F.col("_r") <= DOCS_PER_LANG)
              .orderBy("lang", "_r").select("text", "lang").collect())
    return train([t.encode() for t, _ in sample], [lang for _, lang in sample])


def predict(docs: DataFrame, net: Network | None) -> DataFrame:
    """doc_id, held_out, lang_pred and score of each row of ``docs`` (doc_id, text). No shuffle."""
    with_workers(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), (fold_of() == HELD).alias("held_out"), F.col("text").cast("string"))
    return rows.mapInArrow(lambda batches: predict_batches(batches, net), "doc_id long, held_out boolean, lang_pred string, score double")


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = load(spark, sf_dir, "documents")
    return predict(docs, fit(docs))
