"""Benchmark decontamination by Wu-Manber multi-pattern search over words (operator 8).

Symbols are words of the lower-cased text, by 64-bit hash. Patterns are the benchmark's
windows of 13 words; items of fewer words are one window of their own length. Patterns of one
length m form a table:

* SHIFT: for the hash of a block of two words, how far the search may jump: m - 1 for a block
  in no pattern, else the distance of its last place from the pattern's end;
* the suffix-hash bucket: patterns whose last block is the one found (shift 0);
* confirmation by direct comparison of the window's words.

All documents of a slice are searched in lockstep: each step looks up one block per document
still active and jumps, so most positions are never looked at. Length-1 patterns have no
block of two; their block is the word itself.

Spark makes the windows, tells them apart by window and item and writes them once. By ranges of
their hash they form blocks of at most ``BLOCK_WORDS`` pattern words, a word counting once for
every 16 bytes, so a block has at most 64 MB (more only where a single window has). Each block is
broadcast to one pass over all documents; a worker builds its tables once, not in each task. No
text of the documents is shuffled; with several blocks the runs of hit words are.

Defined results: null or empty text has no words and no hits; items without words have no
window; equal item_ids count as one item and null item_ids are ignored in ``n_items`` but their
windows still hit; rows of documents stay as they are, repeated rows included.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import islice
from uuid import uuid4

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.llm.shared import drop, empty_text, fresh_path, load, stored, text_digest, with_workers
from lakeshift.llm.textkit import WIDE_SLICE, Words, rolling, slices

WINDOW = 13
BLOCK_WORDS = 4_000_000
WORD_BYTES = 16
BUCKET_BITS = (12, 16, 20)
TABLE_BITS = 18
RESULT = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean")


class Patterns:
    """Shift and bucket tables for patterns of one length."""

    def __init__(self, length: int) -> None:
        self.length = length
        self.block = min(2, length)
        self.shift = np.full(1 << TABLE_BITS, length - self.block + 1, np.int32)
        self.buckets: dict[int, dict[bytes, set]] = {}

    def build(self, windows: dict[bytes, set]) -> None:
        """windows: the words joined by one space -> item ids."""
        joined = list(windows)
        text = pa.array([w.decode() for w in joined], pa.large_string())
        for first, buf, offsets in slices(text, WIDE_SLICE):
            words = Words(buf, offsets, "alnum")
            blocks = self.blocks(words.hashes())
            m, b = self.length, self.block
            starts = words.first[:-1]
            for j in range(m - b + 1):  # later places are nearer to the end: keep the least shift
                np.minimum.at(self.shift, self.slot(blocks[starts + j]), m - b - j)
            for i, h in enumerate(blocks[starts + m - b].tolist()):
                self.buckets.setdefault(h, {})[joined[first + i]] = windows[joined[first + i]]

    def blocks(self, hashes: np.ndarray) -> np.ndarray:
        return rolling(hashes, self.block)

    @staticmethod
    def slot(blocks: np.ndarray) -> np.ndarray:
        return (blocks >> np.uint64(64 - TABLE_BITS)).astype(np.int64)

    def search(self, words: Words, hashes: np.ndarray, raw: bytes) -> list[tuple[int, set]]:
        """(first word, item ids) of every occurrence."""
        m, b = self.length, self.block
        blocks = self.blocks(hashes)
        if not len(blocks):
            return []
        slots = self.slot(blocks)
        at = words.first[:-1] + m - b  # the block that ends a window at the document's start
        stop = words.first[1:] - b
        live = at <= stop
        at, stop = at[live], stop[live]
        found = []
        while len(at):
            jump = self.shift[slots[at]]
            hit = np.flatnonzero(jump == 0)
            for p in at[hit].tolist():
                bucket = self.buckets.get(int(blocks[p]))
                if bucket:
                    i = p - (m - b)
                    window = b" ".join([raw[x:y] for x, y in zip(words.start[i:i + m].tolist(), words.end[i:i + m].tolist())])
                    if window in bucket:
                        found.append((i, bucket[window]))
            at = at + np.maximum(jump, 1)
            live = at <= stop
            if not live.all():
                at, stop = at[live], stop[live]
        return found


def tables(windows: pa.Table | None) -> list[Patterns]:
    """Tables of a block of windows: (length, window, item)."""
    by_length: dict[int, dict[bytes, set]] = {}
    if windows is not None:
        for length, window, item in zip(*(windows[c].to_pylist() for c in ("length", "window", "item"))):
            by_length.setdefault(length, {}).setdefault(window, set()).add(item)
    out = []
    for length, found in sorted(by_length.items()):
        out.append(Patterns(length))
        out[-1].build(found)
    return out


#: Tables of the block that this worker searched last, by the block's name.
_BUILT: dict[str, list[Patterns]] = {}


def worker_tables(name: str, block: Broadcast) -> list[Patterns]:
    if name not in _BUILT:
        _BUILT.clear()
        _BUILT[name] = tables(block.value)
    return _BUILT[name]


def window_batches(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.RecordBatch]:
    """(item, text) -> the item's windows: length, words joined by one space, item."""
    def flush() -> pa.RecordBatch:
        columns = [pa.array(c, kind) for c, kind in zip(zip(*out) if out else ((), (), ()), (pa.int32(), pa.binary(), pa.string()))]
        out.clear()
        return pa.RecordBatch.from_arrays(columns, ["length", "window", "item"])

    out: list[tuple[int, bytes, str | None]] = []
    for batch in batches:
        for first, buf, offsets in slices(batch.column(1)):
            words = Words(buf, offsets, "alnum", lower=True)
            raw = words.buf.tobytes()
            for row, (a, b) in enumerate(zip(words.first[:-1].tolist(), words.first[1:].tolist())):
                item, m = batch.column(0)[first + row].as_py(), min(size, b - a)
                spans = [raw[x:y] for x, y in zip(words.start[a:b].tolist(), words.end[a:b].tolist())]
                for i in range(b - a - m + 1 if m else 0):
                    out.append((m, b" ".join(spans[i:i + m]), item))
                    if len(out) >= 10_000:
                        yield flush()
    yield flush()


def hits(words: Words, found: list[Patterns]) -> tuple[np.ndarray, list[set]]:
    """(flag of each word inside an occurrence, item ids of each row)."""
    hashes, raw = words.hashes(), words.buf.tobytes()
    cover = np.zeros(len(words.start) + 1, np.int64)
    items: list[set] = [set() for _ in range(words.rows)]
    for patterns in found:
        for i, ids in patterns.search(words, hashes, raw):
            cover[i] += 1
            cover[i + patterns.length] -= 1
            items[int(np.searchsorted(words.first, i, "right")) - 1] |= ids
    return np.cumsum(cover[:-1]) > 0, items


def search_batches(batches: Iterator[pa.RecordBatch], name: str, block: Broadcast) -> Iterator[pa.RecordBatch]:
    found = worker_tables(name, block)
    for batch in batches:
        for first, buf, offsets in slices(batch.column(1), WIDE_SLICE):
            words = Words(buf, offsets, "alnum", lower=True)
            flags, items = hits(words, found)
            n = np.diff(words.first)
            sums = np.concatenate([[0], np.cumsum(flags)])
            n_hit = sums[words.first[1:]] - sums[words.first[:-1]]
            ids = [sorted(x for x in s if x is not None) for s in items]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(first, words.rows), pa.array(n), pa.array(n_hit),
                pa.array([len(x) for x in ids], pa.int64()),
                pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in ids]),
                pa.array((n_hit > 0) & (20 * n_hit >= n))],
                ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"])


def cover_batches(batches: Iterator[pa.RecordBatch], name: str, block: Broadcast) -> Iterator[pa.RecordBatch]:
    """(row, text) -> (row, runs of hit words, item ids) of the rows that this block of patterns hits."""
    found = worker_tables(name, block)
    for batch in batches:
        for first, buf, offsets in slices(batch.column(1), WIDE_SLICE):
            words = Words(buf, offsets, "alnum", lower=True)
            flags, items = hits(words, found)
            rows = [i for i, s in enumerate(items) if s]
            places = [np.flatnonzero(flags[words.first[i]:words.first[i + 1]]) for i in rows]
            yield pa.RecordBatch.from_arrays([
                batch.column(0).slice(first, words.rows).take(pa.array(rows, pa.int64())),
                pa.array(places, pa.list_(pa.int64())),
                pa.array([sorted(x for x in items[i] if x is not None) for i in rows], pa.list_(pa.string()))],
                ["row_key", "places", "items"])


def blocks_of(benchmark: DataFrame, size: int, most: int) -> Iterator[pa.Table]:
    """The benchmark's windows in blocks of at most ``most`` words, one at a time.

    Windows fall into buckets by the leading bits of their hash; the driver sees the weights of
    these buckets and joins neighbours to blocks.
    """
    with_workers(benchmark.sparkSession)
    windows = stored(
        benchmark.select(F.col("item_id").cast("string").alias("item"), F.col("text").cast("string"))
        .mapInArrow(lambda batches: window_batches(batches, size), "length int, window binary, item string")
        .distinct().withColumn("place", F.xxhash64("window", "item")), "benchmark-windows")
    weight = F.greatest(F.col("length"), F.ceil(F.octet_length("window") / WORD_BYTES))
    for bits in BUCKET_BITS:
        bucket = F.shiftright("place", 64 - bits)
        weights = windows.groupBy(bucket.alias("bucket")).agg(F.sum(weight).alias("w")).orderBy("bucket").collect()
        if all(r.w <= most for r in weights):
            break
    ranges, words = [], 0
    for r in weights:
        if not ranges or words + r.w > most:
            ranges.append([r.bucket, r.bucket])
            words = 0
        ranges[-1][1] = r.bucket
        words += r.w
    for lo, hi in ranges:
        block = F.col("place").between(lo << (64 - bits), ((hi + 1) << (64 - bits)) - 1)
        yield windows.filter(block).select("length", "window", "item").toArrow()
    drop(windows)


def sent(spark: SparkSession, block: pa.Table | None) -> tuple[str, Broadcast]:
    """Name and broadcast of a block."""
    return uuid4().hex, spark.sparkContext.broadcast(block)


def decontaminate(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """n_words, n_hit, n_items, items_sha256 and contaminated of each row of ``docs`` (doc_id, text).

    With one block of patterns (the usual case) this is a single pass over the documents without a
    shuffle; with more, every block makes its own pass and the hit rows are merged by row.
    """
    with_workers(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    blocks = blocks_of(benchmark, size, block_words)
    ahead = list(islice(blocks, 2))
    if len(ahead) < 2:
        name, block = sent(docs.sparkSession, ahead[0] if ahead else None)
        return docs.mapInArrow(lambda batches: search_batches(batches, name, block), RESULT)
    return _by_blocks(docs, ahead, blocks).drop("row_key")


def _row_key() -> Column:
    """Tells rows by id and text: rows of equal keys have equal texts and so equal verdicts."""
    key = F.col("doc_id").cast("long")
    return F.struct(F.coalesce(key, F.lit(0)).alias("id"), key.isNull().alias("none"),
                    text_digest(empty_text()).alias("digest"))


def _by_blocks(docs: DataFrame, ahead: list[pa.Table], blocks: Iterator[pa.Table]) -> DataFrame:
    """The result columns and the row_key of each row of ``docs`` (doc_id, text); one pass for each
    block of ``ahead`` and ``blocks``."""
    row = "row_key struct<id: long, none: boolean, digest: binary>"
    docs = docs.select("doc_id", _row_key().alias("row_key"), "text")
    folder = fresh_path(docs.sparkSession, "decontam")
    while ahead:  # one bounded block of patterns at a time, its hits written before the next
        name, block = sent(docs.sparkSession, ahead.pop(0))
        (docs.select("row_key", "text")
         .mapInArrow(lambda batches, name=name, block=block: cover_batches(batches, name, block), f"{row}, places array<long>, items array<string>")
         .write.mode("append").parquet(folder))
        block.destroy()
        ahead += islice(blocks, 1)
    merged = docs.sparkSession.read.parquet(folder).groupBy("row_key").agg(
        F.size(F.array_distinct(F.flatten(F.collect_list("places")))).cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    counted = docs.mapInArrow(_count_batches, f"doc_id long, {row}, n_words long")
    hit, items = F.coalesce("n_hit", F.lit(0)), F.coalesce("items", F.array().cast("array<string>"))
    return (counted.join(merged, "row_key", "left")
            .select("row_key", "doc_id", "n_words", hit.alias("n_hit"), F.size(items).cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", items).cast("binary"), 256).alias("items_sha256"),
                    ((hit > 0) & (20 * hit >= F.col("n_words"))).alias("contaminated")))


def _count_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for first, buf, offsets in slices(batch.column(2), WIDE_SLICE):
            words = Words(buf, offsets, "alnum", lower=True)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(first, words.rows), batch.column(1).slice(first, words.rows), pa.array(np.diff(words.first))],
                ["doc_id", "row_key", "n_words"])


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate(load(spark, sf_dir, "documents"), load(spark, sf_dir, "benchmark"))


def keep_clean(docs: DataFrame, benchmark: DataFrame, size: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns kept; each row is judged by its
    own text, whatever the number of blocks."""
    with_workers(docs.sparkSession)
    schema = docs.schema
    blocks = blocks_of(benchmark, size, block_words)
    ahead = list(islice(blocks, 2))
    if len(ahead) < 2:
        name, block = sent(docs.sparkSession, ahead[0] if ahead else None)

        def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            found = worker_tables(name, block)
            place = schema.names.index("text")
            for batch in batches:
                for first, buf, offsets in slices(batch.column(place).cast(pa.string()), WIDE_SLICE):
                    words = Words(buf, offsets, "alnum", lower=True)
                    flags, _ = hits(words, found)
                    sums = np.concatenate([[0], np.cumsum(flags)])
                    n_hit = sums[words.first[1:]] - sums[words.first[:-1]]
                    good = (n_hit == 0) | (20 * n_hit < np.diff(words.first))
                    yield batch.slice(first, words.rows).filter(pa.array(good))

        return docs.mapInArrow(clean, schema)
    plain = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    judged = _by_blocks(plain, ahead, blocks).filter("contaminated").select(F.col("row_key").alias("_dirty")).distinct()
    return docs.join(judged, _row_key() == judged["_dirty"], "left_anti")
