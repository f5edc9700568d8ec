"""Substring dedup by super-k-mer partitioning (operator 2).

A window is ``WIDTH`` consecutive words. A word goes if a window over it has a word sequence
that also starts earlier (smaller document, or earlier in the same one).

1. *Frequencies.* One pass counts all ``MER``-word grams by hash slot (``SLOTS`` counts in all,
   whatever the input) so that minimisers prefer rare grams.
2. *Super-k-mers.* The minimiser of a window is its least gram by (frequency class, hash),
   leftmost on ties. Consecutive windows sharing a minimiser travel as one packed
   string, keyed by the minimiser, so equal windows always meet. Windows that also share its
   place differ (it stands at different offsets), so only super-k-mers over several places
   (``many``) can repeat a window within themselves. Equal strings of one batch are
   combined before the shuffle and compressed with a shared dictionary: the earliest stays, all windows of the others are repeats at
   once. A text in a million copies thus costs a row per batch, not a row per copy.
3. *Buckets.* Each partition is sorted by (minimiser, string, place), so equal strings are
   neighbours, the earliest first, and the rest are repeats as they stream by. The windows of
   the distinct strings of one minimiser are then sorted; in a run of equal windows all but the
   first are repeats. Memory is bounded by the distinct strings of one minimiser, which the
   frequency classes keep few.
4. *Removal.* Repeats come out as word ranges per document, are gathered by document and
   joined to the texts.

Documents are told apart by (doc_id, 128-bit digest of the text). Defined results: a null or empty text has no
words; null doc_ids come after all others; a row repeated whole (same id and text) is the same
document seen again and is judged alike; rows with one id and different texts are ordered by
that digest; windows never cross documents; texts of any length are processed whole; extra
columns are ignored; an empty table gives no rows.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.llm.shared import empty_text, id_key, load, stored, text_digest, with_workers
from lakeshift.llm.textkit import SLICE_BYTES, Words, rolling, slices

WIDTH = 20
MER = 2
SLOT_BITS = 14
BATCH_BYTES = 8 << 20
#: Bounds of the sample behind the compression dictionary.
SAMPLE_DOCS, SAMPLE_CHARS, DICTIONARY_BYTES = 400, 4000, 1 << 16

ROW = "mini int, packed binary, id long, tie binary, start int, stop int, many boolean"
NAMES = ["mini", "packed", "id", "tie", "start", "stop", "many"]


def slot_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Grams of this task by hash slot."""
    total = np.zeros(1 << SLOT_BITS, np.int64)
    for batch in batches:
        for _, buf, offsets in slices(batch.column(0)):
            words = Words(buf, offsets)
            grams = rolling(words.hashes(), MER)
            within = grams[_starts(words, MER)]
            total += np.bincount((within >> np.uint64(64 - SLOT_BITS)).astype(np.int64), minlength=len(total))
    slot = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array(slot.astype(np.int32)), pa.array(total[slot])], ["slot", "n"])


def _starts(words: Words, k: int) -> np.ndarray:
    """Word positions at which ``k`` words of one document start."""
    n = len(words.start)
    ok = np.zeros(n + 1, np.int32)
    lo, hi = words.first[:-1], words.first[1:] - k + 1
    some = hi > lo
    np.add.at(ok, lo[some], 1)
    np.add.at(ok, hi[some], -1)
    return np.flatnonzero(np.cumsum(ok[:n]))


def frequency_classes(docs: DataFrame) -> np.ndarray:
    """Class 0-15 of each slot: how many doublings its count lies above twice the mean."""
    counted = (docs.select(empty_text().alias("text")).mapInArrow(slot_counts, "slot int, n long")
               .groupBy("slot").agg(F.sum("n").alias("n")).collect())  # at most SLOTS rows
    counts = np.zeros(1 << SLOT_BITS)
    for slot, n in counted:
        counts[slot] = n
    mean = max(counts.mean(), 1e-9)
    return np.clip(np.floor(np.log2(np.maximum(counts / (2 * mean), 0.5))) + 1, 0, 15).astype(np.uint64)


def least_places(keys: np.ndarray, width: int) -> np.ndarray:
    """Place of the leftmost least key of every ``width`` consecutive keys, by doubling."""
    best, at, have = keys, np.arange(len(keys)), 1
    while have < width:
        step = min(have, width - have)
        later = best[step:] < best[:-step]
        at = np.where(later, at[step:], at[:-step])
        best = np.where(later, best[step:], best[:-step])
        have += step
    return at


def super_kmers(words: Words, classes: np.ndarray, width: int) -> tuple[np.ndarray, ...]:
    """(minimiser, first word, word behind the last, many) of all super-k-mers of a slice."""
    none = np.zeros(0, np.int64)
    windows = _starts(words, width)
    if not len(windows):
        return none, none, none, none
    mer = min(MER, width)
    grams = rolling(words.hashes(), mer)
    level = classes[(grams >> np.uint64(64 - SLOT_BITS)).astype(np.int64)]
    keys = level << np.uint64(60) | grams >> np.uint64(4)
    place = least_places(keys, width - mer + 1)[windows]
    doc = np.searchsorted(words.first, windows, "right")
    mini = grams[place]
    cut = np.flatnonzero((mini[1:] != mini[:-1]) | (doc[1:] != doc[:-1])) + 1
    begin = np.concatenate([[0], cut])
    end = np.concatenate([cut, [len(windows)]]) - 1
    return (mini[begin] >> np.uint64(32)).astype(np.uint32).view(np.int32), windows[begin], windows[end] + width, place[begin] != place[end]


def packed_words(words: Words) -> tuple[bytes, np.ndarray, np.ndarray]:
    """The words of a slice with single spaces between them: (bytes, start and end of each word)."""
    keep = np.zeros(len(words.buf) + 1, np.int8)
    keep[words.start] += 1
    keep[words.end] -= 1
    keep = np.cumsum(keep[:-1]).astype(bool)
    behind = words.end[words.end < len(words.buf)]
    text = words.buf
    gap = behind[~keep[behind]]
    text = text.copy()
    text[gap] = 0x20
    keep[gap] = True
    place = np.concatenate([[0], np.cumsum(keep)])
    return text[keep].tobytes(), place[words.start], place[words.end]


def packing_dictionary(docs: DataFrame) -> bytes:
    """A compression dictionary from a bounded sample of texts; it changes sizes, never results."""
    texts = [r[0].encode() for r in docs.select(F.left("text", F.lit(SAMPLE_CHARS))).limit(SAMPLE_DOCS).collect()]
    pieces = [t[k:k + 200] for t in texts for k in range(0, len(t), 200)]
    if sum(map(len, pieces)) < 100 * DICTIONARY_BYTES // 10:
        return b""
    return zstandard.train_dictionary(DICTIONARY_BYTES, pieces).as_bytes()


def packer(dictionary: bytes):
    return zstandard.ZstdCompressor(level=3, dict_data=zstandard.ZstdCompressionDict(dictionary), write_checksum=False,
                                    write_dict_id=False).compress


class Combiner:
    """Distinct super-k-mers of a batch with their earliest place; later places are repeats."""

    def __init__(self, pack) -> None:
        self.pack = pack
        self.seen: dict[bytes, int] = {}
        self.mini, self.place, self.many, self.repeats, self.size = [], [], [], [], 0

    def add(self, words: Words, ids: np.ndarray, ties: np.ndarray, classes: np.ndarray, width: int) -> None:
        minis, first, last, many = super_kmers(words, classes, width)
        if not len(first):
            return
        raw, a, b = packed_words(words)
        self.size += len(raw)
        doc = np.searchsorted(words.first, first, "right") - 1
        rows = zip(minis.tolist(), a[first].tolist(), b[last - 1].tolist(), ids[doc].tolist(), ties[doc].tolist(),
                   (first - words.first[doc]).tolist(), (last - words.first[doc]).tolist(), many.tolist())
        seen, places = self.seen, self.place
        for mini, x, y, i, tie, start, stop, several in rows:
            string, here = raw[x:y], (i, tie, start, stop)
            k = seen.setdefault(string, len(places))
            if k == len(places):
                places.append(here)
                self.mini.append(mini)
                self.many.append(several)
            elif here != places[k]:
                if here < places[k]:
                    here, places[k] = places[k], here
                self.repeats.append(here)

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.place:
            yield _rows(self.mini, list(map(self.pack, self.seen)), self.place, self.many)
        if self.repeats:
            yield _rows([r[0] & 0x7FFFFFFF for r in self.repeats], [None] * len(self.repeats), self.repeats, [False] * len(self.repeats))
        self.__init__(self.pack)


def _rows(minis: list, packed: list, places: list, many: list) -> pa.RecordBatch:
    i, tie, start, stop = zip(*places)
    return pa.RecordBatch.from_arrays(
        [pa.array(minis, pa.int32()), pa.array(packed, pa.binary()), pa.array(i, pa.int64()), pa.array(tie, pa.binary()),
         pa.array(start, pa.int32()), pa.array(stop, pa.int32()), pa.array(many)], NAMES)


def pack_batches(batches: Iterator[pa.RecordBatch], classes: np.ndarray, width: int, dictionary: bytes) -> Iterator[pa.RecordBatch]:
    """(id, tie, text) -> super-k-mers and the repeats already known (packed null)."""
    own = Combiner(packer(dictionary))
    for batch in batches:
        ids, ties = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
        for first, buf, offsets in slices(batch.column(2)):
            rows = slice(first, first + len(offsets) - 1)
            own.add(Words(buf, offsets), ids[rows], ties[rows], classes, width)
            if own.size >= BATCH_BYTES:
                yield from own.flush()
    yield from own.flush()


def bucket_repeats(strings: list[tuple[bytes, tuple]], width: int) -> list[tuple[int, bytes, int, int]]:
    """Word ranges of repeated windows among the distinct strings of one minimiser."""
    windows = []
    for k, (packed, (i, tie, start, _)) in enumerate(strings):
        words = packed.split(b" ")
        windows += [(b" ".join(words[j:j + width]), i, tie, start + j, k) for j in range(len(words) - width + 1)]
    windows.sort()
    out, before = [], None
    marks: dict[int, list[int]] = {}
    for w in windows:
        if before is not None and w[0] == before[0]:
            if w[1:4] != before[1:4]:
                marks.setdefault(w[4], []).append(w[3])
        else:
            before = w
    for k, starts in marks.items():
        i, tie = strings[k][1][:2]
        starts.sort()
        lo = hi = starts[0]
        for s in starts[1:]:
            if s > hi + 1:
                out.append((i, tie, lo, hi + width))
                lo = s
            hi = s
        out.append((i, tie, lo, hi + width))
    return out


RANGE = "id long, tie binary, start int, stop int"
RANGE_TYPES = (pa.int64(), pa.binary(), pa.int32(), pa.int32())


def count_buckets(batches: Iterator[pa.RecordBatch], width: int, dictionary: bytes) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (mini, packed, id, tie, start) -> ranges of words in repeated windows."""
    mini, strings, out, inner = None, [], [], False
    unpack = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(dictionary)).decompress

    def close() -> None:
        nonlocal inner
        if len(strings) > 1 or inner:
            out.extend(bucket_repeats([(unpack(p), place) for p, place in strings], width))
        strings.clear()
        inner = False

    def ranges(found: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*found), RANGE_TYPES)], NAMES[2:6])

    for batch in batches:
        known = batch.column(1).is_null().to_numpy(zero_copy_only=False)
        if known.any():
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(known)) for c in batch.columns[2:6]], NAMES[2:6])
            batch = batch.filter(pa.array(~known))
        minis = batch.column(0).to_numpy()
        n = len(minis)
        if not n:
            continue
        # a minimiser with one row, over one place, and no neighbour in the next or last batch holds no repeat
        alone = np.ones(n, bool)
        same = minis[1:] == minis[:-1]
        alone[1:] &= ~same
        alone[:-1] &= ~same
        alone &= ~batch.column(6).to_numpy(zero_copy_only=False)
        alone[-1] = False
        if minis[0] == mini:
            alone[0] = False
        rows = batch.filter(pa.array(~alone))
        for m, packed, i, tie, start, stop, many in zip(*(c.to_pylist() for c in rows.columns)):
            if m != mini:
                close()
                mini = m
            if strings and strings[-1][0] == packed:
                if strings[-1][1] != (i, tie, start, stop):
                    out.append((i, tie, start, stop))
            else:
                strings.append((packed, (i, tie, start, stop)))
                inner |= many
        if len(out) > 10_000:
            yield ranges(out)
            out.clear()
    close()
    if out:
        yield ranges(out)


def shrink_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Compress the texts (column 3) for the way through the shuffle."""
    pack = zstandard.ZstdCompressor(level=1).compress
    for batch in batches:
        small = pa.array([pack(t.as_buffer().to_pybytes()) for t in batch.column(3)], pa.binary())
        yield pa.RecordBatch.from_arrays([*batch.columns[:3], small], ["doc_id", "id", "tie", "small"])


def _texts(small: pa.Array) -> Iterator[tuple[int, pa.Array]]:
    """(first row, texts) of runs of rows whose texts take a bounded number of bytes (or one row)."""
    unpack = zstandard.ZstdDecompressor().decompress
    first, texts, size = 0, [], 0
    for k, x in enumerate(small):
        texts.append(unpack(x.as_buffer().to_pybytes()))
        size += len(texts[-1])
        if size >= SLICE_BYTES or k == len(small) - 1:
            yield first, pa.array(texts, pa.binary()).cast(pa.string())
            first, texts, size = k + 1, [], 0


def keep_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, small, starts, stops) -> counts and the words that stay, joined by one space."""
    for batch in batches:
        for begin, texts in _texts(batch.column(1)):
            rows = batch.slice(begin, len(texts))
            yield from _keep(rows.column(0), texts, rows.column(2), rows.column(3))


def _keep(doc_ids: pa.Array, texts: pa.Array, all_starts: pa.Array, all_stops: pa.Array) -> Iterator[pa.RecordBatch]:
    for first, buf, offsets in slices(texts):
        words = Words(buf, offsets)
        raw, a, b = packed_words(words)
        n = np.diff(words.first)
        removed, kept = np.zeros(len(n), np.int64), []
        starts, stops = (c.slice(first, len(n)) for c in (all_starts, all_stops))
        hit = starts.is_valid().to_numpy(zero_copy_only=False)
        for d in range(len(n)):
            lo, hi = int(words.first[d]), int(words.first[d + 1])
            if not hit[d]:
                kept.append(raw[a[lo]:b[hi - 1]] if hi > lo else b"")
                continue
            cover = np.zeros(hi - lo + 1, np.int64)
            np.add.at(cover, starts[d].values.to_numpy(), 1)
            np.add.at(cover, stops[d].values.to_numpy(), -1)
            stay = np.flatnonzero(np.cumsum(cover[:-1]) == 0) + lo
            removed[d] = hi - lo - len(stay)
            kept.append(b" ".join([raw[x:y] for x, y in zip(a[stay].tolist(), b[stay].tolist())]))
        yield pa.RecordBatch.from_arrays(
            [doc_ids.slice(first, len(n)), pa.array(n), pa.array(removed), pa.array(kept, pa.binary()).cast(pa.string())],
            ["doc_id", "n_words", "n_removed", "kept_text"])


def repeat_ranges(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """Ranges of words (id, tie, start, stop) that repeated windows cover; ``docs`` has id, tie, text."""
    with_workers(docs.sparkSession)
    classes = frequency_classes(docs)
    dictionary = packing_dictionary(docs)
    packed = docs.select("id", "tie", "text").mapInArrow(lambda batches: pack_batches(batches, classes, width, dictionary), ROW)
    return (packed.repartition("mini").sortWithinPartitions("mini", "packed", "id", "tie", "start")
            .mapInArrow(lambda batches: count_buckets(batches, width, dictionary), RANGE))


def dedup_substrings(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """doc_id, n_words, n_removed and kept_text of each row of ``docs`` (doc_id, text)."""
    docs = docs.select(F.col("doc_id").cast("long"), id_key().alias("id"), text_digest(empty_text()).alias("tie"), empty_text().alias("text"))
    ranges = stored(repeat_ranges(docs, width), "substring-ranges")
    by_doc = ranges.groupBy("id", "tie").agg(F.collect_list("start").alias("starts"), F.collect_list("stop").alias("stops"))
    small = docs.mapInArrow(shrink_batches, "doc_id long, id long, tie binary, small binary")
    return (small.join(by_doc, ["id", "tie"], "left").select("doc_id", "small", "starts", "stops")
            .mapInArrow(keep_batches, "doc_id long, n_words long, n_removed long, kept_text string"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_substrings(load(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
