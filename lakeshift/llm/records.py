"""Token-id records in length-delimited binary files with an offset index (operator 7).

File format (all numbers little-endian), one frame per document, files ordered by
(part number, file counter):

    u32 length | u32 masked CRC of the length | payload | u32 masked CRC of the payload | 0x0A
    payload: u8 flags (1: the id is null, 2: 16-bit ids, 4: padding) | i64 doc_id | token ids

A masked checksum is the CRC-32 rotated right by 15 bits plus a constant, so that a checksum
stored in data does not check itself. The closing byte is the record separator of Spark's
text writer, which writes the frames as they are: files come from Spark's own committed
write, so a lost executor or a second attempt leaves no torn or doubled file. Documents are
range-partitioned and sorted by doc_id (rows of one id by text hash) before encoding. Frames are
packed to rows of about ``BLOB_BYTES``, ``FILE_BLOBS`` of which fill a file; a larger frame is
followed by padding frames (flag 4, no payload) for each further blob that it is worth, so a
file has a bounded number of bytes, or one large frame.

The index is a Parquet table (shard, offset, length, doc_id, n_tokens, start, ids_crc32) made
by one scan that checks every frame. ``read_shuffled`` uses it to fetch records in a
seeded random order.

Encoding: pre-tokens (split as the tokenizer splits) are looked up by 64-bit hash in a cache
of token ids and confirmed by a second one of another seed (128 bits in all); a pre-token that only
shares the first hash with another, and every unseen one, is encoded by the tokenizers library's model.
Texts are never cut.

Defined results: a null or empty text holds the end id alone; null doc_ids come first, rows
with equal doc_id are ordered by text hash; special strings inside a text become their id, as
the library does by default; an empty table writes no frame and an empty index; extra columns
are ignored.
"""
from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshift.llm.shared import fresh_path, load, with_workers
from lakeshift.llm.textkit import WIDE_SLICE, slices, span_hashes
from lakeshift.llm.tokencount import SPECIAL, byte_alphabet, cut_special, pre_tokens

TOKENIZER = "byte_bpe_50k.json"
END_ID = 2
BLOB_BYTES, FILE_BLOBS = 2 << 20, 16
CACHE_ENTRIES, RECENT_ENTRIES = 1_500_000, 100_000
SECOND_SEED = 77
MASK_ADD = 0xA282EAD8
HEAD = struct.Struct("<II")
BODY = struct.Struct("<Bq")
CLOSE = b"\n"
PADDING = 4


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return ((crc >> 15 | crc << 17) + MASK_ADD) & 0xFFFFFFFF


class Learned:
    """Encoded pre-tokens by first hash, sorted: second hash, place and number of their ids."""

    def __init__(self) -> None:
        self.columns = [np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)]

    @property
    def hash(self) -> np.ndarray:
        return self.columns[0]

    def add(self, *more: np.ndarray) -> None:
        merged = [np.concatenate(x) for x in zip(self.columns, more)]
        order = np.argsort(merged[0], kind="stable")
        self.columns = [c[order] for c in merged]

    def find(self, hashes: np.ndarray) -> list[np.ndarray]:
        """Whether each is here, and its other columns (of any row if not)."""
        if not len(self.hash):
            return [np.zeros(len(hashes), bool), *(np.zeros(len(hashes), c.dtype) for c in self.columns[1:])]
        place = np.minimum(np.searchsorted(self.hash, hashes), len(self.hash) - 1)
        return [self.hash[place] == hashes, *(c[place] for c in self.columns[1:])]


class Encoder:
    """Token ids of many texts at once, through a cache of encoded pre-tokens."""

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer
        tokenizer = Tokenizer.from_file(path)
        self._model = tokenizer.model
        self._alphabet = dict(enumerate(byte_alphabet()))
        self.special_id = tokenizer.token_to_id(SPECIAL)
        self.narrow = tokenizer.get_vocab_size() <= 1 << 16
        self._clear()

    def _clear(self) -> None:
        self._known, self._recent = Learned(), Learned()
        self._ids = np.zeros(0, np.uint32)

    def _encode(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all words, number of ids of each)."""
        model, alphabet = self._model, self._alphabet
        found = [[t.id for t in model.tokenize(w.decode("latin-1").translate(alphabet))] for w in words]
        size = np.fromiter(map(len, found), np.int32, len(found))
        return np.fromiter((i for f in found for i in f), np.uint32, int(size.sum())), size

    def _learn(self, hashes: np.ndarray, checks: np.ndarray, words: list[bytes]) -> None:
        ids, size = self._encode(words)
        self._recent.add(hashes, checks, len(self._ids) + np.cumsum(size) - size, size)
        self._ids = np.concatenate([self._ids, ids])
        if len(self._recent.hash) > RECENT_ENTRIES:
            self._known.add(*self._recent.columns)
            self._recent = Learned()

    def _lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(learned, second hash, place of the ids, number of ids) of distinct first hashes."""
        have, *found = self._known.find(hashes)
        rest = np.flatnonzero(~have)
        late, *more = self._recent.find(hashes[rest])
        have[rest] = late
        for one, two in zip(found, more):
            one[rest] = two
        return have, *found

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each closed by the end id; number of ids of each text)."""
        parts, owner, special = cut_special(texts)
        sizes = special + 1
        if parts:
            buf, begins, part_at = pre_tokens(parts)
            ends = np.append(begins[1:], len(buf))
            hashes, checks = span_hashes(buf, begins, ends), span_hashes(buf, begins, ends, SECOND_SEED)
            known, where, inverse = np.unique(hashes, return_index=True, return_inverse=True)
            if len(self._known.hash) > CACHE_ENTRIES:
                self._clear()
            have, check, at, size = self._lookup(known)
            if not have.all():
                data, new = buf.tobytes(), ~have
                self._learn(known[new], checks[where[new]], [data[begins[i]:ends[i]] for i in where[new].tolist()])
                _, check, at, size = self._lookup(known)
            size, at, ids = size[inverse].astype(np.int64), at[inverse], self._ids
            other = np.flatnonzero(check[inverse] != checks)
            if len(other):  # another pre-token of the same first hash
                data = buf.tobytes()
                more, n = self._encode([data[begins[i]:ends[i]] for i in other.tolist()])
                size[other], at[other] = n, len(ids) + np.cumsum(n) - n
                ids = np.concatenate([ids, more])
            stop = np.cumsum(size)
            flat = ids[np.repeat(at - (stop - size), size) + np.arange(int(stop[-1]))]
            part_first = np.searchsorted(begins, part_at)
            part_stop = stop[np.append(part_first[1:], len(begins)) - 1]
            part_size = np.diff(part_stop, prepend=0)
            sizes = sizes + np.bincount(owner, part_size, len(texts)).astype(np.int64)
        out = np.full(int(sizes.sum()), END_ID, np.uint32)
        if not special.any():
            if parts:
                keep = np.ones(len(out), bool)
                keep[np.cumsum(sizes) - 1] = False
                out[keep] = flat
            return out, sizes
        pieces, k, done = [], 0, 0
        for i, t in enumerate(texts):
            for n, piece in enumerate(t.split(SPECIAL)):
                if n:
                    pieces.append(np.array([self.special_id], np.uint32))
                if piece:
                    pieces.append(flat[done:done + part_size[k]])
                    done += part_size[k]
                    k += 1
            pieces.append(np.array([END_ID], np.uint32))
        return np.concatenate(pieces), sizes


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def frame(doc_id: int | None, ids: np.ndarray, narrow: bool) -> bytes:
    """One frame but for its closing byte, which the text writer adds."""
    flags = (doc_id is None) | narrow << 1
    payload = BODY.pack(flags, doc_id or 0) + ids.astype("<u2" if narrow else "<u4").tobytes()
    length = struct.pack("<I", len(payload))
    return length + struct.pack("<I", masked(length)) + payload + struct.pack("<I", masked(payload))


def _padding() -> bytes:
    payload = BODY.pack(PADDING, 0)
    length = struct.pack("<I", len(payload))
    return length + struct.pack("<I", masked(length)) + payload + struct.pack("<I", masked(payload))


def blob_rows(found: list[bytes]) -> list[bytes]:
    """Rows for the writer, which closes each: all frames in one, and padding for what it is worth beyond a blob."""
    blob = CLOSE.join(found)
    return [blob] + [_padding()] * (len(blob) // BLOB_BYTES - 1)


def frames(data: bytes) -> Iterator[tuple[int, int, int | None, np.ndarray]]:
    """(offset, length, doc_id, ids as u32) of every frame but padding; raises ValueError on damage."""
    at = 0
    while at < len(data):
        found = one_frame(data, at)
        if not data[at + HEAD.size] & PADDING:
            yield (at, *found)
        at += HEAD.size + struct.unpack_from("<I", data, at)[0] + 5


def one_frame(data: bytes, at: int) -> tuple[int, int | None, np.ndarray]:
    length, check = HEAD.unpack_from(data, at)
    if masked(data[at:at + 4]) != check:
        raise ValueError(f"damaged length at byte {at}")
    body = data[at + HEAD.size:at + HEAD.size + length]
    stop = at + HEAD.size + length
    if len(body) != length or struct.unpack_from("<I", data, stop)[0] != masked(body) or data[stop + 4:stop + 5] != CLOSE:
        raise ValueError(f"damaged record at byte {at}")
    flags, doc_id = BODY.unpack_from(body)
    ids = np.frombuffer(body, "<u2" if flags & 2 else "<u4", offset=BODY.size).astype("<u4")
    return HEAD.size + length + 5, None if flags & 1 else doc_id, ids


def encode_batches(batches: Iterator[pa.RecordBatch], path: str) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) -> blobs of frames."""
    own = encoder(path)
    held, size = [], 0

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(blob_rows(held), pa.binary())], ["value"])

    for batch in batches:
        doc_ids = batch.column(0).to_pylist()
        for first, buf, offsets in slices(batch.column(1), WIDE_SLICE // 2):
            data = buf.tobytes()
            ids, sizes = own([data[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())])
            stops = np.cumsum(sizes)
            for i, (b, n) in enumerate(zip(stops.tolist(), sizes.tolist())):
                held.append(frame(doc_ids[first + i], ids[b - n:b], own.narrow))
                size += len(held[-1])
                if size >= BLOB_BYTES:
                    yield rows()
                    held, size = [], 0
    if held:
        yield rows()


def scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(path, content) of files -> their records, every frame checked."""
    for batch in batches:
        for path, content in zip(batch.column(0), batch.column(1)):
            rows, start = [], 0
            for at, length, doc_id, ids in frames(memoryview(content.as_buffer())):
                rows.append((path.as_py(), at, length, doc_id, len(ids), start, zlib.crc32(ids.tobytes())))
                start += len(ids)
            columns = list(zip(*rows)) or [()] * 7
            yield pa.RecordBatch.from_arrays(
                [pa.array(columns[0], pa.string()), *(pa.array(c, pa.int64()) for c in columns[1:])],
                ["shard", "offset", "length", "doc_id", "n_tokens", "start", "ids_crc32"])


RECORD = "shard string, offset long, length long, doc_id long, n_tokens long, start long, ids_crc32 long"


def _files(spark: SparkSession, folder: str) -> DataFrame:
    return with_workers(spark).read.format("binaryFile").option("pathGlobFilter", "part-*").load(f"{folder}/data")


def scan_records(spark: SparkSession, folder: str) -> DataFrame:
    """All records of a folder read back from its files; ``start`` counts the ids of all records before."""
    # Each task reads whole files, so the rows of a file stay together; totals per file are few.
    found = _files(spark, folder).select("path", "content").mapInArrow(scan_batches, RECORD)
    return found


def with_starts(records: DataFrame) -> DataFrame:
    """Turn starts within files into starts within the whole set, through the totals per file."""
    totals = records.groupBy("shard").agg(F.sum("n_tokens").alias("total"))
    part = F.regexp_extract("shard", r"part-(\d+)", 1).cast("long")
    count = F.regexp_extract("shard", r"-c(\d+)\.", 1).cast("long")
    before = Window.orderBy(part, count).rowsBetween(Window.unboundedPreceding, -1)
    totals = totals.select("shard", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("base"))
    return (records.join(totals, "shard")
            .withColumn("start", F.col("start") + F.col("base")).drop("base"))


def stored_order(docs: DataFrame) -> list[Column]:
    """Keys of the order in which Spark wrote ``docs``, read from its files: file number, row number."""
    name = F.col("_metadata.file_name")
    return [F.regexp_extract(name, pattern, 1).cast("long") for pattern in (r"part-(\d+)", r"-c(\d+)\.")] + [F.col("_metadata.row_index")]


def write_records(docs: DataFrame, folder: str, path: str, order: list[Column] | None = None) -> None:
    """Encode ``docs`` (doc_id, text) into ``folder``/data and its index into ``folder``/index, in the
    order of the columns ``order`` or else by doc_id."""
    spark = with_workers(docs.sparkSession)
    names = [f"_order{i}" for i in range(len(order or ()))]
    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
                       *[c.alias(n) for c, n in zip(order or (), names)])
    by = [F.col(n) for n in names] or [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = rows.repartitionByRange(*by).sortWithinPartitions(*by).select("doc_id", "text")
    (rows.mapInArrow(lambda batches: encode_batches(batches, path), "value binary")
     .select(F.col("value").cast("string"))
     .write.option("maxRecordsPerFile", FILE_BLOBS).option("compression", "none").text(f"{folder}/data"))
    scan_records(spark, folder).write.parquet(f"{folder}/scan")
    with_starts(spark.read.schema(RECORD).parquet(f"{folder}/scan")).write.parquet(f"{folder}/index")


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.schema(RECORD).parquet(f"{folder}/index")


def read_shuffled(spark: SparkSession, folder: str, seed: int = 0) -> DataFrame:
    """doc_id and ids of all records, fetched by the index, in a seeded random order."""
    wanted = read_index(spark, folder).groupBy("shard").agg(F.collect_list("offset").alias("offsets"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for content, offsets in zip(batch.column(0), batch.column(1)):
                data = memoryview(content.as_buffer())
                got = [one_frame(data, at)[1:] for at in offsets.as_py()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([g[0] for g in got], pa.int64()), pa.array([g[1].astype(np.int64) for g in got], pa.list_(pa.int64()))],
                    ["doc_id", "ids"])

    files = _files(spark, folder).join(wanted, F.col("path") == F.col("shard"))
    return (files.select("content", "offsets").mapInArrow(fetch, "doc_id long, ids array<long>")
            .orderBy(F.xxhash64("doc_id", F.lit(seed))))


def records_result(docs: DataFrame, path: str, order: list[Column] | None = None) -> DataFrame:
    """Write ``docs`` to a new folder and return doc_id, start, n_tokens and ids_crc32 read back from its files."""
    folder = fresh_path(docs.sparkSession, "records")
    write_records(docs, folder, path, order=order)
    return read_index(docs.sparkSession, folder).select("doc_id", "start", "n_tokens", "ids_crc32", "shard", "offset")


def op7_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return records_result(load(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
