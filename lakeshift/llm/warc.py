"""WARC archives: one gzip member per record, written by Spark, read in sequence (operator 13).

*Writing.* Of equal payloads the one with the largest page_id becomes a ``response`` record, the
others ``revisit`` records without payload. Payloads meet as 256-bit digests: counts and largest
ids are combined maxima of slim rows, and only payloads that occur twice or more are joined back,
by an ordinary join that skew handling may split. Records come out of Arrow batches as gzip members,
packed to blobs of about ``BLOB_BYTES``, and go through Spark's own committed text writer, so
neither a lost executor nor a second attempt leaves a torn or doubled file. The writer's
separator is the zero byte: it is the last byte of a member's length field for members below 16 MB and
padding between members for larger ones. ``FILE_BLOBS`` blobs fill a file; a large blob
counts for as many as it holds, so a file has a bounded size (or one large record).

    WARC/1.1 head | HTTP head | payload | CRLF CRLF          (a revisit has no payload)

*Reading.* A file is decompressed step by step, ``CHUNK`` bytes in and at most ``PIECE`` out. Heads end at
the first blank line, ``Content-Length`` frames the block, both digests are taken while the block passes, and
a member must end with its record. Offsets of all records make the index. Revisits are then
looked up: the record they refer to must exist and have their digest.

Defined results: a null html is an empty payload; rows without a page_id are archived too (smallest
of all, no refers_to if it is the response); among equal payloads of one page_id the largest
url is the response (nulls smallest), of rows repeated whole any one; control characters in a
url are percent-encoded, a null url has no header; an empty table writes no record; extra columns
are ignored. Files carry no ``warcinfo`` record.
"""
from __future__ import annotations

import base64
import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from datetime import datetime, timezone

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.llm.shared import empty_text, fresh_path, load, stored, with_workers

BLOB_BYTES, FILE_BLOBS = 4 << 20, 8
CHUNK, PIECE = 1 << 16, 1 << 18

#: Fixed values of the format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
BLANK_LINE = b"\r\n\r\n"
PAGE_ID = "X-Page-Id"

_CONTROL = re.compile("[\x00-\x20\x7f]")


def base32(sha1: bytes) -> str:
    return base64.b32encode(sha1).decode()


def urn(digest: bytes) -> str:
    return f"<{uuid.UUID(bytes=digest[:16]).urn}>"


def record(kind: str, record_id: str, date: str, url: str | None, page_id: int | None, size: int, sha1: bytes,
           payload: bytes | None, refers_to: str | None) -> bytes:
    """One record as a gzip member. ``size`` and ``sha1`` are those of the full payload."""
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode() + (payload or b"")
    head = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", date)]
    if url is not None:
        head.append(("WARC-Target-URI", _CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url)))
    if page_id is not None:
        head.append((PAGE_ID, str(page_id)))
    if refers_to is not None:
        head += [("WARC-Profile", PROFILE), ("WARC-Refers-To", refers_to)]
    head += [("WARC-Payload-Digest", f"sha1:{base32(sha1)}"), ("WARC-Block-Digest", f"sha1:{base32(hashlib.sha1(block).digest())}"),
             ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    lines = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head).encode() + b"\r\n"
    pack = zlib.compressobj(6, zlib.DEFLATED, 31)
    return pack.compress(lines) + pack.compress(block) + pack.compress(BLANK_LINE) + pack.flush()


def blob_rows(members: list[bytes]) -> list[bytes]:
    """What the writer is given for some members: it closes each row by a zero byte."""
    blob = b"".join(members)
    return [blob[:-1] if blob.endswith(b"\0") else blob] + [b""] * (len(blob) // BLOB_BYTES - 1)


def write_batches(batches: Iterator[pa.RecordBatch], date: str, salt: str) -> Iterator[pa.RecordBatch]:
    """(page_id, url, kind, payload, size, sha1, key) -> blobs of records."""
    part, n = TaskContext.get().partitionId(), 0
    members, held = [], 0

    def rows() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(blob_rows(members), pa.binary())], ["value"])

    for batch in batches:
        for page_id, url, kind, payload, size, sha1, key in zip(*batch.columns):
            own = hashlib.md5(f"{salt}:{part}:{n}".encode()).digest()
            n += 1
            kind, key = kind.as_py(), key.as_py()
            data = payload.as_buffer().to_pybytes() if payload.is_valid else None
            member = record("revisit" if kind == "revisit" else "response", urn(key if kind == "named" else own), date, url.as_py(), page_id.as_py(),
                            size.as_py(), sha1.as_py(), data, urn(key) if kind == "revisit" else None)
            members.append(member)
            held += len(member)
            if held >= BLOB_BYTES:
                yield rows()
                members, held = [], 0
    if members:
        yield rows()


def _copied(rows: DataFrame, least_bytes: int) -> DataFrame:
    """Payloads that occur twice or more: key, the page that is their response, rows equal to it."""
    slim = rows.filter(F.col("size") >= least_bytes).groupBy("key", "page_id", "url").agg(F.count(F.lit(1)).alias("c"))
    return slim.groupBy("key").agg(F.max(F.struct("page_id", "url", "c")).alias("best"), F.sum("c").alias("n")).filter("n > 1").drop("n")


def typed(pages: DataFrame, least_bytes: int = 0) -> DataFrame:
    """page_id, url, kind, payload, size, sha1, key: kind is ``response``, ``named`` (the response of copies)
    or ``revisit`` (payload null). Payloads of fewer than ``least_bytes`` are all responses."""
    html = empty_text("html").cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), html.alias("payload"))
    rows = rows.select("*", F.octet_length("payload").cast("long").alias("size"), F.unhex(F.sha1("payload")).alias("sha1"),
                       F.unhex(F.sha2("payload", 256)).alias("key"))
    copied = stored(_copied(rows, least_bytes), "warc-copied")
    best = F.col("page_id").eqNullSafe(F.col("best.page_id")) & F.col("url").eqNullSafe(F.col("best.url"))
    kind = (F.when(F.col("best").isNull(), "response").when(~best, "revisit")
            .when(F.col("best.c") > 1, "tied").otherwise("named"))
    columns = ["page_id", "url", "kind", F.when(F.col("kind") != "revisit", F.col("payload")).alias("payload"), "size", "sha1", "key"]
    out = rows.join(copied, "key", "left").withColumn("kind", kind)
    out = out.filter("kind != 'tied'").select(*columns)
    ties = copied.filter("best.c > 1")
    if ties.isEmpty():
        return out
    # rows equal to the response in all columns: one of them is it, the others revisit it
    equal = rows.join(ties, "key").filter(best).groupBy("key", "page_id", "url").agg(
        *(F.first(c).alias(c) for c in ("payload", "size", "sha1")), F.count(F.lit(1)).alias("n"))
    kinds = F.concat(F.array(F.lit("named")), F.array_repeat(F.lit("revisit"), (F.col("n") - 1).cast("int")))
    return out.unionByName(equal.withColumn("kind", F.explode(kinds)).select(*columns))


def write_archives(pages: DataFrame, folder: str, least_bytes: int = 0, date: str | None = None) -> None:
    """Archive ``pages`` (page_id, url, html) in ``folder``."""
    with_workers(pages.sparkSession)
    date = date or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    salt = uuid.uuid4().hex
    (typed(pages, least_bytes).mapInArrow(lambda batches: write_batches(batches, date, salt), "value binary")
     .select(F.col("value").cast("string"))
     .write.option("maxRecordsPerFile", FILE_BLOBS).option("compression", "none").option("lineSep", "\0").text(folder))


class Member:
    """One gzip member of ``data`` from ``at``, decompressed step by step."""

    def __init__(self, data: memoryview, at: int) -> None:
        self.data, self.at, self.zip, self.held = data, at, zlib.decompressobj(31), b""

    def piece(self) -> bytes:
        """Some more of the content, empty at its end."""
        if self.held:
            out, self.held = self.held, b""
            return out
        while not self.zip.eof:
            feed = self.zip.unconsumed_tail
            if not feed:
                feed = self.data[self.at:self.at + CHUNK]
                self.at += len(feed)
                if not len(feed):
                    raise ValueError("a member is cut off")
            try:
                out = self.zip.decompress(feed, PIECE)
            except zlib.error as e:
                raise ValueError(f"damaged member: {e}") from e
            if out:
                return out
        return b""

    def head(self) -> bytes:
        """All up to the first blank line, without it."""
        got, seen = bytearray(), 0
        while (k := got.find(BLANK_LINE, seen)) < 0:
            seen = max(len(got) - 3, 0)
            more = self.piece()
            if not more:
                raise ValueError("a head does not end")
            got += more
        self.held = bytes(got[k + 4:]) + self.held
        return bytes(got[:k])

    def take(self, n: int) -> Iterator[bytes]:
        """The next ``n`` bytes in pieces."""
        while n:
            more = self.piece()
            if not more:
                raise ValueError("a block is shorter than its length")
            if len(more) > n:
                more, self.held = more[:n], more[n:]
            n -= len(more)
            yield more

    def end(self) -> int:
        """Offset behind the member, which must hold nothing more."""
        if self.piece():
            raise ValueError("a block is longer than its length")
        return self.at - len(self.zip.unused_data)


def fields(head: bytes) -> dict[str, str]:
    """Named fields of a head behind its first line, names in lower case."""
    lines = head.decode().split("\r\n")[1:]
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}


class Block:
    """An HTTP response that passes by in pieces: its head, and length and digests of what follows."""

    def __init__(self, keep: bool) -> None:
        self.whole, self.payload, self.size = hashlib.sha1(), hashlib.sha1(), 0
        self.start, self.head, self.kept = bytearray(), None, [] if keep else None

    def add(self, piece: bytes) -> None:
        self.whole.update(piece)
        if self.head is None:
            self.start += piece
            if (k := self.start.find(BLANK_LINE)) < 0:
                return
            self.head, piece = bytes(self.start[:k]), bytes(self.start[k + 4:])
        self.payload.update(piece)
        self.size += len(piece)
        if self.kept is not None:
            self.kept.append(piece)


def one_record(data: memoryview, at: int, keep: bool = False) -> tuple[int, dict]:
    """(offset behind the record, its fields) of the record at ``at``; raises ValueError on any damage."""
    member = Member(data, at)
    head = member.head()
    if not head.startswith(VERSION + b"\r\n"):
        raise ValueError(f"no record at byte {at}")
    found = fields(head)
    block = Block(keep)
    for piece in member.take(int(found["content-length"])):
        block.add(piece)
    if b"".join(member.take(len(BLANK_LINE))) != BLANK_LINE:
        raise ValueError(f"no blank line behind the block of byte {at}")
    end = member.end()
    kind, digest = found["warc-type"], found["warc-payload-digest"].removeprefix("sha1:")
    if block.head is None or found["warc-block-digest"] != f"sha1:{base32(block.whole.digest())}":
        raise ValueError(f"block digest differs at byte {at}")
    size = int(fields(block.head)["content-length"])
    if kind == "response" and (size != block.size or digest != base32(block.payload.digest())) or kind == "revisit" and block.size:
        raise ValueError(f"payload differs at byte {at}")
    page_id = found.get(PAGE_ID.lower())
    return end, {"offset": at, "length": end - at, "record_id": found["warc-record-id"], "record_type": kind,
                 "page_id": None if page_id is None else int(page_id), "target_uri": found.get("warc-target-uri"), "date": found["warc-date"],
                 "payload_bytes": size, "payload_digest": digest, "refers_to_id": found.get("warc-refers-to"),
                 "payload": b"".join(block.kept) if keep and kind == "response" else None}


def records(data: bytes | memoryview, keep: bool = False) -> Iterator[dict]:
    """The records of one archive file in sequence."""
    data, at = memoryview(data), 0
    while True:
        while at < len(data) and data[at] == 0:  # padding between members
            at += 1
        if at == len(data):
            return
        at, found = one_record(data, at, keep)
        yield found


RECORD = ("archive string, offset long, length long, record_id string, record_type string, page_id long, target_uri string, date string, "
          "payload_bytes long, payload_digest string, refers_to_id string")
KINDS = {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}


def read_batches(batches: Iterator[pa.RecordBatch], schema: str) -> Iterator[pa.RecordBatch]:
    """(path, content) of archive files -> their records."""
    columns = [c.split() for c in schema.split(", ")]
    keep = columns[-1][0] == "payload"

    def table(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([r[name] for r in rows], KINDS[kind]) for name, kind in columns], [name for name, _ in columns])

    for batch in batches:
        for path, content in zip(*batch.columns):
            rows, held = [], 0
            for found in records(memoryview(content.as_buffer()), keep):
                rows.append(found | {"archive": path.as_py()})
                held += 200 + len(found["payload"] or b"")
                if held >= BLOB_BYTES:
                    yield table(rows)
                    rows, held = [], 0
            if rows:
                yield table(rows)


def read_archives(spark: SparkSession, folder: str, payloads: bool = False) -> DataFrame:
    """All records of the archives in ``folder``, every digest checked; with ``payloads`` the payload of responses too."""
    schema = RECORD + ", payload binary" if payloads else RECORD
    files = with_workers(spark).read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder)
    return files.select("path", "content").mapInArrow(lambda batches: read_batches(batches, schema), schema)


def resolved(found: DataFrame) -> DataFrame:
    """Records with ``refers_to``, the page of the response that a revisit refers to; fails if that is not
    there or has another digest."""
    response = found.filter("record_type = 'response'")
    target = response.select(F.col("record_id").alias("_to"), F.col("page_id").alias("refers_to"), F.col("payload_digest").alias("_digest"))
    revisit = found.filter("record_type = 'revisit'").join(target, F.col("refers_to_id") == F.col("_to"), "left")
    sound = F.when(F.col("_digest").eqNullSafe(F.col("payload_digest")), F.lit(True)).otherwise(
        F.raise_error(F.concat(F.lit("no response of equal digest for "), "record_id")).cast("boolean"))
    return response.withColumn("refers_to", F.lit(None).cast("long")).unionByName(revisit.filter(sound).drop("_to", "_digest"))


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = fresh_path(spark, "warc")
    write_archives(load(spark, sf_dir, "pages"), folder)
    index = stored(read_archives(spark, folder), "warc-index")
    return resolved(index).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
