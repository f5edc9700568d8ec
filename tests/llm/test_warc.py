"""Archives against brute force, the gzip module, and damage."""
import base64
import gzip
import hashlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from lakeshift.llm import warc

COLUMNS = "page_id long, url string, html string, key string, kind int, best string, size string"
CLASH = ("k", 3, "b", "s")


def table():
    r = np.random.default_rng(5)
    body = lambda k: "<p>" + " ".join(r.choice(["the", "naïve", "日本", "<b>x</b>"], k)) + "</p>"
    out = [(i, f"http://a/{i}", body(20 + i)) for i in range(30)]
    out += [(100 + i, f"http://b/{i}", "same page") for i in range(40)] + [(99, "http://c\r\nX-Page-Id: 7", "same page")]
    out += [(200, "http://d", "once"), (201, "http://d", None), (202, None, ""), (203, "http://e", "x" * 300_000), (204, "http://e", "x" * 300_000)]
    out += [(None, "http://n", "no id"), (None, "http://m", "no id"), (None, None, "alone"), (300, "u1", "one id"), (300, "u2", "one id"), (300, None, "one id")]
    out += [(400, "whole", "row repeated")] * 3 + [(399, "whole", "row repeated"), (401, "w", "pair")] + [(402, "w", "pair")] * 2
    return [(*x, *CLASH) for x in out]


def wanted(rows):
    best = {}
    for p, u, h, *_ in rows:
        rank = (p is not None, p or 0, u is not None, u or "")
        best[h or ""] = max(best.get(h or "", rank), rank)
    out, used = Counter(), set()
    for p, u, h, *_ in rows:
        data = (h or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        rank = (p is not None, p or 0, u is not None, u or "")
        if rank == best[h or ""] and (h or "") not in used:
            used.add(h or "")
            out[p, len(data), digest, "response", None] += 1
        else:
            out[p, len(data), digest, "revisit", best[h or ""][1] if best[h or ""][0] else None] += 1
    return out


def members(data):
    """Content of each gzip member."""
    import zlib
    while data := data.lstrip(b"\0"):
        d = zlib.decompressobj(31)
        yield d.decompress(data)
        assert d.eof
        data = d.unused_data


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('warc')}/archives"
    warc.write_archives(spark.createDataFrame(table(), COLUMNS).repartition(3), path)
    return path


def test_round_trip(spark, folder):
    found = warc.resolved(warc.read_archives(spark, folder, payloads=True)).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found) == wanted(table())
    texts = {hashlib.sha1((h or "").encode()).hexdigest(): (h or "").encode() for _, _, h, *_ in table()}
    for r in found:
        if r.record_type == "response":
            assert bytes(r.payload) == texts[hashlib.sha1(bytes(r.payload)).hexdigest()] and len(r.payload) == r.payload_bytes
    assert len({r.record_id for r in found}) == len(found)


def test_files_are_plain_gzip(spark, folder):
    """One member per record, readable as one gzip file, at the offsets of the index."""
    index = warc.read_archives(spark, folder).collect()
    for row in spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(folder).collect():
        data = bytes(row.content)
        parts = list(members(data))
        assert gzip.decompress(data) == b"".join(parts)
        mine = sorted((r for r in index if r.archive == row.path), key=lambda r: r.offset)
        assert len(parts) == len(mine) > 0
        for part, r in zip(parts, mine):
            assert gzip.decompress(data[r.offset:r.offset + r.length]) == part
            assert part.startswith(b"WARC/1.1\r\nWARC-Type: " + r.record_type.encode()) and part.endswith(b"\r\n\r\n")


def test_small_payloads_are_all_responses(spark, tmp_path):
    path = f"{tmp_path}/a"
    warc.write_archives(spark.createDataFrame(table(), COLUMNS), path, least_bytes=100)
    found = Counter((r.record_type, r.payload_bytes) for r in warc.resolved(warc.read_archives(spark, path)).collect())
    assert found["response", 300_000] == found["revisit", 300_000] == 1 and sum(found.values()) == len(table())
    assert all(kind == "response" for kind, n in found if n < 100)


def test_empty(spark, tmp_path):
    warc.write_archives(spark.createDataFrame([], COLUMNS), f"{tmp_path}/a")
    assert warc.resolved(warc.read_archives(spark, f"{tmp_path}/a")).count() == 0


def one(payload, kind="response", refers=None):
    sha1 = hashlib.sha1(payload).digest()
    return warc.record(kind, warc.urn(sha1), "2024-01-01T00:00:00Z", "http://x", 5, len(payload), sha1, payload if kind == "response" else None, refers)


def written(rows):
    return b"".join(x + b"\0" for x in rows)


@pytest.mark.parametrize("size", [0, 10, warc.CHUNK, warc.PIECE * 3 + 1, 17 << 20])
def test_sizes(size):
    """Pieces that end anywhere; members above 16 MB end with a byte of their own and are padded."""
    payload = np.random.default_rng(1).integers(0, 64, size, np.uint8).tobytes()
    member = one(payload)
    data = written(warc.blob_rows([one(b"before"), member]) + warc.blob_rows([one(b"after")]))
    assert (member[-1] == 0) == (size < 16 << 20)
    got = list(warc.records(data, keep=True))
    assert [g["payload"] for g in got] == [b"before", payload, b"after"]


def test_large_blobs_fill_a_file(monkeypatch):
    monkeypatch.setattr(warc, "BLOB_BYTES", 1000)
    member = one(np.random.default_rng(1).integers(0, 256, 5000, np.uint8).tobytes())
    rows = warc.blob_rows([member])
    assert len(rows) == len(member) // 1000 and len(list(warc.records(written(rows) * 3))) == 3


def test_damage_is_found():
    data = one(b"some payload of a page") + one(b"another payload")
    whole = list(warc.records(data))
    assert len(whole) == 2
    for k in range(0, len(data), 3):
        broken = data[:k] + bytes([data[k] ^ 0x55]) + data[k + 1:]
        try:
            got = list(warc.records(broken))
        except (ValueError, KeyError, UnicodeDecodeError):
            continue
        assert [g | {"offset": 0} for g in got] == [g | {"offset": 0} for g in whole]  # a flag of the gzip head only
    with pytest.raises(ValueError):
        list(warc.records(data[:-5]))
    # well-formed members whose content breaks a rule
    plain = gzip.decompress(one(b"some payload"))
    for bad in (plain.replace(b"some payload", b"same payload"), plain.replace(b"Content-Length: 12", b"Content-Length: 13"),
                plain + b"more", plain[:-2], plain.replace(b"WARC/1.1", b"WARC/9.9")):
        with pytest.raises(ValueError):
            list(warc.records(gzip.compress(bad)))


def test_dangling_revisit_fails(spark):
    index = spark.createDataFrame([("a", 0, 1, "<r1>", "revisit", 1, None, "d", 3, "ABC", "<r0>")], warc.RECORD)
    with pytest.raises(Exception, match="no response of equal digest"):
        warc.resolved(index).collect()
    other = spark.createDataFrame([("a", 0, 1, "<r0>", "response", 1, None, "d", 3, "XYZ", None)], warc.RECORD)
    with pytest.raises(Exception, match="no response of equal digest"):
        warc.resolved(index.unionByName(other)).collect()
    same = other.withColumn("payload_digest", F.lit("ABC"))
    assert warc.resolved(index.unionByName(same)).count() == 2
