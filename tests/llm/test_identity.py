"""Texts and words are told apart by what they hold: equal short hashes, patterned words, long chains, ties."""
import zlib
from collections import Counter
from fractions import Fraction

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeshift.llm import minhash, mixing, records, substring, textkit

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def twins(spark):
    """Pairs of unlike texts of one 32-bit hash: the first repeats a passage, the second repeats nothing."""
    passage = " ".join(f"p{i}" for i in range(25))
    one = F.concat(F.lit(passage + " a"), F.col("id"))
    two = F.concat_ws(" ", *[F.concat(F.lit(f"b{k}x"), F.col("id")) for k in range(25)])
    texts = spark.range(120_000).select(F.explode(F.array(F.struct(F.lit(0).alias("kind"), one.alias("text")), F.struct(F.lit(1).alias("kind"), two.alias("text")))).alias("t")).select("t.*")
    pairs = texts.groupBy(F.hash("text")).agg(F.min(F.struct("kind", "text")).alias("a"), F.max(F.struct("kind", "text")).alias("b")).filter("a.kind < b.kind")
    found = [(r.a.text, r.b.text) for r in pairs.select("a", "b").limit(3).collect()]
    assert found
    return passage, found


def test_null_ids_of_one_short_hash(spark, twins):
    passage, pairs = twins
    texts = [passage] + [t for p in pairs for t in p]
    docs = spark.createDataFrame([(1, passage), *((None, t) for t in texts[1:])], "doc_id long, text string")
    got = {r.kept_text: r.n_removed for r in substring.dedup_substrings(docs).filter("doc_id is null").collect()}
    for a, b in pairs:
        assert got[b] == 0 and got[a.removeprefix(passage).strip()] == 25
    found = Counter((r.n_shingles, r.component_id) for r in minhash.near_duplicates(docs, 2).collect())
    assert found == Counter({(24, 1): 1, (25, 1): len(pairs), (24, None): len(pairs)})
    kept = sorted(r.text for r in minhash.keep_one(docs, 2).collect())
    assert kept == sorted([passage, *(b for _, b in pairs)])


def thue_morse(n):
    return np.frombuffer(bytes(ord("a") + bin(i).count("1") % 2 for i in range(n)), np.uint8).tobytes().decode()


def test_patterned_words(spark):
    flip = str.maketrans("ab", "ba")
    words = [w for n in (256, 1024, 2048, 4096, 8192) for w in (thue_morse(n), thue_morse(n).translate(flip))]
    buf = np.frombuffer(" ".join(words).encode(), np.uint8)
    w = textkit.Words(buf, np.array([0, len(buf)]))
    assert len(set(w.hashes().tolist())) == len(words) == len(w.start)
    tok = Tokenizer.from_file(PATH)
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(words)], "doc_id long, text string").coalesce(1)
    got = {r.doc_id: (r.n_tokens, r.ids_crc32) for r in records.records_result(docs, PATH).collect()}
    for i, t in enumerate(words):
        ids = [*tok.encode(t, add_special_tokens=False).ids, 2]
        assert got[i] == (len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
    assert all(r.component_id == r.doc_id for r in minhash.near_duplicates(docs, 2).collect())


def test_span_hashes_tell_spans_apart():
    """Equal where the bytes are equal, whatever stands around them; else different."""
    r = np.random.default_rng(4)
    spans = {bytes(r.integers(0, 3, int(n), np.uint8)) for n in r.integers(0, 40, 20_000)} | {b"\0" * n for n in range(50)} | {b"x" * n for n in (4095, 4096, 4097, 9000)}
    spans = sorted(spans)
    seen = {}
    for lead in (b"", b"zz"):
        buf = lead + b"".join(s + b"|" for s in spans)
        size = np.array([len(s) for s in spans])
        start = len(lead) + np.cumsum(size + 1) - size - 1
        for seed in (0, 5):
            h = textkit.span_hashes(np.frombuffer(buf, np.uint8), start, start + size, seed).tolist()
            assert seen.setdefault(seed, h) == h and len(set(h)) == len(spans)
    assert not set(seen[0]) & set(seen[5])


def test_first_hash_alone_is_not_trusted(monkeypatch):
    """Pre-tokens that share the first hash get ids of their own, learned before or in the same batch."""
    real = textkit.span_hashes
    monkeypatch.setattr(records, "span_hashes", lambda buf, a, b, seed=0: real(buf, a, b, seed) if seed else (b - a).astype(np.uint64))
    tok = Tokenizer.from_file(PATH)
    own = records.Encoder(PATH)
    for texts in (["red fox", "big dog"], ["one two six", "ten", "red"], ["naïve café", ""]):
        ids, sizes = own(texts)
        assert [x.tolist() for x in np.split(ids, np.cumsum(sizes)[:-1])] == [[*tok.encode(t, add_special_tokens=False).ids, 2] for t in texts]


def test_long_chains_settle(spark):
    """A path, whose links lie in many files and whose labels run against it, and other shapes."""
    r = np.random.default_rng(6)
    name = lambda k: int(k).to_bytes(8, "big")
    path = [*range(2, 1201), 1]
    links = list(zip(path, path[1:])) + [(5000, 5000 + k) for k in range(1, 300)] + [(9000 + k, 9001 + k) for k in r.permutation(40).tolist()]
    links += [(7001, 7002), (7002, 7003), (7003, 7001), (7001, 7002)]
    links = [links[i] for i in r.permutation(len(links))]
    rows = [(name(a), name(b)) if i % 2 else (name(b), name(a)) for i, (a, b) in enumerate(links)]
    edges = spark.sparkContext.parallelize(rows, 40).toDF("a binary, b binary")
    got = {int.from_bytes(x.node, "big"): int.from_bytes(x.label, "big") for x in minhash.components(edges).collect()}
    want = {k: 1 for k in path} | {5000 + k: 5000 for k in range(300)} | {9000 + k: 9000 for k in range(41)} | {k: 7001 for k in (7001, 7002, 7003)}
    assert got == want


def test_probes_pass_in_chunks():
    """A block of unlike classes holds itself and a chunk, and finds each link of what passes."""
    import pyarrow as pa
    r = np.random.default_rng(8)

    def row(values, probe, label=None):
        values = np.unique(values)
        _, low = minhash.signatures(values, np.array([0, len(values)]))
        digest = values.tobytes()[:16] + bytes([len(values) % 251])
        return (b"c", 0, probe, digest, low[0].tobytes(), values.tobytes(), label or digest)

    sets = [r.integers(1, 1 << 62, 50, dtype=np.uint64) for _ in range(30)]
    members = [row(s, False) for s in sets]
    probes = [row(np.append(s[:45], r.integers(1, 1 << 62, 2, dtype=np.uint64)), True) for s in sets[::2]] + [row(r.integers(1, 1 << 62, 50, dtype=np.uint64), True) for _ in range(20)]
    rows = sorted(members, key=lambda x: x[3]) + sorted(probes, key=lambda x: x[3])
    kinds = (pa.binary(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary(), pa.binary())
    batch = [pa.RecordBatch.from_arrays([pa.array([x[k] for x in rows], t) for k, t in enumerate(kinds)], list("abcdefg"))]
    for chunk in (1, 7, 100):
        links = {frozenset(x) for b in minhash.confirm_batches(iter(batch), chunk, True) for x in zip(*(c.to_pylist() for c in b.columns))}
        assert links == {frozenset((p[6], m[6])) for p, m in zip(probes, members[::2])}


def plain_targets(sizes):
    """Targets by the text of the contract: share by weight, stop at twice the size, share the excess again."""
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    target, left, free = {s: Fraction(0) for s in order}, Fraction(3, 2) * sum(sizes.values()), set(order)
    while left and free:
        total = sum(weight[s] for s in free)
        give = {s: left * weight[s] / total for s in free}
        left = Fraction(0)
        for s, g in give.items():
            target[s] += g
            if target[s] >= 2 * sizes[s]:
                left += target[s] - 2 * sizes[s]
                target[s] = Fraction(2 * sizes[s])
                free.discard(s)
    return target


def test_targets_of_random_sources(spark):
    """Null, empty and equal sources, ties of size to weight, sources without words."""
    r = np.random.default_rng(9)
    cases = [{"a": 500, None: 200}, {"": 500, None: 200}, {None: 7}, {"a": 0, None: 0}, {"a": 10, "b": 4, "c": 2, None: 10}]
    for _ in range(12):
        names = [x for x in ("", "a", "b", "c", "d", "é", None) if r.random() < 0.7] or [None]
        cases.append({x: int(r.choice([0, 1, 2, 5, 10, 20, 100, 1000])) for x in names})
    for case in cases:
        frame = spark.createDataFrame([(s, n) for s, n in case.items()], "source string, size long")
        got = {x.source: x.target for x in mixing.source_targets(frame).collect()}
        want = plain_targets(case)
        assert set(got) == set(want)
        for s in want:
            assert got[s] == pytest.approx(float(want[s]), abs=1e-6), (case, s)


def test_record_files_are_bounded(spark, tmp_path, monkeypatch):
    """Large frames count for the blobs they are worth; padding is skipped; equal ids may be split."""
    monkeypatch.setattr(records, "BLOB_BYTES", 3000)
    big = np.arange(9000, dtype=np.uint32)
    rows = records.blob_rows([records.frame(1, big, False)]) + records.blob_rows([records.frame(None, big[:3], True)])
    assert len(rows) == 36_021 // 3000 + 1
    got = list(records.frames(b"".join(x + records.CLOSE for x in rows)))
    assert [(d, i.tolist()) for _, _, d, i in got] == [(1, big.tolist()), (None, [0, 1, 2])]
    docs = spark.createDataFrame([(7, f"text number {i}") for i in range(500)] + [(None, "none")], "doc_id long, text string")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        records.write_records(docs, f"{tmp_path}/r", PATH)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    back = records.read_index(spark, f"{tmp_path}/r").orderBy("start").collect()
    assert [r.doc_id for r in back] == [None] + [7] * 500
    assert len({r.shard for r in back}) > 1
