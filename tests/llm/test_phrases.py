"""Phrase mining against counting every phrase in Python."""
import os
import re
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
import pytest

from lakeshift.llm import phrases

COLUMNS = "doc_id long, text string, lang string, block long, idx int, word string, id long, f long, phrase string"
CLASH = (1, 2, "w", 3, 4, "p")
CUT = re.compile("[.,;:!?\n\x0b\x0c\r]")


def brute(rows, least, top, covered):
    f, n = defaultdict(Counter), Counter()
    for _, text, lang, *_ in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in CUT.split(low):
            w = re.findall("[^ \t]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                for i in range(len(w) - k + 1):
                    f[lang][tuple(w[i:i + k])] += 1
    out = set()
    for lang, count in f.items():
        kept = []
        for p, a in count.items():
            if len(p) < 2 or a < least:
                continue
            if any(len(q) > len(p) and b >= least and 100 * b >= covered * a and any(q[i:i + len(p)] == p for i in range(len(q))) for q, b in count.items()):
                continue
            score, cut = min((2000000 * a // (count[p[:k]] + count[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), count[p[:cut]], count[p[cut:]], cut))
        for rank, (s, a, p, l, r, cut) in enumerate(sorted(kept)[:top], 1):
            out.add((lang, rank, p.decode(), -a, l, r, n[lang], -s, cut))
    return out


def table():
    r = np.random.default_rng(2)
    vocabulary = ["the", "of", "New", "york", "city", "hall", "naïve", "日本", "a", "b", "É", "x\x1cy", "-"]
    out = []
    for i in range(60):
        w = [str(x) for x in r.choice(vocabulary, int(r.integers(0, 30)))]
        for _ in range(int(r.integers(0, 3))):
            w[int(r.integers(0, len(w) + 1)):0] = ["new", "York", "city"] if i % 2 else ["a", "a", "a", "a", "a"]
        joined = "".join(x + str(r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", "!?", "\r\x0b"])) for x in w)
        out.append((i, joined, ["en", "fr", None, "und"][i % 4], *CLASH))
    out += [(100, None, "en", *CLASH), (101, "", None, *CLASH), (102, "...", "en", *CLASH), (103, " ".join(["new york"] * 300), "en", *CLASH),
            (103, " ".join(["new york"] * 300), "en", *CLASH), (104, "x" * 50_000 + " city hall", "fr", *CLASH), (None, "new york city", "", *CLASH)]
    return out


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(table(), COLUMNS).repartition(3)


@pytest.mark.parametrize("block_words,least,top,covered", [(1 << 18, 3, 2000, 80), (40, 3, 25, 60), (5, 2, 2000, 100), (1 << 18, 10**6, 5, 80)])
def test_phrases(docs, block_words, least, top, covered):
    """One block a language, and blocks that cut pieces anywhere."""
    got = phrases.mine(docs, least, top, covered, block_words)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score", "cut"]
    assert set(map(tuple, got.collect())) == brute(table(), least, top, covered)


@pytest.mark.parametrize("bucket_words,least_buckets", [(1, 1), (1 << 21, 1)])
def test_phrases_of_any_number_of_buckets(docs, monkeypatch, bucket_words, least_buckets):
    """About one pair in a bucket, and all pairs in one."""
    monkeypatch.setattr(phrases, "BUCKET_WORDS", bucket_words)
    monkeypatch.setattr(phrases, "LEAST_BUCKETS", least_buckets)
    assert set(map(tuple, phrases.mine(docs, 3, 2000, 80, 40).collect())) == brute(table(), 3, 2000, 80)


def test_pairs_travel_packed(spark, monkeypatch):
    """Before they are counted, pairs are written and shuffled by bucket, in few bytes each."""
    tables, write = {}, phrases.stored

    def stored(df, name, **options):
        made = write(df, name, **options)
        tables[name] = made.count(), sum(os.path.getsize(f.split(":", 1)[1]) for f in made.inputFiles())
        return made

    monkeypatch.setattr(phrases, "stored", stored)
    words = np.random.default_rng(5).integers(0, 1000, 300_000)
    pairs = len(set(zip(words[:-1].tolist(), words[1:].tolist())))
    frame = spark.createDataFrame([(" ".join(f"w{i}" for i in words), "en")], "text string, lang string").coalesce(1)
    assert phrases.mine(frame).count() == 0
    rows, size = tables["phrases-2"]
    assert pairs > 200_000 and rows <= 1 + phrases.LEAST_BUCKETS
    assert size <= 4 * len(words) + 5 * pairs


def test_packed_integers():
    for kind, values in (("<i4", [0, 1, -1, 2**31 - 1]), ("<i8", [5, -(2**62), 2**62 + 3]), ("<i8", [])):
        assert phrases.unpack(pa.scalar(phrases.pack(np.array(values, kind))), kind).tolist() == values


def test_bucket_counts_pairs_by_themselves():
    """Pairs that share a bucket stay apart; counts of 0 name a place; sums pass 32 bits."""
    def row(at, *entries):
        g1, g2, n = np.array(entries, "<i8").T
        return {"bucket": 0, "at": at, "packed": phrases.pack(np.concatenate([np.diff(g1, prepend=0), g2, n]))}

    b = 1 << phrases.BITS
    rows = [row(9 * b + 4, (4, 7, 2**31), (1 << 60, 7, 2)), row(b + 1, (4, 6, 2), (4, 7, 0), (5, 7, 2**31)), row(5 * b + 9, (4, 6, 1))]
    got = phrases.count_bucket(pa.Table.from_pylist(rows), 3)
    one = got.filter(pa.compute.is_valid(got["id"])).to_pylist()
    assert sorted((x["id"], x["g1"], x["g2"], x["f"]) for x in one) == [(b + 1, 4, 6, 3), (b + 2, 4, 7, 2**31), (b + 3, 5, 7, 2**31)]
    held = got.filter(pa.compute.is_valid(got["packed"]))
    assert {at: [x.tolist() for x in phrases.places_of(pa.array([packed]))] for at, packed in zip(held["at"].to_pylist(), held["packed"].to_pylist())} == {
        b: [[1, 2, 3], [b + 1, b + 2, b + 3]], 5 * b: [[9], [b + 1]], 9 * b: [[4], [b + 2]]}
    assert len(phrases.count_bucket(pa.Table.from_pylist(rows), 2**40)) == 0


def test_long_text_runs_over_chunks(spark, monkeypatch):
    """A text of several chunks and blocks is one text."""
    monkeypatch.setattr(phrases, "CHUNK_BYTES", 37)
    words = [t for data in (b"One two,three  four.five " * 9, b"", b"x" * 100 + b" y") for run in phrases.tokens_of(data) for t in run]
    assert words == [t for data in (b"one two , three four . five " * 9, b"x" * 100 + b" y") for t in data.split()] or \
        [b"." if w == b"," else w for w in [t for data in (b"one two . three four . five " * 9, b"x" * 100 + b" y") for t in data.split()]] == words
    text = "alpha beta gamma delta epsilon, " * 40_000
    frame = spark.createDataFrame([(text, "en")], "text string, lang string")
    got = {r.phrase: r for r in phrases.mine(frame, block_words=1000).collect()}
    assert set(got) == {"alpha beta gamma delta", "beta gamma delta epsilon"}
    assert {(r.a, r.l, r.r, r.n, r.score) for r in got.values()} == {(40_000, 40_000, 40_000, 200_000, 1_000_000)}


def test_scores_beyond_64_bits(spark):
    """Counts whose products pass 64 bits give exact quotients."""
    a, l, r = (1 << 62) + 1, (1 << 62) + 5, (1 << 62) + 9
    frame = spark.createDataFrame([(1, "en", "p q", a, [l, a], [r, a])], "id long, lang string, phrase string, f long, heads array<long>, tails array<long>")
    assert phrases._scored(frame, 2).first().score == 2_000_000 * a // (l + r)


def test_empty(spark):
    assert phrases.mine(spark.createDataFrame([], COLUMNS)).count() == 0
