"""Every operator against a brute-force version on a small nasty table: nulls, empty and blank texts,
repeated rows, ties, one long text, extra columns with clashing names, and the empty table."""
import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from lakeshift.llm import adaptive, decontam, langid, line_templates, minhash, mixing, quality, records, substring, tokencount

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")
CLASHING = ("x", 1, 2, "i", "t", 3, "d", "h", "y")  # values of the extra columns
WORD = re.compile("[^\x20\x09-\x0d]+")
COMMON = " ".join(f"common{i}" for i in range(30))
EXTRA = ("id", "_at", "n", "_id", "_tie", "_row", "_doc", "_hash", "label")
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, id string, _at int, n int, _id string, _tie string, _row int, _doc string, _hash string, label string"


def text(seed, n):
    r = np.random.default_rng(seed)
    return " ".join(r.choice(["the", "of", "alpha", "beta", "gamma", "delta", "it's", "x1", "naïve", "日本"], n)) + f" end{seed}"


def rows():
    out = [(i, text(i, 40 + i), ["en", "fr", None][i % 3], ["a", "b", None, "c"][i % 4]) for i in range(12)]
    out += [(100, text(1, 41), "en", "a"), (101, text(2, 42) + " more", "en", "a"), (102, None, "en", None), (103, "", None, "b"),
            (104, " \t\n ", "en", "b"), (105, "one", "en", "c"), (None, text(5, 45), "en", "a"), (106, COMMON + " tail a", "fr", "a"),
            (107, "head " + COMMON, "fr", "b"), (108, text(77, 4000) + " " + COMMON, "en", "a"), (109, "be " * 60, "en", "c"),
            (110, "<|endoftext|>mid <|endoftext|>", "en", "c"), (5, text(5, 45), "en", "b"), (111, "12 !! ##", "en", "b"),
            (112, "same line 7\nsame line 8\nother\n\nsame line 7", "en", "a"), (112, "same id, other text", "en", "a")]
    return [(*r, None, *CLASHING) for r in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), COLUMNS).repartition(3)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], COLUMNS)


def words(t):
    return WORD.findall(t or "")


def key(r):
    return (r[0] is None, r[0] or 0)


def test_tokens_and_records(spark, docs, none):
    tok = Tokenizer.from_file(PATH)
    enc = [(r[0], tok.encode(r[1] or "", add_special_tokens=False).ids) for r in rows()]
    got = tokencount.count_tokens(docs, PATH).collect()
    assert Counter((r.doc_id, r.n_tokens, r.n_bytes) for r in got) == Counter(
        (r[0], len(e), len((r[1] or "").encode())) for r, (_, e) in zip(rows(), enc))
    back = records.records_result(docs, PATH).collect()
    want = Counter((d, len(e) + 1, zlib.crc32(np.array([*e, 2], "<u4").tobytes())) for d, e in enc)
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in back) == want
    at = 0
    for r in sorted(back, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens
    assert tokencount.count_tokens(none, PATH).count() == records.records_result(none, PATH).count() == 0


def test_damaged_record_is_found():
    data = records.frame(3, np.array([1, 2, 3], np.uint32), True) + records.CLOSE
    assert [(d, i.tolist()) for _, _, d, i in records.frames(data)] == [(3, [1, 2, 3])]
    for k in (0, 9, len(data) - 2):
        with pytest.raises(ValueError):
            list(records.frames(data[:k] + bytes([data[k] ^ 1]) + data[k + 1:]))


def test_substring(docs, none):
    first, seen = {}, []
    for r in rows():
        seen.append((r[0] if r[0] is not None else 1 << 62, r[1] or ""))
    for d, t in sorted(set(seen)):
        w = words(t)
        for k in range(len(w) - 19):
            first.setdefault(tuple(w[k:k + 20]), (d, t, k))
    want = Counter()
    for d, t in seen:
        w, gone = words(t), set()
        for k in range(len(w) - 19):
            if first[tuple(w[k:k + 20])] != (d, t, k):
                gone |= set(range(k, k + 20))
        want[(d, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone))] += 1
    got = substring.dedup_substrings(docs).collect()
    assert Counter((1 << 62 if r.doc_id is None else r.doc_id, r.n_words, r.n_removed, r.kept_text) for r in got) == want
    assert substring.dedup_substrings(none).count() == 0


@pytest.mark.parametrize("block", [1024, 2])
def test_near_duplicates(docs, none, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    sets = []
    for r in rows():
        w = [x.lower() for x in words(r[1])]
        sets.append(frozenset(zip(w, w[1:])) if len(w) > 1 else frozenset([tuple(w)] if w else []))
    n = len(sets)
    comp = list(range(n))
    for i in range(n):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = comp[i], comp[j]
                comp = [b if c == a else c for c in comp]
    least = {c: min((rows()[i][0] for i in range(n) if comp[i] == c and rows()[i][0] is not None), default=None) for c in comp}
    want = Counter((rows()[i][0], len(sets[i]), least[comp[i]] if sets[i] else rows()[i][0]) for i in range(n))
    got = minhash.near_duplicates(docs, 2).collect()
    assert Counter((r.doc_id, r.n_shingles, r.component_id) for r in got) == want
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)
    assert minhash.near_duplicates(none, 2).count() == 0
    kept = minhash.keep_one(docs, 2)
    assert kept.columns == docs.columns and {tuple(r) for r in kept.select(*EXTRA).collect()} == {CLASHING}
    assert kept.count() == len(set(c for c, s in zip(comp, sets) if s)) + sum(not s for s in sets)


@pytest.mark.parametrize("block_words", [10**6, 30])
def test_decontamination(spark, docs, none, block_words):
    items = [(1, COMMON), (2, "One"), (None, "the of"), (4, ""), (5, None), (6, "BE be be"), (1, "zeta")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    pattern = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    low = lambda t: re.sub("[A-Z]", lambda m: m[0].lower(), t or "")
    windows = {}
    for i, t in items:
        w = pattern.findall(low(t))
        m = min(13, len(w))
        for k in range(len(w) - m + 1 if m else 0):
            windows.setdefault(tuple(w[k:k + m]), set()).add(i)
    want = Counter()
    for r in rows():
        w, hit, found = pattern.findall(low(r[1])), set(), set()
        for p, ids in windows.items():
            for k in range(len(w) - len(p) + 1):
                if tuple(w[k:k + len(p)]) == p:
                    hit |= set(range(k, k + len(p)))
                    found |= ids
        ids = sorted(str(x) for x in found if x is not None)
        want[(r[0], len(w), len(hit), len(ids), hashlib.sha256(",".join(ids).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))] += 1
    got = decontam.decontaminate(docs, bench, block_words=block_words)
    assert Counter(tuple(r) for r in got.collect()) == want
    assert decontam.decontaminate(none, bench, block_words=block_words).count() == 0
    assert decontam.decontaminate(docs, bench.limit(0)).filter("n_hit > 0").count() == 0


@pytest.mark.parametrize("block_words", [10**6, 30])
def test_keep_clean_judges_each_row_by_its_text(spark, none, block_words):
    """Null and repeated ids: a contaminated row takes no clean row of its id along."""
    bench = spark.createDataFrame([(1, COMMON), (2, " ".join(f"other{i}" for i in range(20)))], "item_id long, text string")
    assert (len(list(decontam.blocks_of(bench, 13, block_words))) > 1) == (block_words == 30)
    data = [(None, text(1, 20)), (None, COMMON), (None, text(2, 20)), (7, text(3, 20)), (7, "a " + COMMON), (7, text(3, 20)),
            (0, text(4, 20)), (8, COMMON), (9, None), (None, None), (None, "")]
    frame = spark.createDataFrame([(*r, None, None, None, *CLASHING) for r in data], COLUMNS).repartition(3)
    got = decontam.keep_clean(frame, bench, block_words=block_words)
    assert got.columns == frame.columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter(r for r in data if COMMON not in (r[1] or ""))
    assert decontam.keep_clean(none, bench, block_words=block_words).count() == 0


def test_blocks_hold_every_window_once(spark):
    """Spark makes the windows; blocks of at most so many words (16 bytes each at least) share them out."""
    items = [(1, text(1, 300)), (1, text(1, 300)), (2, text(1, 300)), (None, COMMON), (3, "long" * 40 + " words"), (4, None), (5, " ")]
    bench = spark.createDataFrame(items, "item_id long, text string").repartition(3)
    pattern = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    want = set()
    for i, t in items:
        w = pattern.findall((t or "").lower())
        m = min(13, len(w))
        want |= {(m, " ".join(w[k:k + m]).encode(), None if i is None else str(i)) for k in range(len(w) - m + 1 if m else 0)}
    blocks = [[tuple(r.values()) for r in b.to_pylist()] for b in decontam.blocks_of(bench, 13, 1000)]
    assert Counter(r for b in blocks for r in b) == Counter(want)
    assert len(blocks) > 1 and all(sum(max(m, -(-len(w) // 16)) for m, w, _ in b) <= 1000 for b in blocks)


def test_mixing(docs, none):
    got = mixing.positions(docs).collect()
    assert Counter((r.doc_id, r["size"]) for r in got) == Counter((r[0], len(words(r[1]))) for r in rows())
    assert all(0 <= r.taken <= 2 * r["size"] for r in got)
    by = {}
    for r in got:
        by.setdefault((r.source_size, r.target), []).append(r.taken)
    assert all(abs(sum(v) - t) < 1 for (_, t), v in by.items())
    assert abs(sum(t for _, t in by) - 1.5 * sum(r["size"] for r in got)) < 1e-6
    again = mixing.positions(docs.repartition(5)).collect()
    assert Counter((r.doc_id, r.taken, tuple(r.positions)) for r in got) == Counter((r.doc_id, r.taken, tuple(r.positions)) for r in again)
    mixed = mixing.mix(docs)
    assert {tuple(r) for r in mixed.select(*EXTRA).collect()} == {CLASHING}
    assert mixed.columns == docs.columns and mixed.count() == sum(len(r.positions) for r in got)
    assert mixing.positions(none).count() == 0


def test_adaptive_rules(docs, none):
    want = Counter()
    for r in rows():
        t = r[1] or ""
        w = words(t)
        c = Counter(zip(w, w[1:], w[2:]))
        cover = {k + j for k in range(len(w) - 2) if c[tuple(w[k:k + 3])] > 1 for j in range(3)}
        lines = [x for x in t.split("\n") if words(x)]
        failed = len(w) < 50 or 100 * len(cover) > 50 * len(w)
        want[(r[0], len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", t)), len(lines) - len(set(lines)), len(cover), failed)] += 1
    got = adaptive.judge(docs).collect()
    assert Counter(tuple(r)[:7] for r in got) == want
    assert not any(r.kept and r.base_failed for r in got) and any(r.kept for r in got)
    assert adaptive.judge(none).count() == 0


def test_adaptive_limits_come_from_the_sketch(spark):
    """Two sources of one language with rates of their own get limits of their own, also below the
    fixed cutoffs; a small one takes those of its language, and a source of junk alone keeps its rows."""
    def doc(seed, symbols, lines):
        w = [f"w{seed}x{i}" for i in range(100)]
        return " ".join(w[:60]) + " " + "#" * symbols + "".join(f"\n{x}" for x in w[60:80] + w[60:60 + lines])
    data = [(i, doc(i, 0, 0), "en", "plain") for i in range(300)]
    data += [(1000 + i, doc(i, 20 + i % 20, i % 10), "en", "code") for i in range(300)]
    data += [(2000, doc(2000, 8, 0), "en", "plain"), (2001, doc(2001, 30, 5), "en", "code"), (2002, doc(2002, 0, 0), "en", "rare"),
             (2003, "be " * 60, "en", "junk")]
    frame = spark.createDataFrame(data, "doc_id long, text string, lang string, source string").repartition(3)
    got = {r.doc_id: r for r in adaptive.judge(frame).collect()}
    assert len(got) == len(data)
    chars = lambda i: got[i].n_symbols / got[i].word_chars
    assert 0.01 < chars(2000) < 0.1 and not got[2000].kept and not got[2003].kept
    assert all(got[i].kept for i in [2001, 2002, *range(300), *range(1000, 1300)])
    rates = sorted(chars(i) for i in [*range(1000, 1300), 2001])
    lo, hi = rates[len(rates) // 2], rates[len(rates) * 3 // 4]
    assert got[2000].symbol_rate_limit == 0.01
    assert hi <= got[2001].symbol_rate_limit <= 1.1 * hi + 6 * (1.1 * hi - lo)
    tail = sorted(got[i].n_dup_lines / (got[i].n_dup_lines + 21) for i in [*range(1000, 1300), 2001])
    assert tail[298] <= got[2001].dup_line_rate_limit <= 1.1 * tail[298] + 2 * (1.1 * tail[298] - tail[270] / 1.1)
    # no upper quantile of its own: that of the language
    assert got[2000].dup_line_rate_limit == got[2002].dup_line_rate_limit < tail[-1] + 2 * tail[-1]
    assert 0.01 < got[2000].repeat_rate_limit == got[2002].repeat_rate_limit < 0.4


@pytest.mark.parametrize("long_text", [10, 1 << 16])
def test_repeated_words_are_confirmed(docs, monkeypatch, long_text):
    """Both forms of the sort count right, and windows of equal hash but other words are no repeat."""
    monkeypatch.setattr(adaptive, "LONG_TEXT", long_text, raising=False)
    test_adaptive_rules(docs, docs.limit(0))
    apart = docs.sparkSession.createDataFrame([(1, " ".join(f"w{i}" for i in range(99)), "en", "a")], "doc_id long, text string, lang string, source string")
    monkeypatch.setattr(adaptive.F, "xxhash64", lambda *words: adaptive.F.length(words[0]).cast("long") * 0)
    assert [r.n_repeat_words for r in adaptive.document_rates(apart).collect()] == [0]


def test_line_templates(spark, docs, none):
    extra = [(1000 + i, f"user {i} logged in from host\nunique {text(500 + i, 9)}", "en", "a", None, *CLASHING) for i in range(12)]
    both = docs.unionByName(spark.createDataFrame(extra, COLUMNS))
    got = {r.doc_id: r for r in line_templates.drop_recurring_lines(both).collect()}
    for r in extra:
        assert (got[r[0]].n_lines, got[r[0]].n_dropped, got[r[0]].kept_text) == (2, 1, r[1].split("\n")[1])
    assert got[105].kept_text == "one" and got[102].n_lines == 0 and got[3].n_dropped == 0
    assert line_templates.drop_recurring_lines(none).count() == 0


def test_line_templates_count_documents(spark):
    """One document with many lines of a template is one document; repeated rows count each."""
    words = ["red", "blue", "green", "black", "white", "brown", "pink", "grey", "gold", "teal", "lime", "navy"]
    alone = "\n".join(f"disk check ended well on unit {w} at last" for w in words)
    shared = [(100 + i, f"fan check ended well on unit {w} at last") for i, w in enumerate(words[:10])]
    # one text of two like lines as nine rows of one id, and nine rows without id: 18 documents
    twice = "\n".join(f"belt check ended well on unit {w} at last" for w in words[:2])
    few = "\n".join(f"pump check ended well on unit {w} at last" for w in words[:2])
    data = [(1, alone), *shared, *[(2, twice)] * 9, *[(None, f"{twice}\n{i}x") for i in range(9)], *[(3, few)] * 4, (4, few)]
    frame = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    got = line_templates.drop_recurring_lines(frame).collect()
    want = Counter({(1, 12, 0): 1, (2, 2, 2): 9, (None, 3, 2): 9, (3, 2, 0): 4, (4, 2, 0): 1})
    want.update((i, 1, 1) for i, _ in shared)
    assert Counter((r.doc_id, r.n_lines, r.n_dropped) for r in got) == want
    assert {r.kept_text for r in got if r.doc_id == 1} == {alone}


def test_long_lines_recur_in_fewer_documents(spark):
    """The fewer words a line has the more documents it needs; its first document keeps it."""
    line = lambda seed, n: " ".join(f"{w}{'abcdefgh'[i % 8]}" for i, w in enumerate((["kappa", "sigma", "omega", "theta"] * n)[:n])) + f" {'xyz'[seed]}"
    long, middle, short = line(0, 59), line(1, 19), line(2, 6)
    data = [(5, f"{long}\nhead five"), (4, f"tail four\n{long}"), (None, long), *[(10 + i, f"{middle}\nrow {'abcde'[i]}") for i in range(5)],
            *[(20 + i, middle[2:]) for i in range(4)], *[(30 + i, short) for i in range(9)], (50, f"{long} other\n{long} other")]
    frame = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    got = Counter((r.doc_id, r.kept_text) for r in line_templates.drop_recurring_lines(frame).collect())
    want = dict(data) | {5: "head five", None: ""} | {10 + i: f"row {'abcde'[i]}" for i in range(1, 5)}
    assert got == Counter(want.items())


def test_quality(spark, docs, none):
    good = [(i, text(i, 80), 1) for i in range(300)]
    bad = [(1000 + i, " ".join(f"{w.upper()}!!" for w in text(i, 80).split()), 0) for i in range(100)]
    frame = spark.createDataFrame(good + bad, "doc_id long, text string, quality int")
    model = quality.fit(frame, frame)
    got = {r.doc_id: r for r in quality.score(frame, model).collect()}
    held = [(d, q) for d, _, q in good + bad if got[d].held_out]
    assert all(got[d].held_out == (zlib.crc32(str(d).encode()) % 4 == 2) for d in got)
    assert sum(got[d].predicted == q for d, q in held) >= 0.95 * len(held)
    assert quality.score(docs, model).count() == len(rows()) and quality.score(none, model).count() == 0
    alone = quality.fit(frame.limit(0), frame)
    assert {r.predicted for r in quality.score(docs, alone).collect()} == {1}
    assert quality.keep_good(docs, model).columns == docs.columns


def test_language_excerpts_come_from_whole_texts(spark):
    """Bounded pieces from all over the texts, the same in every run; short texts whole, null stays null."""
    texts = ["".join(chr(0x4E00 + (7 * s + i) % 5000) for i in range(5000)) for s in range(200)] + ["short é", "", None]
    frame = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    take = lambda n: {r[0]: r[1] for r in frame.repartition(n).select("i", langid.excerpt(langid.F.col("text"))).collect()}
    got = take(3)
    assert got == take(5) and [got[200 + k] for k in range(3)] == ["short é", "", None]
    assert all(len(got[i]) == langid.EXCERPT and got[i] in texts[i] for i in range(200))
    at = sorted(texts[i].index(got[i]) for i in range(200))
    assert at[20] < 1000 and at[-20] > 3600 and at[0] >= 0 and at[-1] <= 4600


def test_language(spark, docs, none):
    r = np.random.default_rng(1)
    say = {"aa": "lorem ipsum dolor amet".split(), "bb": "zwrk qpxh vvtk jjzq".split()}
    data = [(i, " ".join(r.choice(say[k], 20)), k) for i, k in enumerate(["aa", "bb"] * 150)]
    frame = spark.createDataFrame(data, "doc_id long, text string, lang string")
    net = langid.fit(frame)
    got = {x.doc_id: x for x in langid.predict(frame, net).collect()}
    held = [(d, k) for d, _, k in data if got[d].held_out]
    assert sum(got[d].lang_pred == k for d, k in held) >= 0.95 * len(held)
    odd = {x.doc_id: x.lang_pred for x in langid.predict(docs, net).collect()}
    assert odd[102] == odd[103] == odd[104] == odd[111] == "und" and odd[105] != "und"
    assert langid.predict(none, net).count() == 0 and langid.fit(none) is None
    assert {x.lang_pred for x in langid.predict(docs, None).collect()} == {"und"}
