"""Conversation repair against brute force: every edit string of small conversations, nulls, ties, spills."""
import hashlib
import re
import zlib
from functools import lru_cache

import numpy as np
import pytest

from lakeshift.llm import conversations as C

FULL = re.compile("s?(ua)+|")
INK = re.compile("[^\x20\x09-\x0d]")
COLUMNS = "conv_id long, turn long, role string, text string, _conv string, seq int, moves string"
CLASH = ("x", 1, "y")


def faults(rows):
    seen, out = set(), []
    for role, text in rows:
        ink = INK.findall(text)
        out.append("blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else "")
        seen.add((role, text))
    return out


def cheapest(rows):
    """(cost, audit, repaired) by trying every edit, least cost, then least audit."""
    fault, n = faults(rows), len(rows)
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}

    @lru_cache(None)
    def best(i, last, inserts):
        found = []
        if i == n and last in ("", "a"):
            found.append((0, "", ()))
        if inserts < 3:
            for role in ("user", "assistant"):
                if (last, role[0]) in after:
                    c, a, r = best(i, role[0], inserts + 1)
                    found.append((c + 3, "I" + a, (f"{role}:", *r)))
        if i < n:
            role, text = rows[i]
            c, a, r = best(i + 1, last, 0)
            found.append((c + 4, "D" + a, r))
            if fault[i] not in ("blank", "duplicate"):
                extra = 3 * (fault[i] == "truncated")
                if (last, role[:1]) in after:
                    c, a, r = best(i + 1, role[:1], 0)
                    found.append((c + extra, "K" + a, (f"{role}:{text}", *r)))
                for to in ("user", "assistant"):
                    if (last, to[0]) in after:
                        c, a, r = best(i + 1, to[0], 0)
                        found.append((c + extra + 3, "R" + a, (f"{to}:{text}", *r)))
        return min(found, default=(10**9, "", ()))

    return best(0, "", 0)


def wanted(rows):
    """Result of one conversation of (turn, role, text) rows in order, nulls replaced but for turns."""
    pairs = [(r, t) for _, r, t in rows]
    f = faults(pairs)
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[:1] for r, _ in pairs]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    cost, audit, repaired = cheapest(tuple(pairs))
    return (gaps, f.count("blank"), f.count("duplicate"), f.count("truncated"), illegal, cost, audit,
            hashlib.sha256("\n".join(repaired).encode()).hexdigest()), repaired


def table():
    r = np.random.default_rng(3)
    out = []
    for conv in range(150):
        for turn in range(int(r.integers(1, 9))):
            if r.random() < 0.1:
                continue
            role = str(r.choice(["system", "user", "assistant", "assistant", "user", "tool", "", "sys"]))
            text = str(r.choice(["Yes.", "no", "Why?", " ", "", "long text that ends!  \n", "x.", "same. \t", "It is " + str(turn) + "."]))
            out.append((conv, turn * int(r.integers(1, 3)), role, text))
    out += [(1000, None, "user", "a."), (1000, None, None, "a."), (1000, 1, "assistant", None), (1000, 1 << 62, "user", "z"),
            (None, 0, "user", "q?"), (None, 1, "assistant", "a."), (1001, None, "user", "b."), (1002, 3, None, None),
            (1003, 1, "user", "twice."), (1003, 1, "user", "twice."), (1003, 2, "assistant", "ok."),
            (1004, -(1 << 63), "user", "a."), (1004, (1 << 63) - 1, "assistant", "b.")]
    return out


def in_order(rows):
    """Rows of one conversation in the operator's order, nulls filled."""
    fill = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    return sorted(fill, key=lambda x: (x[0] is not None, x[0] or 0, x[1], hashlib.md5(x[2].encode()).digest()))


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(*r, *CLASH) for r in table()], COLUMNS).repartition(4)


@pytest.mark.parametrize("block", [1 << 16, 2, 3])
def test_repair(frame, monkeypatch, block):
    """Whole conversations and such whose backpointers are spilled every few rows."""
    monkeypatch.setattr(C, "BLOCK_ROWS", block)
    by = {}
    for conv, *row in table():
        by.setdefault(conv, []).append(tuple(row))
    want = {}
    for conv, rows in by.items():
        result, _ = wanted(in_order(rows))
        want[conv] = (min(result[0], (1 << 63) - 1), *result[1:])
    if block != 1 << 16:  # workers do not see the patch: run the streams here
        import pandas as pd
        slim = C._placed(frame)
        rows = [tuple(r) for r in slim.collect()]
        rows.sort(key=lambda r: r[:4] + (bytes(r[4]),))
        first = {}
        for r in rows:
            first.setdefault((r[0], r[3], bytes(r[4])), r[1:3])
        falling = []
        for r in sorted(rows, key=lambda r: (r[1], r[2], r[3], bytes(r[4])), reverse=True):
            fault = C.DUPLICATE if r[5] != C.BLANK and r[1:3] > first[r[0], r[3], bytes(r[4])] else r[5]
            falling.append((*r[:4], bytes(r[4]), fault))
        falling.sort(key=lambda r: r[0])
        cut = lambda rows, names: iter([pd.DataFrame(rows[k:k + 7], columns=names) for k in range(0, len(rows), 7)])
        blocks = [tuple(x) for f in C.cost_frames(cut(falling, [*C.ORDER, "fault"])) for x in f.itertuples(index=False)]
        assert len(blocks) > len(want)
        both = [(*r[:4], bytes(r[4]), None, r[6], None, None) for r in rows] + [(*b[:5], b[5], None, b[6], b[7]) for b in blocks]
        both.sort(key=lambda r: (*r[:5], r[5] is None, -(r[5] or 0)))
        out = C.repair_frames(cut(both, [*C.ORDER, "seq", "text", "moves", "counts"]), False)
        got = {(int(x[0][1:]) if x[0] else None): tuple(x[1:]) for f in out for x in f.itertuples(index=False)}
    else:
        got = {r.conv_id: tuple(r)[1:] for r in C.repair(frame).collect()}
    assert got == want


def test_repaired_turns(frame):
    by = {}
    for conv, *row in table():
        by.setdefault(conv, []).append(tuple(row))
    got = {}
    for r in sorted(C.repaired_turns(frame).collect(), key=lambda r: r.place):
        got.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    for conv, rows in by.items():
        assert tuple(got.get(conv, ())) == wanted(in_order(rows))[1]
        assert FULL.fullmatch("".join(x[0] for x in got.get(conv, ())))


def test_damage_and_lost_conversations(spark, frame):
    """The registered query's damage, a row for every conversation, and the empty table."""
    by = {conv: [] for conv, *_ in table()}
    show = lambda x: " " if x is None else str(x)
    for conv, turn, role, text in table():
        k = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        text, role = show(text), show(role)
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        by[conv] += [(turn, "user" if k == 4 else role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    got = {r.conv_id: tuple(r)[1:] for r in C.repair_report(frame, C.damaged(frame)).collect()}
    want = {}
    for conv, rows in by.items():
        result, _ = wanted(in_order(rows))
        want[conv] = (min(result[0], (1 << 63) - 1), *result[1:])
    assert got == want and any(not rows for rows in by.values())
    none = spark.createDataFrame([], COLUMNS)
    assert C.repair_report(none, C.damaged(none)).count() == C.repaired_turns(none).count() == 0
