"""Token counts by a compiled finite-state transducer (operator 9).

Two deterministic transducers replace the tokenizer:

1. *Splitter* over character classes. Its few states recognise the pre-token starts of the
   byte-level BPE pattern; look-ahead is a delayed output ("the previous character was a
   start"). A batch of texts is cut into equal chunks; every chunk is run from all states at
   once, giving its **state map** (start state -> end state); the maps are composed by a
   **parallel prefix scan** (log-step doubling), which gives each chunk its true start state,
   and a second run emits the starts. Chunks whose lanes have met go on in one lane.
2. *Counter* over bytes. A state stands for all pre-token prefixes that no continuation can
   tell apart: the suffixes that still begin vocabulary entries, each with the relative token
   count before it and the class of the last token there (what it bars from following). Every transition is annotated with
   the change of the token count it emits. States and transitions are compiled on first use
   from the vocabulary (the tokenizer's own model names the tokens of one representative)
   and kept per worker up to ``MAX_STATES``; beyond it the table is compiled afresh, which
   changes no count. A pre-token start resets the state, so a chunk's map is constant behind
   its first start; lanes are cut there and need no further composition.

Only vocabulary facts are compiled in: for rank-merged BPE the tokens of a prefix, cut after
any token, are again the tokens of that shorter prefix, so the last token of each prefix
determines the count.

Defined results: null or empty text has 0 bytes and 0 tokens; the special string
``<|endoftext|>`` inside a text counts as one token and splits it, as the library does by
default; texts of any length are counted whole; rows repeat as they come; extra columns of
the input do not pass to the result.
"""
from __future__ import annotations

import json
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.llm.shared import load, with_workers
from lakeshift.llm.textkit import WIDE_SLICE, slices

TOKENIZER = "byte_bpe_50k.json"
LIMIT = 512
MAX_STATES = 110_000

#: The one special string of the vocabulary.
SPECIAL = "<|endoftext|>"

# character classes: END parts texts; STMD, RV, E_, L_ are the letters of the contractions
LETTER, NUMBER, BLANK, WHITE, OTHER, APOS, END, STMD, RV, E_, L_ = range(11)
CLASSES = 16
(BEGIN, IN_L, IN_N, IN_O, ONE_BLANK, ONE_WHITE, RUN_BLANK, RUN_WHITE, Q, Q_RV, Q_L, Q_DONE) = range(12)
STATES = 12
HERE, BEFORE = 1, 2


def _splitter() -> tuple[np.ndarray, np.ndarray]:
    """next[state * 16 + class], out[state * 16 + class] (HERE / BEFORE: a pre-token starts there)."""
    nxt = np.zeros(STATES * CLASSES, np.uint8)
    out = np.zeros(STATES * CLASSES, np.uint8)
    letters = (LETTER, STMD, RV, E_, L_)
    for s in range(STATES):
        for c in range(CLASSES):
            kind = "l" if c in letters else {NUMBER: "n", OTHER: "o", APOS: "o", BLANK: "b", WHITE: "w"}.get(c, "end")
            late = BEFORE if s in (Q_RV, Q_L) else 0  # "'r" that is no contraction: its letter starts a word
            if s == Q_RV and c == E_ or s == Q_L and c == L_:
                to, o = Q_DONE, 0
            elif s == Q and c == STMD:
                to, o = Q_DONE, 0
            elif s == Q and c == RV:
                to, o = Q_RV, 0
            elif s == Q and c == L_:
                to, o = Q_L, 0
            elif kind == "end":
                to, o = BEGIN, late
            elif kind in "bw":
                inside = s in (ONE_BLANK, ONE_WHITE, RUN_BLANK, RUN_WHITE)
                one, run = (ONE_BLANK, RUN_BLANK) if kind == "b" else (ONE_WHITE, RUN_WHITE)
                to, o = (run, 0) if inside else (one, HERE | late)
            else:
                same = {"l": s in (IN_L, Q_RV, Q_L), "n": s == IN_N, "o": s in (IN_O, Q)}[kind]
                to = {"l": IN_L, "n": IN_N, "o": IN_O}[kind]
                if same:
                    o = late
                elif s == ONE_BLANK:
                    o = 0  # the blank has started it
                elif s == RUN_BLANK:
                    o = BEFORE
                elif s == RUN_WHITE:
                    o = BEFORE | HERE
                else:
                    o = HERE | late
                if c == APOS and o & HERE:
                    to = Q  # an apostrophe that starts a pre-token may be a contraction
            nxt[s * CLASSES + c], out[s * CLASSES + c] = to, o
    return nxt, out


NEXT, OUT = _splitter()
_classes: dict[str, np.ndarray] = {}


def class_table() -> np.ndarray:
    """Class of every code point, by the Unicode properties that the splitting pattern names."""
    if "t" not in _classes:
        t = np.full(0x110000, OTHER, np.uint8)
        text = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
        place = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        for pattern, c in ((r"\p{L}", LETTER), (r"\p{N}", NUMBER), (r"\p{White_Space}", WHITE)):
            t[place[[m.start() for m in regex.finditer(pattern, text)]]] = c
        t[0x20] = BLANK
        t[ord("'")] = APOS
        for ch in "stmd":
            t[ord(ch)] = STMD
        for ch in "rv":
            t[ord(ch)] = RV
        t[ord("e")], t[ord("l")] = E_, L_
        _classes["t"] = t
    return _classes["t"]


CHUNK = 512


def starts(classes: np.ndarray) -> np.ndarray:
    """Flags of pre-token starts for a run of texts, each closed by END."""
    n = len(classes)
    lanes = -(-n // CHUNK)
    grid = np.full(lanes * CHUNK, END, np.uint8)
    grid[:n] = classes
    grid = np.ascontiguousarray(grid.reshape(lanes, CHUNK).T)
    # state maps of all chunks: lane s of chunk k is the state reached from s
    maps = np.repeat(np.arange(STATES, dtype=np.uint8)[:, None], lanes, 1)
    for i in range(CHUNK):
        maps = NEXT[(maps << 4) | grid[i]]
        if maps.shape[0] > 1 and i % 8 == 7 and (maps == maps[:1]).all():
            maps = maps[:1]  # all start states have met
    if maps.shape[0] == 1:
        maps = np.repeat(maps, STATES, 0)
    # inclusive prefix scan by composition: maps[k] := maps[k] after maps[k - step]
    step = 1
    while step < lanes:
        if (maps == maps[:1]).all():
            break  # constant maps: composing changes nothing
        maps[:, step:] = np.take_along_axis(maps[:, step:], maps[:, :-step].astype(np.intp), 0)
        step *= 2
    state = np.empty(lanes, np.uint8)
    state[0] = BEGIN
    state[1:] = maps[BEGIN, :-1]
    found = np.empty((CHUNK, lanes), np.uint8)
    for i in range(CHUNK):
        at = (state << 4) | grid[i]
        found[i] = OUT[at]
        state = NEXT[at]
    found = np.ascontiguousarray(found.T).reshape(-1)[:n]
    flags = (found & HERE).astype(bool)
    flags[:-1] |= (found[1:] & BEFORE).astype(bool)
    return flags


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    out = [""] * 256
    for b in shown:
        out[b] = chr(b)
    for k, b in enumerate(hidden):
        out[b] = chr(256 + k)
    return out


class Counter:
    """The token-counting transducer over bytes; compiled on first use."""

    def __init__(self, tokenizer) -> None:
        self._model = tokenizer.model
        self._chars = byte_alphabet()
        spec = json.loads(tokenizer.to_str())["model"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in spec["merges"]]
        self._prefixes = {w[:k] for w in spec["vocab"] for k in range(1, len(w) + 1)}
        self._token = {i: w for w, i in spec["vocab"].items()}
        self._rank = {m: r for r, m in enumerate(merges)}
        self._made = {a + b: (b, r) for r, (a, b) in enumerate(merges)}
        self._ranks_of: dict[str, list[int]] = {}
        self._rights_of: dict[str, list[str]] = {}
        for r, (a, b) in enumerate(merges):
            self._ranks_of.setdefault(a, []).append(r)
            self._rights_of.setdefault(a, []).append(b)
        for rights in self._rights_of.values():
            rights.sort()
        self._reset()

    def _reset(self) -> None:
        self._keys: dict[tuple, int] = {}
        self._info: list[tuple[str, tuple[int, ...], tuple[int, ...], tuple[int, ...]]] = []
        self._bars: dict[tuple, int] = {}
        self._bar_ids: dict[tuple, int] = {}
        self.table = np.full((1024, 256), -1, np.int32)  # next state << 8 | emitted count + 128
        self._state("", (), (0,), (-1,))

    def _bar(self, last: int, suffix: str) -> int:
        """Class of last tokens that bar the same entries beginning with ``suffix`` from following.

        An entry t cannot follow when a merge (b, x) across the border comes before the merge
        that consumes b on the left; b runs over the right edges of the last token's merges and
        x over the left edges of t, so x begins or extends ``suffix``.
        """
        have = self._bars.get((last, suffix))
        if have is None:
            b, taken, bars = self._token.get(last), len(self._rank), []
            while b is not None:
                if not suffix:
                    if n := bisect_left(self._ranks_of.get(b, ()), taken):
                        bars.append((b, n))
                else:
                    rights = self._rights_of.get(b, ())
                    lo = bisect_left(rights, suffix)
                    hi = bisect_left(rights, suffix + "\U0010ffff")
                    for x in (*(suffix[:k] for k in range(1, len(suffix))), *rights[lo:hi]):
                        if (r := self._rank.get((b, x), taken)) < taken:
                            bars.append((x, r))
                b, taken = self._made.get(b, (None, 0))
            have = self._bar_ids.setdefault(tuple(sorted(bars)), len(self._bar_ids))
            self._bars[last, suffix] = have
        return have

    def _state(self, word: str, suffixes: tuple[int, ...], counts: tuple[int, ...], last: tuple[int, ...]) -> int:
        """suffixes: lengths of the suffixes of ``word`` that begin vocabulary entries, longest first.
        counts/last: token count and last token of the prefixes of ``word``, the whole word at the end."""
        base, n = counts[-1], len(word)
        key = (word[n - suffixes[0]:] if suffixes else "", self._bar(last[-1], ""),
               *((self._bar(last[-1 - k], word[n - k:]), counts[-1 - k] - base) for k in suffixes))
        have = self._keys.get(key)
        if have is None:
            have = self._keys[key] = len(self._info)
            reach = (suffixes[0] if suffixes else 0) + 1
            self._info.append((word, suffixes, counts[-reach:], last[-reach:]))
            if have >= len(self.table):
                self.table = np.concatenate([self.table, np.full((8192, 256), -1, np.int32)])
        return have

    def compile(self, state: int, byte: int) -> int:
        """Make the transition of ``state`` over ``byte``; returns its entry."""
        word, suffixes, counts, last = self._info[state]
        char = self._chars[byte]
        longer = word + char
        tokens = self._model.tokenize(longer)
        new = tuple(k + 1 for k in (*suffixes, 0) if longer[len(longer) - k - 1:] in self._prefixes)
        emitted = len(tokens) - counts[-1]
        to = self._state(longer, new, (*counts, len(tokens)), (*last, tokens[-1].id))
        self.table[state, byte] = entry = to << 8 | (emitted + 128)
        return entry

    def count(self, buf: np.ndarray, begins: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Token counts of lanes of about CHUNK bytes: (first byte of each lane, tokens in it).

        begins: positions of the pre-token starts; texts: those that begin a text, where
        lanes are cut in any case.
        """
        if len(self._info) > MAX_STATES:
            self._reset()
        n = len(buf)
        even = begins[np.searchsorted(begins, np.arange(0, n, CHUNK), "right") - 1]
        cuts = np.unique(np.concatenate([even, texts]))
        ends = np.append(cuts[1:], n)
        order = np.argsort(cuts - ends, kind="stable")  # longest lanes first: the active ones stay a prefix
        at, width = cuts[order], (ends - cuts)[order]
        flag = np.zeros(n, bool)
        flag[begins] = True
        state = np.zeros(len(at), np.int32)
        total = np.zeros(len(at), np.int64)
        active = len(at)
        alive = np.searchsorted(-width, -np.arange(1, int(width[0]) + 1), "right")  # lanes of at least that width
        for step in range(int(width[0])):
            active = int(alive[step])
            p = at[:active] + step
            sym = buf[p]
            s = np.where(flag[p], 0, state[:active])
            entry = self.table[s, sym]
            if (entry < 0).any():
                miss = np.flatnonzero(entry < 0)
                for k in np.unique(s[miss].astype(np.int64) << 9 | sym[miss]):
                    self.compile(int(k >> 9), int(k & 511))
                entry = self.table[s, sym]
            state[:active] = entry >> 8
            total[:active] += (entry & 255) - 128
        out = np.empty(len(at), np.int64)
        out[order] = total
        return cuts, out


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    if path not in _counters:
        from tokenizers import Tokenizer
        _counters[path] = Counter(Tokenizer.from_file(path))
    return _counters[path]


def pre_tokens(parts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(UTF-8 bytes of all non-empty parts, byte positions of pre-token starts, first byte of each part)."""
    code = np.frombuffer(("\x00".join(parts) + "\x00").encode("utf-32-le"), np.uint32)
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    closing = np.cumsum(sizes + 1) - 1
    classes = class_table()[code]
    classes[closing] = END
    flags = starts(classes)
    keep = np.ones(len(code), bool)
    keep[closing] = False
    flags, code = flags[keep], code[keep]
    width = 1 + (code > 0x7F) + (code > 0x7FF) + (code > 0xFFFF).astype(np.int64)
    place = np.cumsum(width) - width
    buf = np.frombuffer("".join(parts).encode(), np.uint8)
    return buf, place[flags], place[np.cumsum(sizes) - sizes]


def cut_special(texts: list[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(non-empty parts between special strings, row of each part, special strings of each row)."""
    parts, owner, special = [], [], np.zeros(len(texts), np.int64)
    for i, t in enumerate(texts):
        pieces = t.split(SPECIAL) if SPECIAL in t else (t,)
        special[i] = len(pieces) - 1
        for p in pieces:
            if p:
                parts.append(p)
                owner.append(i)
    return parts, np.array(owner, np.int64), special


def count_texts(texts: list[str], path: str) -> np.ndarray:
    """Tokens of each text."""
    parts, owner, total = cut_special(texts)
    if not parts:
        return total
    buf, begins, text_at = pre_tokens(parts)
    cuts, counts = counter(path).count(buf, begins, text_at)
    of = np.searchsorted(text_at, cuts, "right") - 1
    return total + np.bincount(owner[of], counts, len(texts)).astype(np.int64)


def token_counts(batches: Iterator[pa.RecordBatch], path: str, limit: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, text) batches -> (doc_id, n_bytes, n_tokens, over_limit), a bounded slice at a time."""
    for batch in batches:
        ids, text = batch.column(0), batch.column(1)
        for first, buf, offsets in slices(text, WIDE_SLICE):
            rows = len(offsets) - 1
            data = buf.tobytes()
            texts = [data[a:b].decode() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
            n = count_texts(texts, path)
            yield pa.RecordBatch.from_arrays(
                [ids.slice(first, rows), pa.array(np.diff(offsets)), pa.array(n), pa.array(n > limit)],
                ["doc_id", "n_bytes", "n_tokens", "over_limit"])


def count_tokens(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """doc_id, n_bytes, n_tokens and over_limit of each row of ``docs`` (doc_id, text). No shuffle."""
    with_workers(docs.sparkSession)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(
        lambda batches: token_counts(batches, path, limit),
        "doc_id long, n_bytes long, n_tokens long, over_limit boolean")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return count_tokens(load(spark, sf_dir, "documents"), public_tokenizers.path(TOKENIZER))
