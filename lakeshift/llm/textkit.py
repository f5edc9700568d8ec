"""Vectorised word handling over the raw UTF-8 bytes of many texts at once.

Everything works on one contiguous byte buffer holding several documents, so the cost
per word is a handful of numpy passes instead of Python calls. Slices hold a bounded
number of bytes (``SLICE_BYTES``, or one document when it is longer), which bounds the
memory of a Python worker whatever the batch holds. Operators that move all documents of a slice
in lockstep take ``WIDE_SLICE``.
"""
from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES, WIDE_SLICE = 1 << 18, 1 << 21

#: The ASCII white space that separates words, \x20 and \x09-\x0D.
WHITE_SPACE = b"\t\n\x0b\x0c\r "

_SPACE = np.zeros(256, bool)
_SPACE[list(WHITE_SPACE)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_ALNUM = np.zeros(256, bool)
for _lo, _hi in ((0x30, 0x3A), (0x61, 0x7B), (0x80, 0x100)):
    _ALNUM[_lo:_hi] = True

_ODD = np.uint64(0x9E3779B97F4A7C15)
_MIX1 = np.uint64(0xBF58476D1CE4E5B9)
_MIX2 = np.uint64(0x94D049BB133111EB)
#: The low bytes of a word of eight that belong to a span of so many bytes.
_LOW = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)
#: Longer spans are hashed one by one.
LONG_SPAN = 1 << 12


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads 64-bit values."""
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


def span_hashes(buf: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """64-bit hash of each span of bytes, eight bytes a step for all spans at once.

    Every step is a bijection of the state, so equal lengths of up to eight bytes never
    collide; other pairs do with odds of 2 ** -64, whatever the pattern of their bytes.
    """
    size = end - start
    h = mix(size.astype(np.uint64) * _ODD + np.uint64(seed))
    long = np.flatnonzero(size > LONG_SPAN)
    for i in long.tolist():
        digest = hashlib.blake2b(buf[start[i]:end[i]], digest_size=8, salt=struct.pack("<q", seed)).digest()
        h[i] = int.from_bytes(digest, "little")
    live = np.flatnonzero((size > 0) & (size <= LONG_SPAN)) if len(long) or not size.all() else np.arange(len(size))
    padded = np.concatenate([buf, np.zeros(8, np.uint8)])
    eights = np.lib.stride_tricks.as_strided(padded, (len(buf) + 1, 8), (1, 1))
    at, left = start[live], size[live]
    while len(live):
        block = eights[at].view(np.uint64).reshape(-1) & _LOW[np.minimum(left, 8)]
        h[live] = mix(h[live] ^ block)
        more = left > 8
        live, at, left = live[more], at[more] + 8, left[more] - 8
    return h


def slices(text: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of rows of at most ``limit`` bytes (one row may be longer).

    Null texts count as empty.
    """
    if text.null_count:
        text = text.fill_null("")
    text = text.cast(pa.large_string())
    n = len(text)
    if not n:
        return
    offsets = np.frombuffer(text.buffers()[1], np.int64)[text.offset:text.offset + n + 1]
    data = text.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    i = 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, "right")) - 1
        j = min(max(j, i + 1), n)
        lo, hi = int(offsets[i]), int(offsets[j])
        yield i, data[lo:hi], offsets[i:j + 1] - lo
        i = j


class Words:
    """Words of a slice: ``start``/``end`` byte positions, ``doc`` row, ``hash``; ``first[d]:first[d+1]`` are row d's."""

    def __init__(self, buf: np.ndarray, offsets: np.ndarray, kind: str = "space", lower: bool = False):
        self.rows = len(offsets) - 1
        if lower:
            buf = _LOWER[buf]
        self.buf = buf
        inside = ~_SPACE[buf] if kind == "space" else _ALNUM[buf]
        n = len(buf)
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.empty(n, bool)
        after = np.empty(n, bool)
        if n:
            before[0], after[-1] = False, False
            before[1:], after[:-1] = inside[:-1], inside[1:]
            before &= ~edge[:n]
            after &= ~edge[1:]
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.first = np.searchsorted(self.start, offsets)
        self._offsets = offsets

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), np.diff(self.first))

    def hashes(self) -> np.ndarray:
        """64-bit hash of each word; equal words have equal hashes wherever they stand."""
        return span_hashes(self.buf, self.start, self.end)


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """Order-dependent hash of every ``k`` consecutive items (length n-k+1, may cross documents)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.zeros(n, np.uint64)
    for i in range(k):
        total *= _ODD
        total += hashes[i:i + n]
    return mix(total)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive values, by doubling (length n-width+1)."""
    n = len(values) - width + 1
    if n <= 0:
        return values[:0]
    have, best = 1, values
    while have < width:
        step = min(have, width - have)
        best = np.minimum(best[:-step], best[step:])
        have += step
    return best[:n]
