"""Phrase collocation mining by SETM: sorted occurrence relations, extended length by length (operator 12).

Texts are lower-cased (A-Z), cut at punctuation and line ends into pieces and at blanks into words. The
relation R(k) holds the occurrences of k-word phrases in order of piece and position. It is
persisted in blocks of about ``BLOCK_WORDS`` positions of one language, each as one packed array of the
block's own phrase numbers (0: no phrase, or a border of pieces), beside a row per distinct phrase:

1. *Merge-join.* R(k+1) is R(k) joined with itself on piece and adjacent position. As the relation is
   sorted by both, that join is one pass over neighbours of a block's array: an occurrence of k + 1
   words is two frequent ones of k words, side by side.
2. *Group-count.* Equal extensions of a block are combined. They meet, packed, by a shuffle on buckets
   of pairs of k-word phrases, where the pairs themselves (never their hashes) are told apart and
   counted; that also names the phrase: its least place (block + number).
3. *Semi-join.* Only phrases of ``LEAST`` occurrences go back to the blocks that hold them; all others
   become 0 there, so nothing infrequent is ever extended.

Tables are deleted as soon as the next length is written. A phrase costs an entry per block that holds it, however often it stands there. Blocks are bounded: a long
text runs over several, which share their last words so that no adjacency is lost. So are buckets: their number grows with the words.

Candidates meet their parts by ordinary joins on phrase names; scores are exact integer quotients of
decimals. ``top`` per language is a row number that Spark limits before the shuffle.

Defined results: null and empty texts have no words; a null lang is ``und``; repeated rows count each;
no word is too long and no text; an empty table, or one without a candidate, gives no rows; extra
columns are ignored.
"""
from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshift.llm.shared import drop, load, stored, with_workers
from lakeshift.llm.textkit import mix, slices

#: Longest phrase, least occurrences, percent of a phrase's occurrences inside a longer one, rows per language.
LONGEST, LEAST, COVERED, TOP = 4, 30, 80, 2000
NO_LANG = "und"
#: Positions of a block, bytes of a long text read at once, bits of a block's own numbers.
BLOCK_WORDS, CHUNK_BYTES, BITS = 1 << 20, 1 << 18, 21
#: Words of the table for each bucket of pairs (a bucket is counted in memory), least number of buckets.
BUCKET_WORDS, LEAST_BUCKETS = 1 << 21, 256
SCALE = 2_000_000

_CUTS = b".,;:!?\n\x0b\x0c\r"
_PLAIN = bytes.maketrans(bytes(range(65, 91)) + _CUTS + b"\t", bytes(range(97, 123)) + b"." * len(_CUTS) + b" ")
_BETWEEN = re.compile(rb"[ .]")

#: ``at`` is block + number; the row of number 0 holds the block itself, those of pairs a bucket's from that number on.
#: Tables are written small: they are most of the disk.
WORD_ROWS = "at long, lang string, word string, n int, own int, packed binary"
PAIR_ROWS = "at long, bucket int, own int, packed binary"
COUNT_ROWS = "id long, g1 long, g2 long, f long, at long, packed binary"
SMALL = {"compression": "zstd"}
NUMBER = (1 << BITS) - 1


def pack(values: np.ndarray) -> bytes:
    """Integers as planes of equal bytes of all values, compressed: high bytes are mostly 0."""
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(values.view(np.uint8).reshape(-1, values.itemsize).T))


def unpack(data: pa.Scalar, kind: str) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(data.as_buffer()), np.uint8)
    return np.ascontiguousarray(planes.reshape(np.dtype(kind).itemsize, -1).T).view(kind).reshape(-1)


class Numbers(dict):
    """Words of a block by number from 1; 0 is a border of pieces."""

    def __init__(self) -> None:
        self[b"."] = 0

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self)
        return n


class Builder:
    """The block being filled for one language."""

    def __init__(self, lang: str) -> None:
        self.lang, self.numbers, self.parts, self.size = lang, Numbers(), [], 0

    def add(self, tokens: list[bytes]) -> None:
        self.parts.append(np.fromiter(map(self.numbers.__getitem__, tokens), np.int32, len(tokens)))
        self.size += len(tokens)

    def flush(self, block: int, inside: bool) -> pa.RecordBatch:
        """The block's rows. ``inside`` a text its last words are not its own: the next block starts with them."""
        places = np.concatenate(self.parts)
        own = max(len(places) - (LONGEST - 1), 0) if inside else len(places)
        words = list(self.numbers)
        n = np.bincount(places[:own], minlength=len(words)).astype(np.int32)
        tail = [words[i] for i in places[own:].tolist()]
        self.__init__(self.lang)
        if tail:
            self.add(tail)
        rows = len(words)  # row 0 is the block itself
        packed = pack(places.astype("<i4"))
        first = np.arange(rows) == 0
        return pa.RecordBatch.from_arrays([
            pa.array(block + np.arange(rows)), pa.array([self.lang] * rows, pa.string()),
            pa.array([None, *words[1:]], pa.binary()).cast(pa.string()), pa.array(np.where(first, own - n[0], n).astype(np.int32)),
            pa.array(np.full(rows, own, np.int32), mask=~first), pa.array([packed] + [None] * (rows - 1), pa.binary())],
            ["at", "lang", "word", "n", "own", "packed"])


def tokens_of(data: bytes) -> Iterator[list[bytes]]:
    """Words, and ``.`` between pieces, of one text in runs of bounded size."""
    data, at = data.translate(_PLAIN), 0
    while at < len(data):
        cut = _BETWEEN.search(data, at + CHUNK_BYTES)
        end = cut.start() if cut else len(data)
        yield data[at:end].replace(b".", b" . ").split()
        at = end


def word_batches(batches: Iterator[pa.RecordBatch], block_words: int) -> Iterator[pa.RecordBatch]:
    """(lang, text) -> R(1): blocks and their words."""
    part, n = TaskContext.get().partitionId(), 0
    builders: dict[str, Builder] = {}

    def flush(builder: Builder, inside: bool = False) -> pa.RecordBatch:
        nonlocal n
        n += 1
        return builder.flush((part << 20 | n - 1) << BITS, inside)

    for batch in batches:
        langs = batch.column(0).to_pylist()
        for first, buf, offsets in slices(batch.column(1)):
            data = buf.tobytes()
            for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
                lang = langs[first + k]
                builder = builders.get(lang) or builders.setdefault(lang, Builder(lang))
                for tokens in tokens_of(data[a:b]):
                    builder.add(tokens)
                    if builder.size >= block_words:
                        yield flush(builder, True)
                builder.add([b"."])
            if sum(x.size for x in builders.values()) >= 4 * block_words:
                yield from [flush(x) for x in builders.values()]
                builders.clear()
    yield from [flush(x) for x in builders.values()]


def places_of(found: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Number and id of the frequent phrases of a block, given one by one or packed by bucket."""
    if pa.types.is_struct(found.type):
        return found.field(0).to_numpy(), found.field(1).to_numpy()
    parts = [unpack(x, "<i8").reshape(2, -1) for x in found]
    return np.concatenate([x[0].cumsum() for x in parts]), np.concatenate([x[1] for x in parts])


def bucket_of(g1: np.ndarray, g2: np.ndarray, buckets: int) -> np.ndarray:
    """Equal pairs share a bucket."""
    mixed = mix(mix(g1.astype(np.uint64)) + g2.astype(np.uint64))
    return (mixed >> np.uint64(32)) * np.uint64(buckets) >> np.uint64(32)


def extend_batches(batches: Iterator[pa.RecordBatch], buckets: int) -> Iterator[pa.RecordBatch]:
    """(block, own, packed, its frequent phrases) of R(k) -> R(k+1) and its distinct phrases by bucket."""
    names = ["at", "bucket", "own", "packed"]
    for batch in batches:
        for block, own, packed, found in zip(*batch.columns):
            block, own = block.as_py(), own.as_py()
            numbers, ids = places_of(found.values)
            order = np.argsort(ids)
            ids, rank = ids[order], np.zeros(1 << BITS, np.int64)
            rank[numbers[order]] = np.arange(1, len(ids) + 1)
            places = rank[unpack(packed, "<i4")]
            at = np.flatnonzero((places[:-1] != 0) & (places[1:] != 0))  # the merge-join on adjacent positions
            if not len(at):
                continue
            pairs, which = np.unique(places[at] << BITS | places[at + 1], return_inverse=True)
            g1, g2 = ids[(pairs >> BITS) - 1], ids[(pairs & NUMBER) - 1]
            n = np.bincount(which[at < own], minlength=len(pairs))
            bucket = bucket_of(g1, g2, buckets)
            order = np.argsort(bucket, kind="stable")  # within a bucket pairs stand in order
            number = np.empty(len(pairs), "<i4")
            number[order] = np.arange(1, len(pairs) + 1)
            longer = np.zeros(len(places) - 1, "<i4")
            longer[at] = number[which]
            held, first = np.unique(bucket[order], return_index=True)
            rows = [pack(np.concatenate([np.diff(g1[x], prepend=0), g2[x], n[x]]).astype("<i8")) for x in np.split(order, first[1:])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(block + 1 + first), pa.array(held.astype(np.int32)), pa.nulls(len(rows), pa.int32()), pa.array(rows, pa.binary())], names)
            yield pa.RecordBatch.from_arrays(
                [pa.array([block]), pa.nulls(1, pa.int32()), pa.array([own], pa.int32()), pa.array([pack(longer)], pa.binary())], names)


def count_bucket(rows: pa.Table, least: int) -> pa.Table:
    """The distinct phrases of all blocks in one bucket -> a row per frequent one (id, g1, g2, f), and a row per block
    with the places and ids of those that it holds (at, packed)."""
    rows = rows.sort_by("at")
    parts = [unpack(x, "<i8").reshape(3, -1) for x in rows["packed"]]
    at = np.concatenate([first + np.arange(x.shape[1]) for first, x in zip(rows["at"].to_pylist(), parts)])
    g1, g2, n = np.concatenate([x[0].cumsum() for x in parts]), *(np.concatenate([x[k] for x in parts]) for k in (1, 2))
    del parts
    order = np.lexsort((g2, g1))  # stable: the least place of a phrase comes first
    at, g1, g2 = at[order], g1[order], g2[order]
    start = np.flatnonzero(np.concatenate([[True], (g1[1:] != g1[:-1]) | (g2[1:] != g2[:-1])]))
    f, size = np.add.reduceat(n[order], start), np.diff(start, append=len(at))
    kept = np.repeat(f >= least, size)
    f, ids, at, g1, g2 = (x[kept] for x in (np.repeat(f, size), np.repeat(at[start], size), at, g1, g2))
    one = ids == at
    phrases = pa.table([x[one] for x in (ids, g1, g2, f)], ["id", "g1", "g2", "f"])
    order = np.argsort(at)
    at, ids = at[order], ids[order]
    blocks, start = np.unique(at & ~NUMBER, return_index=True)
    places = [pack(np.concatenate([np.diff(at[a:b] & NUMBER, prepend=0), ids[a:b]])) for a, b in zip(start, [*start[1:], len(at)])]
    held = pa.table([pa.array(blocks), pa.array(places, pa.binary())], ["at", "packed"])
    return pa.concat_tables([phrases, held], promote_options="default")


def _is_block() -> Column:
    return F.col("own").isNotNull()


def _frequent_words(relation: DataFrame, least: int) -> DataFrame:
    """Group-count: where the blocks hold words of frequent groups, with the id of the group; its name and
    count f stand in the one row whose place is the id."""
    by = ["lang", "word"]
    group = Window.partitionBy(*by)
    rows = relation.filter(~_is_block()).select(*by, "at", "n")
    rows = rows.withColumn("f", F.sum("n").over(group)).withColumn("id", F.min("at").over(group)).filter(F.col("f") >= least)
    return stored(rows.select("at", "id", *(F.when(F.col("id") == F.col("at"), F.col(c)).alias(c) for c in (*by, "f"))), "frequent-1", **SMALL)


def _frequent(relation: DataFrame, least: int, name: str) -> DataFrame:
    """The same for phrases of several words, by their pair (g1, g2): a row per phrase, and the places by block and bucket."""
    rows = relation.filter(~_is_block()).select("bucket", "at", "packed").groupBy("bucket")
    return stored(rows.applyInArrow(lambda rows: count_bucket(rows, least), COUNT_ROWS), name, **SMALL)


def _words_back(frequent: DataFrame) -> DataFrame:
    """The frequent words of each block."""
    number = F.col("at").bitwiseAND(F.lit(NUMBER)).cast("int").alias("number")
    return frequent.groupBy((F.col("at") - number).alias("at")).agg(F.collect_list(F.struct(number, "id")).alias("found"))


def _back(frequent: DataFrame) -> DataFrame:
    """The frequent phrases of each block."""
    return frequent.filter(F.col("packed").isNotNull()).groupBy("at").agg(F.collect_list("packed").alias("found"))


def _extended(relation: DataFrame, back: DataFrame, buckets: int, name: str) -> DataFrame:
    """Semi-join with the frequent phrases, then the merge-join with itself."""
    blocks = relation.filter(_is_block()).select("at", "own", "packed").join(back, "at")
    return stored(blocks.select("at", "own", "packed", "found").mapInArrow(lambda x: extend_batches(x, buckets), PAIR_ROWS), name, **SMALL)


def _joined(longer: DataFrame, parts: DataFrame) -> DataFrame:
    """Phrases of k + 1 words with text, language and the counts of all their first and last parts, from those of k words."""
    left = parts.select(F.col("id").alias("g1"), "lang", F.col("phrase").alias("_head"), "heads")
    right = parts.select(F.col("id").alias("g2"), F.col("last").alias("last"), "tails")
    rows = longer.join(left, "g1").join(right, "g2")
    own = F.array("f")
    return rows.select("id", "g1", "g2", "f", "lang", F.concat_ws(" ", "_head", "last").alias("phrase"), "last",
                       F.concat("heads", own).alias("heads"), F.concat("tails", own).alias("tails"))


def _scored(phrases: DataFrame, size: int) -> DataFrame:
    """The lowest score over all cuts of phrases of ``size`` words, the first such cut, and the counts of its parts."""
    exact = lambda c: F.col(c).cast("decimal(20,0)")
    cuts = F.array(*[F.struct(F.lit(k).alias("cut"), F.get("heads", F.lit(k - 1)).alias("l"), F.get("tails", F.lit(size - k - 1)).alias("r"))
                     for k in range(1, size)])
    rows = phrases.select("id", "lang", "phrase", "f", F.explode(cuts).alias("_c")).select("id", "lang", "phrase", "f", "_c.*")
    rows = rows.withColumn("_top", exact("f") * F.lit(SCALE)).withColumn("_bottom", exact("l") + exact("r"))
    rows = rows.withColumn("score", F.expr("_top div _bottom"))
    best = F.min(F.struct("score", "cut", "l", "r")).alias("_b")
    return rows.groupBy("id", "lang", "phrase", "f").agg(best).select("id", "lang", "phrase", "f", "_b.*")


def _open(phrases: DataFrame, longer: DataFrame | None, covered: int) -> DataFrame:
    """Phrases that no phrase of one word more covers (one of two words more lies in such a one)."""
    if longer is None:
        return phrases
    inside = longer.select(F.explode(F.array_distinct(F.array("g1", "g2"))).alias("id"), F.col("f").alias("_f"))
    inside = inside.groupBy("id").agg(F.max("_f").alias("_f"))
    wide = lambda c: F.col(c).cast("decimal(20,0)")
    closed = F.coalesce(wide("_f") * 100 >= wide("f") * covered, F.lit(False))
    return phrases.join(inside, "id", "left").filter(~closed).drop("_f")


def mine(docs: DataFrame, least: int = LEAST, top: int = TOP, covered: int = COVERED, block_words: int = BLOCK_WORDS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score, cut: the first ``top`` phrases of 2 to ``LONGEST`` words per language of
    ``docs`` (text, lang)."""
    with_workers(docs.sparkSession)
    docs = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit(NO_LANG)).alias("lang"), F.col("text").cast("string").alias("text"))
    relation = stored(docs.mapInArrow(lambda batches: word_batches(batches, block_words), WORD_ROWS), "phrases-1", **SMALL)
    total = stored(relation.filter(_is_block()).groupBy("lang").agg(F.sum("n").cast("long").alias("n")), "phrases-total")
    buckets = max((total.agg(F.sum("n")).first()[0] or 0) // BUCKET_WORDS, LEAST_BUCKETS)
    frequent = _frequent_words(relation, least)
    parts = frequent.filter(F.col("id") == F.col("at")).select("id", "lang", F.col("word").alias("phrase"), F.col("word").alias("last"), F.array("f").alias("heads"),
                                       F.array("f").alias("tails"))
    phrases = []
    for size in range(2, LONGEST + 1):
        back = _words_back(frequent) if size == 2 else _back(frequent)
        shorter, relation = relation, _extended(relation, back, buckets, f"phrases-{size}")
        drop(shorter)
        seen, frequent = frequent, _frequent(relation, least, f"frequent-{size}")
        parts = stored(_joined(frequent.filter(F.col("id").isNotNull()).select("id", "g1", "g2", "f"), parts), f"joined-{size}")
        drop(seen)
        phrases.append(parts)
    drop(relation, frequent)
    found = None
    for size, (here, longer) in enumerate(zip(phrases, [*phrases[1:], None]), 2):
        rows = _scored(_open(here, longer, covered), size)
        found = rows if found is None else found.unionByName(rows)
    first = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("f").desc(), "phrase")
    best = found.withColumn("rank", F.row_number().over(first)).filter(F.col("rank") <= top)
    return best.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", F.col("f").alias("a"), "l", "r", "n",
                                           F.col("score").cast("long").alias("score"), "cut")


def op12_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mine(load(spark, sf_dir, "documents"))
