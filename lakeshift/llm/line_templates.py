"""Line dedup by a log-template tree (operator 4).

1. Lines (split at \\n) become tokens (split at white space); a token with a digit is a variable
   field ``<*>``. Equal masked lines of one batch are combined to one row with the number of documents
   that hold them.
2. The tree has fixed depth: token count, then the first ``DEPTH`` tokens. Its leaves are the
   shuffle key; rows of a leaf arrive sorted, so equal lines are added up as they stream by.
3. In a leaf, a line joins the template with the largest share of equal tokens if that reaches
   ``SIMILAR``; tokens that differ become variable fields of the template.
4. All lines of templates found in at least ``MIN_DOCS`` different documents are dropped, wherever
   they stand. The tree only knows a bound of that number, the sum over a template's lines; the
   lines of templates whose bound suffices meet the lines of all documents in an ordinary join
   by 128-bit digest, which Spark splits where one line is hot, and the documents of each
   template are counted on what meets.
5. Long lines recur in fewer documents by no chance: a masked line whose words times its documents
   reach ``LONG`` (50 words: 2 documents, 20 words: 5) stays in its first document, by id and text
   hash, and goes from all others, so that no passage is lost with its last copy.

Defined results: rows repeated whole are one place under 5, so its first document keeps a line in
each of its rows; a line that stands twice in its first document stays twice; lines without a token are never dropped and not counted; a null or empty text has no
lines; a line repeated within one document counts once for it; rows repeated whole count as
documents of their own; null doc_ids are documents too; ties between templates go to the
first in order of lines; an empty table gives no rows; extra columns are ignored.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.llm.shared import empty_text, id_key, load, stored, with_workers
from lakeshift.llm.substring import _texts, shrink_batches
from lakeshift.llm.textkit import slices

DEPTH = 4
SIMILAR = 0.7
MIN_DOCS = 10
LONG = 100
BATCH_LINES = 50_000
ANY = b"<*>"

_DIGIT = re.compile(rb"\d")


def masked(line: bytes) -> list[bytes]:
    """Tokens of a line with variable fields masked."""
    return [ANY if _DIGIT.search(t) else t for t in line.split()]


def digest(line: bytes) -> bytes:
    return hashlib.md5(line).digest()


def leaf(tokens: list[bytes]) -> int:
    head = b" ".join([str(len(tokens)).encode(), *tokens[:DEPTH]])
    return int.from_bytes(hashlib.md5(head).digest()[:8], "little", signed=True)


def least_docs(tokens: int, min_docs: int) -> int:
    """Documents in which a line of so many tokens recurs."""
    return min(min_docs, max(2, -(-LONG // tokens)))


def lines_of(column: pa.Array) -> Iterator[tuple[int, list[bytes]]]:
    """(row, lines) of each text."""
    for first, buf, offsets in slices(column):
        data = buf.tobytes()
        for k, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist())):
            yield first + k, data[a:b].split(b"\n")


def tree_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) -> leaf, masked line, number of documents; equal lines combined."""
    counts: dict[bytes, int] = {}

    def flush() -> pa.RecordBatch:
        rows = [(leaf(line.split(b" ")), line, n) for line, n in counts.items()]
        a, b, c = zip(*rows) if rows else ((), (), ())
        counts.clear()
        return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.binary()), pa.array(c, pa.int64())], ["leaf", "line", "n"])

    for batch in batches:
        for _, lines in lines_of(batch.column(0)):
            for line in {b" ".join(masked(x)) for x in lines}:
                if line:
                    counts[line] = counts.get(line, 0) + 1
            if len(counts) >= BATCH_LINES:
                yield flush()
    yield flush()


class Leaf:
    """Templates of one leaf: tokens, documents, (digest, documents) of the lines."""

    def __init__(self) -> None:
        self.templates: list[list] = []

    def add(self, line: bytes, n: int) -> None:
        tokens = line.split(b" ")
        best, share = None, SIMILAR
        for t in self.templates:
            s = sum(a == b for a, b in zip(t[0], tokens)) / len(tokens)
            if s > share or s == share and best is None:
                best, share = t, s
        if best is None:
            self.templates.append([tokens, n, [(digest(line), n)]])
        else:
            best[0] = [a if a == b else ANY for a, b in zip(best[0], tokens)]
            best[1] += n
            best[2].append((digest(line), n))

    def candidates(self, min_docs: int) -> list[tuple[bytes, bytes, int, bool]]:
        """(digest, group, documents needed, dropped everywhere) of the lines of templates that may be in
        ``min_docs`` documents, and of long lines that recur in fewer. A template's group is
        named by its first line, that of a line alone by a longer name."""
        out = []
        for tokens, docs, lines in self.templates:
            if docs >= min_docs:
                out += [(d, lines[0][0], min_docs, True) for d, _ in lines]
            least = least_docs(len(tokens), min_docs)
            out += [(d, b"=" + d, least, False) for d, n in lines if least <= n < min_docs]
        return out


def template_batches(batches: Iterator[pa.RecordBatch], min_docs: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (leaf, line) -> candidates of all leaves."""
    def table() -> pa.RecordBatch:
        kinds = (pa.binary(), pa.binary(), pa.int32(), pa.bool_())
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], kind) for i, kind in enumerate(kinds)],
                                          ["digest", "template", "least", "everywhere"])

    key, line, n, tree, out = None, None, 0, Leaf(), []
    for batch in batches:
        for k, x, c in zip(*(col.to_pylist() for col in batch.columns)):
            if (k, x) == (key, line):
                n += c
                continue
            if line is not None:
                tree.add(line, n)
            if k != key:
                out += tree.candidates(min_docs)
                tree = Leaf()
            key, line, n = k, x, c
        if len(out) > 10_000:
            yield table()
            out = []
    if line is not None:
        tree.add(line, n)
    out += tree.candidates(min_docs)
    yield table()


def place_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, tie, text) -> one row per line with a token: id, tie, number, digest."""
    for batch in batches:
        rows, numbers, digests = [], [], []
        for row, lines in lines_of(batch.column(2)):
            for number, x in enumerate(lines):
                if tokens := masked(x):
                    rows.append(row)
                    numbers.append(number)
                    digests.append(digest(b" ".join(tokens)))
        take = pa.array(rows, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(take), batch.column(1).take(take), pa.array(numbers, pa.int32()), pa.array(digests, pa.binary())],
            ["id", "tie", "number", "digest"])


def drop_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, small, numbers) -> line counts and the text without the numbered lines."""
    for batch in batches:
        for first, texts in _texts(batch.column(1)):
            ids, n, dropped, kept = batch.column(0).slice(first, len(texts)), [], [], []
            for row, lines in lines_of(texts):
                gone = set(batch.column(2)[first + row].as_py() or ())
                n.append(sum(bool(x.split()) for x in lines))
                dropped.append(len(gone))
                kept.append(b"\n".join([x for k, x in enumerate(lines) if k not in gone]))
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(n, pa.int64()), pa.array(dropped, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc_id", "n_lines", "n_dropped", "kept_text"])


def drop_recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_text of each row of ``docs`` (doc_id, text)."""
    with_workers(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), id_key().alias("id"), F.xxhash64(empty_text()).alias("tie"), empty_text().alias("text"))
    candidates = stored(
        docs.select("text").mapInArrow(tree_batches, "leaf long, line binary, n long")
        .repartition("leaf").sortWithinPartitions("leaf", "line")
        .mapInArrow(lambda batches: template_batches(batches, min_docs), "digest binary, template binary, least int, everywhere boolean"), "templates")
    placed = docs.select("id", "tie", "text").mapInArrow(place_batches, "id long, tie long, number int, digest binary")
    # rows repeated whole share id and tie: each has all the numbers
    held = stored(placed.join(candidates, "digest").groupBy("id", "tie", "template", "least", "everywhere").agg(
        F.collect_set("number").alias("numbers"), F.count(F.lit(1)).alias("n"))
        .withColumn("n", F.floor(F.col("n") / F.size("numbers"))), "template-lines")
    place = F.struct("id", "tie")
    recurring = (held.groupBy("template", "least").agg(F.sum("n").alias("n_docs"), F.min(place).alias("first"))
                 .filter(F.col("n_docs") >= F.col("least")).select("template", "first"))
    gone = held.join(recurring, "template").filter(F.col("everywhere") | (place != F.col("first"))).groupBy("id", "tie").agg(F.flatten(F.collect_list("numbers")).alias("numbers"))
    small = docs.mapInArrow(shrink_batches, "doc_id long, id long, tie long, small binary")
    return (small.join(gone, ["id", "tie"], "left").select("doc_id", "small", "numbers")
            .mapInArrow(drop_batches, "doc_id long, n_lines long, n_dropped long, kept_text string"))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = drop_recurring_lines(load(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))
