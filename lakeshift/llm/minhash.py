"""MinHash near-dedup with b-bit signatures (operator 3).

1. *Signatures.* A document's set holds the hashes of its distinct shingles. ``BANDS * ROWS``
   minima are taken; full minima make the band keys, of each only ``BITS`` low bits are kept and
   packed. Documents with equal sets form a class (by a 128-bit digest), aggregated before
   anything else, so exact copies cost one row a class.
2. *Candidates.* Classes sharing a band key meet. Buckets of up to ``BLOCK`` classes keep the
   pairs whose similarity, estimated from equal signature fields and corrected for chance
   collisions, reaches ``FLOOR`` (over 5 standard deviations below the threshold); each task
   sends on only what connects them. Larger buckets are joined to their first class without a look,
   which only adds candidates. Connected candidates are a cluster.
3. *Confirmation* on full sets. A cluster is cut into blocks of ``BLOCK`` classes. In a block,
   pairs are tried by falling estimate, skipping those already connected, so a group costs
   about one comparison per member and never emits its pairs. Clusters of several blocks go on:
   a few members of the first block's largest part are tried against the other blocks, then
   every member that this has not joined to that part is tried against all blocks, after which
   no untried pair can connect anything. A task holds one block and a chunk of what is tried against it.
4. *Components* by large and small stars, as joins that end when nothing changes; nothing is collected.

Defined results: a null or empty text, or one without words, has an empty set, is linked with
nothing and is its own component; fewer words than a shingle make one shingle; null doc_ids
take part in links, count as larger than all ids, and have a null component only if all of it
is null; repeated rows belong to the same component and are kept alike; an empty table gives
no rows; extra columns are ignored.
"""
from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeshift.llm.shared import NULL_ID, drop, empty_text, id_key, load, stored, text_digest, with_workers
from lakeshift.llm.textkit import Words, mix, rolling, slices

SHINGLE = 2
THRESHOLD = 80  # percent
BANDS, ROWS, BITS = 32, 5, 4
FLOOR = 0.6
BLOCK = 1024
PROBES = 4

_MULTIPLIER = np.random.default_rng(7).integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_FIELD = np.uint64(0x1111111111111111)


def shingle_sets(words: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the distinct shingles of all rows, sorted within each row; first of each row and the end)."""
    hashes = words.hashes()
    n = np.diff(words.first)
    doc = words.doc
    grams = rolling(hashes, k)
    left = words.first[1:][doc] - np.arange(len(hashes))
    at = np.flatnonzero(left[:len(grams)] >= k)
    short = np.flatnonzero((n > 0) & (n < k))
    values, owner = grams[at], doc[at]
    if len(short):
        whole = [rolling(hashes[words.first[d]:words.first[d + 1]], int(n[d])) for d in short.tolist()]
        values = np.concatenate([values, *[mix(w + np.uint64(k)) for w in whole]])
        owner = np.concatenate([owner, short])
    order = np.lexsort((values, owner))
    values, owner = values[order], owner[order]
    new = np.ones(len(values), bool)
    new[1:] = (values[1:] != values[:-1]) | (owner[1:] != owner[:-1])
    values, owner = values[new], owner[new]
    return values, np.searchsorted(owner, np.arange(words.rows + 1))


def signatures(values: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(band keys [rows, BANDS], packed low bits [rows, words]) of non-empty sets."""
    rows = len(first) - 1
    minima = np.empty((BANDS * ROWS, rows), np.uint64)
    for k, m in enumerate(_MULTIPLIER):
        minima[k] = np.minimum.reduceat(values * m, first[:-1])
    keys = np.empty((rows, BANDS), np.uint64)
    for b in range(BANDS):
        keys[:, b] = rolling_rows(minima[b * ROWS:(b + 1) * ROWS], b)
    low = (minima >> np.uint64(24)) & np.uint64((1 << BITS) - 1)
    per = 64 // BITS
    packed = np.zeros((rows, -(-BANDS * ROWS // per)), np.uint64)
    for k in range(BANDS * ROWS):
        packed[:, k // per] |= low[k] << np.uint64(BITS * (k % per))
    return keys, packed


def rolling_rows(values: np.ndarray, band: int) -> np.ndarray:
    total = np.full(values.shape[1], np.uint64(band + 1))
    for v in values:
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + v)
    return total


def estimates(one: np.ndarray, many: np.ndarray) -> np.ndarray:
    """Estimated similarity of one packed signature to many: equal fields, corrected for collisions."""
    x = many ^ one
    x |= x >> np.uint64(1)
    x |= x >> np.uint64(2)
    unequal = np.bitwise_count(x & _FIELD).sum(1, dtype=np.int64)
    equal = 1 - unequal / (BANDS * ROWS)
    chance = 1 / (1 << BITS)
    return (equal - chance) / (1 - chance)


def sign_batches(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    """(doc_id, text, tie) -> doc_id, tie, class digest (null for empty sets), set size, band keys, packed signature."""
    for batch in batches:
        for begin, buf, offsets in slices(batch.column(1)):
            words = Words(buf, offsets, lower=True)
            values, first = shingle_sets(words, shingle)
            tie = batch.column(2).slice(begin, words.rows)
            size = np.diff(first)
            some = np.flatnonzero(size)
            digest, bands, packed = ([None] * words.rows for _ in range(3))
            if len(some):
                starts = first[np.append(some, words.rows)]
                starts[-1] = len(values)
                keys, low = signatures(values, starts)
                one = np.add.reduceat(mix(values ^ np.uint64(0x5851F42D4C957F2D)), starts[:-1])
                two = np.add.reduceat(mix(values * np.uint64(0xD6E8FEB86659FD93)), starts[:-1])
                both = np.stack([one, two], 1)
                for k, d in enumerate(some.tolist()):
                    digest[d], bands[d], packed[d] = both[k].tobytes(), keys[k].tobytes(), low[k].tobytes()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).slice(begin, words.rows), tie, pa.array(digest, pa.binary()), pa.array(size.astype(np.int64)),
                 pa.array(bands, pa.binary()), pa.array(packed, pa.binary())], ["doc_id", "tie", "digest", "n", "bands", "packed"])


def band_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(digest, bands) -> one row per band."""
    for batch in batches:
        keys = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.int64)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys), batch.column(0).take(pa.array(np.repeat(np.arange(len(batch)), BANDS)))], ["key", "digest"])


class Forest:
    """Union-find over 0..n-1."""

    def __init__(self, n: int) -> None:
        self.up = list(range(n))

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        i, j = self.find(i), self.find(j)
        if i == j:
            return False
        self.up[max(i, j)] = min(i, j)
        return True


def _groups(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[list[tuple]]:
    """Runs of rows with equal first ``keys`` columns, from sorted batches."""
    group: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if group and row[:keys] != group[0][:keys]:
                yield group
                group = []
            group.append(row)
    if group:
        yield group


def _edges(found: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    a, b = zip(*found) if found else ((), ())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.binary()), pa.array(b, pa.binary())], ["a", "b"])


class Stars:
    """Connected keys of one task, as links of each key to one key of its component."""

    MOST = 200_000

    def __init__(self) -> None:
        self.place: dict[bytes, int] = {}
        self.forest = Forest(0)

    def link(self, a: bytes, b: bytes) -> None:
        up = self.forest.up
        for x in (a, b):
            if x not in self.place:
                self.place[x] = len(up)
                up.append(len(up))
        self.forest.join(self.place[a], self.place[b])

    def flush(self) -> Iterator[pa.RecordBatch]:
        keys = list(self.place)
        yield _edges([(k, keys[self.forest.find(i)]) for i, k in enumerate(keys) if self.forest.find(i) != i])
        self.__init__()


def candidate_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (key, digest, n, packed) -> links that connect the pairs with a sufficient estimate."""
    stars = Stars()
    for group in _groups(batches, 1):
        n = np.array([g[2] for g in group])
        packed = np.frombuffer(b"".join(g[3] for g in group), np.uint64).reshape(len(group), -1)
        forest = Forest(len(group))
        for i in range(len(group) - 1):
            near = estimates(packed[i], packed[i + 1:]) >= FLOOR
            near &= 100 * np.minimum(n[i], n[i + 1:]) >= THRESHOLD * np.maximum(n[i], n[i + 1:])
            for j in np.flatnonzero(near).tolist():
                if forest.join(i, i + 1 + j):
                    stars.link(group[i][1], group[i + 1 + j][1])
        if len(stars.place) > Stars.MOST:
            yield from stars.flush()
    yield from stars.flush()


def contract_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, b) links -> fewer links that connect the same."""
    stars = Stars()
    for batch in batches:
        for a, b in zip(*(c.to_pylist() for c in batch.columns)):
            stars.link(a, b)
        if len(stars.place) > Stars.MOST:
            yield from stars.flush()
    yield from stars.flush()


def _similar(a: np.ndarray, b: np.ndarray) -> bool:
    """100 * |a and b| >= THRESHOLD * |a or b| for two sorted sets."""
    if 100 * min(len(a), len(b)) < THRESHOLD * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort(kind="stable")
    common = int((both[1:] == both[:-1]).sum())
    return 100 * common >= THRESHOLD * (len(a) + len(b) - common)


def confirm(rows: list[tuple], probes: Sequence[tuple] = ()) -> list[tuple[bytes, bytes]]:
    """Links of the labels of (digest, packed, set, label) rows to one label of their component.

    Rows of one label count as connected already; with probes, each of them is tried against all
    rows, else all pairs of rows. Pairs are tried by falling estimate.
    """
    members, rows = len(rows), [*rows, *probes]
    packed = np.frombuffer(b"".join(r[1] for r in rows), np.uint64).reshape(len(rows), -1)
    sets = [np.frombuffer(r[2], np.uint64) for r in rows]
    size = np.array([len(s) for s in sets])
    forest, first = Forest(len(rows)), {}
    for i, r in enumerate(rows):
        forest.join(i, first.setdefault(r[3], i))
    guess, left, right = [], [], []
    for i in range(members, len(rows)) if probes else range(members - 1):
        others = np.arange(members) if probes else np.arange(i + 1, members)
        e = estimates(packed[i], packed[others])
        near = (e >= FLOOR) & (100 * np.minimum(size[i], size[others]) >= THRESHOLD * np.maximum(size[i], size[others]))
        guess.append(e[near].astype(np.float32))
        right.append(others[near])
        left.append(np.full(int(near.sum()), i))
    if guess:
        guess, left, right = map(np.concatenate, (guess, left, right))
        order = np.argsort(-guess, kind="stable")
        for i, j in zip(left[order].tolist(), right[order].tolist()):
            if forest.find(i) != forest.find(j) and _similar(sets[i], sets[j]):
                forest.join(i, j)
    roots = [(label, rows[forest.find(i)][3]) for label, i in first.items()]
    return [(label, root) for label, root in roots if label != root]


def confirm_batches(batches: Iterator[pa.RecordBatch], chunk: int, probing: bool) -> Iterator[pa.RecordBatch]:
    """Sorted (cluster, block, probe, digest, packed, members, label) -> confirmed links of labels.

    The rows of a block are held; ``probing``, the probes behind them pass by in chunks, else all
    pairs of the block are tried.
    """
    key, rows, probes, before = None, [], [], None

    def close() -> Iterator[pa.RecordBatch]:
        found = confirm(rows, probes) if rows and (probes or not probing) else []
        if found:
            yield _edges(found)

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if row[:2] != key:
                yield from close()
                key, rows, probes = row[:2], [], []
            if row[:4] == before:
                continue  # a repeated row counts once
            before = row[:4]
            if row[2]:
                probes.append(row[3:])
                if len(probes) >= chunk:
                    yield from close()
                    probes = []
            else:
                rows.append(row[3:])
    yield from close()


def set_batches(batches: Iterator[pa.RecordBatch], shingle: int) -> Iterator[pa.RecordBatch]:
    """(digest, text, ...) -> the same rows with the sorted shingle hashes in place of the text."""
    for batch in batches:
        for begin, buf, offsets in slices(batch.column(1)):
            words = Words(buf, offsets, lower=True)
            values, first = shingle_sets(words, shingle)
            members = [values[a:b].tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [c.slice(begin, words.rows) if k != 1 else pa.array(members, pa.binary()) for k, c in enumerate(batch.columns)],
                ["digest", "members", "packed", "cluster"])


def _checked(links: DataFrame) -> tuple:
    """Number and order-free hash of a set of links: equal for equal sets."""
    return tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("b", "a"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(a, b) links -> (node, label): the least node of each connected component, for nodes with links.

    Links are contracted within tasks first. Then a round hangs every greater neighbour of a node on
    the least one around it (large star), and every node with its lesser neighbours on the least
    of those (small star), until the links stay the same: then each node hangs on its
    component's least. The number of rounds grows with the logarithm of the longest path, not with it.
    Minima are combined before they are shuffled, links of a hub are split by skew handling.
    """
    a, b = F.col("a"), F.col("b")
    links = edges.select("a", "b").mapInArrow(contract_batches, "a binary, b binary")
    links = stored(links.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter(a != b).distinct(), "links")
    seen = _checked(links)
    while True:
        ends = links.select(F.explode(F.array(F.struct(a, b), F.struct(b.alias("a"), a.alias("b")))).alias("e")).select("e.a", "e.b")
        least = ends.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = stored(ends.join(least, "a").filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).distinct(), "large-star")
        lesser = large.groupBy("a").agg(F.min("b").alias("m"))
        hung = large.join(lesser, "a")
        small = hung.select("a", F.col("m").alias("b")).unionByName(hung.filter(b != F.col("m")).select(b.alias("a"), F.col("m").alias("b")))
        small = stored(small.distinct(), "small-star")
        drop(links, large)
        links, before, seen = small, seen, _checked(small)
        if seen == before:
            break
    root = links.select(b.alias("node"), b.alias("label")).distinct()
    return links.select(a.alias("node"), b.alias("label")).unionByName(root)


def _confirmed(rows: DataFrame, probing: bool) -> DataFrame:
    """Confirmed links of (cluster, block, digest, packed, members, label, probe) rows."""
    rows = rows.select("cluster", "block", "probe", "digest", "packed", "members", "label")
    return stored(rows.repartition("cluster", "block").sortWithinPartitions("cluster", "block", "probe", "digest")
                  .mapInArrow(lambda batches: confirm_batches(batches, BLOCK, probing), "a binary, b binary"), "confirmed")


def class_components(signed: DataFrame, docs: DataFrame, shingle: int) -> DataFrame:
    """(digest, label) of the classes that are linked with others: equal labels, one component."""
    # one class per distinct set; all of a class agree on the other columns
    classes = stored(signed.filter("digest is not null").groupBy("digest").agg(
        F.min(F.struct("doc_id", "tie")).alias("one"), F.first("n").alias("n"), F.first("bands").alias("bands"),
        F.first("packed").alias("packed")), "classes")
    keyed = classes.select("digest", "bands").mapInArrow(band_batches, "key long, digest binary")
    size = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.min("digest").alias("hub"))
    shared = stored(keyed.join(size.filter("size > 1"), "key"), "buckets")
    small = shared.filter(F.col("size") <= BLOCK).join(classes.select("digest", "n", "packed"), "digest")
    forest = (small.select("key", "digest", "n", "packed").repartition("key").sortWithinPartitions("key", "digest")
              .mapInArrow(candidate_batches, "a binary, b binary"))
    large = shared.filter((F.col("size") > BLOCK) & (F.col("digest") != F.col("hub"))).select(F.col("digest").alias("a"), F.col("hub").alias("b"))
    clusters = components(forest.unionByName(large))
    drop(shared)
    # the full sets of candidates only, each from one document of its class
    wanted = (clusters.withColumnRenamed("node", "digest").withColumnRenamed("label", "cluster").join(classes, "digest")
              .select("digest", "packed", "cluster", F.col("one.doc_id").alias("_id"), F.col("one.tie").alias("_tie")))
    text = docs.select(F.col("doc_id").alias("_d"), text_digest(F.col("text")).alias("_t"), "text")
    match = F.col("_id").eqNullSafe(F.col("_d")) & (F.col("_tie") == F.col("_t"))
    sets = (wanted.join(text, match).select("digest", "text", "packed", "cluster")
            .mapInArrow(lambda batches: set_batches(batches, shingle), "digest binary, members binary, packed binary, cluster binary"))
    sizes = clusters.groupBy(F.col("label").alias("cluster")).agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("blocks"))
    sets = stored(sets.join(sizes, "cluster").withColumn("block", F.pmod(F.xxhash64("digest"), F.col("blocks"))), "sets")
    within = _confirmed(sets.withColumn("label", F.col("digest")).withColumn("probe", F.lit(False)), False)
    within = within.select(F.col("a").alias("digest"), F.col("b").alias("label"))
    wide = sets.filter("blocks > 1")
    if wide.isEmpty():
        return within
    # a few members of the first block's largest part meet all other blocks of the cluster
    marked = stored(wide.join(within, "digest", "left").withColumn("label", F.coalesce("label", "digest")), "labelled")
    main = (marked.filter("block = 0").groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("c"))
            .groupBy("cluster").agg(F.max(F.struct("c", "label")).alias("_m")).select("cluster", F.col("_m.label").alias("_main")))
    ranked = F.row_number().over(Window.partitionBy("cluster").orderBy("digest"))
    probes = (marked.filter("block = 0").join(main, "cluster").filter("label = _main").withColumn("_r", ranked)
              .filter(F.col("_r") <= PROBES).drop("_r", "_main"))
    probed = _confirmed(_against(marked, probes), True)
    joined = probed.select(F.col("a").alias("x"), F.col("b").alias("y")).unionByName(probed.select(F.col("b").alias("x"), F.col("a").alias("y")))
    # what that has not joined to the largest part meets every other block
    inner = main.select(F.col("_main").alias("x")).unionByName(
        joined.join(main, F.col("y") == F.col("_main")).select("x")).distinct()
    outside = marked.join(inner, F.col("label") == F.col("x"), "left_anti")
    late = _confirmed(_against(marked, outside), True)
    over = components(probed.unionByName(late)).select(F.col("node").alias("label"), F.col("label").alias("_over"))
    named = sets.select("digest").join(within, "digest", "left").withColumn("label", F.coalesce("label", "digest"))
    return named.join(over, "label", "left").select("digest", F.coalesce("_over", "label").alias("label"))


def _against(members: DataFrame, probes: DataFrame) -> DataFrame:
    """All members in their blocks, and each probe in every other block of its cluster."""
    sent = (probes.withColumn("_to", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
            .filter("_to != block").withColumn("block", F.col("_to")).drop("_to"))
    return members.withColumn("probe", F.lit(False)).unionByName(sent.withColumn("probe", F.lit(True)))


def _judged(docs: DataFrame, shingle: int) -> DataFrame:
    """doc_id, tie (text digest), n and component_id of each row of ``docs``."""
    with_workers(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), empty_text().alias("text"))
    signed = stored(docs.select("doc_id", "text", text_digest(F.col("text")).alias("tie")).mapInArrow(
        lambda batches: sign_batches(batches, shingle),
        "doc_id long, tie binary, digest binary, n long, bands binary, packed binary"), "signed")
    linked = class_components(signed, docs, shingle)
    first = signed.filter("digest is not null").groupBy("digest").agg(F.min("doc_id").alias("_first"))
    joined = first.join(linked, "digest", "left").withColumn("_part", F.coalesce("label", "digest"))
    least = joined.groupBy("_part").agg(F.min("_first").alias("component_id"))
    of_class = joined.select(F.col("digest").alias("_digest"), "_part").join(least, "_part")
    rows = signed.select("doc_id", "tie", "n", "digest").join(of_class, F.col("digest") == F.col("_digest"), "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return rows.select("doc_id", "tie", "n", component.alias("component_id"), "_part")


def near_duplicates(docs: DataFrame, shingle: int = 5) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row of ``docs`` (doc_id, text)."""
    return _judged(docs, shingle).select(
        "doc_id", F.col("n").alias("n_shingles"), "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def keep_one(docs: DataFrame, shingle: int = 5) -> DataFrame:
    """One row of ``docs`` of each component, all columns kept; rows without a shingle all stay.

    The row of the smallest doc_id (nulls last) stays; among rows of that id the one of the
    least text digest, and one of equal rows.
    """
    found = _judged(docs.select("doc_id", "text"), shingle)
    place = F.struct(F.coalesce("doc_id", F.lit(NULL_ID)).alias("_i"), F.col("tie").alias("_t"))
    chosen = found.filter("n > 0").groupBy("_part").agg(F.min(place).alias("_p")).select("_p._i", "_p._t", F.lit(True).alias("_one"))
    empty = found.filter("n = 0").select(place.alias("_p")).distinct().select("_p._i", "_p._t", F.lit(False).alias("_one"))
    same = Window.partitionBy("_id", "_tie").orderBy("_id")
    keyed = docs.select(F.struct("*").alias("_doc"), text_digest(empty_text()).alias("_tie"), id_key().alias("_id"))
    rows = keyed.join(chosen.unionByName(empty), (F.col("_id") == F.col("_i")) & (F.col("_tie") == F.col("_t")))
    return rows.withColumn("_row", F.row_number().over(same)).filter("_row = 1 or not _one").select("_doc.*")


def op3_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(load(spark, sf_dir, "documents"), SHINGLE)
