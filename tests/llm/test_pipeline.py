"""The corpus pipeline, stage by stage, against brute force on a small fixture."""
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from lakeshift.llm import mixing, quality, records

public_tokenizers = pytest.importorskip("public_tokenizers")
WORD = re.compile("[^\x20\x09-\x0d]+")
ITEM = " ".join(f"question{i}" for i in range(40))
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def prose(seed, n=60):
    r = np.random.default_rng(seed)
    return " ".join(r.choice(["the", "of", "alpha", "beta", "gamma", "delta", "river", "stone", "cloud", "bridge"], n))


def table():
    out = [(i, prose(i), "en", ["a", "b", None][i % 3]) for i in range(120)]
    out += [(300 + i, " ".join(f"{w.upper()}!!" for w in prose(i).split()), "en", "a") for i in range(60)]
    out += [(400 + i, prose(7) + (" again" if i % 2 else ""), "fr", "b") for i in range(8)]
    out += [(500 + i, prose(200 + i) + " " + ITEM + " " + prose(300 + i), "en", "a") for i in range(4)]
    out += [(3, prose(3), "en", "a"), (None, prose(9), None, None), (600, prose(600, 1500), "en", "c")]
    return [(*r, len(r[1])) for r in out]


def components(texts):
    """Component number of each text: linked at 0.8 or more of five-word shingles."""
    sets = []
    for t in texts:
        w = [x.lower() for x in WORD.findall(t)]
        sets.append({tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))})
    comp = list(range(len(sets)))
    for i in range(len(sets)):
        for j in range(i):
            if comp[i] != comp[j] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                comp = [comp[j] if c == comp[i] else c for c in comp]
    return comp


def contaminated(text):
    w, item, hit = text.lower().split(), ITEM.split(), set()
    windows = {tuple(item[k:k + 13]) for k in range(len(item) - 12)}
    for k in range(len(w) - 12):
        if tuple(w[k:k + 13]) in windows:
            hit |= set(range(k, k + 13))
    return bool(hit) and 20 * len(hit) >= len(w)


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(table(), COLUMNS).write.parquet(f"{path}/documents.parquet")
    labels = [(r[0], 0 if 300 <= r[0] < 400 else 1, 0) for r in table() if r[0] is not None]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


def content(frame):
    return Counter((r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in frame.collect())


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    rejected = {r.doc_id for r in quality.score(docs, model).collect() if not r.predicted}
    assert {300 + i for i in range(60)} == rejected
    good = corpus_pipeline.quality_stage(spark, docs, sf_dir)
    want = [r for r in table() if r[0] not in rejected]
    assert good.columns == docs.columns and content(good) == Counter(want)

    single = corpus_pipeline.near_dedup_stage(spark, good, sf_dir)
    comp = components([r[1] for r in want])
    first = {}
    for c, r in sorted(zip(comp, want), key=lambda x: (x[1][0] is None, x[1][0] or 0)):
        first.setdefault(c, r)
    assert len(first) < len(want)
    # rows that share a doc_id hold one text here, their sources may differ
    assert single.columns == docs.columns
    assert Counter(r[:2] for r in content(single).elements()) == Counter(r[:2] for r in first.values())

    clean = corpus_pipeline.decontamination_stage(spark, single, sf_dir)
    left = Counter(r for r in content(single).elements() if not contaminated(r[1]))
    assert clean.columns == docs.columns and content(clean) == left
    assert not {r[0] for r in left} & {500, 501, 502, 503}

    mixed = corpus_pipeline.mixing_stage(spark, clean, sf_dir)
    copies = Counter()
    for r in mixing.positions(clean).collect():
        copies[r.doc_id] += len(r.positions)
    assert mixed.columns == docs.columns
    assert Counter(r.doc_id for r in mixed.collect()) == +copies and set(content(mixed)) <= set(left)


def test_run(spark, sf_dir):
    """The written records are those of the mixed documents, end to end and in order."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir)
    tok = Tokenizer.from_file(public_tokenizers.path(records.TOKENIZER))
    want = Counter()
    for r in docs.collect():
        ids = [*tok.encode(r.text, add_special_tokens=False).ids, 2]
        want[(r.doc_id, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))] += 1
    got = corpus_pipeline.run(spark, sf_dir).orderBy("start").collect()
    assert Counter((r.doc_id, r.n_tokens, r.ids_crc32) for r in got) == want
    assert [r.start for r in got] == np.cumsum([0, *(r.n_tokens for r in got)])[:-1].tolist()


def test_records_keep_the_mixed_order(spark, sf_dir, tmp_path):
    """Records stand in the curriculum's order, over several files."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    at = [(p, r.doc_id) for r in mixing.positions(docs).collect() for p in r.positions]
    mixed = corpus_pipeline.mixing_stage(spark, docs, sf_dir)
    order = [r.doc_id for r in mixed.collect()]
    assert order != sorted(order, key=lambda d: (d is not None, d)) and Counter(order) == Counter(d for _, d in at)
    # as ``run`` stores it, in several files, each holding a run of the order
    spark.createDataFrame(list(enumerate(r.asDict() for r in mixed.collect())), f"n long, r struct<{', '.join(x.replace(' ', ': ') for x in COLUMNS.split(', '))}>") \
        .repartitionByRange(5, "n").sortWithinPartitions("n").select("r.*").write.option("maxRecordsPerFile", 20).parquet(f"{tmp_path}/mixed")
    got = corpus_pipeline.records_stage(spark, spark.read.parquet(f"{tmp_path}/mixed"), sf_dir).orderBy("start").collect()
    assert [r.doc_id for r in got] == order


def test_empty(spark, tmp_path):
    for name, schema in [("documents", COLUMNS), ("labels", "doc_id long, quality int, toxic int"), ("benchmark", "item_id long, text string")]:
        spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
