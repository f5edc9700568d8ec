"""Corpus pipeline: quality filter, near-dedup, decontamination, mixing, token records.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each result as
Parquet to the shared folder and reads it back as the next stage's documents. All stages but the
last return the columns of documents.

Defined results: rows with a null doc_id pass stages by their own text; documents without words
are linked with nothing by the near-dedup stage and judged by the classifier like any other; an
empty table stays empty; of repeated rows of one component near-dedup keeps one.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.llm import decontam, minhash, mixing, quality, records
from lakeshift.llm.shared import fresh_path, load

#: SQL can express neither the classifier nor the encoded records.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    return quality.keep_good(docs, quality.fit(docs, load(spark, sf_dir, "labels")))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that of the smallest doc_id."""
    return minhash.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the benchmark does not contaminate."""
    return decontam.keep_clean(docs, load(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often and in the order as the curriculum takes them."""
    return mixing.mix(docs)


def records_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id records of the mixed documents in the curriculum's order, that of the files of the
    stage before; read back from their own files."""
    import public_tokenizers
    return records.records_result(docs, public_tokenizers.path(records.TOKENIZER), records.stored_order(docs)).select("doc_id", "start", "n_tokens", "ids_crc32")


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("records", records_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = fresh_path(spark, f"pipeline-{name}")
        out = stage(spark, docs, sf_dir)
        out.write.parquet(path)
        docs = spark.read.schema(out.schema).parquet(path)
    return docs
