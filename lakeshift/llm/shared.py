"""Helpers of this subpackage: shared-folder tables, input columns, package path for workers."""
from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeshift.session import scratch_path, shared_dir

_ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

#: Sorts after every other id; stands for a null id inside keys.
NULL_ID = (1 << 63) - 1


#: Bytes of one Arrow batch, and what keeps freed memory from staying with Python workers.
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
WORKER_MEMORY = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_ARENA_MAX": "2", "MALLOC_TRIM_THRESHOLD_": str(8 << 20)}


def with_workers(spark: SparkSession) -> SparkSession:
    """Let Python workers import this package when it runs from a source tree, and bound their memory:
    Arrow batches of 8 MB where the session does not set a size, freed memory given back.

    On a cluster the package is installed on the executors or sent with ``--py-files``.
    """
    if spark.sparkContext.getConf().get(ARROW_BYTES) is None:
        spark.conf.set(ARROW_BYTES, str(8 << 20))
    env = spark.sparkContext.environment
    for name, value in WORKER_MEMORY.items():
        env.setdefault(name, value)
    paths = env.get("PYTHONPATH", "").split(os.pathsep)
    if _ROOT not in paths:
        env["PYTHONPATH"] = os.pathsep.join([_ROOT, *[p for p in paths if p]])
    return spark


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return with_workers(spark).read.parquet(f"{sf_dir}/{table}.parquet")


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new folder under ``spark.checkpoint.dir`` (shared by all executors)."""
    return scratch_path(spark, f"llm-{name}")


def stored(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: lineage ends at durable files."""
    path = fresh_path(df.sparkSession, name)
    df.write.mode("overwrite").options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop(*tables: DataFrame) -> None:
    """Delete tables made by ``stored`` once nothing reads them any more."""
    for table in tables:
        spark = table.sparkSession
        folders = {f.rsplit("/", 1)[0] for f in table.inputFiles()}
        for folder in folders:
            if f"{shared_dir(spark).rstrip('/').split(':')[-1]}/lakeshift/llm-" not in folder:
                raise ValueError(f"not a written intermediate table: {folder}")
            path = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(folder))
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def id_key(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NULL_ID))


def empty_text(column: str = "text") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def text_digest(text: Column) -> Column:
    """128-bit digest of a text: stands for the text in keys."""
    return F.unhex(F.md5(text.cast("binary")))
