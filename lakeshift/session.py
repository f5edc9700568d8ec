"""Session construction and shared-storage helpers."""
from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

# Settings that matter at scale: AQE re-plans joins from runtime sizes (the only place
# a dimension gets broadcast, after its size is measured), coalesces small shuffle
# partitions and splits skewed ones; partition overwrite is dynamic so reruns of one
# day replace only that day.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


LOCAL_CONF = {
    # Listing a table with thousands of partition folders: the default launches one
    # listing task per folder; a few dozen tasks each listing many folders is far cheaper.
    # On a cluster, set it to about the number of executor cores.
    "spark.sql.sources.parallelPartitionDiscovery.parallelism": "64",
}


def build_session(master: str = "local[*]", shuffle_partitions: int = 8,
                  app_name: str = "lakeshift", extra: dict | None = None) -> SparkSession:
    """Create (or reuse) a session with the settings above. Tests and bench use this;
    on a cluster the launcher's own session is used and only SCALE_CONF is applied."""
    builder = (SparkSession.builder.master(master).appName(app_name)
               .config("spark.ui.enabled", "false")
               .config("spark.ui.showConsoleProgress", "false")
               .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
               .config("spark.driver.memory", "8g"))
    for k, v in {**SCALE_CONF, **LOCAL_CONF, **(extra or {})}.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    Read from the session; only when it is unset in a local session (tests) a fresh local
    folder is created and registered, elsewhere that is an error, so lineage cuts and written tables always live in one place.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    sc = None
    try:
        sc = spark.sparkContext
        d = sc.getCheckpointDir() or d
    except Exception:  # noqa: BLE001 - e.g. a Connect session has no SparkContext handle
        sc = None
    if not d:
        if sc is not None and not sc.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="lakeshift-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(d)
            d = sc.getCheckpointDir() or d
        spark.conf.set("spark.checkpoint.dir", d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new, unique path under the shared folder for one written table."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/lakeshift/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """Strip a file: scheme (for os-level checks in tests)."""
    return path[len("file:"):] if path.startswith("file:") else path


__all__ = ["build_session", "shared_dir", "scratch_path", "local_path", "SCALE_CONF"]
