"""Writes: partitioned table writes, upserts, soft-delete change application and
schema evolution on append. File tables (Parquet/ORC/CSV) are immutable, so an upsert
writes a new version directory and returns it; readers switch to the new path."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from lakeshift.operators.changes import CHANGE_TYPE, UNCHANGED
from lakeshift.operators.bronze import bronze_table_schema
from lakeshift.operators.dedup import duplicate_key, one_per_key
from lakeshift.sinks import keyindex
from lakeshift.sinks.log import CommitLog
from lakeshift.spec import TableSpec

WRITE_MODES = ("append", "overwrite", "merge")
FILE_FORMATS = ("parquet", "orc", "csv", "json")


def validate_mode(mode: str) -> str:
    if mode not in WRITE_MODES:
        raise ValueError(f"Invalid write_mode '{mode}'. Must be append, overwrite, or merge.")
    return mode


def write_table(df: DataFrame, path: str, mode: str = "append", file_format: str = "parquet",
                partition_by: str | Sequence[str] | None = None,
                keys: Sequence[str] | None = None, replace: str = "partitions",
                rebalance: bool = True) -> str:
    """Write ``df``. Partitioned writes are rebalanced on the partition columns first
    (AQE splits a hot partition value across tasks instead of one huge task and keeps
    file counts bounded); ``rebalance=False`` writes straight from the input's tasks,
    for partition columns of one or a few values. A partitioned overwrite replaces the
    partitions present in ``df`` (``replace="partitions"``) or everything
    (``replace="table"``). ``merge`` upserts on ``keys`` and returns the new path."""
    validate_mode(mode)
    if replace not in ("partitions", "table"):
        raise ValueError(f"Invalid replace '{replace}'. Must be partitions or table.")
    if file_format not in FILE_FORMATS:
        raise ValueError(f"Unsupported file_format '{file_format}'")
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    if mode == "merge":
        if not keys:
            raise ValueError("merge needs key columns")
        import uuid
        out = f"{path.rstrip('/')}__v{uuid.uuid4().hex[:12]}"
        return merge_into_path(df.sparkSession, path, df, keys, out, file_format, parts)
    w = (df.hint("rebalance", *parts) if parts and rebalance else df).write.mode(mode).format(file_format)
    if file_format == "csv":
        w = w.option("header", "true")
    if parts:
        # Per write, not per session: a rerun of some days must never drop the others.
        w = w.partitionBy(*parts).option(
            "partitionOverwriteMode", "dynamic" if replace == "partitions" else "static")
    w.save(path)
    return path


def read_table(spark: SparkSession, path: str, file_format: str = "parquet",
               like: DataFrame | None = None, partition_by: Sequence[str] = ()) -> DataFrame:
    """The table that ``write_table`` wrote. Partition columns take the types they have in
    ``like`` instead of inferred ones (``"01"`` stays text), columns that csv holds as text too."""
    reader = spark.read.format(file_format)
    if file_format == "csv":
        reader = reader.option("header", "true")
    elif file_format != "json":
        reader = reader.option("mergeSchema", "true")
    found = reader.load(path)
    if like is None:
        return found
    types = {f.name: f.dataType for f in like.schema.fields
             if f.name in partition_by or file_format in ("csv", "json")}
    return reader.schema(T.StructType([T.StructField(f.name, types.get(f.name, f.dataType))
                                       for f in found.schema.fields])).load(path)


def _wider(a: DataFrame, b: DataFrame) -> dict[str, T.DataType]:
    """The type that holds a column of both frames: what a union of the two gives it."""
    both = a.limit(0).unionByName(b.limit(0), allowMissingColumns=True)
    return {f.name: f.dataType for f in both.schema.fields}


def upsert(target: DataFrame, updates: DataFrame, keys: Sequence[str],
           strategy: str = "join", order_by: Sequence[str] = ()) -> DataFrame:
    """Target rows whose key is not in ``updates``, plus all of ``updates``
    (update + insert); keys compare null-safe. Of several updates for a key the latest by
    ``order_by`` counts; without it they fail the job. A column that only one side has is
    null for the other's rows, and one that differs in type takes the wider type.

    ``strategy="join"``: one anti join on the keys, then a union.
    ``strategy="group"``: union both tagged by side and keep, per key, the update row
    if there is one — no shuffle when both tables are bucketed by the keys (the union
    keeps the bucket partitioning). The target must hold one row per key (a table
    keyed by its primary key); here too a key held twice fails the job."""
    keys = list(keys)
    if strategy == "group":
        if order_by:
            updates = one_per_key(updates, keys, order_by)
        cols = list(target.columns) + [c for c in updates.columns if c not in target.columns]
        types = _wider(target, updates)

        def side(df, tag):
            row = F.struct(*[(F.col(f"`{c}`") if c in df.columns else F.lit(None))
                             .cast(types[c]).alias(c) for c in cols])
            return df.select(*[F.col(f"`{k}`").cast(types[k]).alias(f"__k{i}")
                               for i, k in enumerate(keys)],
                             F.lit(tag).alias("__side"), row.alias("__row"))
        g = (side(target, 1).unionByName(side(updates, 2))
             .groupBy(*[f"__k{i}" for i in range(len(keys))])
             .agg(F.first(F.when(F.col("__side") == 2, F.col("__row")), ignorenulls=True).alias("u"),
                  F.first(F.when(F.col("__side") == 1, F.col("__row")), ignorenulls=True).alias("t"),
                  F.greatest(F.count_if(F.col("__side") == 1), F.count_if(F.col("__side") == 2)).alias("n"))
             .filter(F.when(F.col("n") > 1, duplicate_key(keys)).otherwise(F.lit(True))))
        return g.select(F.coalesce(F.col("u"), F.col("t")).alias("r")).select("r.*")
    if strategy != "join":
        raise ValueError("strategy must be 'join' or 'group'")
    updates = one_per_key(updates, keys, order_by)
    upd_keys = updates.select(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)])
    kept = target.join(upd_keys, _null_safe_on(keys, "__k"), "left_anti")
    return kept.unionByName(updates, allowMissingColumns=True)


def _null_safe_on(keys: Sequence[str], prefix: str):
    cond = None
    for i, k in enumerate(keys):
        c = F.col(k).eqNullSafe(F.col(f"{prefix}{i}"))
        cond = c if cond is None else cond & c
    return cond


def apply_changes(target: DataFrame, changes: DataFrame, keys: Sequence[str],
                  strategy: str = "join") -> DataFrame:
    """Apply a change set (``_change_type``) to a target: new and updated rows replace
    or add, deleted rows stay as soft deletes (``_is_deleted`` true), unchanged rows
    are left as they are."""
    delta = changes.filter(F.col(CHANGE_TYPE) != UNCHANGED).drop(CHANGE_TYPE)
    return upsert(target, delta, keys, strategy)


def merge_into_path(spark: SparkSession, target_path: str, updates: DataFrame,
                    keys: Sequence[str], out_path: str, file_format: str = "parquet",
                    partition_by: str | Sequence[str] | None = None,
                    strategy: str = "join") -> str:
    """Upsert ``updates`` into the table at ``target_path``, writing the merged table
    to ``out_path`` (a new version). Returns ``out_path``."""
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by or [])
    target = read_table(spark, target_path, file_format, updates, parts)
    merged = upsert(target, updates, keys, strategy)
    return write_table(merged, out_path, "overwrite", file_format, parts)


SCHEMA_LOG = "_schema"
_INTEGERS = ("tinyint", "smallint", "int", "bigint")


def _holds(wide: T.DataType, narrow: T.DataType) -> bool:
    """Whether files of the narrow type can be read as the wide one."""
    a, b = wide.simpleString(), narrow.simpleString()
    if a in _INTEGERS and b in _INTEGERS:
        return _INTEGERS.index(a) >= _INTEGERS.index(b)
    if isinstance(wide, T.DecimalType) and isinstance(narrow, T.DecimalType):
        return wide.scale >= narrow.scale and wide.precision - wide.scale >= narrow.precision - narrow.scale
    return a == b or (a, b) == ("double", "float")


def _grown(have: T.StructType, new: T.StructType) -> T.StructType:
    """The table's schema after a batch: columns added, types widened; anything else is refused."""
    fields, clash = {f.name: f for f in have.fields}, []
    for f in new.fields:
        old = fields.get(f.name)
        if old is None or _holds(f.dataType, old.dataType):
            fields[f.name] = T.StructField(f.name, f.dataType)
        elif not _holds(old.dataType, f.dataType):
            clash.append(f"{f.name}: {old.dataType.simpleString()} / {f.dataType.simpleString()}")
    if clash:
        raise ValueError(f"column types differ from the table's: {', '.join(clash)}")
    return T.StructType(list(fields.values()))


def table_schema(spark: SparkSession, path: str, file_format: str = "parquet") -> tuple[int, T.StructType]:
    """Number and content of the table's logged schema. A table without a log is read once for it."""
    import json
    from pyspark.errors import AnalysisException
    number, state = CommitLog(spark, f"{path.rstrip('/')}/{SCHEMA_LOG}").latest()
    if number:
        return number, T.StructType.fromJson(json.loads(state["schema"]))
    try:
        return 0, read_table(spark, path, file_format).schema
    except AnalysisException as e:
        if e.getCondition() not in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            raise
        return 0, T.StructType([])


def append_evolving(df: DataFrame, path: str, file_format: str = "parquet",
                    partition_by: str | Sequence[str] | None = None) -> str:
    """Append a batch whose schema may add columns or widen types (integers, float to double, decimals);
    narrower columns are written in the table's type, anything else is refused before a row
    is written. The schema lives in a log beside the data, so an append opens no data file; two
    appends that change it at once both end up in it. Readers use ``read_evolving``."""
    if file_format not in ("parquet", "orc"):
        return write_table(df, path, "append", file_format, partition_by)
    spark = df.sparkSession
    while True:
        number, have = table_schema(spark, path, file_format)
        grown = _grown(have, df.schema)
        if number and grown == have or CommitLog(spark, f"{path.rstrip('/')}/{SCHEMA_LOG}").publish(number + 1, {"schema": grown.json()}):
            break
    kinds = {f.name: f.dataType for f in grown.fields}
    rows = df.select(*[F.col(f"`{c}`").cast(kinds[c]).alias(c) for c in df.columns])
    return write_table(rows, path, "append", file_format, partition_by)


def read_evolving(spark: SparkSession, path: str) -> DataFrame:
    """Read a Parquet table by its logged schema (no file is opened for it); columns and widths that
    older files lack read as null and widened. A table without a log is merged from its files."""
    number, schema = table_schema(spark, path)
    return spark.read.schema(schema).parquet(path) if number else spark.read.option("mergeSchema", "true").parquet(path)


def create_bronze_table(spark: SparkSession, name: str, spec: TableSpec, path: str,
                        file_format: str = "parquet") -> DataFrame:
    """Register an external bronze table: declared columns plus lineage columns."""
    schema: T.StructType = bronze_table_schema(spec)
    return spark.catalog.createTable(name, path=path, source=file_format, schema=schema)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a Parquet table in the cluster-shared folder
    (``spark.checkpoint.dir``) and return a scan of it. Cuts lineage so several later
    passes read columns from storage instead of recomputing the plan, and survives
    executor loss (unlike a local checkpoint)."""
    from lakeshift.session import scratch_path
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def merge_partitions(spark: SparkSession, target_path: str, updates: DataFrame,
                     keys: Sequence[str], partition_by: str | Sequence[str],
                     file_format: str = "parquet", strategy: str = "join",
                     order_by: Sequence[str] = (), indexed: bool = False) -> str:
    """Upsert ``updates`` into a partitioned table *in place*, rewriting only the
    partitions that hold an old or a new version of an updated row (dynamic partition
    overwrite); a row may change its partition. New columns are kept, partition columns
    have the types they have in ``updates``, several updates for a key are settled as in
    ``upsert``. Other columns keep the type of the files that stay as they are; updates of a
    wider type are refused. Returns ``target_path``.

    The touched partitions are a small written table, joined by plain equality so that
    Spark prunes folders at run time. Partitions that lost all their rows are removed
    last; a run that dies before that is mended by running the same merge again.

    Old versions are found by the keys of the whole table, or, ``indexed``, by those of the partitions that
    the table's key index names (built by the first indexed merge; see ``sinks.keyindex``). An
    indexed merge takes the schema from the table's schema log, so it opens no file of other partitions.
    """
    parts = [partition_by] if isinstance(partition_by, str) else list(partition_by)
    keys = list(keys)
    if indexed and file_format not in ("parquet", "orc"):
        raise ValueError("an indexed merge needs parquet or orc")
    target = _logged(spark, target_path, file_format, updates, parts) if indexed else read_table(
        spark, target_path, file_format, updates, parts)
    updates = one_per_key(materialize(_as_stored(updates, target), "merge-updates"), keys, order_by)
    updates = materialize(updates, "merge-updates")
    upd_keys = updates.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)])
    near = _near(spark, target_path, target, updates, keys, parts) if indexed else target
    old = near.join(upd_keys, _null_safe_on(keys, "__k"), "left_semi").select(*parts)
    touched = listed_partitions(old.unionByName(updates.select(*parts)), parts, "merge-touched")
    merged = upsert(_in_partitions(target, touched, parts), updates, keys, strategy)
    write_table(merged, target_path, "overwrite", file_format, parts)
    written = _logged(spark, target_path, file_format, updates, parts) if indexed else read_table(
        spark, target_path, file_format, updates, parts)
    _drop_left(spark, written, updates, touched, keys, parts)
    return target_path


def _logged(spark: SparkSession, path: str, file_format: str, updates: DataFrame, parts: Sequence[str]) -> DataFrame:
    """The table read by its logged schema, which takes in the columns of ``updates``: columns that no file
    has yet read as null. The partition columns have their types of ``updates``."""
    kinds = {f.name: f.dataType for f in updates.schema.fields}
    while True:
        number, have = table_schema(spark, path, file_format)
        fields = [T.StructField(f.name, kinds.get(f.name, f.dataType) if f.name in parts else f.dataType) for f in have.fields]
        fields += [T.StructField(f.name, f.dataType) for f in updates.schema.fields if f.name not in have.fieldNames()]
        grown = T.StructType(fields)
        if number and grown == have or CommitLog(spark, f"{path.rstrip('/')}/{SCHEMA_LOG}").publish(number + 1, {"schema": grown.json()}):
            return spark.read.format(file_format).schema(grown).load(path)


def _near(spark: SparkSession, path: str, target: DataFrame, updates: DataFrame, keys: Sequence[str],
          parts: Sequence[str]) -> DataFrame:
    """Rows of the partitions that may hold a key of ``updates``; the index covers ``updates`` from here on."""
    index = keyindex.read_key_index(spark, path)
    if index is None:
        keyindex.build_key_index(spark, target, path, keys, parts)
        index = keyindex.read_key_index(spark, path)
    near = listed_partitions(keyindex.candidate_partitions(index, updates, keys, parts), parts, "merge-near")
    keyindex.add_keys(spark, path, updates, keys, parts)
    return _in_partitions(target, near, parts)


def _as_stored(updates: DataFrame, target: DataFrame) -> DataFrame:
    wider = _wider(target, updates)
    have = {f.name: f.dataType for f in target.schema.fields}
    clash = [f"{c}: {t.simpleString()} / {wider[c].simpleString()}" for c, t in have.items() if wider[c] != t]
    if clash:
        raise ValueError(f"column types wider than the table's: {', '.join(clash)}")
    return updates.select(*[F.col(f"`{c}`").cast(have[c]).alias(c) if c in have else F.col(f"`{c}`")
                            for c in updates.columns])


def _any_null(parts: Sequence[str]):
    null = F.lit(False)
    for c in parts:
        null = null | F.col(f"`{c}`").isNull()
    return null


def listed_partitions(df: DataFrame, parts: Sequence[str], name: str) -> DataFrame:
    """The distinct partition values of ``df`` as a small written table, for ``_in_partitions``."""
    return materialize(df.select(*parts).distinct().withColumn("__open", _any_null(parts).cast("int")), name)


def _in_partitions(target: DataFrame, touched: DataFrame, parts: Sequence[str]) -> DataFrame:
    """Rows of ``target`` in the listed partitions; those with a null value apart."""
    names = [f"__p{i}" for i in range(len(parts))]
    listed = touched.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(parts, names)], "__open")
    equal = same = F.lit(True)
    for c, n in zip(parts, names):
        equal = equal & (target[f"`{c}`"] == F.col(n))
        same = same & target[f"`{c}`"].eqNullSafe(F.col(n))
    return (target.join(listed.filter("__open = 0"), equal, "left_semi")
            .unionByName(target.filter(_any_null(parts)).join(listed.filter("__open = 1"), same, "left_semi")))


def _drop_left(spark: SparkSession, target: DataFrame, updates: DataFrame, touched: DataFrame,
               keys: Sequence[str], parts: Sequence[str]) -> None:
    """Remove the folders of partitions from which every row moved away: an overwrite by
    partitions leaves them. They are those still holding an old version of a moved row."""
    new = updates.select(*[F.col(f"`{k}`").alias(f"__k{i}") for i, k in enumerate(keys)],
                         F.struct(*parts).alias("__new"))
    there = target.withColumn("__file", F.col("_metadata.file_path"))
    left = (_in_partitions(there, touched, parts).join(new, _null_safe_on(keys, "__k"))
            .filter(~F.struct(*parts).eqNullSafe(F.col("__new")))
            .select("__file"))
    drop_folders(spark, left, "__file")


def drop_folders(spark: SparkSession, files: DataFrame, column: str) -> None:
    """Remove the folders that hold the listed files: one driver call per partition that goes."""
    folders = files.select(F.regexp_replace(column, "/[^/]*$", "").alias("folder")).distinct()
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    for row in folders.toLocalIterator():
        folder = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(row.folder))
        folder.getFileSystem(conf).delete(folder, True)


def bronze_ddl(spec: TableSpec, location: str, database: str = "bronze",
               file_format: str = "PARQUET") -> str:
    """``CREATE TABLE IF NOT EXISTS`` text for SQL users: declared columns plus lineage
    columns, NOT NULL where declared, external location. Decimals keep their scale."""
    cols = ",\n".join(
        f"  {f.name} {f.dataType.simpleString().upper()}{'' if f.nullable else ' NOT NULL'}"
        for f in bronze_table_schema(spec).fields)
    return (f"CREATE TABLE IF NOT EXISTS {database}.{spec.table_name} (\n{cols}\n) "
            f"USING {file_format}\nLOCATION '{location}'")


def write_bucketed_table(df: DataFrame, name: str, keys: Sequence[str], buckets: int,
                         path: str | None = None, mode: str = "overwrite") -> DataFrame:
    """Save ``df`` as a catalog table bucketed and sorted by ``keys`` (stored at
    ``path``, default a new folder under the shared checkpoint folder). Source and
    target tables bucketed the same way make key completeness, distinct-value flags,
    change detection and dedup on those keys run without any shuffle."""
    from lakeshift.session import scratch_path
    spark = df.sparkSession
    location = path or scratch_path(spark, f"tables/{name}")
    (df.write.mode(mode).format("parquet").option("path", location)
     .bucketBy(buckets, *keys).sortBy(*keys).saveAsTable(name))
    return spark.table(name)
