"""Replay-safe keyed upsert sink for streaming results, compacted inside the job.

Each micro-batch is written to a Parquet change log partitioned by
``batch_id`` with dynamic partition overwrite: a replayed batch id replaces
its own partition, so the log never holds two copies of one batch.  The
*current* table is the newest version of every key::

    groupBy(key).agg(max_by(struct(values), batch_id))

Every ``compact_every`` batches the writer merges what the log holds into a
*base* and switches an atomically replaced pointer to it. Readers take the base
that the pointer names and the batches after it (the tail). A base that was
written but not switched to is ignored and removed later; a batch that is
replayed after the switch lies within the base and is ignored. The base and the
batches before the last one stay until the next compaction, for readers that
hold the older pointer. So the log has a bounded number of partitions, however
long the job runs.

Append-mode sinks emit a key once: there the tail becomes one more base, and
all bases are merged when they number ``compact_every``.

A base may be clustered: range-partitioned and sorted by a column, with a
manifest of the range of each file. :func:`key_files` picks the files of a key.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstream.session import make_dirs
from shopstream.sinks import pointer

COMPACT_EVERY = 20
BATCH_COL = "batch_id"


def log_schema(value_schema: T.StructType) -> T.StructType:
    return T.StructType(list(value_schema.fields) + [T.StructField(BATCH_COL, T.LongType())])


def init_log(spark: SparkSession, path: str, value_schema: T.StructType) -> None:
    """Create the (empty) log folder so readers work before the first batch."""
    if not make_dirs(spark, path):
        (spark.createDataFrame([], log_schema(value_schema))
         .write.mode("append").partitionBy(BATCH_COL).parquet(path))


def batch_writer(path: str, keys: Sequence[str] | None = None, value_schema: T.StructType | None = None,
                 compact_every: int | None = None, append_only: bool = False,
                 cluster_by: str | None = None) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function: write the batch under its own ``batch_id``, compact from time to time."""
    def write(batch: DataFrame, batch_id: int) -> None:
        (batch.withColumn(BATCH_COL, F.lit(batch_id).cast("long"))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy(BATCH_COL).parquet(path))
        if compact_every:
            spark = batch.sparkSession
            held = pointer.read(spark, path) or {"upto": -1}
            if batch_id - held["upto"] >= compact_every:
                compact_log(spark, path, value_schema or batch.schema, keys or (), batch_id, append_only,
                            cluster_by, compact_every)
    return write


def _tail(spark: SparkSession, path: str, value_schema: T.StructType, upto: int) -> DataFrame:
    """Rows of the batches after ``upto``: their folders alone are listed."""
    later = [n for n in pointer.children(spark, path)
             if n.startswith(f"{BATCH_COL}=") and int(n.split("=")[1]) > upto]
    if not later:
        return spark.createDataFrame([], log_schema(value_schema))
    return spark.read.schema(log_schema(value_schema)).option("basePath", path).parquet(
        *[f"{path}/{n}" for n in later])


def read_log(spark: SparkSession, path: str, value_schema: T.StructType) -> DataFrame:
    """Rows of the bases that the pointer names and of the batches after them, with their batch ids."""
    held = pointer.read(spark, path)
    if held is None:
        return _tail(spark, path, value_schema, -1)
    bases = spark.read.schema(log_schema(value_schema)).parquet(*[f"{path}/{b}" for b in held["bases"]])
    return bases.unionByName(_tail(spark, path, value_schema, held["upto"]))


def compact_log(spark: SparkSession, path: str, value_schema: T.StructType, keys: Sequence[str], upto: int,
                append_only: bool = False, cluster_by: str | None = None, most: int = COMPACT_EVERY,
                before_switch: Callable[[], None] = lambda: None) -> None:
    """Merge the log up to a batch into a base, switch the pointer, drop what no reader can hold."""
    held = pointer.read(spark, path) or {"upto": -1, "bases": []}
    base = f"_bases/base-{upto}-{uuid.uuid4().hex[:8]}"
    kept = held["bases"] if append_only and len(held["bases"]) < most else []
    if kept:
        rows = _tail(spark, path, value_schema, held["upto"])
    else:
        rows = read_log(spark, path, value_schema)
    rows = rows.where(F.col(BATCH_COL) <= upto)
    if not append_only:
        rows = current_view(rows, keys).withColumn(BATCH_COL, F.lit(upto).cast("long"))
    rows = rows.select(*value_schema.fieldNames(), BATCH_COL)
    if cluster_by:
        rows = rows.repartitionByRange(cluster_by).sortWithinPartitions(cluster_by)
    rows.write.parquet(f"{path}/{base}")
    new = {"upto": upto, "bases": [*kept, base], "manifests": []}
    if cluster_by:
        new["manifests"] = [*(held.get("manifests", []) if kept else []), _write_manifest(spark, path, base, cluster_by)]
    before_switch()
    pointer.switch(spark, path, new)
    _sweep(spark, path, new, held)


def _write_manifest(spark: SparkSession, path: str, base: str, column: str) -> str:
    """Key range and number of keys of each file of a base, as a table beside it."""
    name = base.replace("base-", "manifest-")
    (spark.read.parquet(f"{path}/{base}").groupBy(F.col("_metadata.file_path").alias("file"))
     .agg(F.min(column).alias("least"), F.max(column).alias("most"), F.count_distinct(column).alias("n_keys"))
     .write.parquet(f"{path}/{name}"))
    return name


def key_files(spark: SparkSession, path: str, where) -> list[str] | None:
    """Files of the clustered bases whose manifest rows (file, least, most, n_keys) pass; ``None`` without a base."""
    held = pointer.read(spark, path)
    if held is None:
        return None
    manifest = spark.read.schema("file string, least string, most string, n_keys long").parquet(
        *[f"{path}/{m}" for m in held["manifests"]])
    return [r.file for r in manifest.where(where).select("file").collect()]


def _sweep(spark: SparkSession, path: str, new: dict, old: dict) -> None:
    """Removes what neither this pointer nor the one before it names."""
    keep = {n.split("/")[1] for p in (new, old) for n in [*p.get("bases", []), *p.get("manifests", [])]}
    for name in pointer.children(spark, f"{path}/_bases"):
        if name not in keep:
            pointer.delete(spark, f"{path}/_bases/{name}")
    for name in pointer.children(spark, path):
        if name.startswith(f"{BATCH_COL}=") and int(name.split("=")[1]) <= old["upto"]:
            pointer.delete(spark, f"{path}/{name}")
        elif name.startswith(pointer.NAME + "-"):
            pointer.delete(spark, f"{path}/{name}")


def appended_rows(log: DataFrame) -> DataFrame:
    """Current rows of an append-mode sink: the log itself.

    Append mode emits each key once (a window is final when the watermark
    passes it) and a replayed batch overwrites its own partition, so no key
    has two versions and no per-key reduction (shuffle) is needed.
    """
    return log.drop(BATCH_COL)


def current_view(log: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Newest version of every key (by batch id), for update-mode sinks."""
    values = [c for c in log.columns if c not in keys and c != BATCH_COL]
    latest = log.groupBy(*keys).agg(
        F.max_by(F.struct(*values), F.col(BATCH_COL)).alias("_v"))
    return latest.select(*keys, *[F.col("_v").getField(v).alias(v) for v in values])


def compact(spark: SparkSession, path: str, out_path: str, value_schema: T.StructType,
            keys: Sequence[str]) -> str:
    """Write the current rows to ``out_path`` as a single-version log."""
    cur = current_view(read_log(spark, path, value_schema), keys)
    cur.withColumn(BATCH_COL, F.lit(0).cast("long")).write.mode("overwrite") \
        .partitionBy(BATCH_COL).parquet(out_path)
    return out_path
