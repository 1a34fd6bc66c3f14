"""Stored serving table: string cells by row key, written by the jobs, read by key.

The cells ``(row_key, family, qualifier, value)`` of every micro-batch go to a
change log of their own, whose bases are range-partitioned and sorted by row key,
with a manifest of key ranges. A reader opens the files whose range can hold its
keys and the few batches after the base; the newest cell wins. Nothing is computed
from events.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstream.operators.serving import scan as scan_rows
from shopstream.sinks import changelog

SCHEMA = T.StructType([T.StructField(c, T.StringType()) for c in ("row_key", "family", "qualifier", "value")])
KEYS = ("row_key", "family", "qualifier")


def init(spark: SparkSession, path: str) -> None:
    """Create the store if it does not exist."""
    changelog.init_log(spark, path, SCHEMA)


def batch_writer(path: str, compact_every: int | None = changelog.COMPACT_EVERY) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function for cells."""
    write = changelog.batch_writer(path, KEYS, SCHEMA, compact_every, cluster_by="row_key")
    return lambda cells, batch_id: write(cells.select(*SCHEMA.fieldNames()), batch_id)


def store(cells: DataFrame, path: str) -> None:
    """Put all cells of a relation into a store as one batch, with a clustered base."""
    spark = cells.sparkSession
    init(spark, path)
    cells = cells.select(*SCHEMA.fieldNames())
    last = max([int(n.split("=")[1]) for n in changelog.pointer.children(spark, path)
                if n.startswith(changelog.BATCH_COL + "=")], default=-1)
    changelog.batch_writer(path)(cells, last + 1)
    changelog.compact_log(spark, path, SCHEMA, KEYS, last + 1, cluster_by="row_key")


def _rows(spark: SparkSession, path: str, files: list[str] | None) -> DataFrame:
    """Newest cells of the given base files and of the batches after the base."""
    held = changelog.pointer.read(spark, path)
    rows = changelog._tail(spark, path, SCHEMA, held["upto"] if held else -1)
    if files:
        rows = rows.unionByName(spark.read.schema(changelog.log_schema(SCHEMA)).parquet(*files))
    return rows


def read(spark: SparkSession, path: str) -> DataFrame:
    """All current cells."""
    return changelog.current_view(changelog.read_log(spark, path, SCHEMA), KEYS)


def get(spark: SparkSession, path: str, row_key: str) -> DataFrame:
    """All cells of one row: the files whose key range holds the key, with the key pushed into them."""
    key = F.lit(row_key)
    files = changelog.key_files(spark, path, (F.col("least") <= key) & (F.col("most") >= key))
    return changelog.current_view(_rows(spark, path, files).where(F.col("row_key") == row_key), KEYS)


def scan(spark: SparkSession, path: str, limit: int = 10, start_key: str | None = None) -> DataFrame:
    """Cells of the first ``limit`` row keys from ``start_key`` on, in key order.

    Of the base only the first files that can hold them are opened: files from
    the start key on until those behind the first hold ``limit`` keys.
    """
    held = changelog.pointer.read(spark, path)
    files: list[str] = []
    if held is not None:
        manifest = spark.read.schema("file string, least string, most string, n_keys long").parquet(
            *[f"{path}/{m}" for m in held["manifests"]])
        if start_key is not None:
            manifest = manifest.where(F.col("most") >= start_key)
        found = 0
        # the first file may begin before the start key, so its keys are not counted
        for k, row in enumerate(manifest.orderBy("least").limit(limit + 1).collect()):
            if found >= limit:
                break
            files.append(row.file)
            found += row.n_keys if k or start_key is None else 0
    rows = _rows(spark, path, files)
    if start_key is not None:
        rows = rows.where(F.col("row_key") >= start_key)
    return scan_rows(changelog.current_view(rows, KEYS), limit)
