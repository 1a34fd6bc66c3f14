"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.session import new_run_dir

# ASCII white space of the contracts: \x20 and \x09-\x0D
BLANKS = b" \t\n\x0b\x0c\r"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


_MADE: list[list[str]] = []


@contextmanager
def cuts_made() -> Iterator[list[str]]:
    """The folders that ``cut`` writes inside the block, in order."""
    made: list[str] = []
    _MADE.append(made)
    try:
        yield made
    finally:
        _MADE[:] = [m for m in _MADE if m is not made]


def remove_cuts(spark: SparkSession, folders: list[str]) -> None:
    """Remove folders that ``cut`` wrote and no frame in use reads any more."""
    jvm = spark.sparkContext._jvm
    own = new_run_dir(spark, "llm-").rpartition("llm-")[0] + "llm-"
    for folder in folders:
        if not folder.startswith(own):
            raise ValueError(f"not a folder of cut: {folder}")
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def cut(spark: SparkSession, df: DataFrame, label: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` below the shared folder and read it back (ends the lineage).

    A lost executor loses nothing of it, and side effects or non-deterministic
    columns above it are evaluated exactly once per committed task.
    """
    path = new_run_dir(spark, f"llm-{label}")
    for made in _MADE:
        made.append(path)
    writer = df.write
    if compression:
        writer = writer.option("compression", compression)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_rows(spark: SparkSession, rows: int) -> Iterator[None]:
    """Jobs that run inside the block hand at most ``rows`` rows at a time to Python."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def whole(df: DataFrame, name: str = "row") -> Column:
    """All columns of ``df`` in one struct, so that no name can clash with an operator's own."""
    return F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias(name)


def unpack(df: DataFrame, columns: list[str], name: str = "row") -> DataFrame:
    """The columns that ``whole`` wrapped, under their own names."""
    return df.select(*[F.col(f"`{name}`.`{c}`").alias(c) for c in columns])


def text_of(column: str = "text") -> Column:
    """The text as UTF-8 bytes, null as empty."""
    return F.coalesce(F.col(f"`{column}`").cast("binary"), F.lit(b""))


def join_classes(spark: SparkSession, rows: DataFrame, classes: DataFrame, keys: list[str], size: str,
                 most: int = 1000) -> DataFrame:
    """``rows`` with the columns of their class (null if they have none), whatever the share of one class.

    ``classes`` has one row per key with the number ``size`` of its rows. Classes
    of more than 1/``most`` of all rows number fewer than ``most``: these reach
    the tasks, and only the others meet their rows in a shuffle.
    """
    classes = cut(spark, classes, "classes")
    total = classes.agg(F.sum(size)).first()[0] or 0
    hot = classes.where(F.col(size) * most > total)
    values = [c for c in classes.columns if c not in keys]
    marked = rows.join(F.broadcast(hot.withColumn("_hot", F.lit(True))), keys, "left")
    cold = marked.where("_hot is null").drop(*values, "_hot").join(
        classes.where(F.col(size) * most <= total), keys, "left")
    return marked.where("_hot").drop("_hot").unionByName(cold)


_HELD: dict[str, Callable[[], None]] = {}


def hold(owner: str, release: Callable[[], None]) -> None:
    """Note that this worker keeps a cache for ``owner`` and release those of other operators.

    Spark reuses Python workers from stage to stage; without this the caches of
    all operators of a pipeline would add up in each worker. What they held goes
    back to the system, which counts the memory of idle workers too.
    """
    others = [o for o in _HELD if o != owner]
    for other in others:
        _HELD.pop(other)()
    if others:
        gc.collect()
        pa.default_memory_pool().release_unused()
        with suppress(OSError, AttributeError):  # only glibc has it
            ctypes.CDLL(None).malloc_trim(0)
    _HELD[owner] = release


# schemes of Spark's file systems that a task's own reader and writer knows under another name
_SCHEMES = {"s3a": "s3", "s3n": "s3", "gs": "gs", "gcs": "gs", "hdfs": "hdfs", "viewfs": "viewfs", "file": "file",
            "abfs": "abfs", "abfss": "abfss", "s3": "s3"}


def shared_folder(spark: SparkSession, path: str) -> str:
    """``path`` with the scheme that Spark would give it, checked before any task runs.

    A path without a scheme lies on the default file system of the cluster, not
    on the disk of each executor.
    """
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    uri = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).makeQualified(p).toString()
    scheme = uri.partition(":")[0]
    if scheme not in _SCHEMES:
        raise ValueError(f"tasks cannot write to {scheme}: give a folder on {', '.join(sorted(_SCHEMES))}")
    return uri


def task_uri(uri: str) -> str:
    """A folder of ``shared_folder`` under the scheme that tasks know."""
    scheme, _, rest = uri.partition(":")
    if scheme not in _SCHEMES or not rest:
        raise ValueError(f"not a shared folder: {uri}")
    return f"{_SCHEMES[scheme]}:{rest}"


def open_store(uri: str):
    """(file system, path) of a folder of ``shared_folder``, for writes and reads from tasks.

    Only the shared work folder is reached this way; tables are read by Spark.
    """
    from pyarrow import fs

    uri = task_uri(uri)
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    return fs.FileSystem.from_uri(uri)
