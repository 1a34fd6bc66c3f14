"""A small JSON file that names the current version of a folder, replaced atomically.

Readers take what the pointer names and nothing else, so a version that is being
written, or was left half written, does not exist for them. Metadata only, through
the Hadoop file system of the folder.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession

NAME = "_current"


def _path(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, conf, p, p.getFileSystem(conf)


def read_text(spark: SparkSession, path: str) -> str | None:
    """Content of a small file; ``None`` if there is none."""
    jvm, _, p, fs = _path(spark, path)
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    try:
        return jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def read(spark: SparkSession, folder: str) -> dict | None:
    """What the pointer of ``folder`` names; ``None`` if there is none yet."""
    text = read_text(spark, f"{folder}/{NAME}")
    return None if text is None else json.loads(text)


def write(spark: SparkSession, path: str, text: str) -> None:
    """A whole small file; a file that exists is an error."""
    _, _, p, fs = _path(spark, path)
    out = fs.create(p, False)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def switch(spark: SparkSession, folder: str, value: dict) -> None:
    """Replaces the pointer in one rename: readers see the old or the new one."""
    temp = f"{folder}/{NAME}-{uuid.uuid4().hex}.tmp"
    write(spark, temp, json.dumps(value))
    jvm, conf, p, _ = _path(spark, temp)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(p.toUri(), conf)
    overwrite = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
    overwrite[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
    context.rename(p, jvm.org.apache.hadoop.fs.Path(f"{folder}/{NAME}"), overwrite)


def exists(spark: SparkSession, path: str) -> bool:
    _, _, p, fs = _path(spark, path)
    return bool(fs.exists(p))


def children(spark: SparkSession, folder: str) -> list[str]:
    """Names directly below a folder (none if it does not exist)."""
    _, _, p, fs = _path(spark, folder)
    return [st.getPath().getName() for st in fs.listStatus(p)] if fs.exists(p) else []


def delete(spark: SparkSession, path: str) -> None:
    _, _, p, fs = _path(spark, path)
    fs.delete(p, True)
