"""Exact dedup by content sort.

Texts are normalised (blanks deleted) and range-partitioned by sampled
splitters over their normalised bytes; an external sort inside each partition
places equals side by side, and neighbours are compared in full. The sort key
is the first 64 normalised bytes, then a 64-bit hash of all of them, then the
order of preference among equals: the splitters stay small whatever the length
of the texts, and a group of copies may span any number of partitions. Texts
that agree in prefix and hash are still compared byte by byte.

A run is a stretch of equal texts in one partition; its rows find their group by
the run they are in. Only the first and the last text of a partition can go on
in another one: these runs, about two a partition, meet on the driver.

Defined cases: a null text counts as empty; of equal texts the row with the
most code points stays, then the smallest id (nulls last), then any one of
equal rows; an empty table gives an empty result; extra columns are ignored, or
carried unchanged by ``dedup``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shopstream.llm.common import BLANKS, cut, hold, text_of, unpack, whole

PREFIX = 64


def normalise(text: bytes) -> bytes:
    return text.translate(None, BLANKS)


@F.pandas_udf(T.StructType().add("prefix", T.BinaryType()).add("hash", T.LongType()))
def _sort_key(texts: pd.Series) -> pd.DataFrame:
    hold("content", lambda: None)
    plain = [normalise(t) for t in texts]
    return pd.DataFrame({"prefix": [t[:PREFIX] for t in plain],
                         "hash": np.array([xxhash.xxh64_intdigest(t) for t in plain], np.uint64).view(np.int64)})


def sorted_by_content(docs: DataFrame, id_col: str, text_col: str, carry: bool) -> DataFrame:
    """Rows in content order: equal texts side by side, the one to keep first."""
    text = text_of(text_col)
    keyed = docs.select(_sort_key(text).alias("key"), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                        F.length(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))).alias("n_chars"),
                        text.alias("text"), *([whole(docs)] if carry else []))
    order = [F.col("key.prefix"), F.col("key.hash"), F.col("n_chars").desc(), F.col("doc_id").asc_nulls_last()]
    return keyed.repartitionByRange(*order).sortWithinPartitions(*order)


def runs(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", heads_only: bool = False) -> DataFrame:
    """Runs of equal neighbours, one row per document (or per run, with its whole row).

    Columns: doc_id, n_chars, text_sha256, row_id (rises in content order),
    run_id (row_id of the first of the run), first and last (the run's text
    may begin or end its partition, so another one may hold more of it).
    ``last`` is told on an own row without a document, which the end of a
    partition adds for each such run.
    """
    ordered = sorted_by_content(docs, id_col, text_col, heads_only)
    row_type = f", row {docs.schema.simpleString()}" if heads_only else ""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at = TaskContext.get().partitionId() << 36
        group, first_group = None, None
        seen: dict[bytes, tuple[str, int]] = {}  # texts of one (prefix, hash): one, but for a collision
        for batch in batches:
            keys = batch.column(0)
            prefixes, hashes = keys.field(0).to_pylist(), keys.field(1).to_pylist()
            texts = batch.column(3).to_pylist()
            shas, row_ids, run_ids, firsts, heads = [], [], [], [], []
            for k, (prefix, hashed, text) in enumerate(zip(prefixes, hashes, texts)):
                if (prefix, hashed) != group:
                    group, seen = (prefix, hashed), {}
                    first_group = first_group or group
                plain = normalise(text)
                known = seen.get(plain)  # compares the bytes in full
                if known is None:
                    known = seen[plain] = (hashlib.sha256(plain).hexdigest(), at)
                    heads.append(k)
                shas.append(known[0])
                run_ids.append(known[1])
                firsts.append(group == first_group)
                row_ids.append(at)
                at += 1
            columns = {"doc_id": batch.column(1), "n_chars": batch.column(2),
                       "text_sha256": pa.array(shas, pa.string()), "row_id": pa.array(row_ids, pa.int64()),
                       "run_id": pa.array(run_ids, pa.int64()), "first": pa.array(firsts, pa.bool_()),
                       "last": pa.array([False] * len(shas), pa.bool_())}
            if heads_only:
                columns["row"] = batch.column(4)
            out = pa.RecordBatch.from_pydict(columns)
            schema = out.schema
            yield out.take(pa.array(heads, pa.int64())) if heads_only else out
        if group is not None:
            marks = [{"text_sha256": sha, "run_id": run_id, "last": True} for sha, run_id in seen.values()]
            yield pa.RecordBatch.from_pylist(marks, schema=schema)

    return ordered.mapInArrow(
        run, "doc_id long, n_chars int, text_sha256 string, row_id long, run_id long, first boolean, last boolean"
             + row_type)


def parted(rows: DataFrame) -> dict[str, list[int]]:
    """Runs of each text that several partitions hold, in content order.

    The rows that reach the driver are two a partition (more only where two
    texts share prefix and hash), a number that the tasks bound.
    """
    edges = rows.where("last or (first and row_id = run_id)").select("text_sha256", "run_id").distinct().collect()
    found: dict[str, list[int]] = {}
    for sha, run_id in sorted(map(tuple, edges), key=lambda e: e[1]):
        found.setdefault(sha, []).append(run_id)
    return {sha: ids for sha, ids in found.items() if len(ids) > 1}


def decisions(spark: SparkSession, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Group sizes are those of runs. A run lies in one partition, so no run has
    more rows than a partition, whatever the size of its group.
    """
    marked = cut(spark, runs(docs, id_col=id_col, text_col=text_col), "content-runs")
    rows = marked.where("not last")
    joined = [(run_id, ids[0]) for ids in parted(marked).values() for run_id in ids]
    lead = spark.createDataFrame(joined, "run_id long, lead_run long")  # two rows a partition
    sizes = rows.groupBy("run_id").agg(F.count("*").alias("n"),
                                       F.min(F.when(F.col("row_id") == F.col("run_id"), F.col("doc_id"))).alias("head"))
    alone = sizes.where("n > 1").join(F.broadcast(lead), "run_id", "left_anti").select(
        "run_id", F.col("n").alias("group_size"), F.col("head").alias("keep_id"), F.col("run_id").alias("lead_run"))
    spread = cut(spark, sizes.join(F.broadcast(lead), "run_id"), "content-spread")
    totals = spread.groupBy("lead_run").agg(
        F.sum("n").alias("group_size"), F.min(F.when(F.col("run_id") == F.col("lead_run"), F.col("head"))).alias("keep_id"))
    groups = alone.unionByName(spread.select("run_id", "lead_run").join(totals, "lead_run"))
    in_group = F.col("group_size").isNotNull()
    return rows.join(groups, "run_id", "left").select(
        "doc_id", F.when(in_group, F.col("keep_id")).otherwise(F.col("doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.when(in_group, F.col("row_id") == F.col("lead_run")).otherwise(True).alias("kept"), "text_sha256")


def dedup(spark: SparkSession, docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, whole and unchanged.

    Only the first of a run goes on, so copies end in the sorting task. Of a text
    that several partitions hold, the first run's head stays: at most a row or two
    per partition are dropped for that, and these are broadcast.
    """
    heads = cut(spark, runs(docs, id_col=id_col, text_col=text_col, heads_only=True), "content-heads")
    again = spark.createDataFrame([(run_id,) for ids in parted(heads).values() for run_id in ids[1:]], "run_id long")
    stay = heads.where("not last").join(F.broadcast(again), "run_id", "left_anti")
    return unpack(stay, docs.columns)
