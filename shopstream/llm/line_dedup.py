"""Line dedup: lines that many documents share stay in one of them.

Lines are normalised and hashed, documents are counted per hash, lines whose
count reaches the threshold are dropped outside the smallest document that
holds them, and the others are reassembled by position.

Defined cases: a null or empty text is one empty line; a null id counts as one
document that sorts last; rows that share an id are one document; keys shorter
than the least length are never dropped; an empty table gives an empty result;
extra columns pass through untouched,
but for n_lines and n_dropped, which the result replaces.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shopstream.llm.common import BLANKS, text_of, whole


def line_key(line: bytes, least: int) -> bytes | None:
    """128-bit hash of a line without outer blanks, A-Z lowered; None for a key under ``least`` code points."""
    key = line.strip(BLANKS).lower()
    if len(key) < least or len(key) < 4 * least and len(key.decode("utf-8")) < least:
        return None
    return hashlib.md5(key, usedforsecurity=False).digest()


def _line_rows(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                rows = batch.slice(at, 512)
                ids, marks, keys = [], [], []
                for doc_id, mark, text in zip(*(rows.column(k).to_pylist() for k in range(3))):
                    own = {line_key(line, least) for line in text.split(b"\n")} - {None}
                    keys += own
                    ids += [doc_id] * len(own)
                    marks += [mark] * len(own)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(marks, pa.binary()), pa.array(keys, pa.binary())],
                    names=["doc_id", "mark", "line"])
    return run


def shared_lines(lines: DataFrame, threshold: int) -> DataFrame:
    """Hashes of lines that ``threshold`` documents hold, with the smallest document.

    Two nested groupings with partial aggregates: a line in a third of all
    documents shuffles one row per document and then one per task.
    """
    held = lines.groupBy("line", "doc_id").agg(F.lit(1).alias("one"))
    return held.groupBy("line").agg(F.count("*").alias("n_docs"), F.min("doc_id").alias("first_doc")).where(
        F.col("n_docs") >= threshold)


def dedup_lines(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", threshold: int = 2,
                least: int = 10) -> DataFrame:
    """``docs`` with its text replaced by the lines that stay; appends n_lines and n_dropped.

    A line's documents are the rows that share an id. Rows are matched by id
    and digest of the text, so equal rows get equal results.
    """
    docs = docs.drop("n_lines", "n_dropped")
    columns = docs.columns
    keyed = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                        F.unhex(F.md5(text_of(text_col))).alias("mark"), text_of(text_col).alias("text"),
                        whole(docs.drop(text_col)))
    lines = keyed.select("doc_id", "mark", "text").mapInArrow(
        _line_rows(least), "doc_id long, mark binary, line binary")
    shared = shared_lines(lines, threshold)
    drops = (lines.join(shared, "line").where(~F.col("doc_id").eqNullSafe(F.col("first_doc")))
             .groupBy("doc_id", "mark").agg(F.collect_set("line").alias("lines"))
             .withColumnsRenamed({"doc_id": "drop_id", "mark": "drop_mark"}))
    matched = keyed.join(drops, F.col("doc_id").eqNullSafe(F.col("drop_id")) & (F.col("mark") == F.col("drop_mark")),
                         "left").select("row", "text", "lines")

    def reassemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts, n_lines, n_dropped = [], [], []
            for text, drop in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                held = text.split(b"\n")
                gone = set(drop or ())
                kept = [line for line in held if line_key(line, least) not in gone] if gone else held
                texts.append(b"\n".join(kept))
                n_lines.append(len(held))
                n_dropped.append(len(held) - len(kept))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(n_lines, pa.int64()),
                 pa.array(n_dropped, pa.int64())], names=["row", "text", "n_lines", "n_dropped"])

    row_type = docs.drop(text_col).schema.simpleString()
    done = matched.mapInArrow(reassemble, f"row {row_type}, text string, n_lines long, n_dropped long")
    return done.select(*[F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`").alias(c) for c in columns],
                       F.col("n_lines"), F.col("n_dropped"))
