"""Concatenate and cut: all documents as one token stream, cut at fixed windows.

Pass one encodes every partition and writes its documents with their offsets in
the partition. The partition totals (one row per partition) are summed into
global offsets. Pass two cuts each document where a window ends, so only the
last sequence of the whole corpus is shorter than the window.

Defined cases: a null or empty text is the end id alone; null and repeated ids
are documents of their own; an empty table gives no pieces; extra columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.llm.common import cut, text_of
from shopstream.llm.tokens import BATCH_BYTES, CACHE, encoder
from shopstream.llm.tokens import batches as grouped

ROWS = 1024  # documents whose ids a task holds at a time
_ENCODED = "doc_id long, part int, part_start long, doc_tokens long, ids binary"


def encode(spark: SparkSession, docs: DataFrame, vocabulary: str, end_id: int, *,
           id_col: str = "doc_id", text_col: str = "text", rows: int = ROWS, batch_bytes: int = BATCH_BYTES,
           cache: int = CACHE) -> DataFrame:
    """Pass one: ids of each document (unsigned 32-bit, little-endian) and their place in its partition.

    ``rows`` and ``batch_bytes`` bound the documents that are held and the texts that are
    encoded together, ``cache`` the chunks that a worker remembers; they change memory
    and speed only.
    """
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = encoder(vocabulary, cache)
        part, at = TaskContext.get().partitionId(), 0
        for batch in (whole.slice(k, rows) for whole in batches for k in range(0, whole.num_rows, rows)):
            ids = [x + end for texts in grouped(zip(batch.column(1).to_pylist()), rows, batch_bytes)
                   for x in tokens.encode_batch([text for text, in texts])]
            sizes = [len(x) // 4 for x in ids]
            starts = list(accumulate(sizes, initial=at))
            at = starts.pop()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([part] * len(ids), pa.int32()), pa.array(starts, pa.int64()),
                 pa.array(sizes, pa.int64()), pa.array(ids, pa.binary())],
                names=["doc_id", "part", "part_start", "doc_tokens", "ids"])

    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return cut(spark, texts.mapInArrow(run, _ENCODED), "tokens", compression="zstd")


def offsets(spark: SparkSession, encoded: DataFrame) -> DataFrame:
    """First global token of each partition: prefix sums over one row per partition."""
    totals = encoded.groupBy("part").agg(F.sum("doc_tokens").alias("n")).orderBy("part").collect()
    firsts = accumulate((r["n"] for r in totals), initial=0)
    rows = [(r["part"], first) for r, first in zip(totals, firsts)]
    return spark.createDataFrame(rows, "part int, first long")


def pack(spark: SparkSession, docs: DataFrame, vocabulary: str, end_id: int, *, window: int = 4096,
         id_col: str = "doc_id", text_col: str = "text", **memory: int) -> DataFrame:
    """Pieces of all documents in fixed windows of ``window`` tokens.

    Columns: doc_id, start (tokens of the document before the piece), length,
    ids, doc_tokens, sequence_id, offset (in the sequence), boundary (the piece
    continues in another sequence or continues one). ``memory``: ``rows``,
    ``batch_bytes`` and ``cache`` of ``encode``.
    """
    encoded = encode(spark, docs, vocabulary, end_id, id_col=id_col, text_col=text_col, **memory)
    # one row per partition: a size that the number of tasks bounds
    placed = encoded.join(F.broadcast(offsets(spark, encoded)), "part").withColumn(
        "at", F.col("first") + F.col("part_start"))
    last = F.expr(f"(at + doc_tokens - 1) div {window}")
    cuts = placed.withColumn("sequence_id", F.explode(F.sequence(F.expr(f"at div {window}"), last)))
    begin = F.greatest(F.col("at"), F.col("sequence_id") * window)
    end = F.least(F.col("at") + F.col("doc_tokens"), (F.col("sequence_id") + 1) * window)
    pieces = cuts.withColumns({"begin": begin, "length": end - begin})
    start = F.col("begin") - F.col("at")
    return pieces.select(
        "doc_id", start.alias("start"), "length",
        F.expr("substring(ids, cast((begin - at) * 4 + 1 as int), cast(length * 4 as int))").alias("ids"),
        "doc_tokens", "sequence_id", (F.col("begin") - F.col("sequence_id") * window).alias("offset"),
        (F.col("length") < F.col("doc_tokens")).alias("boundary"))


def sequences(pieces: DataFrame, *, window: int = 4096, pad_id: int = 0) -> DataFrame:
    """Whole sequences of pieces: ids in order, padded to the window unless their number is a power of two.

    A group holds ``window`` tokens at most.
    """
    ordered = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    whole = pieces.groupBy("sequence_id").agg(
        F.sum("length").alias("n_tokens"),
        F.aggregate(ordered, F.lit(b""), lambda acc, p: F.concat(acc, p["ids"])).alias("ids"))
    n = F.col("n_tokens")
    pad = F.when(n.bitwiseAND(n - 1) == 0, 0).otherwise(window - n)
    filler = F.unhex(F.expr(f"repeat('{pad_id.to_bytes(4, 'little').hex()}', cast(n_padding as int))"))
    return whole.withColumn("n_padding", pad).select(
        "sequence_id", "n_tokens", "n_padding", F.concat("ids", filler).alias("ids"))
