"""Token-id files with bit-plane shuffling.

Layout of a file (little-endian): magic; blocks; index. A block holds a fixed
number of ids, transposed into byte planes (or bit planes), each plane
compressed with zstandard; a plane of zeros takes no bytes. The index has the
place and plane sizes of each block and (id, first token, tokens) of each
document, so that a reader can fetch one document's blocks alone.

Files follow ascending document id: the table is range-partitioned and sorted
by id, one file per partition. Every task attempt writes a file of its own name
and returns a manifest row; the manifest, written as a table, names the files
that count, so a lost executor or repeated task leaves nothing half done.

Defined cases: a null or empty text is the end id alone; null ids come first;
rows of one id keep some order and are documents of their own; an empty table
gives no files; extra columns are ignored.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.llm.common import cut, open_store, shared_folder, text_of
from shopstream.llm.tokens import batches as grouped
from shopstream.llm.tokens import encoder
from shopstream.session import new_run_dir

MAGIC = b"IDPLANE1"
BLOCK = 1 << 16
MANIFEST = "part int, path string, n_docs long, n_tokens long, bytes long"
_NULL_ID = -(1 << 63)


def shuffle_block(ids: np.ndarray, bits: bool = False) -> list[bytes]:
    """Planes of a block: 4 byte planes, or 32 bit planes, lowest first."""
    planes = np.ascontiguousarray(ids.astype("<u4")).view(np.uint8).reshape(-1, 4).T
    if not bits:
        return [p.tobytes() if p.any() else b"" for p in planes]
    out = []
    for p in planes:
        for bit in range(8):
            one = (p >> bit) & 1
            out.append(np.packbits(one).tobytes() if one.any() else b"")
    return out


def unshuffle_block(planes: list[bytes], n: int) -> np.ndarray:
    """The ids of ``shuffle_block``'s planes."""
    out = np.zeros((n, 4), np.uint8)
    if len(planes) == 4:
        for k, p in enumerate(planes):
            if p:
                out[:, k] = np.frombuffer(p, np.uint8)
    else:
        for k, p in enumerate(planes):
            if p:
                out[:, k // 8] |= np.unpackbits(np.frombuffer(p, np.uint8), count=n) << (k % 8)
    return out.view("<u4").ravel()


class FileWriter:
    """Streams ids into one file; holds a block and the index."""

    def __init__(self, sink, bits: bool = False, level: int = 3):
        import zstandard

        self.sink, self.bits = sink, bits
        self.compress = zstandard.ZstdCompressor(level=level).compress
        self.at = sink.write(MAGIC) and len(MAGIC)
        self.waiting: list[np.ndarray] = []
        self.n_waiting = self.n_tokens = 0
        self.blocks: list[bytes] = []
        self.docs: list[tuple[int, int, int]] = []

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.docs.append((_NULL_ID if doc_id is None else doc_id, self.n_tokens, len(ids) // 4))
        self.n_tokens += len(ids) // 4
        self.waiting.append(np.frombuffer(ids, "<u4"))
        self.n_waiting += len(ids) // 4
        if self.n_waiting >= BLOCK:
            ready = np.concatenate(self.waiting)
            whole = len(ready) // BLOCK * BLOCK
            for k in range(0, whole, BLOCK):
                self._block(ready[k:k + BLOCK])
            self.waiting, self.n_waiting = [ready[whole:].copy()], len(ready) - whole

    def _block(self, ids: np.ndarray) -> None:
        planes = [self.compress(p) if p else b"" for p in shuffle_block(ids, self.bits)]
        self.blocks.append(struct.pack(f"<QI{len(planes)}I", self.at, len(ids), *map(len, planes)))
        for p in planes:
            self.sink.write(p)
            self.at += len(p)

    def close(self) -> int:
        if self.n_waiting:
            self._block(np.concatenate(self.waiting))
        index = np.array(self.docs, "<i8").reshape(-1, 3).tobytes()
        head = struct.pack("<QIIQ", self.at, len(self.blocks), 32 if self.bits else 4, len(self.docs))
        body = b"".join(self.blocks) + index
        self.sink.write(body + head + struct.pack("<I", zlib.crc32(body + head)) + MAGIC)
        return self.at + len(body) + len(head) + 4 + len(MAGIC)


class FileReader:
    """Reads documents of one file in order, a block at a time."""

    TAIL = 24 + 4 + len(MAGIC)

    def __init__(self, source, size: int):
        import zstandard

        self.source = source
        self.expand = zstandard.ZstdDecompressor().decompress
        source.seek(size - self.TAIL)
        tail = source.read(self.TAIL)
        at, n_blocks, n_planes, n_docs = struct.unpack("<QIIQ", tail[:24])
        source.seek(at)
        body = source.read(size - self.TAIL - at)
        if tail[28:] != MAGIC or zlib.crc32(body + tail[:24]) != struct.unpack("<I", tail[24:28])[0]:
            raise ValueError("the index of a token-id file is damaged")
        width = 12 + 4 * n_planes
        self.blocks = [struct.unpack(f"<QI{n_planes}I", body[k * width:(k + 1) * width]) for k in range(n_blocks)]
        self.docs = np.frombuffer(body, "<i8", 3 * n_docs, n_blocks * width).reshape(-1, 3)

    def block(self, k: int) -> np.ndarray:
        at, n, *sizes = self.blocks[k]
        self.source.seek(at)
        planes = [self.expand(self.source.read(size)) if size else b"" for size in sizes]
        return unshuffle_block(planes, n)

    def documents(self) -> Iterator[tuple[int | None, int, bytes]]:
        """(doc id, tokens of the file before it, ids) in file order."""
        held, first, k = np.zeros(0, "<u4"), 0, 0
        for doc_id, start, n in self.docs.tolist():
            pieces = [held[start - first:start - first + n]]
            while sum(map(len, pieces)) < n:
                first, held = first + len(held), self.block(k)
                k += 1
                pieces.append(held[:n - sum(map(len, pieces))])
            yield None if doc_id == _NULL_ID else doc_id, start, np.concatenate(pieces).tobytes()


def write_files(spark: SparkSession, docs: DataFrame, vocabulary: str, end_id: int, *, out_dir: str | None = None,
                bits: bool = False, level: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode and write all documents in ascending id; returns the manifest."""
    out_dir = shared_folder(spark, out_dir or new_run_dir(spark, "llm-token-files"))
    end = end_id.to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens, part = encoder(vocabulary), TaskContext.get().partitionId()
        store, folder = open_store(out_dir)
        path = f"{folder}/part-{part:06d}-{uuid.uuid4().hex}.ids"
        sink = writer = None
        for batch in batches:
            if writer is None and batch.num_rows:
                store.create_dir(folder, recursive=True)
                sink = store.open_output_stream(path, compression=None)
                writer = FileWriter(sink, bits, level)
            for rows in grouped(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                for (doc_id, _), ids in zip(rows, tokens.encode_batch([text for _, text in rows])):
                    writer.add(doc_id, ids + end)
        if writer is not None:
            size = writer.close()
            sink.close()
            yield pa.RecordBatch.from_pylist([{
                "part": part, "path": f"{out_dir}/{path.rsplit('/', 1)[1]}", "n_docs": len(writer.docs),
                "n_tokens": writer.n_tokens, "bytes": size}], schema=pa.schema([
                    ("part", pa.int32()), ("path", pa.string()), ("n_docs", pa.int64()),
                    ("n_tokens", pa.int64()), ("bytes", pa.int64())]))

    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    ordered = texts.repartitionByRange(F.col("doc_id").asc_nulls_first()).sortWithinPartitions(
        F.col("doc_id").asc_nulls_first())
    return cut(spark, ordered.mapInArrow(run, MANIFEST), "token-manifest")


def read_files(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """Documents of all files: doc_id, start (ids of all documents before it), n_tokens, ids.

    The manifest has one row per file, a number that the tasks bound; a prefix
    sum over it gives each file's first id. One task reads one file.
    """
    files = manifest.orderBy("part").collect()
    firsts = accumulate((f["n_tokens"] for f in files), initial=0)
    rows = [(f["path"], first, f["bytes"]) for f, first in zip(files, firsts)]
    listed = spark.createDataFrame(rows, "path string, first long, bytes long")
    if rows:
        listed = listed.repartitionByRange(len(rows), "path")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()),
                            ("ids", pa.binary())])
        for batch in batches:
            for f in batch.to_pylist():
                store, path = open_store(f["path"])
                with store.open_input_file(path) as source:
                    held, size = [], 0
                    for doc_id, start, ids in FileReader(source, f["bytes"]).documents():
                        held.append((doc_id, f["first"] + start, len(ids) // 4, ids))
                        size += len(ids)
                        if size > 8 << 20:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(
                                zip(*held), schema)], schema=schema)
                            held, size = [], 0
                    if held:
                        yield pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(
                            zip(*held), schema)], schema=schema)

    return listed.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")
