"""Fill-in-middle transformation by secondary sort.

A text is cut into units (blanks and the word after them, or the blanks at its
end) and two unit boundaries drawn from its id part prefix, middle and suffix.
Rearranged documents are emitted as pieces of a bounded number of units, keyed
by document and output position. A shuffle by document with a sort by position
inside each partition (repartitionAndSortWithinPartitions, as the DataFrame API
spells it) streams the pieces in output order into an incremental digest; no
document is assembled in memory. For restoration the same stream is read as a
reader of the output would: the marks are searched in it, across piece ends,
and what lies between them goes out again, keyed by its place in the text. A
second sort brings the text back, digested the same way.

Documents that stay plain are the text itself: they send their digest alone.

Defined cases: null and empty texts are plain, with n 0; a null id is written
as nothing in the seed, so null ids share their cuts; repeated rows are
documents of their own; an empty table gives an empty result; texts of any
length are used whole, and pieces bound what a sort or a digest holds; extra
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.llm.common import text_of

# fixed values: the marks of prefix, suffix and middle, and the order of the segments by form
MARKS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
ORDERS = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
PLACES = {"prefix": 0, "middle": 1, "suffix": 2}  # in the text

UNITS = 8192          # of a piece, at most
PIECE_BYTES = 1 << 18  # of a piece, at most
BATCH_BYTES = 8 << 20  # of the pieces that a task holds before it hands them on
_BLANK = np.zeros(256, bool)
_BLANK[[0x20, *range(0x09, 0x0E)]] = True

PIECE = ("row_id long, at int, part int, doc_id long, n long, form string, prefix_chars long, middle_chars long, "
         "output_sha256 string, restored_sha256 string, piece binary")
_SCHEMA = pa.schema([("row_id", pa.int64()), ("at", pa.int32()), ("part", pa.int32()), ("doc_id", pa.int64()),
                     ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()),
                     ("middle_chars", pa.int64()), ("output_sha256", pa.string()), ("restored_sha256", pa.string()),
                     ("piece", pa.binary())])
_HEAD = -1  # place of a document's first row, which holds its columns and no text


def unit_ends(text: bytes) -> np.ndarray:
    """Byte position after each unit."""
    blank = _BLANK[np.frombuffer(text, np.uint8)]
    if not len(blank):
        return np.zeros(0, np.int64)
    ends = np.flatnonzero(~blank & np.r_[blank[1:], True]) + 1
    return np.r_[ends, len(blank)] if blank[-1] else ends


def draws(doc_id: int | None, seed: int = 42) -> tuple[int, int, int, int]:
    """The four numbers that a document's id draws."""
    found = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    return tuple(int(found[k:k + 8], 16) for k in range(0, 32, 8))


def _chars(text: bytes) -> int:
    return int(np.count_nonzero(np.frombuffer(text, np.uint8) & 0xC0 != 0x80))


def plan(doc_id: int | None, text: bytes, rate: int, spm_rate: int, seed: int) -> tuple[np.ndarray, str, int, int]:
    """(unit ends, form, units of the prefix, units up to the end of the middle)."""
    ends = unit_ends(text)
    h1, h2, h3, h4 = draws(doc_id, seed)
    a, b = sorted((h1 % (len(ends) + 1), h2 % (len(ends) + 1)))
    if not text or h3 % 100 >= rate or any(mark in text for mark in MARKS.values()):
        return ends, "plain", a, b
    return ends, "spm" if h4 % 100 < spm_rate else "psm", a, b


def pieces(text: bytes, ends: np.ndarray, first: int, last: int) -> Iterator[bytes]:
    """Units ``first`` to ``last`` of a text in pieces of ``UNITS`` units and ``PIECE_BYTES`` bytes at most."""
    bounds = np.r_[0, ends]
    for k in range(first, last, UNITS):
        lo, hi = int(bounds[k]), int(bounds[min(last, k + UNITS)])
        for at in range(lo, hi, PIECE_BYTES):
            yield text[at:min(hi, at + PIECE_BYTES)]


class Splitter:
    """Segments of an output that arrives piece by piece, found by their marks."""

    def __init__(self, form: str):
        self.waiting = list(ORDERS[form])
        self.segment: str | None = None
        self.held = b""

    def feed(self, piece: bytes) -> Iterator[tuple[str, bytes]]:
        """(segment, bytes) of what is certain by now; a mark may still be cut off at the end."""
        self.held += piece
        while self.waiting:
            mark = MARKS[self.waiting[0]]
            at = self.held.find(mark)
            if at < 0:
                keep = len(mark) - 1
                if self.segment is not None and len(self.held) > keep:
                    yield self.segment, self.held[:-keep]
                    self.held = self.held[-keep:]
                return
            if at:
                if self.segment is None:
                    raise ValueError("an output starts with a mark")
                yield self.segment, self.held[:at]
            self.segment, self.held = self.waiting.pop(0), self.held[at + len(mark):]
        if self.held:
            yield self.segment, self.held
            self.held = b""


class _Rows:
    """Collects rows of the piece schema and hands them on in bounded batches."""

    def __init__(self):
        self.rows: list[dict] = []
        self.size = 0

    def add(self, row: dict) -> None:
        self.rows.append(row)
        self.size += 200 + len(row.get("piece") or b"")

    def full(self) -> bool:
        return self.size >= BATCH_BYTES

    def take(self) -> pa.RecordBatch:
        rows, self.rows, self.size = self.rows, [], 0
        return pa.RecordBatch.from_pylist(rows, schema=_SCHEMA)


def _emit(rate: int, spm_rate: int, seed: int):
    """Texts to pieces in output order, with a head row per document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Rows()
        for batch in batches:
            for row_id, doc_id, text in zip(*(batch.column(k) for k in range(3))):
                row_id, doc_id, text = row_id.as_py(), doc_id.as_py(), text.as_py()
                ends, form, a, b = plan(doc_id, text, rate, spm_rate, seed)
                head = {"row_id": row_id, "at": _HEAD, "part": 0, "doc_id": doc_id, "n": len(ends), "form": form}
                if form == "plain":
                    digest = hashlib.sha256(text).hexdigest()
                    out.add({**head, "output_sha256": digest, "restored_sha256": digest})
                else:
                    bounds = [0, *(int(ends[k - 1]) if k else 0 for k in (a, b)), len(text)]
                    out.add({**head, "prefix_chars": _chars(text[:bounds[1]]),
                             "middle_chars": _chars(text[bounds[1]:bounds[2]])})
                    units = {"prefix": (0, a), "middle": (a, b), "suffix": (b, len(ends))}
                    at = 0
                    for segment in ORDERS[form]:
                        out.add({"row_id": row_id, "at": at, "part": 0, "piece": MARKS[segment]})
                        for piece in pieces(text, ends, *units[segment]):
                            at += 1
                            out.add({"row_id": row_id, "at": at, "part": 0, "piece": piece})
                            if out.full():
                                yield out.take()
                        at += 1
                if out.full():
                    yield out.take()
        if out.rows:
            yield out.take()

    return run


def _streamed(begin: Callable, step: Callable, end: Callable):
    """Runs documents of rows sorted by document and place: head, then its pieces."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, state = _Rows(), None
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                for row in batch.slice(at, 64).to_pylist():
                    if row["at"] == _HEAD:
                        if state is not None:
                            end(state, out)
                        state = begin(row)
                    else:
                        step(state, row["piece"], out)
                    if out.full():
                        yield out.take()
        if state is not None:
            end(state, out)
        if out.rows:
            yield out.take()

    return run


def _assemble():
    """Output digests; what the marks part goes on, keyed by its place in the text."""

    def begin(head):
        if head["form"] == "plain":
            return head, None, None, None
        return head, hashlib.sha256(), Splitter(head["form"]), dict.fromkeys(PLACES, 0)

    def step(state, piece, out):
        head, digest, splitter, counts = state
        digest.update(piece)
        for segment, body in splitter.feed(piece):
            out.add({"row_id": head["row_id"], "at": PLACES[segment], "part": counts[segment], "piece": body})
            counts[segment] += 1

    def end(state, out):
        head, digest, splitter, _ = state
        if digest is not None:
            if splitter.waiting:
                raise ValueError("an output ends before its last mark")
            head = {**head, "output_sha256": digest.hexdigest()}
        out.add(head)

    return _streamed(begin, step, end)


def _restore():
    """Digests of the texts from their segments in order."""

    def begin(head):
        return head, hashlib.sha256()

    def step(state, piece, out):
        state[1].update(piece)

    def end(state, out):
        head, digest = state
        out.add(head if head["restored_sha256"] else {**head, "restored_sha256": digest.hexdigest()})

    return _streamed(begin, step, end)


def arranged(docs: DataFrame, *, rate: int = 50, spm_rate: int = 80, seed: int = 42, id_col: str = "doc_id",
             text_col: str = "text") -> DataFrame:
    """Pieces of all documents, each partition in output order: concatenated by row_id and ``at``, the outputs."""
    texts = docs.select(F.monotonically_increasing_id().alias("row_id"),
                        F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    emitted = texts.mapInArrow(_emit(rate, spm_rate, seed), PIECE)
    return emitted.repartition("row_id").sortWithinPartitions("row_id", "at")


def outputs(docs: DataFrame, **options) -> DataFrame:
    """Transformed texts as rows: row_id, doc_id, form, text (plain documents unchanged).

    This one builds whole texts, a document at a time.
    """
    id_col, text_col = options.get("id_col", "doc_id"), options.get("text_col", "text")
    rate, spm_rate, seed = options.get("rate", 50), options.get("spm_rate", 80), options.get("seed", 42)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            forms, texts = [], []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                ends, form, a, b = plan(doc_id, text, rate, spm_rate, seed)
                units = {"prefix": (0, a), "middle": (a, b), "suffix": (b, len(ends))}
                forms.append(form)
                texts.append(text if form == "plain" else b"".join(
                    part for s in ORDERS[form] for part in (MARKS[s], *pieces(text, ends, *units[s]))))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(forms), pa.array(texts, pa.binary()).cast(
                pa.string())], names=["doc_id", "form", "text"])

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, form string, text string")


def round_trip(spark: SparkSession, docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    segments = arranged(docs, **options).mapInArrow(_assemble(), PIECE)
    restored = segments.repartition("row_id").sortWithinPartitions("row_id", "at", "part").mapInArrow(_restore(), PIECE)
    return restored.select("doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256")
