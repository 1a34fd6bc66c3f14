"""SimHash near-dedup with bit-sliced comparison.

A document's fingerprint has bit b set when more than half of its shingle
hashes have it. Two fingerprints link when they differ in at most ``radius``
bits. Distinct fingerprints are cut into ``radius + 2`` bit fields; two linked
ones agree on at least two fields, so all links lie within buckets of an equal
pair of fields. No link is lost, whatever the data.

Buckets are compared by task: a run of sorted fingerprints is stored as 64 bit
planes (bit vectors over the run), and one shift of a plane against itself
compares every fingerprint with the one s places on. Carry-save counters, one
bit vector per binary digit, add the differing planes of all pairs at once. A
block whose pairs all passed the radius is abandoned. A bucket beyond
``cell`` fingerprints is split into pairs of cells for many tasks. Tasks return
a spanning forest of their links, never all pairs.

Defined cases: a text without words (or null) has fingerprint zero, which links
like any other; null ids sort last within a component (component_id is null when
every id is null); repeated rows share their result; an empty table gives an
empty result; extra columns are ignored, or carried unchanged by ``dedup``.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.llm.common import cut, hold, text_of, unpack, whole
from shopstream.llm.components import components

_WORDS = 1 << 12  # words of 64 pairs that are compared at once


def shingle_hashes(text: bytes, size: int, seed: int) -> np.ndarray:
    words = text.lower().split()  # ASCII letters and ASCII blanks only
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    digest = xxhash.xxh64_intdigest
    if len(words) <= size:
        return np.array([digest(joined, seed)], np.uint64)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-size] + 1]).tolist()
    return np.array([digest(joined[s:e], seed) for s, e in zip(starts, ends[size - 1:].tolist())], np.uint64)


def fingerprint(text: bytes, size: int = 3, seed: int = 42) -> int:
    hashes = shingle_hashes(text, size, seed)
    n = len(hashes)
    if not n:
        return 0
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[at:at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1,
                             bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(text: Column, size: int, seed: int) -> Column:
    """Fingerprints (as signed 64-bit) of a column of text bytes."""

    @F.pandas_udf("long")
    def prints(texts: pd.Series) -> pd.Series:
        hold("simhash", lambda: None)
        found = np.fromiter((fingerprint(t, size, seed) for t in texts), np.uint64, len(texts))
        return pd.Series(found.view(np.int64))

    return prints(text)


# ------------------------------------------------------------- bit-sliced links
def bit_planes(values: np.ndarray, words: int) -> np.ndarray:
    """64 bit vectors over the values: plane b holds bit b of each, one lane per value."""
    padded = np.zeros(words * 64, np.uint64)
    padded[:len(values)] = values
    out = np.empty((64, words), np.uint64)
    for b in range(64):
        out[b] = np.packbits(((padded >> np.uint64(b)) & np.uint64(1)).astype(np.uint8),
                             bitorder="little").view("<u8")
    return out


def near_lanes(planes: np.ndarray, shifts: np.ndarray, valid: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(lanes i, shifts s) where value i differs from value i + s in at most ``radius`` bits.

    Row k of ``valid`` is the bit vector of the lanes that shift ``shifts[k]``
    concerns. The counters start so that their overflow marks the first
    difference too many. After every eight planes the words whose lanes have
    all passed the radius are abandoned, and the rest goes on without them.
    """
    digits = int(radius + 1).bit_length()
    begin = (1 << digits) - 1 - radius
    row, at = np.nonzero(valid)
    over, shift = ~valid[row, at], shifts[row]
    skip, rest = at + shift // 64, (shift % 64).astype(np.uint64)
    counters = [np.full(len(at), ~np.uint64(0) if begin >> k & 1 else np.uint64(0)) for k in range(digits)]
    for b in range(64):
        plane = planes[b]
        carry = plane[at] ^ (plane[skip] >> rest | plane[skip + 1] << np.uint64(1) << np.uint64(63) - rest)
        for k in range(digits):
            counters[k], carry = counters[k] ^ carry, counters[k] & carry
        over |= carry
        if b % 8 == 7:
            live = np.flatnonzero(~over)
            if len(live) < len(at):
                at, skip, rest, shift, over = at[live], skip[live], rest[live], shift[live], over[live]
                counters = [c[live] for c in counters]
            if not len(at):
                return at, shift
    bits = np.unpackbits((~over).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    word, lane = np.nonzero(bits)
    return at[word] * 64 + lane, shift[word]


def _find(parent: np.ndarray, nodes: np.ndarray) -> np.ndarray:
    roots = parent[nodes]
    while True:
        up = parent[roots]
        if np.array_equal(up, roots):
            parent[nodes] = roots
            return roots
        roots = up


def _unite(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Joins the sets of i[k] and j[k] for all k; the smallest position of a set is its root."""
    while len(i):
        ri, rj = _find(parent, i), _find(parent, j)
        apart = ri != rj
        i, j = i[apart], j[apart]
        if len(i):
            np.minimum.at(parent, np.maximum(ri[apart], rj[apart]), np.minimum(ri[apart], rj[apart]))


def forest(values: np.ndarray, groups: np.ndarray, sides: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within each group: (value, another value of its set) pairs.

    Rows of a group must be adjacent. Rows of side 0 are compared with each
    other, rows of side 1 with rows of side 2.
    """
    starts = np.flatnonzero(np.r_[True, groups[1:] != groups[:-1]]) if len(groups) else np.zeros(0, np.int64)
    sizes = np.diff(np.r_[starts, len(groups)])
    # larger groups first: the rows that a shift concerns are then a prefix
    by_size = np.argsort(-sizes, kind="stable")
    by_size = by_size[sizes[by_size] > 1]
    sizes, starts = sizes[by_size], starts[by_size]
    ends = np.cumsum(sizes)
    n = int(ends[-1]) if len(ends) else 0
    order = np.arange(n) + np.repeat(starts - (ends - sizes), sizes)
    values, sides, last = values[order], sides[order], np.repeat(ends, sizes)
    lanes = np.arange(n)
    parent = np.arange(n)
    planes = bit_planes(values, 2 * (-(-n // 64)) + 2)
    shift, most = 1, int(sizes[0]) if n else 0
    while shift < most:
        reach = int(ends[np.searchsorted(-sizes, -shift) - 1])  # the groups of more than ``shift`` rows
        words = -(-reach // 64)
        shifts = np.arange(shift, min(most, shift + max(1, _WORDS // words)))
        roots = _find(parent, lanes)
        valid = np.zeros((len(shifts), words * 64), bool)
        for k, s in enumerate(shifts.tolist()):
            # pairs that one set already holds need no comparison
            inside = np.flatnonzero(lanes[:reach] + s < last[:reach])
            apart = roots[inside] != roots[inside + s]
            apart &= (sides[inside] == 0) | (sides[inside] != sides[inside + s])
            valid[k, inside[apart]] = True
        found, s = near_lanes(planes, shifts, np.packbits(valid, axis=1, bitorder="little").view("<u8"), radius)
        _unite(parent, found, found + s)
        shift += len(shifts)
    roots = _find(parent, np.arange(n))
    linked = roots != np.arange(n)
    return values[linked], values[roots[linked]]


def _link_rows(radius: int, held_rows: int = 1 << 17):
    """Links of sorted (bucket, i, j, side, print) rows; only whole groups are compared."""

    def links(rows: list[np.ndarray]) -> pa.RecordBatch:
        bucket, i, j, side, value = rows
        change = (bucket[1:] != bucket[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        group = np.r_[0, np.cumsum(change)] if len(bucket) else np.zeros(0, np.int64)
        a, b = forest(value.view(np.uint64), group, side, radius)
        return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []
        n = 0
        for batch in batches:
            held.append([batch.column(k).to_numpy(zero_copy_only=False) for k in range(5)])
            n += batch.num_rows
            if n < held_rows:
                continue
            rows = [np.concatenate(c) for c in zip(*held)]
            same = (rows[0] == rows[0][-1]) & (rows[1] == rows[1][-1]) & (rows[2] == rows[2][-1])
            stop = n - int(same.sum())
            if stop:
                yield links([c[:stop] for c in rows])
            held, n = [[c[stop:] for c in rows]], n - stop
        if n:
            yield links([np.concatenate(c) for c in zip(*held)])

    return run


def links(spark: SparkSession, prints: DataFrame, radius: int, *, cell: int = 8192) -> DataFrame:
    """Spanning links (a, b) among the distinct fingerprints of ``prints.fp``.

    Every bucket is an equal pair of ``radius + 2`` bit fields. A bucket of
    more than ``cell`` fingerprints is dealt out as pairs of its cells.
    """
    fields = radius + 2
    edges = [64 * k // fields for k in range(fields + 1)]
    field = [F.shiftrightunsigned("fp", lo).bitwiseAND((1 << hi - lo) - 1) for lo, hi in zip(edges, edges[1:])]
    width = max(hi - lo for lo, hi in zip(edges, edges[1:]))
    keys = [F.lit(k << 2 * width).cast("long").bitwiseOR(F.shiftleft(field[a], width)).bitwiseOR(field[b])
            for k, (a, b) in enumerate(combinations(range(fields), 2))]
    rows = prints.select("fp", F.explode(F.array(*keys)).alias("bucket"))
    large = cut(spark, rows.groupBy("bucket").count().where(F.col("count") > cell)
                .select("bucket", F.ceil(F.col("count") / cell).cast("int").alias("cells")), "large-buckets")
    mine = F.pmod(F.xxhash64("fp", F.lit(7)), F.col("cells")).cast("int")
    dealt = rows.join(large, "bucket", "left").select(
        "bucket", "fp", F.coalesce(mine, F.lit(0)).alias("mine"),
        F.explode(F.sequence(F.lit(0), F.coalesce("cells", F.lit(1)) - 1)).alias("other"))
    side = F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2)
    cells = dealt.select("bucket", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                         side.alias("side"), "fp")
    return cells.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").mapInArrow(
        _link_rows(radius), "a long, b long")


def classes(spark: SparkSession, prints: DataFrame, radius: int) -> DataFrame:
    """(fp, root) for every distinct fingerprint of ``prints``: root names its component."""
    distinct = cut(spark, prints.select("fp").distinct(), "fingerprints")
    found = components(spark, links(spark, distinct, radius))
    return distinct.join(found, F.col("fp") == F.col("node"), "left").select(
        "fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(spark: SparkSession, docs: DataFrame, *, shingle: int = 3, radius: int = 3, seed: int = 42,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hex digits), component_id (least id of its component)."""
    rows = cut(spark, docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                                  fingerprints(text_of(text_col), shingle, seed).alias("fp")), "prints")
    least = rows.groupBy("fp").agg(F.min("doc_id").alias("least"))
    rooted = cut(spark, least.join(classes(spark, rows, radius), "fp"), "roots")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    by_print = rooted.join(smallest, "root").select("fp", "component_id")
    return rows.join(by_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def dedup(spark: SparkSession, docs: DataFrame, *, shingle: int = 3, radius: int = 3, seed: int = 42,
          id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows that stay, whole and unchanged: of each component the least id (then any one of its rows)."""
    rows = cut(spark, docs.select(whole(docs), F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                                  fingerprints(text_of(text_col), shingle, seed).alias("fp"),
                                  F.monotonically_increasing_id().alias("row_id")), "prints-rows")
    order = F.struct(F.col("doc_id").isNull().alias("unknown"), "doc_id", "row_id")
    least = rows.groupBy("fp").agg(F.min(order).alias("least"))
    rooted = least.join(classes(spark, rows, radius), "fp")
    stay = rooted.groupBy("root").agg(F.min("least").alias("least")).select(F.col("least.row_id").alias("row_id"))
    return unpack(rows.join(stay, "row_id", "left_semi"), docs.columns)
