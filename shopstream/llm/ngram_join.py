"""N-gram Jaccard join with token-combination prefixes.

A document is its set of distinct word shingles ("tokens" below). Two documents
link when 100 * intersection >= percent * union; then each lacks at most
``n - ceil(n * percent / 100)`` tokens of the other. Tokens have a global order,
rarest first, and every document indexes a prefix of its tokens:

* a rare token is a signature by itself: a prefix of one token more than the
  allowed misses must share one;
* frequent tokens are dealt into classes by their hash, and a class of c tokens
  yields its k-token combinations (k = 2, or 3 for the most frequent): c - k + 1
  misses are needed to break them all, so the prefix is extended until the
  classes together need more misses than allowed. Classes hold a few tokens
  each, so the combinations grow with the prefix, not with its square.

Two linked documents therefore share a signature, whatever the order. Which
tokens are frequent is counted over the whole corpus, on the tokens whose hash is
0 modulo ``COUNTED``; these come first in the order, so a prefix rarely needs
others. The most frequent ones, ``TABLE`` at most, reach the tasks; a token
beyond the table counts as rare, which costs comparisons, never a link.

Documents of equal sets are one node. Within the nodes of a signature, sizes and
parity bitmaps (their Hamming distance is a lower bound of the symmetric
difference) rule pairs out; of the pairs that remain a spanning forest is
verified on the whole sets. Only where a verified pair turned out not to link
are the remaining pairs between different components compared: a few for each
node are listed and verified likewise; where there are more, the whole sets of a
signature meet, which gives a spanning forest of links, fewer rows than nodes.
Signatures of many nodes are dealt out as pairs of cells; no pair list of a large
group is written.

Defined cases: null and empty texts have no tokens, n_shingles 0, and link with
nothing; null ids sort last within a component (component_id is null when every
id is null); repeated rows share their result; an empty table gives an empty
result; extra columns are ignored. Texts of any length are used whole. Shingles
are compared as 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.llm.common import cut, join_classes, text_of
from shopstream.llm.components import components
from shopstream.llm.decontaminate import FILTER_BITS, _passes, seed_filter
from shopstream.llm.text_runs import ODD, mix, words
from shopstream.llm.tokens import batches as grouped

COUNTED = 4            # one token in so many has its documents counted
TABLE = 250_000        # frequent tokens that reach the tasks, at most
PAIRS_FROM = 7         # tokens of 2**7 documents or more are indexed in pairs
TRIPLES_FROM = 14      # and those of 2**14 or more in triples
SHORT = 64             # smaller sets index single tokens only
PER_CLASS = {2: 4, 3: 6}  # tokens of a full prefix in a class of pairs, of triples
BITMAP_BITS = 4096     # of a bitmap, at most; it has one bit per token up to that
CELL = 4096            # nodes of a signature that one task compares with each other
LISTED = 8             # pairs for each node of a signature that are listed, at most
CELL_BYTES = 32 << 20  # of whole sets in a cell, where they are compared


def token_sets(texts: list[bytes], size: int = 3) -> list[np.ndarray]:
    """Sorted hashes of the distinct shingles of each text; the whole sequence if it has fewer words."""
    own, bounds = words(texts)
    grams = np.full(max(0, len(own) - size + 1), size, np.uint64)
    for k in range(size):
        grams = mix(grams * ODD + own[k:len(own) - size + 1 + k])
    out = []
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if hi - lo >= size:
            out.append(np.unique(grams[lo:hi - size + 1]))
            continue
        whole = np.full(min(1, hi - lo), hi - lo, np.uint64)
        for k in range(lo, hi):
            whole = mix(whole * ODD + own[k])
        out.append(whole)
    return out


def digest(tokens: np.ndarray) -> tuple[int, int]:
    """128-bit name of a set, as two signed 64-bit integers."""
    found = hashlib.md5(tokens.tobytes(), usedforsecurity=False).digest()
    return int.from_bytes(found[:8], "little", signed=True), int.from_bytes(found[8:], "little", signed=True)


def bitmap(tokens: np.ndarray) -> bytes:
    """Parity of the tokens in each of 64 to ``BITMAP_BITS`` places."""
    bits = min(BITMAP_BITS, max(64, 1 << max(0, len(tokens) - 1).bit_length()))
    places = (tokens & np.uint64(bits - 1)).astype(np.int64)
    return np.packbits((np.bincount(places, minlength=bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def allowed_misses(n: int, percent: int) -> int:
    """Tokens of a set of ``n`` that a linked set may lack."""
    return n - -(-n * percent // 100)


def bands(n: int, percent: int) -> set[int]:
    """Size bands (powers of two) that a set of ``n`` tokens shares with the sets it may link to."""
    least, most = -(-n * percent // 100), n * 100 // percent
    return {n.bit_length(), max(1, least).bit_length(), most.bit_length()}


def signatures(tokens: np.ndarray, levels: np.ndarray, percent: int) -> np.ndarray:
    """Signatures of a set: single rare tokens and combinations of frequent ones, for each of its bands.

    ``levels`` is the order of the tokens: the power of two of their documents,
    and beyond all of these (``_UNCOUNTED``) for tokens that are not counted.
    """
    n = len(tokens)
    misses = allowed_misses(n, percent)
    order = np.lexsort((tokens, levels))
    out = []
    for band in bands(n, percent):
        most = allowed_misses((1 << band) - 1, percent)
        singles, classes, needed = [], {}, 0
        if 1 << band <= SHORT:
            singles = order[:misses + 1].tolist()
        else:
            for at in order.tolist():
                if needed > misses:
                    break
                level = levels[at]
                k = 1 if level < PAIRS_FROM or level == _UNCOUNTED else 2 if level < TRIPLES_FROM else 3
                if k == 1:
                    singles.append(at)
                    needed += 1
                    continue
                count = max(1, most // (PER_CLASS[k] - k + 1))
                held = classes.setdefault((k, int(tokens[at] >> np.uint64(20)) % count), [])
                held.append(at)
                needed += len(held) >= k
        salt = np.uint64(band * int(ODD) & (1 << 64) - 1)
        out.append(mix(tokens[singles] + salt))
        for (k, _), held in classes.items():
            if len(held) >= k:
                picked = tokens[np.array(list(combinations(held, k)))]
                out.append(mix(mix(picked).sum(axis=1, dtype=np.uint64) + salt + np.uint64(k)))
    return np.unique(np.concatenate(out)) if out else np.zeros(0, np.uint64)


_UNCOUNTED = 127


def _levels(tokens: np.ndarray, table: np.ndarray, power: np.ndarray) -> np.ndarray:
    """Place of each token in the order: its power of two in the table, 0 beyond it, last if not counted."""
    out = np.full(len(tokens), _UNCOUNTED, np.int8)
    counted = np.flatnonzero(tokens % np.uint64(COUNTED) == 0)
    out[counted] = 0
    if len(table):
        at = np.minimum(np.searchsorted(table, tokens[counted]), len(table) - 1)
        found = table[at] == tokens[counted]
        out[counted[found]] = power[at[found]]
    return out


def _sets(size: int, emit):
    """A task over (doc_id, text) rows; ``emit`` turns (doc ids, sets) into a record batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict = {}
        for batch in batches:
            for rows in grouped(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())):
                yield emit([r[0] for r in rows], token_sets([r[1] for r in rows], size), state)
    return run


def _new(key, state: dict, most: int = 200_000) -> bool:
    """Whether this task has not met ``key`` among its last ones: equal sets are combined before the shuffle."""
    if key in state:
        return False
    if len(state) >= most:
        state.clear()
    state[key] = None
    return True


def summaries(texts: DataFrame, size: int) -> DataFrame:
    """doc_id, n, d1, d2 (name of the set) and bitmap of every row."""

    def emit(ids, sets, _):
        names = [digest(s) for s in sets]
        return pa.RecordBatch.from_arrays(
            [pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array([d[0] for d in names], pa.int64()),
             pa.array([d[1] for d in names], pa.int64()), pa.array([bitmap(s) for s in sets], pa.binary())],
            names=["doc_id", "n", "d1", "d2", "bits"])

    return texts.mapInArrow(_sets(size, emit), "doc_id long, n long, d1 long, d2 long, bits binary")


def frequent_tokens(texts: DataFrame, size: int) -> tuple[np.ndarray, np.ndarray]:
    """(sorted tokens, powers of two of their documents), the most frequent of the counted ones.

    The counts stay distributed. The least power that is taken leaves ``TABLE``
    tokens at most, so what reaches the driver has a fixed bound.
    """

    def emit(_, sets, __):
        kept = [s[s % np.uint64(COUNTED) == 0] for s in sets]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(kept).view(np.int64))], names=["token"])

    counts = texts.mapInArrow(_sets(size, emit), "token long").groupBy("token").count().where("count > 1").select(
        "token", (F.length(F.bin("count")) - 1).cast("byte").alias("power"))
    counts = cut(texts.sparkSession, counts, "token-counts")
    sizes = sorted((tuple(r) for r in counts.groupBy("power").count().collect()), reverse=True)  # 63 rows at most
    total, least = 0, 64
    for power, n in sizes:
        total += n
        if total > TABLE:
            break
        least = power
    rows = counts.where(F.col("power") >= least).toPandas()
    order = np.argsort(rows["token"].to_numpy(np.int64).view(np.uint64))
    return (rows["token"].to_numpy(np.int64).view(np.uint64)[order], rows["power"].to_numpy(np.int8)[order])


def signature_rows(texts: DataFrame, size: int, percent: int, held) -> DataFrame:
    """(sig, d1, d2): the signatures of each set, once per task and set; ``held`` is the broadcast table of frequent tokens."""

    def emit(_, sets, state):
        sigs, d1, d2 = [np.zeros(0, np.uint64)], [], []
        for own in sets:
            if not len(own):
                continue
            name = digest(own)
            if _new(name, state):
                sigs.append(signatures(own, _levels(own, *held.value), percent))
                d1.append(np.full(len(sigs[-1]), name[0], np.int64))
                d2.append(np.full(len(sigs[-1]), name[1], np.int64))
        none = [np.zeros(0, np.int64)]
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(sigs).view(np.int64)),
                                           pa.array(np.concatenate(d1 or none)), pa.array(np.concatenate(d2 or none))],
                                          names=["sig", "d1", "d2"])

    return texts.mapInArrow(_sets(size, emit), "sig long, d1 long, d2 long")


_HELD = 1 << 16  # rows of a signature that are held to name it by its nodes


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, d1, d2) of signatures with two or more sets, from rows sorted by signature.

    Signatures of the same sets are one bucket: it is named by the sum of its
    sets' hashes. A signature of very many rows streams through under its own name.
    """

    def batch(bucket, d1, d2):
        return pa.RecordBatch.from_arrays([pa.array(bucket.view(np.int64)), pa.array(d1), pa.array(d2)],
                                          names=["bucket", "d1", "d2"])

    def whole(sig, d1, d2):
        new = np.r_[True, (sig[1:] != sig[:-1]) | (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])]
        sig, d1, d2 = sig[new], d1[new], d2[new]
        starts = np.flatnonzero(np.r_[True, sig[1:] != sig[:-1]])
        sizes = np.diff(np.r_[starts, len(sig)])
        names = mix(np.add.reduceat(mix(d1.view(np.uint64) ^ mix(d2.view(np.uint64))), starts))
        keep = np.repeat(sizes > 1, sizes)
        # named buckets repeat: one of them goes on
        bucket = np.repeat(names, sizes)[keep]
        d1, d2 = d1[keep], d2[keep]
        if not len(bucket):
            return batch(bucket, d1, d2)
        starts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
        first = np.isin(starts, np.unique(bucket, return_index=True)[1])
        keep = np.repeat(first, np.diff(np.r_[starts, len(bucket)]))
        return batch(bucket[keep], d1[keep], d2[keep])

    held = [np.zeros(0, np.int64)] * 3
    streaming = None
    for part in batches:
        rows = [np.concatenate([h, part.column(k).to_numpy(zero_copy_only=False)]) for k, h in enumerate(held)]
        if streaming is not None:
            own = int(np.searchsorted(rows[0], streaming, "right"))
            if own:
                yield batch(mix(rows[0][:own].view(np.uint64) + ODD), rows[1][:own], rows[2][:own])
            rows = [r[own:] for r in rows]
            if not len(rows[0]):
                held = rows
                continue
            streaming = None
        if not len(rows[0]):
            held = rows
            continue
        last = int(np.searchsorted(rows[0], rows[0][-1], "left"))
        if last:
            yield whole(*[r[:last] for r in rows])
        held = [r[last:] for r in rows]
        if len(held[0]) > _HELD:
            streaming = held[0][0]
            yield batch(mix(held[0].view(np.uint64) + ODD), held[1], held[2])
            held = [np.zeros(0, np.int64)] * 3
    if len(held[0]):
        yield whole(*held)


def buckets(spark: SparkSession, rows: DataFrame, nodes: DataFrame) -> DataFrame:
    """(bucket, i, j, side, node, n, bits) of every bucket, those beyond ``CELL`` nodes dealt out as pairs of cells."""
    shared = rows.repartition("sig").sortWithinPartitions("sig", "d1", "d2").mapInArrow(
        _shared, "bucket long, d1 long, d2 long")
    members = cut(spark, shared.distinct().join(nodes.select("d1", "d2", "node", "n", "bits"), ["d1", "d2"]).select(
        "bucket", "node", "n", "bits"), "ngram-buckets")
    large = cut(spark, members.groupBy("bucket").count().where(F.col("count") > CELL).select(
        "bucket", F.ceil(F.col("count") / CELL).cast("int").alias("cells")), "ngram-large")
    return _dealt(members, large)


def _dealt(members: DataFrame, large: DataFrame) -> DataFrame:
    """``members`` (bucket, node, ...) with i, j and side; the buckets of ``large`` go to pairs of their cells."""
    mine = F.pmod(F.xxhash64("node", F.lit(7)), F.col("cells")).cast("int")
    others = [c for c in members.columns if c != "bucket"]
    dealt = members.join(large, "bucket", "left").select(
        "bucket", *others, F.coalesce(mine, F.lit(0)).alias("mine"),
        F.explode(F.sequence(F.lit(0), F.coalesce("cells", F.lit(1)) - 1)).alias("other"))
    side = F.when(F.col("mine") == F.col("other"), 0).when(F.col("mine") < F.col("other"), 1).otherwise(2)
    return dealt.select("bucket", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"),
                        side.alias("side"), *others)


def _folded(bits: list[bytes]) -> np.ndarray:
    """Bitmaps of one bucket at their smallest width; halves of a wider one add up to it."""
    width = min(map(len, bits)) // 8
    out = np.empty((len(bits), width), np.uint64)
    for k, b in enumerate(bits):
        words = np.frombuffer(b, np.uint64)
        out[k] = np.bitwise_xor.reduce(words.reshape(-1, width), axis=0) if len(words) > width else words
    return out


def _nearness(n: np.ndarray, bits: np.ndarray, side: np.ndarray, label: np.ndarray | None, percent: int):
    """Which of the places ``others`` sizes and bitmaps do not rule out for place ``p`` of a bucket."""

    def near(p: int, others: np.ndarray) -> np.ndarray:
        if side[p]:
            others = others[side[others] != side[p]]
        if label is not None:
            others = others[label[others] != label[p]]
        both = n[others] + n[p]
        most = (100 - percent) * both // (100 + percent)  # of the symmetric difference
        others, most = others[abs(n[others] - n[p]) <= most], most[abs(n[others] - n[p]) <= most]
        apart = np.bitwise_count(bits[others] ^ bits[p]).sum(axis=1, dtype=np.int64)
        return others[apart <= most]

    return near


def candidate_edges(node: np.ndarray, n: np.ndarray, bits: np.ndarray, side: np.ndarray, label: np.ndarray | None,
                    percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a bucket that sizes and bitmaps do not rule out.

    Without labels: a spanning forest of them, searched from the least node.
    With labels: all of them between different labels.
    """
    near, left = _nearness(n, bits, side, label, percent), np.arange(len(node))
    if label is not None:
        for p in left:
            found = near(p, left[p + 1:])
            if len(found):
                yield np.full(len(found), node[p]), node[found]
        return
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            p = queue.pop()
            found = near(p, left)
            if len(found):
                yield np.full(len(found), node[p]), node[found]
                queue.extend(found[::-1])
                left = left[~np.isin(left, found)]


def linked_edges(node: np.ndarray, sets: list[np.ndarray], side: np.ndarray, label: np.ndarray,
                 percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links of a bucket between different labels, by whole sets: a spanning forest, nodes of one label being joined."""
    n = np.array([len(s) for s in sets], np.int64)
    near = _nearness(n, _folded([bitmap(s) for s in sets]), side, label, percent)
    known, tokens = np.unique(np.concatenate(sets), return_inverse=True)
    starts, own = np.cumsum(n) - n, np.zeros(len(known), bool)
    left = np.arange(len(node))
    while len(left):
        queue, left = [left[0]], left[1:]
        while queue and len(left):
            p = queue.pop()
            joined = label[left] == label[p]
            queue.extend(left[joined])
            left = left[~joined]
            others = near(p, left)
            if not len(others):
                continue
            before = np.cumsum(n[others]) - n[others]
            inside = np.arange(n[others].sum()) + np.repeat(starts[others] - before, n[others])
            own[tokens[starts[p]:starts[p] + n[p]]] = True
            both = np.add.reduceat(own[tokens[inside]], before, dtype=np.int64)
            own[tokens[starts[p]:starts[p] + n[p]]] = False
            found = others[100 * both >= percent * (n[p] + n[others] - both)]
            if len(found):
                yield np.full(len(found), node[p]), node[found]
                queue.extend(found[::-1])
                left = left[~np.isin(left, found)]


def _by_bucket(group):
    """A task over rows sorted by (bucket, i, j); ``group`` gets the columns of two or more rows, two cells at most."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] | None = None
        for batch in batches:
            keys = [batch.column(k).to_numpy(zero_copy_only=False) for k in range(3)]
            change = np.flatnonzero((keys[0][1:] != keys[0][:-1]) | (keys[1][1:] != keys[1][:-1])
                                    | (keys[2][1:] != keys[2][:-1])) + 1
            columns = [c.to_pylist() for c in batch.columns]
            for lo, hi in zip([0, *change.tolist()], [*change.tolist(), batch.num_rows]):
                part = [c[lo:hi] for c in columns]
                if held is not None and [held[k][0] for k in range(3)] == [part[k][0] for k in range(3)]:
                    held = [h + p for h, p in zip(held, part)]
                    continue
                if held is not None and len(held[0]) > 1:
                    yield from group(held)
                held = part if hi > lo else held
        if held is not None and len(held[0]) > 1:
            yield from group(held)

    return run


def _edge_batches(edges) -> Iterator[pa.RecordBatch]:
    for a, b in edges:
        yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names=["a", "b"])


def candidates(rows: DataFrame, percent: int) -> DataFrame:
    """(a, b) node pairs of the buckets to verify."""

    def group(rows: list[list]) -> Iterator[pa.RecordBatch]:
        side, node, n = (np.array(rows[k], np.int64) for k in (3, 4, 5))
        order = np.argsort(node)
        yield from _edge_batches(candidate_edges(node[order], n[order], _folded(rows[6])[order], side[order], None, percent))

    ordered = rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return ordered.mapInArrow(_by_bucket(group), "a long, b long").distinct()


def contested(rows: DataFrame, percent: int, labels: DataFrame) -> DataFrame:
    """What remains between different labels: (null, a, b) for a pair, or (bucket, node, null) for the nodes of many pairs."""

    def group(rows: list[list]) -> Iterator[pa.RecordBatch]:
        side, node, n, label = (np.array(rows[k], np.int64) for k in (3, 4, 5, 7))
        at, wanted = np.arange(len(node)), np.zeros(len(node), bool)
        pairs, total = [], 0
        for a, b in candidate_edges(at, n, _folded(rows[6]), side, label, percent):
            wanted[a] = wanted[b] = True
            total += len(a)
            if total <= LISTED * len(node):
                pairs.append((node[a], node[b]))
        if total > LISTED * len(node):
            columns = np.full(wanted.sum(), rows[0][0]), node[wanted], pa.nulls(wanted.sum(), pa.int64())
        elif total:
            a, b = (np.concatenate(x) for x in zip(*pairs))
            columns = pa.nulls(total, pa.int64()), np.minimum(a, b), np.maximum(a, b)
        else:
            return
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["bucket", "a", "b"])

    rows = rows.join(labels.select("node", "root"), "node", "left").select(
        "bucket", "i", "j", "side", "node", "n", "bits", F.coalesce("root", "node").alias("label"))
    ordered = rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return ordered.mapInArrow(_by_bucket(group), "bucket long, a long, b long").distinct()


def links_between(spark: SparkSession, members: DataFrame, sets: DataFrame, labels: DataFrame, percent: int) -> DataFrame:
    """(a, b): links that join the different labels of the (bucket, node) rows, found where a bucket's sets meet."""

    def group(rows: list[list]) -> Iterator[pa.RecordBatch]:
        side, node, label = (np.array(rows[k], np.int64) for k in (3, 4, 6))
        yield from _edge_batches(linked_edges(node, [np.frombuffer(t, np.uint64) for t in rows[5]], side, label, percent))

    sizes = members.join(sets.select("node", F.length("tokens").alias("size")), "node").groupBy("bucket").agg(
        F.ceil(F.greatest(F.count("*") / CELL, F.sum("size") / CELL_BYTES)).cast("int").alias("cells"))
    large = cut(spark, sizes.where("cells > 1"), "ngram-large")
    rows = _dealt(members, large).join(labels.select("node", "root"), "node", "left").join(sets, "node").select(
        "bucket", "i", "j", "side", "node", "tokens", F.coalesce("root", "node").alias("label"))
    ordered = rows.repartition("bucket", "i", "j").sortWithinPartitions("bucket", "i", "j")
    return ordered.mapInArrow(_by_bucket(group), "a long, b long").distinct()


def whole_sets(spark: SparkSession, texts: DataFrame, nodes: DataFrame, ends: DataFrame, size: int) -> DataFrame:
    """(node, tokens): the whole sets of the nodes in ``ends``.

    A filter of fixed size tells the tasks which sets are wanted, so only those
    (and a few others) leave them.
    """
    wanted = cut(spark, nodes.join(ends, "node", "left_semi").select("node", "d1", "d2"), "ngram-wanted")
    marks = spark.sparkContext.broadcast(seed_filter(wanted.select(F.col("d1").alias("seed")), FILTER_BITS).tobytes())

    def emit(_, sets, state):
        names = [digest(s) for s in sets]
        hashes = np.array([d[0] for d in names], np.int64).view(np.uint64)
        kept = [k for k in _passes(hashes, np.frombuffer(marks.value, np.uint8), FILTER_BITS).tolist()
                if _new(names[k], state)]
        return pa.RecordBatch.from_arrays(
            [pa.array([names[k][0] for k in kept], pa.int64()), pa.array([names[k][1] for k in kept], pa.int64()),
             pa.array([sets[k].tobytes() for k in kept], pa.binary())], names=["d1", "d2", "tokens"])

    sets = texts.mapInArrow(_sets(size, emit), "d1 long, d2 long, tokens binary")
    sets = cut(spark, sets.join(wanted, ["d1", "d2"]).select("node", "tokens").dropDuplicates(["node"]), "ngram-sets")
    marks.unpersist()
    return sets


def verified(spark: SparkSession, texts: DataFrame, nodes: DataFrame, edges: DataFrame, size: int,
             percent: int) -> DataFrame:
    """``edges`` with whether they link, by their whole sets."""
    ends = edges.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    sets = whole_sets(spark, texts, nodes, ends, size)

    @F.pandas_udf("boolean")
    def linked(a, b):
        import pandas as pd

        out = []
        for x, y in zip(a, b):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            out.append(100 * both >= percent * (len(x) + len(y) - both))
        return pd.Series(out, dtype=bool)

    left = sets.select(F.col("node").alias("a"), F.col("tokens").alias("a_tokens"))
    right = sets.select(F.col("node").alias("b"), F.col("tokens").alias("b_tokens"))
    return cut(spark, edges.join(left, "a").join(right, "b").select("a", "b", linked("a_tokens", "b_tokens").alias("linked")),
               "ngram-verified")


def join(spark: SparkSession, docs: DataFrame, *, size: int = 3, percent: int = 90, id_col: str = "doc_id",
         text_col: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(rows, nodes, links): every row with the name of its set; one node per set; a spanning set of links.

    ``links`` joins the nodes of every component; pairs of equal sets are left to ``nodes``.
    """
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), text_of(text_col).alias("text"))
    rows = cut(spark, summaries(texts, size), "ngram-summaries")
    nodes = cut(spark, rows.where("n > 0").groupBy("d1", "d2").agg(
        F.min("doc_id").alias("least"), F.count("*").alias("n_docs"), F.max("n").alias("n"),
        F.max("bits").alias("bits")).withColumn("node", F.monotonically_increasing_id()), "ngram-nodes")
    held = spark.sparkContext.broadcast(frequent_tokens(texts, size))
    dealt = cut(spark, buckets(spark, signature_rows(texts, size, percent, held), nodes), "ngram-dealt")
    held.unpersist()
    checked = verified(spark, texts, nodes, cut(spark, candidates(dealt, percent), "ngram-edges"), size, percent)
    links = checked.where("linked").select("a", "b")
    failed = checked.where("not linked")
    if not failed.isEmpty():
        # the forest missed what lay behind these pairs: their buckets again, between different components
        labels = components(spark, links)
        at_a = failed.join(dealt.select(F.col("node").alias("a"), "bucket"), "a").select("b", "bucket")
        again = at_a.join(dealt.select(F.col("node").alias("b"), "bucket"), ["b", "bucket"], "left_semi").select("bucket").distinct()
        # bitmaps join the rows of these buckets alone: all others need not be shuffled with theirs
        rest = dealt.drop("n", "bits").join(again, "bucket", "left_semi").join(nodes.select("node", "n", "bits"), "node")
        rest = cut(spark, contested(rest, percent, labels), "ngram-contested")
        more = cut(spark, rest.where("b is not null").select("a", "b").join(
            failed.select("a", "b"), ["a", "b"], "left_anti"), "ngram-edges")
        members = rest.where("b is null").select("bucket", F.col("a").alias("node"))
        if not more.isEmpty():
            links = links.union(verified(spark, texts, nodes, more, size, percent).where("linked").select("a", "b"))
        if not members.isEmpty():
            sets = whole_sets(spark, texts, nodes, members.select("node").distinct(), size)
            links = links.union(cut(spark, links_between(spark, members, sets, labels, percent), "ngram-links"))
    return rows, nodes, links


def similar_documents(spark: SparkSession, docs: DataFrame, *, size: int = 3, percent: int = 90,
                      id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (least id reachable by links)."""
    rows, nodes, links = join(spark, docs, size=size, percent=percent, id_col=id_col, text_col=text_col)
    rooted = cut(spark, nodes.join(components(spark, links), "node", "left").select(
        "d1", "d2", "n_docs", "least", F.coalesce("root", "node").alias("root")), "ngram-rooted")
    smallest = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = rooted.join(smallest, "root").select("d1", "d2", "n_docs", "component_id")
    found = join_classes(spark, rows.drop("bits"), classes, ["d1", "d2"], "n_docs")
    return found.select("doc_id", F.col("n").alias("n_shingles"),
                        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))
