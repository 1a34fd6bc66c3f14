"""Benchmark decontamination by spaced-seed hashing.

Fixed masks select some tokens of each window and ignore the others, so a
passage with substituted words still yields equal hashes. Hashes of test items
and of training texts are joined, and each hit is verified on its diagonal:
item and text are compared token by token around it, and the best stretch must
be long and similar enough.

There are two families of masks, and each alone meets every overlap. Light masks
of seven tokens find the stretches of a text worth a look: their hashes pass a
filter of fixed size made from the test hashes (a Bloom filter with two bits per
hash). Only there the heavy masks of nine tokens are hashed; those that pass a
second such filter are joined exactly. A heavy mask spans 11 tokens or more, so a
phrase of up to 10 tokens that many items and many texts share joins nothing. A
larger benchmark only lets more hashes into the join.

Defined cases: null and empty texts and items have no tokens and never match;
items of ``verbatim`` to ``least`` - 1 tokens are too short for differences to be
told from chance: they are found word for word only, and ``remove`` does not act on
them; items of fewer tokens than ``verbatim`` never match;
equal items are reported under the smallest id; repeated rows are reported once
per id and text; empty tables give an empty result; extra columns are ignored,
or carried unchanged by ``remove``.
"""

from __future__ import annotations

import hashlib
import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.llm.common import cut, hold, text_of, whole

# Seven selected tokens each; zeros are ignored positions. Together they hit every
# placement of the differences that a stretch of 13 to 25 tokens may have at a share
# of 0.8 (a longer stretch holds such a one), so no overlap of 13 tokens is unseen.
MASKS = ("1111111", "111011011", "1101100111", "11001101011", "110101000111", "111010111", "1111100101")
# Nine selected tokens each over 11 to 15, with the same property.
HEAVY_MASKS = ("11110111011", "11111010111", "11011111011", "10101111111", "11111101101",
               "100110111111", "110111101011", "111001101111", "111110001111", "111111010011",
               "1101100111011", "1110101111001", "11011010001111", "11100111010011", "111010110111",
               "110000011011111", "110100101100111", "111001001010111", "111011100100011",
               "111101010001011", "111110010000111")
# five tokens each, for items of 8 to 12 tokens: they hit every placement of their differences
SHORT_MASKS = ("111011", "11010011", "11111")
SHORT = 13  # items of fewer tokens take the short masks, and are joined as a whole
FILTER_BITS = 26
CONTEXT = 32  # tokens kept on either side of hits

_WORD = re.compile(r"\w+")
# scripts without spaces between words: Thai, Lao, Tibetan, Burmese, Khmer, kana, Han
_NO_SPACES = "\u0e00-\u0fff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\uff66-\uff9d\U00020000-\U0003ffff"
_UNSPACED = re.compile(f"[{_NO_SPACES}]")
_LETTER = re.compile(rf"(?=\w)[{_NO_SPACES}]|[^\W{_NO_SPACES}]+")
_CACHE = 500_000


class _TokenHashes(dict):
    """64-bit hash of each word, remembered in a bounded number."""

    most = _CACHE

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = found = xxhash.xxh64_intdigest(word.encode())
        return found


_HASHES = _TokenHashes()


def _take(cache: int) -> None:
    # a task's function names this one, not the cache: what it names itself is sent to it as a copy
    hold("decontamination", _HASHES.clear)
    _HASHES.most = cache


def token_hashes(text: str | None) -> np.ndarray:
    """Hashes of the words, or of single characters in scripts without spaces."""
    text = text.lower() if text else ""
    words = (_WORD if text.isascii() or not _UNSPACED.search(text) else _LETTER).findall(text)
    return np.fromiter(map(_HASHES.__getitem__, words), np.uint64, len(words))


def seed_hashes(tokens: np.ndarray, mask: str) -> np.ndarray:
    """Hash of the selected tokens of each window of the mask's length."""
    n = len(tokens) - len(mask) + 1
    out = np.full(max(n, 0), int("1" + mask, 2) * 0x9E3779B97F4A7C15 & (1 << 64) - 1, np.uint64)
    if n > 0:
        for k, on in enumerate(mask):
            if on == "1":
                out = (out ^ tokens[k:k + n]) * np.uint64(0xBF58476D1CE4E5B9)
                out ^= out >> np.uint64(29)
    return out


def _slots(hashes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64), \
        (hashes * np.uint64(0x94D049BB133111EB) >> np.uint64(64 - bits)).astype(np.int64)


def light_masks(n: int, least: int) -> tuple[str, ...]:
    """Masks that find an item of ``n`` tokens in a text."""
    return MASKS if n >= SHORT else SHORT_MASKS if n >= least else ("1" * n,)


def heavy_masks(n: int, least: int, similarity: float) -> tuple[str, ...]:
    """Masks by which an item of ``n`` tokens is joined; a short item takes part as a whole."""
    if n >= SHORT:
        return HEAVY_MASKS
    differ = int((1 - similarity) * n + 1e-9) if n >= least else 0
    return tuple("".join("0" if k in gone else "1" for k in range(n))
                 for gone in itertools.combinations(range(n), differ))


def item_seeds(items: DataFrame, id_col: str, text_col: str, least: int, verbatim: int, similarity: float) -> DataFrame:
    """(item_id, tokens, light, seeds) of every test item of ``verbatim`` tokens or more; equal items once."""
    seed_type = pa.struct([("seed", pa.int64()), ("item_pos", pa.int32())])

    def lists(parts: list[np.ndarray]) -> tuple[pa.Array, np.ndarray]:
        return pa.array(np.cumsum([0] + [len(p) for p in parts]), pa.int32()), np.concatenate([*parts, np.empty(0, np.int64)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for item, text in zip(batch.column(0), batch.column(1)):
                own = token_hashes(text.as_py())
                if len(own) < verbatim:
                    continue
                light = [seed_hashes(own, mask).view(np.int64) for mask in light_masks(len(own), least)]
                heavy = [seed_hashes(own, mask).view(np.int64) for mask in heavy_masks(len(own), least, similarity)]
                places = np.concatenate([np.arange(len(h), dtype=np.int32) for h in heavy])
                at, found = lists([np.concatenate(heavy)])
                seeds = pa.StructArray.from_arrays([pa.array(found), pa.array(places)], fields=list(seed_type))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item.as_py()], pa.int64()), pa.ListArray.from_arrays(*lists([own.view(np.int64)])),
                     pa.ListArray.from_arrays(*lists([np.concatenate(light)])), pa.ListArray.from_arrays(at, seeds)],
                    names=["item_id", "tokens", "light", "seeds"])

    rows = items.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    found = rows.mapInArrow(run, "item_id long, tokens array<long>, light array<long>, "
                                 "seeds array<struct<seed:long,item_pos:int>>")
    return found.groupBy("tokens").agg(F.min("item_id").alias("item_id"), F.first("light").alias("light"),
                                       F.first("seeds").alias("seeds"))


def seed_filter(seeds: DataFrame, bits: int) -> np.ndarray:
    """The filter as bytes; what reaches the driver has its fixed size, whatever the number of seeds."""

    @F.pandas_udf("array<int>")
    def slots(hashes: pd.Series) -> pd.Series:
        a, b = _slots(hashes.to_numpy(np.int64).view(np.uint64), bits)
        return pd.Series(np.stack([a, b], axis=1).astype(np.int32).tolist())

    marks = seeds.select(F.explode(slots("seed")).alias("slot")).groupBy(
        (F.col("slot") / 64).cast("int").alias("word")).agg(
        F.bit_or(F.expr("shiftleft(1L, slot % 64)")).alias("marks")).toPandas()
    out = np.zeros(1 << bits - 6, np.uint64)
    out[marks["word"].to_numpy(np.int64)] = marks["marks"].to_numpy(np.int64).view(np.uint64)
    return out.view(np.uint8)


def _passes(hashes: np.ndarray, marks: np.ndarray, bits: int) -> np.ndarray:
    a, b = _slots(hashes, bits)
    first = np.flatnonzero(marks[a >> 3] >> (a & 7).astype(np.uint8) & 1)
    b = b[first]
    return first[np.flatnonzero(marks[b >> 3] >> (b & 7).astype(np.uint8) & 1)]


_CLUSTER = pa.schema([("doc_id", pa.int64()), ("mark", pa.binary()), ("at", pa.int32()),
                      ("tokens", pa.list_(pa.int64())),
                      ("hits", pa.list_(pa.struct([("seed", pa.int64()), ("pos", pa.int32())])))])


def _hits(tokens, ends, masks, marks, bits):
    """Positions and hashes of the windows that pass the filter and end within their own text or stretch."""
    pos, seed = [np.empty(0, np.int64)], [np.empty(0, np.uint64)]
    for mask in masks:
        hashes = seed_hashes(tokens, mask)
        found = _passes(hashes, marks, bits)
        found = found[found + len(mask) <= ends[found]]
        pos.append(found)
        seed.append(hashes[found])
    return np.concatenate(pos), np.concatenate(seed)


def _stretches(pos, starts, reach):
    """(text, first, end) of the stretches around hits, from ``CONTEXT`` before to ``CONTEXT`` after them."""
    pos = np.unique(pos)
    owner = np.searchsorted(starts, pos, "right") - 1
    apart = np.flatnonzero((np.diff(pos) > 2 * CONTEXT) | (np.diff(owner) > 0)) + 1
    first, last = np.r_[0, apart], np.r_[apart, len(pos)] - 1
    doc = owner[first]
    return doc, np.maximum(starts[doc], pos[first] - CONTEXT), np.minimum(starts[doc + 1], pos[last] + CONTEXT + reach)


def _cluster_rows(filters, bits: int, light: tuple[str, ...], heavy: tuple[str, ...], cache: int):
    """Stretches of a text around light hits that hold heavy hits, with these and the tokens beside them."""
    reach = max(map(len, light))

    def clusters(ids, texts, tokens, starts, marks, heavy_marks):
        rows = []
        pos, _ = _hits(tokens, np.repeat(starts[1:], np.diff(starts)), light, marks, bits)
        if len(pos):
            doc, lo, hi = _stretches(pos, starts, reach)
            edges = np.r_[0, np.cumsum(hi - lo)]
            near = np.arange(edges[-1]) + np.repeat(lo - edges[:-1], hi - lo)
            hit_pos, hit_seed = _hits(tokens[near], np.repeat(edges[1:], hi - lo), heavy, heavy_marks, bits)
            order = np.argsort(hit_pos, kind="stable")
            hit_pos, hit_seed = hit_pos[order], hit_seed[order].view(np.int64)
            cuts = np.searchsorted(hit_pos, edges)
            for k in np.flatnonzero(np.diff(cuts)):
                own = slice(cuts[k], cuts[k + 1])
                d = int(doc[k])
                rows.append({"doc_id": ids[d], "mark": hashlib.md5((texts[d] or "").encode(), usedforsecurity=False).digest(),
                             "at": int(lo[k] - starts[d]), "tokens": tokens[lo[k]:hi[k]].view(np.int64),
                             "hits": [{"seed": s, "pos": p} for s, p in zip(
                                 hit_seed[own].tolist(), (hit_pos[own] - edges[k]).tolist())]})
        return pa.RecordBatch.from_pylist(rows, schema=_CLUSTER)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _take(cache)
        marks, heavy_marks = (np.frombuffer(part, np.uint8) for part in filters.value)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                ids, texts = (batch.column(k).slice(at, 256).to_pylist() for k in range(2))
                own = [token_hashes(text) for text in texts]
                starts = np.r_[0, np.cumsum([len(t) for t in own])]
                yield clusters(ids, texts, np.concatenate(own), starts, marks, heavy_marks)
    return run


def best_stretch(text: np.ndarray, item: np.ndarray, shift: int, least: int, similarity: float) -> tuple[int, int, int] | None:
    """Best overlap of ``item`` laid at ``text[shift:]``: (start in text, length, equal tokens).

    Of the stretches of ``least`` tokens (or the whole item, if that is shorter)
    or more, the one of the highest score, where an equal token adds the allowed
    share of differences and another takes away the similarity. It is an overlap
    if its score is not negative; if it is, no stretch of that length has the share.
    """
    lo, hi = max(0, shift), min(len(text), shift + len(item))
    need = min(least, len(item))
    if hi - lo < max(1, need):
        return None
    equal = text[lo:hi] == item[lo - shift:hi - shift]
    # rounded, so that equal scores compare as equal
    score = np.round(np.r_[0, np.cumsum(equal)] - similarity * np.arange(len(equal) + 1), 9)
    lowest = np.minimum.accumulate(score[:len(score) - need])
    gain = np.round(score[need:] - lowest, 9)
    last = int(np.argmax(gain))
    if gain[last] < 0:
        return None
    begin = int(np.flatnonzero(score[:last + 1] == lowest[last])[0])
    end = last + need
    return lo + begin, end - begin, int(equal[begin:end].sum())


def contaminated(spark: SparkSession, docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id",
                 text_col: str = "text", item_id_col: str = "item_id", item_text_col: str = "text",
                 overlap: int = 13, similarity: float = 0.8, least: int = 8,
                 verbatim: int = 5, filter_bits: int = FILTER_BITS, cache: int = _CACHE) -> DataFrame:
    """Verified overlaps: doc_id, mark (digest of the text), item_id, start, length, matches (in tokens).

    An overlap has ``overlap`` tokens (or the whole item, if that is shorter)
    of which a share of ``similarity`` is equal. The masks meet all such overlaps
    from 13 tokens and a share of 0.8 on, so smaller values are refused. Items of
    fewer than ``least`` (8 to 13) tokens are found word for word. ``cache`` is the number
    of words whose hashes a worker remembers; it changes memory and speed only.
    """
    if overlap < SHORT or similarity < 0.8 or not 8 <= least <= SHORT or not 1 <= verbatim <= least:
        raise ValueError("the masks need overlap >= 13, similarity >= 0.8, 8 <= least <= 13, 1 <= verbatim <= least")
    seeded = cut(spark, item_seeds(items, item_id_col, item_text_col, least, verbatim, similarity), "benchmark-seeds")
    seeds = seeded.select("item_id", F.explode("seeds").alias("s")).select("item_id", "s.*")
    filters = spark.sparkContext.broadcast([
        seed_filter(seeded.select(F.explode("light").alias("seed")), filter_bits).tobytes(),
        seed_filter(seeds, filter_bits).tobytes()])
    # the sizes below 13 that occur, and 13 for all others
    sizes = sorted(r.n for r in seeded.select(F.least(F.size("tokens"), F.lit(SHORT)).alias("n")).distinct().collect())
    light = tuple(dict.fromkeys(mask for n in sizes or [SHORT] for mask in light_masks(n, least)))
    heavy = tuple(dict.fromkeys(mask for n in sizes or [SHORT] for mask in heavy_masks(n, least, similarity)))
    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                        F.col(f"`{text_col}`").cast("string").alias("text"))
    schema = "doc_id long, mark binary, at int, tokens array<long>, hits array<struct<seed:long,pos:int>>"
    clusters = cut(spark, texts.mapInArrow(_cluster_rows(filters, filter_bits, light, heavy, cache), schema).withColumn(
        "cluster", F.monotonically_increasing_id()), "seed-clusters")
    hits = clusters.select("cluster", F.explode("hits").alias("h")).select("cluster", "h.*")
    # a plain join between two shuffles: the adaptive planner splits a hot seed
    diagonals = hits.join(seeds, "seed").select("cluster", "item_id", (F.col("pos") - F.col("item_pos")).alias("shift")).distinct()
    both = (diagonals.join(clusters.select("cluster", "doc_id", "mark", "at", "tokens"), "cluster")
            .join(seeded.select("item_id", F.col("tokens").alias("item")), "item_id"))

    @F.pandas_udf("start int, length int, matches int")
    def verified(text: pd.Series, item: pd.Series, shift: pd.Series) -> pd.DataFrame:
        found = [best_stretch(np.asarray(t), np.asarray(i), int(s), overlap, similarity) or (None,) * 3
                 for t, i, s in zip(text, item, shift)]
        return pd.DataFrame(found, columns=["start", "length", "matches"], dtype="Int32")

    checked = both.select("doc_id", "mark", "at", "item_id", verified("tokens", "item", "shift").alias("v")).where(
        "v.length is not null")
    best = F.struct("v.matches", "v.length", (-(F.col("at") + F.col("v.start"))).alias("left"))
    return checked.groupBy("doc_id", "mark", "item_id").agg(F.max(best).alias("b")).select(
        "doc_id", "mark", "item_id", (-F.col("b.left")).alias("start"), F.col("b.length").alias("length"),
        F.col("b.matches").alias("matches"))


def remove(spark: SparkSession, docs: DataFrame, items: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
           **options) -> DataFrame:
    """The rows without a verified overlap of ``least`` tokens, whole and unchanged.

    Items of fewer tokens are reported by ``contaminated``, but too short to remove a text for.
    """
    found = contaminated(spark, docs, items, id_col=id_col, text_col=text_col, **options).where(
        F.col("length") >= options.get("least", 8))
    bad = cut(spark, found.select(F.col("doc_id").alias("bad_id"), F.col("mark").alias("bad_mark")).distinct(), "leaks")
    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.unhex(F.md5(text_of(text_col))).alias("mark"), whole(docs))
    stay = rows.join(bad, F.col("doc_id").eqNullSafe(F.col("bad_id")) & (F.col("mark") == F.col("bad_mark")), "left_anti")
    return stay.select(*[F.col(f"row.`{c}`").alias(c) for c in docs.columns])
