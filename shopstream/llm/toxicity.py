"""Toxicity by a factorization machine over hashed terms.

A text is the set of its terms: lower-case words and their first four and five
letters, hashed into buckets. The score adds a weight for each term and, for
each pair of terms, the product of their factor vectors, so a pair such as
insult and group mention can weigh more than its parts. The model is fitted on
at most ``sample`` labelled rows (those of the least hash of their id) and has
a fixed size; every text is scored whole. Terms that tell neither alone nor in
a pair with any other term are left at zero (``telling_buckets``,
``paired_buckets``): the noise of thousands of idle terms outweighs a pair.

Defined cases: a null or empty text has no terms and gets the score of the
bias; of repeated labels the larger counts, null labels do not; repeated rows
get equal scores; without labels of both kinds every score is the share of
positive ones (0 without any); an empty table gives an empty result; extra
columns are ignored, or carried unchanged by ``keep_clean``.
"""

from __future__ import annotations

import re
import uuid
import zlib
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.llm.common import hold, text_of

BUCKETS = 1 << 18
FACTORS = 8
SAMPLE = 10_000  # labelled rows that the fit may take
_CACHE = 500_000
_WORD = re.compile(r"\w+")


class _Terms(dict):
    """Buckets of a word's terms, remembered in a bounded number."""

    most = _CACHE

    def __missing__(self, word: str) -> bytes:
        if len(self) >= self.most:
            self.clear()
        terms = {"=" + word} | {word[:k] for k in (4, 5) if len(word) >= k}
        buckets = [zlib.crc32(t.encode()) % BUCKETS for t in terms]
        self[word] = found = np.array(buckets, "<i4").tobytes()
        return found


_TERMS = _Terms()


def term_buckets(text: bytes) -> np.ndarray:
    """Distinct buckets of a text's terms, ascending."""
    words = set(_WORD.findall(text.decode().lower()))
    return np.unique(np.frombuffer(b"".join([_TERMS[w] for w in words]), "<i4"))


@dataclass
class Machine:
    bias: float
    weights: np.ndarray  # (BUCKETS,)
    factors: np.ndarray  # (BUCKETS, FACTORS)

    def margins(self, ids: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Margin of each set ids[starts[k]:starts[k+1]], and its factor sums; no set may be empty."""
        v = self.factors[ids]
        sums = np.add.reduceat(v, starts, axis=0)
        pairs = 0.5 * (sums * sums - np.add.reduceat(v * v, starts, axis=0)).sum(axis=1)
        return self.bias + np.add.reduceat(self.weights[ids], starts) + pairs, sums


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def telling_buckets(sets: list[np.ndarray], labels: np.ndarray, least_z: float) -> np.ndarray:
    """Buckets whose share among positive texts differs from that among the others by ``least_z`` deviations."""
    none = np.zeros(0, "<i4")
    with_it = [np.bincount(np.concatenate([none, *[s for s, y in zip(sets, labels) if (y > 0) == side]]),
                           minlength=BUCKETS) for side in (True, False)]
    n1, n0 = max(1, int((labels > 0).sum())), max(1, int((labels <= 0).sum()))
    share = (with_it[0] + with_it[1]) / (n1 + n0)
    deviation = np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n1 + 1 / n0))
    return np.abs(with_it[0] / n1 - with_it[1] / n0) >= least_z * deviation


def paired_buckets(sets: list[np.ndarray], labels: np.ndarray, expected: np.ndarray, least_docs: int,
                   chance: float, block: int = 512) -> np.ndarray:
    """Buckets of the pairs whose texts are positive more or less often than the single terms explain.

    Every pair of buckets that ``least_docs`` texts have is examined, whatever
    the buckets' own association. ``expected`` is each text's probability by
    single terms. Of the n texts with both buckets k are positive where e were
    expected; such a difference comes by chance with a probability of
    exp(-n KL(k/n, e/n)) at most (Chernoff, Hoeffding), and a pair tells if that
    is under ``chance`` for all pairs together.

    n KL is at most the sum of log(1/p) over the positive texts with both, or of
    log(1/(1-p)) over the others, so a bucket whose own texts sum to less is in
    no telling pair and needs no counting.
    """
    out = np.zeros(BUCKETS, bool)
    rows = np.repeat(np.arange(len(sets), dtype=np.int32), [len(s) for s in sets])
    ids = np.concatenate([np.zeros(0, "<i4"), *sets])
    counts = np.bincount(ids, minlength=BUCKETS)
    common = np.flatnonzero(counts >= least_docs)
    if len(common) < 2:
        return out
    order = np.argsort(ids, kind="stable")
    rows, ends = rows[order], np.cumsum(counts)
    least = np.log(len(common) * (len(common) - 1) / 2 / chance)
    positive = labels > 0
    expected = np.clip(expected, 1e-6, 1 - 1e-6).astype(np.float32)

    def dense(part: np.ndarray) -> np.ndarray:
        found = np.zeros((len(part), len(sets)), np.float32)
        for k, bucket in enumerate(part):
            found[k, rows[ends[bucket] - counts[bucket]:ends[bucket]]] = 1
        return found

    for side, most in ((positive, -np.log(expected)), (~positive, -np.log1p(-expected))):
        reach = np.bincount(ids[order], weights=np.where(side, most, 0)[rows], minlength=BUCKETS)
        able = common[reach[common] >= least]
        for i in range(0, len(able), block):
            a = dense(able[i:i + block])
            a_positive, a_expected = a[:, positive], a * expected
            for j in range(i, len(able), block):
                b = dense(able[j:j + block])
                n = np.maximum(a @ b.T, 1)
                k, e = a_positive @ b[:, positive].T / n, np.clip(a_expected @ b.T / n, 1e-6, 1 - 1e-6)
                with np.errstate(divide="ignore", invalid="ignore"):
                    apart = np.where(k > 0, k * np.log(k / e), 0) + np.where(k < 1, (1 - k) * np.log((1 - k) / (1 - e)), 0)
                tells = n * apart >= least
                if i == j:
                    np.fill_diagonal(tells, False)
                out[able[i:i + block][tells.any(axis=1)]] = True
                out[able[j:j + block][tells.any(axis=0)]] = True
    return out


def fit(sets: list[np.ndarray], labels: np.ndarray, *, steps: int = 1500, batch: int = 256, rate: float = 0.2,
        least_z: float = 4.0, l1: float = 1e-5, l2: float = 1e-4, seed: int = 7, least_docs: int = 10,
        chance: float = 0.01) -> Machine:
    """The machine over the terms that tell alone and those that tell in pairs.

    A first fit has the former only; pairs are then held against what it
    explains, and the machine is fitted again with the terms of telling pairs.
    """
    options = dict(steps=steps, batch=batch, rate=rate, l1=l1, l2=l2, seed=seed)
    if not len(labels) or not 0 < float(labels.mean()) < 1:
        return _descend(sets, labels, np.zeros(BUCKETS, bool), **options)
    telling = telling_buckets(sets, labels, least_z)
    single = _descend(sets, labels, telling, pairs=False, **options)
    expected = _sigmoid(np.array([single.bias + single.weights[s].sum() for s in sets]))
    telling |= paired_buckets(sets, labels, expected, least_docs, chance)
    return _descend(sets, labels, telling, **options)


def _descend(sets: list[np.ndarray], labels: np.ndarray, telling: np.ndarray, *, steps: int, batch: int, rate: float,
             l1: float, l2: float, seed: int, pairs: bool = True) -> Machine:
    """AdaGrad on the logistic loss over the telling terms; the weights' l1 term sets those of idle words to zero."""
    rng = np.random.default_rng(seed)
    share = float(labels.mean()) if len(labels) else 0.0
    prior = float(np.log(max(share, 1e-6) / max(1 - share, 1e-6)))
    model = Machine(prior, np.zeros(BUCKETS, np.float32), np.zeros((BUCKETS, FACTORS), np.float32))
    if not 0 < share < 1:
        return model
    if pairs:
        model.factors[telling] = rng.normal(0, 0.01, (int(telling.sum()), FACTORS))
    # a last id that no text has keeps texts without telling terms in the fit
    idle = BUCKETS
    model.weights, model.factors = np.r_[model.weights, np.float32(0)], np.r_[model.factors, np.zeros((1, FACTORS), np.float32)]
    sets = [np.r_[s[telling[s]], idle] for s in sets]
    grad_w, grad_v = np.full(BUCKETS + 1, 1e-6, np.float32), np.full((BUCKETS + 1, FACTORS), 1e-6, np.float32)
    grad_b = 1e-6
    for _ in range(steps):
        part = rng.integers(0, len(sets), batch)
        ids = np.concatenate([sets[k] for k in part])
        sizes = np.array([len(sets[k]) for k in part])
        starts = np.cumsum(sizes) - sizes
        margin, sums = model.margins(ids, starts)
        slope = ((_sigmoid(margin) - labels[part]) / batch).astype(np.float32)
        per_id = np.repeat(slope, sizes)
        step_v = per_id[:, None] * (np.repeat(sums, sizes, axis=0) - model.factors[ids])
        order = np.argsort(ids, kind="stable")
        first = np.flatnonzero(np.r_[True, np.diff(ids[order]) > 0])
        which = ids[order][first]
        g = np.add.reduceat(per_id[order], first)
        gv = np.add.reduceat(step_v[order], first, axis=0) + l2 * model.factors[which]
        g[which == idle], gv[which == idle] = 0, 0
        grad_w[which] += g * g
        grad_v[which] += gv * gv
        grad_b += float(slope.sum()) ** 2
        pace = rate / np.sqrt(grad_w[which])
        moved = model.weights[which] - pace * g
        model.weights[which] = np.sign(moved) * np.maximum(np.abs(moved) - pace * l1, 0)
        model.factors[which] -= 0.3 * rate / np.sqrt(grad_v[which]) * gv
        model.bias -= rate * float(slope.sum()) / grad_b ** 0.5
    return Machine(model.bias, model.weights[:-1], model.factors[:-1])


def training_rows(spark: SparkSession, docs: DataFrame, labels: DataFrame, *, fold: Column | None, id_col: str,
                  text_col: str, label_id_col: str, label_col: str, sample: int,
                  cache: int = _CACHE) -> tuple[list[np.ndarray], np.ndarray]:
    """Term sets and labels of at most ``sample`` labelled rows of the fold."""
    known = labels.select(F.col(f"`{label_id_col}`").cast("long").alias("label_id"),
                          F.col(f"`{label_col}`").cast("int").alias("label")).where(
        F.col("label").isNotNull() & F.col("label_id").isNotNull())
    known = known.groupBy("label_id").agg(F.max("label").alias("label"))
    if fold is not None:
        known = known.where(fold)
    chosen = known.orderBy(F.xxhash64("label_id"), "label_id").limit(sample)

    @F.pandas_udf("binary")
    def buckets(texts: pd.Series) -> pd.Series:
        _take(cache)
        return pd.Series([term_buckets(t).tobytes() for t in texts])

    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("label_id"), text_of(text_col).alias("text"))
    # the sample's bound is the size of the broadcast; one text per id
    rows = texts.join(F.broadcast(chosen), "label_id").select("label_id", "label", buckets("text").alias("b"))
    rows = rows.groupBy("label_id").agg(F.max("label").alias("label"), F.max("b").alias("b")).toPandas()
    rows = rows.sort_values("label_id")
    return [np.frombuffer(b, "<i4") for b in rows["b"]], rows["label"].to_numpy(np.float32)


def train(spark: SparkSession, docs: DataFrame, labels: DataFrame, *, fold: Column | None = None,
          id_col: str = "doc_id", text_col: str = "text", label_id_col: str = "doc_id", label_col: str = "toxic",
          sample: int = SAMPLE, cache: int = _CACHE) -> Machine:
    """The machine of a bounded sample; ``fold`` is a condition on ``label_id``.

    ``cache`` is the number of words whose terms a worker remembers; it changes memory and speed only.
    """
    sets, y = training_rows(spark, docs, labels, fold=fold, id_col=id_col, text_col=text_col,
                            label_id_col=label_id_col, label_col=label_col, sample=sample, cache=cache)
    return fit(sets, y)


def scores(spark: SparkSession, model: Machine, text: Column, cache: int = _CACHE) -> Column:
    """Score (0 to 1) of a column of text bytes; ``cache`` as for ``train``."""
    useful = np.flatnonzero((model.weights != 0) | (np.abs(model.factors).max(axis=1) > 0))
    shared = spark.sparkContext.broadcast((uuid.uuid4().hex, model.bias, useful, model.weights[useful], model.factors[useful]))

    @F.pandas_udf("double")
    def score(texts: pd.Series) -> pd.Series:
        _take(cache)
        own = _machine(shared.value)
        out = np.full(len(texts), own.bias)
        for k, text in enumerate(texts):
            ids = term_buckets(text)
            if len(ids):
                out[k] = own.margins(ids, np.zeros(1, np.int64))[0][0]
        return pd.Series(_sigmoid(out.astype(np.float64)))

    return score(text)


_MACHINES: dict[str, Machine] = {}


def _take(cache: int) -> None:
    # a task's function names this one, not the caches: those it names itself are sent to it as copies
    hold("toxicity", _release)
    _TERMS.most = cache


def _release() -> None:
    _TERMS.clear()
    _MACHINES.clear()


def _machine(packed) -> Machine:
    """The broadcast machine, unpacked once per worker under its own name (only the latest is held)."""
    name, bias, useful, weights, factors = packed
    if name not in _MACHINES:
        model = Machine(bias, np.zeros(BUCKETS, np.float32), np.zeros((BUCKETS, FACTORS), np.float32))
        model.weights[useful], model.factors[useful] = weights, factors
        _MACHINES.clear()
        _MACHINES[name] = model
    return _MACHINES[name]


def keep_clean(spark: SparkSession, docs: DataFrame, model: Machine, *, text_col: str = "text",
               threshold: float = 0.7, cache: int = _CACHE) -> DataFrame:
    """The rows that score under the threshold, whole and unchanged."""
    return docs.where(scores(spark, model, text_of(text_col), cache) < threshold)
