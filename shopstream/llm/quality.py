"""Quality classifier with hierarchical empirical Bayes.

A logistic classifier over text statistics gives each document evidence of its
own. Hosts and paths add what their other documents say: their mean quality is
shrunk to the level above (path to host, host to the whole corpus) by a prior
whose strength is estimated from how much the sites differ. A site with few
documents stays close to its prior, one with many speaks for itself. A
document's own evidence never counts in the posterior of its site.

Defined cases: a null or empty text has statistics of zero; null hosts and
paths form one site of their own; null labels are left out; without labels of
both kinds the evidence is nil and everything is kept; repeated rows get equal
results; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shopstream.llm.common import cut, text_of

SAMPLE = 20_000  # labelled rows that the fit may take
N_FEATURES = 9

_SYMBOLS = re.compile(rb"[^\x20\x09-\x0D\w.,;:!?'\"()\x80-\xff-]")
_UPPER = re.compile(rb"[A-Z]")


def features(text: bytes) -> list[float]:
    """Length, symbols, capitals, repetition and layout of a text, each between 0 and 1 or so."""
    words = text.lower().split()
    n = len(words)
    if not n:
        return [0.0] * N_FEATURES
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    repeats = sum(a == b for a, b in zip(words, words[1:]))
    letters = len(text)
    lines = text.split(b"\n")
    return [np.log1p(n) / 10, min(1.0, 5 * len(_SYMBOLS.findall(text)) / letters),
            len(_UPPER.findall(text)) / letters, repeats / n, len(counts) / n, max(counts.values()) / n,
            text.count(b"|") / n, min(1.0, text.count(b"!") / n), len(set(lines)) / len(lines)]


@dataclass
class Classifier:
    """Logistic model; ``prior`` is the log odds of the sample it was fitted on."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    prior: float

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        z = np.clip((x - self.mean) / self.scale, -8, 8)
        return np.clip(np.c_[np.ones(len(z)), z, z * z] @ self.weights, -15, 15)


def fit(x: np.ndarray, y: np.ndarray, *, ridge: float = 1.0, rounds: int = 25) -> Classifier:
    """Newton steps on the penalised logistic loss, with squares of the standardised statistics."""
    width = 1 + 2 * N_FEATURES
    share = float(y.mean()) if len(y) else 1.0
    if not 0 < share < 1:
        return Classifier(np.zeros(N_FEATURES), np.ones(N_FEATURES), np.zeros(width), 0.0)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-9
    model = Classifier(mean, scale, np.zeros(width), float(np.log(share / (1 - share))))
    z = np.clip((x - mean) / scale, -8, 8)
    z = np.c_[np.ones(len(z)), z, z * z]
    penalty = ridge * np.eye(width)
    penalty[0, 0] = 1e-6
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(z @ model.weights, -15, 15)))
        hessian = (z * (p * (1 - p))[:, None]).T @ z + penalty
        step = np.linalg.solve(hessian, z.T @ (y - p) - penalty @ model.weights)
        model.weights = model.weights + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return model


def train(docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text",
          label_id_col: str = "doc_id", label_col: str = "quality", sample: int = SAMPLE) -> Classifier:
    """The classifier of at most ``sample`` labelled rows, those of the least hash of their id."""
    known = labels.select(F.col(f"`{label_id_col}`").cast("long").alias("label_id"),
                          F.col(f"`{label_col}`").cast("double").alias("label")).where(
        F.col("label").isNotNull() & F.col("label_id").isNotNull())
    chosen = known.groupBy("label_id").agg(F.max("label").alias("label")).orderBy(
        F.xxhash64("label_id"), "label_id").limit(sample)

    @F.pandas_udf("array<double>")
    def stats(texts: pd.Series) -> pd.Series:
        return pd.Series([features(t) for t in texts])

    texts = docs.select(F.col(f"`{id_col}`").cast("long").alias("label_id"), text_of(text_col).alias("text"))
    # the sample's bound is the size of the broadcast
    rows = texts.join(F.broadcast(chosen), "label_id").select("label_id", "label", stats("text").alias("x"))
    rows = rows.groupBy("label_id").agg(F.max("label").alias("label"), F.max("x").alias("x")).toPandas()
    rows = rows.sort_values("label_id")
    x = np.array(rows["x"].tolist(), float).reshape(-1, N_FEATURES)
    return fit(x, rows["label"].to_numpy(float))


def _strength(groups: DataFrame, level: Column) -> Column:
    """Prior strength (in documents) of groups with columns n, p and prior mean ``level``, by moments.

    The spread of the group means beyond what sampling explains is the
    variance of the sites; strength = level * (1 - level) / variance - 1.
    """
    mean = F.col("p") / F.col("n")
    sampled = level * (1 - level)
    spread = F.sum(F.col("n") * (mean - level) * (mean - level)) - F.sum(sampled)
    weight = F.sum("n") - F.sum(F.col("n") * F.col("n")) / F.sum("n")
    between = F.greatest(spread / F.greatest(weight, F.lit(1.0)), F.lit(1e-6))
    return F.greatest(F.sum(sampled * F.col("n")) / F.sum("n") / between - 1, F.lit(1.0))


def posteriors(spark: SparkSession, docs: DataFrame, model: Classifier, *, host: Column, path: Column,
               id_col: str = "doc_id", text_col: str = "text", threshold: float = 0.5) -> DataFrame:
    """Per document: doc_id, host, path, evidence, host_mean, path_mean, score, kept.

    ``evidence`` is the classifier's log odds without its prior; the score
    joins it with the log odds of the path's posterior mean.
    """

    @F.pandas_udf("double")
    def log_odds(texts: pd.Series) -> pd.Series:
        return pd.Series(model.log_odds(np.array([features(t) for t in texts]).reshape(-1, N_FEATURES)))

    odds = log_odds(text_of(text_col))
    rows = cut(spark, docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), host.alias("host"),
                                  path.alias("path"), odds.alias("odds")), "quality-evidence")
    rows = rows.withColumn("q", 1 / (1 + F.exp(-F.col("odds"))))
    # partial sums in every task: a host with a third of all rows shuffles one row per task
    paths = cut(spark, rows.groupBy("host", "path").agg(F.count("*").cast("double").alias("n"), F.sum("q").alias("p")),
                "quality-paths")
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("p").alias("p"))
    total = hosts.agg(F.sum("n"), F.sum("p")).first()
    mean = min(max((total[1] or 0.0) / total[0], 1e-3), 1 - 1e-3) if total[0] else 0.5
    k_host = hosts.agg(_strength(hosts, F.lit(mean))).first()[0] or 1.0
    hosts = hosts.select(F.col("host").alias("h"), F.col("n").alias("host_n"), F.col("p").alias("host_p"),
                         ((k_host * mean + F.col("p")) / (k_host + F.col("n"))).alias("host_mean"))
    sites = paths.join(hosts, F.col("host").eqNullSafe(F.col("h"))).drop("h")
    k_path = sites.agg(_strength(sites, F.col("host_mean"))).first()[0] or 1.0
    sites = sites.select(F.col("host").alias("h"), F.col("path").alias("s"), "n", "p", "host_n", "host_p")
    joined = rows.join(sites, F.col("host").eqNullSafe(F.col("h")) & F.col("path").eqNullSafe(F.col("s")))
    host_mean = (k_host * mean + F.col("host_p") - F.col("q")) / (k_host + F.col("host_n") - 1)
    path_mean = (k_path * F.col("host_mean") + F.col("p") - F.col("q")) / (k_path + F.col("n") - 1)
    bounded = F.least(F.greatest("path_mean", F.lit(1e-3)), F.lit(1 - 1e-3))
    score = 1 / (1 + F.exp(-(F.col("evidence") + F.log(bounded / (1 - bounded)))))
    return (joined.withColumn("host_mean", host_mean).withColumn("path_mean", path_mean)
            .withColumn("evidence", F.col("odds") - model.prior).withColumn("score", score)
            .select("doc_id", "host", "path", "evidence", "host_mean", "path_mean", "score",
                    (F.col("score") >= threshold).alias("kept")))
