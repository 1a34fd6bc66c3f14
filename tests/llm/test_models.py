"""Quality posteriors and toxicity margins, computed again in plain Python."""

from __future__ import annotations

import math
from collections import defaultdict
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

from shopstream.llm import quality, toxicity
from shopstream.llm.common import text_of

SF = "/root/testdata/sf0.001"


def _strength(groups, levels):
    """Prior strength of groups [(n, p)] around their prior means, by moments."""
    sizes = sum(n for n, _ in groups)
    sampled = [m * (1 - m) for m in levels]
    spread = sum(n * (p / n - m) ** 2 for (n, p), m in zip(groups, levels)) - sum(sampled)
    weight = sizes - sum(n * n for n, _ in groups) / sizes
    between = max(spread / max(weight, 1.0), 1e-6)
    return max(sum(s * n for s, (n, _) in zip(sampled, groups)) / sizes / between - 1, 1.0)


def plain_posteriors(rows, model):
    """{doc_id: (evidence, host_mean, path_mean, score)} of rows (doc_id, host, path, text)."""
    odds = {d: float(model.log_odds(np.array([quality.features((text or "").encode())]))[0]) for d, _, _, text in rows}
    q = {d: 1 / (1 + math.exp(-o)) for d, o in odds.items()}
    hosts, paths = defaultdict(lambda: [0, 0.0]), defaultdict(lambda: [0, 0.0])
    for d, host, path, _ in rows:
        for group in (hosts[host], paths[host, path]):
            group[0] += 1
            group[1] += q[d]
    mean = min(max(sum(q.values()) / len(q), 1e-3), 1 - 1e-3)
    k_host = _strength(list(hosts.values()), [mean] * len(hosts))
    level = {h: (k_host * mean + p) / (k_host + n) for h, (n, p) in hosts.items()}
    k_path = _strength(list(paths.values()), [level[h] for h, _ in paths])
    out = {}
    for d, host, path, _ in rows:
        (hn, hp), (n, p) = hosts[host], paths[host, path]
        host_mean = (k_host * mean + hp - q[d]) / (k_host + hn - 1)
        path_mean = (k_path * host_mean + p - q[d]) / (k_path + n - 1)
        bounded = min(max(path_mean, 1e-3), 1 - 1e-3)
        evidence = odds[d] - model.prior
        out[d] = (evidence, host_mean, path_mean, 1 / (1 + math.exp(-(evidence + math.log(bounded / (1 - bounded))))))
    return out


@pytest.mark.parametrize("sparse", [False, True])
def test_posteriors_equal_plain_python(spark, sparse):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    # null hosts and paths form one site; with sparse, most paths have one document
    docs = docs.select("doc_id", F.when(F.col("doc_id") % 9 != 0, F.col("source")).alias("host"), "text",
                       (F.col("doc_id").cast("string") if sparse else F.when(F.col("doc_id") % 5 != 0, F.col("lang"))).alias("path"))
    model = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    found = quality.posteriors(spark, docs, model, host=F.col("host"), path=F.col("path")).collect()
    expected = plain_posteriors([(r.doc_id, r.host, r.path, r.text) for r in docs.collect()], model)
    assert len(found) == len(expected) == docs.count()
    for r in found:
        assert (r.evidence, r.host_mean, r.path_mean, r.score) == pytest.approx(expected[r.doc_id], rel=1e-9, abs=1e-12)
        assert r.kept == (r.score >= 0.5)


def test_scores_are_weights_plus_every_pair(spark):
    rng = np.random.default_rng(3)
    texts = ["you are an idiot", "idiot idiot IDIOT", "", None, "nobody knows", "kind people, idiot people"]
    model = toxicity.Machine(-0.4, np.zeros(toxicity.BUCKETS, np.float32),
                             np.zeros((toxicity.BUCKETS, toxicity.FACTORS), np.float32))
    used = np.unique(np.concatenate([toxicity.term_buckets((t or "").encode()) for t in texts[:2] + texts[5:]]))
    model.weights[used] = rng.normal(0, 0.5, len(used))
    model.factors[used] = rng.normal(0, 0.3, (len(used), toxicity.FACTORS))

    def plain(text):
        terms = toxicity.term_buckets((text or "").encode())
        margin = model.bias + sum(float(model.weights[t]) for t in terms)
        margin += sum(float(np.dot(model.factors[a].astype(float), model.factors[b])) for a, b in combinations(terms, 2))
        return 1 / (1 + math.exp(-margin))

    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    found = docs.select("doc_id", toxicity.scores(spark, model, text_of()).alias("score")).collect()
    assert {r.doc_id: r.score for r in found} == {k: pytest.approx(plain(t), abs=1e-5) for k, t in enumerate(texts)}
    assert plain(texts[0]) != pytest.approx(plain(texts[1]), abs=1e-3)


def test_a_pair_weighs_more_than_its_terms():
    """Two terms that say nothing alone are toxic together; a linear model can't tell that."""
    rng = np.random.default_rng(5)
    sets, labels = [], []
    for k in range(1200):
        terms = {int(t) for t in rng.integers(1000, 1400, 12)} | {t for t, on in ((10, k % 2), (20, k // 2 % 2)) if on}
        sets.append(np.array(sorted(terms), "<i4"))
        labels.append(float(k % 2 == k // 2 % 2))
    model = toxicity.fit(sets, np.array(labels, np.float32))
    margin = {name: float(model.margins(np.array(ids, "<i4"), np.zeros(1, np.int64))[0][0])
              for name, ids in {"both": [10, 20], "first": [10], "second": [20]}.items()}
    assert margin["both"] > 0 > max(margin["first"], margin["second"])
