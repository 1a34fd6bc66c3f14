"""Toxicity by pairs whose single terms tell little or nothing."""

from __future__ import annotations

import itertools
import math

import numpy as np
import pytest

from shopstream.llm import toxicity


def bucket(word):
    return int(toxicity.term_buckets(word.encode())[0])


# (insult, group) shares among toxic and other texts: both, insult only, group only
EQUAL_SINGLES = (0.2, 0.0, 0.0), (0.0, 0.2, 0.2)
NEARLY = (0.2, 0.3, 0.0), (0.0, 0.02, 0.15)


@pytest.mark.parametrize("toxic, other", [EQUAL_SINGLES, NEARLY])
def test_a_pair_tells_whose_terms_alone_do_not(toxic, other):
    rng = np.random.default_rng(3)
    insult, group, plain = bucket("uno"), bucket("due"), bucket("sei")
    idle = np.array([bucket(f"z{k}") for k in range(300)])
    likely = 1 / np.arange(1, 301) ** 0.7

    def text(*own):
        return np.unique(np.r_[rng.choice(idle, 25, p=likely / likely.sum()), own]).astype("<i4")

    kinds = (insult, group), (insult,), (group,)
    sets, labels = [], []
    for label, count, shares in ((1, 500, toxic), (0, 9500, other)):
        for k in range(count):
            at = np.searchsorted(np.cumsum(shares), (k + 0.5) / count, "right")
            sets.append(text(*(kinds[at] if at < 3 else (plain,) if label else ())))
            labels.append(label)
    labels = np.array(labels, np.float32)
    assert not toxicity.telling_buckets(sets, labels, 4.0)[group]  # by itself the group word tells too little
    model = toxicity.fit(sets, labels)

    def margins(*own):
        return np.array([model.margins(text(*own), np.zeros(1, int))[0][0] for _ in range(100)])

    both, apart = margins(insult, group), max(np.median(margins(group)), np.median(margins(insult)))
    assert np.median(both) > apart + 1 and np.mean(both > 0.85) > 0.95
    assert np.median(margins(group)) < 0 and np.median(margins()) < 0


def test_paired_buckets_are_those_of_every_pair():
    rng = np.random.default_rng(1)
    found = 0
    for trial in range(12):
        n, words = 400, 14
        x = rng.random((n, words)) < rng.uniform(0.05, 0.7, words)
        labels = (rng.random(n) < np.where(x[:, 0] & x[:, 1], 0.9 if trial % 2 else 0.02, 0.3)).astype(np.float32)
        expected = np.clip(rng.normal(0.3, 0.05, n), 0.01, 0.99)
        got = toxicity.paired_buckets([np.flatnonzero(r).astype("<i4") for r in x], labels, expected, 5, 0.01, block=4)
        common = [w for w in range(words) if x[:, w].sum() >= 5]
        least = math.log(len(common) * (len(common) - 1) / 2 / 0.01)
        want = set()
        for a, b in itertools.combinations(common, 2):
            both = x[:, a] & x[:, b]
            if size := int(both.sum()):
                k, e = float(labels[both].mean()), float(expected[both].mean())
                apart = sum(p * math.log(p / q) for p, q in ((k, e), (1 - k, 1 - e)) if p > 0)
                want |= {a, b} if size * apart >= least else set()
        assert set(np.flatnonzero(got)) == want
        found += len(want)
    assert found
