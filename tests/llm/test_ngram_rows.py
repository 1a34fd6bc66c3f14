"""Groups of copies that are near, but not near enough to link: rows in proportion, not pairs."""

import numpy as np
import pytest

from shopstream.llm import ngram_join
from shopstream.llm.common import cuts_made

GROUP = 300


def rows():
    """100 common words and 6 own ones: 100 of 112 are shared, below 90 %; the first ten have a linked copy."""
    base = " ".join(f"c{k}" for k in range(100))
    own = [f"{base} " + " ".join(f"o{k}x{m}" for m in range(6)) for k in range(GROUP)]
    return [*enumerate(own), *((1000 + k, f"{own[k]} extra{k}") for k in range(10))]


@pytest.mark.parametrize("cell, cell_bytes", [(4096, 32 << 20), (64, 20_000)])
def test_near_copies_that_do_not_link_make_no_pair_list(spark, monkeypatch, cell, cell_bytes):
    from pyspark import cloudpickle

    monkeypatch.setattr(ngram_join, "CELL", cell)
    monkeypatch.setattr(ngram_join, "CELL_BYTES", cell_bytes, raising=False)
    cloudpickle.register_pickle_by_value(ngram_join)
    try:
        docs = spark.createDataFrame(rows(), "doc_id long, text string")
        with cuts_made() as made:
            got = {r.doc_id: r.component_id for r in ngram_join.similar_documents(spark, docs, size=1).collect()}
    finally:
        cloudpickle.unregister_pickle_by_value(ngram_join)
    assert got == {k: k % 1000 for k, _ in rows()}
    edges = [spark.read.parquet(f).count() for f in made if any(n in f for n in ("-edges", "-contested", "ngram-links"))]
    assert 0 < max(edges) <= 20 * GROUP  # of 18,000 pairs


def test_linked_edges_join_what_links():
    rng = np.random.default_rng(6)
    base = rng.integers(0, 1 << 63, 200).astype(np.uint64)
    sets = [np.unique(np.r_[rng.permutation(base)[:200 - int(rng.integers(0, 22))],
                            rng.integers(0, 1 << 63, int(rng.integers(0, 14))).astype(np.uint64)]) for _ in range(80)]
    node = rng.permutation(80)
    label = np.where(rng.random(80) < 0.3, 1000 + rng.integers(0, 4, 80), node)
    for side in (np.zeros(80, int), rng.integers(1, 3, 80)):
        root = {int(x): int(y) for x, y in zip(node, label)}

        def joined(pairs):
            own = dict(root)
            for a, b in pairs:
                old, new = own[a], own[b]
                own = {k: new if v == old else v for k, v in own.items()}
            groups = {}
            for k, v in own.items():
                groups.setdefault(v, set()).add(k)
            return sorted(map(sorted, groups.values()))

        linked = {(int(node[x]), int(node[y])) for x in range(80) for y in range(x)
                  if (not side[x] or side[x] != side[y])
                  and 100 * len(np.intersect1d(sets[x], sets[y])) >= 90 * len(np.union1d(sets[x], sets[y]))}
        found = [(int(x), int(y)) for a, b in ngram_join.linked_edges(node, sets, side, label, 90) for x, y in zip(a, b)]
        assert len(joined(linked)) < len(joined([])) and joined(found) == joined(linked)
        assert len(found) < 80 and all((a, b) in linked or (b, a) in linked for a, b in found)
