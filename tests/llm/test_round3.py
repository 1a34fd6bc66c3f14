"""N-gram join, Merkle manifest and fill-in-middle against plain versions, with edge rows."""

from __future__ import annotations

import hashlib
import os
import random
import sys
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
from shopstream.llm import fill_middle, merkle, ngram_join, text_runs  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, node string, row string, total string"


def near_rows():
    """Copies with few edits, a shared passage, short texts, blanks, nulls, repeated ids, one long text."""
    rnd = random.Random(5)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(rnd.randrange(2, 7)))
    passage = " ".join(word() for _ in range(60))
    rows = [(1, None), (2, ""), (3, " \n\t"), (4, "one"), (5, "ONE"), (6, "one two"), (7, "one  two\x0b"), (8, "x y z"),
            (9, "w " * 20000), (10, "W\n" * 20000), (None, "x y z"), (8, "x y z")]
    for group in range(12):
        base = [word() for _ in range(rnd.choice([12, 40, 70, 200, 900]))]
        for k in range(rnd.choice([2, 3, 9])):
            own = list(base)
            for _ in range(rnd.randrange(0, max(1, len(base) // 40) + 1)):
                own[rnd.randrange(len(own))] = word()
            if group % 3 == 0:
                own += passage.split()
            rows.append((100 + 20 * group + k, rnd.choice([" ", "  ", "\n"]).join(own)))
    for k in range(60):  # many documents of little but a shared passage
        rows.append((1000 + k, passage + " " + " ".join(word() for _ in range(k % 9))))
    rnd.shuffle(rows)
    return rows


def grams(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    own = brute.re.findall(r"[^\x20\x09-\x0D]+", lowered)
    size = min(3, len(own))
    return {tuple(own[k:k + size]) for k in range(len(own) - size + 1)} if size else set()


def components(docs, percent):
    sets = [grams(t) for _, t in docs]
    parent = list(range(len(docs)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for a in range(len(docs)):
        for b in range(a):
            if sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    parent[find(a)] = find(b)
    least = {}
    for k, (doc_id, _) in enumerate(docs):
        least[find(k)] = min((x for x in (least.get(find(k)), doc_id) if x is not None), default=None)
    return [(d, len(s), least[find(k)]) for k, ((d, _), s) in enumerate(zip(docs, sets))]


def frame(spark, rows):
    return spark.createDataFrame([(d, t, "en", "a", 1, "own", "own", "own") for d, t in rows], SCHEMA)


@pytest.mark.parametrize("percent,pairs,triples", [(90, 7, 14), (80, 2, 4), (90, 1, 2)])
def test_ngram_join_loses_no_link(spark, monkeypatch, percent, pairs, triples):
    """Also with most tokens counted as frequent, so that combinations carry the join."""
    from pyspark import cloudpickle

    monkeypatch.setattr(ngram_join, "PAIRS_FROM", pairs)
    monkeypatch.setattr(ngram_join, "TRIPLES_FROM", triples)
    monkeypatch.setattr(ngram_join, "SHORT", 16)
    cloudpickle.register_pickle_by_value(ngram_join)  # tasks see the changed values
    try:
        rows = near_rows()
        found = ngram_join.similar_documents(spark, frame(spark, rows), percent=percent)
        got = sorted(map(tuple, found.collect()), key=repr)
    finally:
        cloudpickle.unregister_pickle_by_value(ngram_join)
    assert got == sorted(components(rows, percent), key=repr)


def test_linked_sets_share_a_signature():
    rng = np.random.default_rng(2)
    for trial in range(300):
        n = int(rng.integers(1, 600))
        common = rng.integers(0, 1 << 63, n).astype(np.uint64)
        levels = {int(t): int(rng.choice([0, 3, 8, 9, 15, ngram_join._UNCOUNTED])) for t in common}
        own = [np.unique(np.r_[rng.permutation(common)[:n - int(rng.integers(0, n // 12 + 1))],
                               rng.integers(0, 1 << 63, int(rng.integers(0, n // 12 + 1))).astype(np.uint64)])
               for _ in range(2)]
        both = len(np.intersect1d(*own))
        if 100 * both < 90 * (len(own[0]) + len(own[1]) - both):
            continue
        a, b = (ngram_join.signatures(x, np.array([levels.get(int(t), 0) for t in x], np.int8), 90) for x in own)
        assert len(np.intersect1d(a, b)), (trial, n)


def test_candidate_edges_rule_out_no_link():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 300).astype(np.uint64)
    sets = [np.unique(np.r_[rng.permutation(base)[:300 - k % 25], rng.integers(0, 1 << 63, k % 14).astype(np.uint64)])
            for k in range(60)]
    bits = ngram_join._folded([ngram_join.bitmap(s) for s in sets])
    n = np.array([len(s) for s in sets])
    node = np.arange(60)
    found = {(min(x, y), max(x, y)) for a, b in ngram_join.candidate_edges(node, n, bits, np.zeros(60, int), node, 90)
             for x, y in zip(a.tolist(), b.tolist())}
    linked = {(a, b) for a in range(60) for b in range(a + 1, 60)
              if 100 * len(np.intersect1d(sets[a], sets[b])) >= 90 * len(np.union1d(sets[a], sets[b]))}
    assert linked and linked <= found


@pytest.mark.parametrize("hold", [4, 1 << 16])
def test_shared_signatures(monkeypatch, hold):
    import pyarrow as pa

    monkeypatch.setattr(ngram_join, "_HELD", hold)
    rng = np.random.default_rng(0)
    rows = sorted((int(rng.integers(0, 30)), int(rng.integers(0, 9)), 1) for _ in range(300))
    rows += [(99, 1, 1), (99, 1, 1), (100, 5, 1)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows[k:k + 17])], names=["sig", "d1", "d2"])
               for k in range(0, len(rows), 17)]
    got = {}
    for b in ngram_join._shared(iter(batches)):
        for bucket, d1, _ in zip(*(c.to_pylist() for c in b.columns)):
            got.setdefault(bucket, set()).add(d1)
    want = {}
    for sig, d1, _ in rows:
        want.setdefault(sig, set()).add(d1)
    assert {frozenset(v) for v in got.values() if len(v) > 1} == {frozenset(v) for v in want.values() if len(v) > 1}


def test_run_hashes_depend_on_the_run_alone():
    texts = [b"the Cat sat", b"", b" cat\nTHE\x0b", b"sat" * 3, b"q" * 5000 + b" the"]
    hashes, bounds = text_runs.words(texts)
    words = [w for t in texts for w in t.lower().split()]
    assert bounds.tolist() == [0, 3, 3, 5, 6, 8] and len(hashes) == len(words)
    assert len({(w, int(h)) for w, h in zip(words, hashes)}) == len(set(words)) == len(set(hashes.tolist()))
    old, text_runs.SEGMENT = text_runs.SEGMENT, 7
    try:
        assert text_runs.words(texts)[0].tolist() == hashes.tolist()
    finally:
        text_runs.SEGMENT = old


def sha(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_merkle(rows, arity):
    """(leaf, subroot, root, proof) per row of (doc_id, source, lang, n_chars, text), level by level."""
    leaves = [sha(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in r)) for r in rows]
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is not None, rows[k][0] or 0, leaves[k]))

    def tree(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            x = levels[-1]
            levels.append([sha(*x[k:k + arity]) for k in range(0, len(x), arity)])
        return levels

    def siblings(levels, at):
        out = []
        for x in levels[:-1]:
            first = at - at % arity
            out += [x[k] for k in range(first, min(len(x), first + arity)) if k != at]
            at //= arity
        return out

    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    trees = {g: tree([leaves[k] for k in order if rows[k][2] == g]) for g in langs}
    top = tree([trees[g][-1][0] for g in langs])
    out = []
    for g in langs:
        for place, k in enumerate(k for k in order if rows[k][2] == g):
            path = siblings(trees[g], place) + siblings(top, langs.index(g))
            out.append((rows[k][0], leaves[k], trees[g][-1][0], top[-1][0], sha(*path)))
    return out


@pytest.mark.parametrize("arity,depth", [(2, 2), (2, 10), (3, 2), (4, 1)])
def test_merkle_manifest_of_any_shape(spark, arity, depth):
    rnd = random.Random(arity * depth)
    rows = [(k, "s", rnd.choice([None, "en", "fr", "é", "z"]), rnd.choice([None, k]), rnd.choice([None, "", "é\n", f"t{k}"]))
            for k in range(45)]
    rows += [(None, None, None, None, None), (7, "s", "en", 1, "again"), (7, "s", "en", 1, "again"), (99, "s", "alone", 1, "x")]
    docs = spark.createDataFrame([(d, t, g, s, n, "own", "own", "own") for d, s, g, n, t in rows], SCHEMA)
    tampered = F.crc32(F.col("doc_id").cast("string")) % 7 == 0
    found = merkle.audit(spark, docs, {"n_chars": F.when(tampered, F.col("n_chars") + 1).otherwise(F.col("n_chars"))},
                         arity=arity, depth=depth).collect()
    got = sorted(((r.doc_id, r.leaf, r.subroot, r.root, r.proof_sha256) for r in found), key=repr)
    assert got == sorted(plain_merkle(rows, arity), key=repr)
    changed = {r[0] for r in rows if r[0] is not None and r[3] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0}
    assert changed and all(r.verified == (r.doc_id not in changed) == (r.folded_root == r.root) for r in found)


def test_merkle_manifest_of_nothing(spark):
    assert merkle.build(spark, spark.createDataFrame([], SCHEMA)).root is None


def fim_rows():
    rows = [(k, f"w{k} \té한 " * (k % 9) + "\n" * (k % 3)) for k in range(120)]
    return rows + [(None, "a b c d"), (200, None), (201, ""), (202, "has <P> in it"), (203, "ends with < S"),
                   (204, "<<P" * 500), (205, "x" * 700_000 + " tail"), (206, "many words " * 30_000), (3, "again"), (3, "again")]


def plain_fim(doc_id, text):
    text = text or ""
    units = brute.re.findall(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+", text)
    n = len(units)
    h = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[k:k + 8], 16) for k in (0, 8, 16, 24))
    a, b = sorted((h1 % (n + 1), h2 % (n + 1)))
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    digest = hashlib.sha256(text.encode()).hexdigest()
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 50:
        return doc_id, n, "plain", None, None, digest, digest, text
    form = "spm" if h4 % 100 < 80 else "psm"
    out = f"<S>{s}<P>{p}<M>{m}" if form == "spm" else f"<P>{p}<S>{s}<M>{m}"
    return doc_id, n, form, len(p), len(m), hashlib.sha256(out.encode()).hexdigest(), digest, out


def test_fill_middle_equals_the_plain_version(spark):
    rows = fim_rows()
    want = [plain_fim(*r) for r in rows]
    assert {w[2] for w in want} == {"plain", "spm", "psm"}
    docs = frame(spark, rows)
    got = [tuple(r) for r in fill_middle.round_trip(spark, docs).collect()]
    assert sorted(got, key=repr) == sorted((w[:-1] for w in want), key=repr)
    outputs = [(r.doc_id, r.form, r.text) for r in fill_middle.outputs(docs).collect()]
    assert sorted(outputs, key=repr) == sorted(((w[0], w[2], w[-1]) for w in want), key=repr)


@pytest.mark.parametrize("size", [1, 2, 3, 50])
def test_the_splitter_finds_marks_across_pieces(size):
    body = {"prefix": b"a<P b<", "suffix": b"<<", "middle": b""}
    for form, order in fill_middle.ORDERS.items():
        output = b"".join(fill_middle.MARKS[s] + body[s] for s in order)
        splitter, got = fill_middle.Splitter(form), dict.fromkeys(body, b"")
        for at in range(0, len(output), size):
            for segment, part in splitter.feed(output[at:at + size]):
                got[segment] += part
        assert got == body and not splitter.waiting


def test_a_signature_of_many_documents_is_dealt_out(spark, monkeypatch):
    from pyspark import cloudpickle

    monkeypatch.setattr(ngram_join, "CELL", 8)
    cloudpickle.register_pickle_by_value(ngram_join)
    try:
        rows = near_rows()
        got = sorted(map(tuple, ngram_join.similar_documents(spark, frame(spark, rows)).collect()), key=repr)
    finally:
        cloudpickle.unregister_pickle_by_value(ngram_join)
    assert got == sorted(components(rows, 90), key=repr)
