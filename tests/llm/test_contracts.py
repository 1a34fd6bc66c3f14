"""Registered training-data queries against brute force on whole small tables."""

from __future__ import annotations

import os
import sys
import zlib
from collections import defaultdict

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
import corpus_pipeline  # noqa: E402
from shopstream.llm import exact_dedup, simhash, toxicity  # noqa: E402
from shopstream.llm.oracle import ORACLE  # noqa: E402
from shopstream.llm.queries import QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"


def edge_documents():
    base = " ".join(f"word{k} and" for k in range(60))
    key = "AKIA" + "Z9" * 10
    return [
        (1, None, None, None, None), (2, "", "en", "a", 0), (3, " \t\n\x0b\x0c\r ", "en", "a", 7),
        (4, base, "en", "a", len(base)), (5, base + " ", "en", "b", 1), (6, base.replace("word7", "word8"), "fr", "b", 1),
        (7, "password = 'hunter22xyz' token:abc secret=token:abcdef", "en", "a", 1),
        (8, f"é한 {key} {'0af3' * 8} api-key", "en", "a", 1), (9, f"{key}\nhunter22xyz", "en", "c", 1),
        (10, "Qx7-Zp41_Lm93+Rt05 stays here\n  A shared line of text \nmore", "en", "a", 1),
        (11, "a SHARED line of text\nshort\nshort", "en", "b", 1), (12, "short\n\n\n", "en", "b", 1),
        (13, "x " * 30000, "en", "z", 60000), (14, "   it's  \n\n 12345 ok!?  ", "en", "z", 1),
    ]


@pytest.fixture(scope="module")
def edge_dir(spark, tmp_path_factory):
    """The edge rows as a documents table, and an empty one, with a column named like an operator's own."""
    out = tmp_path_factory.mktemp("edge")
    schema = "doc_id long, text string, lang string, source string, n_chars long, row_id string, kept string"
    rows = [(*r, "own", "own") for r in edge_documents()]
    for name, data in (("some", rows), ("none", [])):
        spark.createDataFrame(data, schema).write.parquet(f"{out}/{name}/documents.parquet")
        for table in ("labels", "benchmark"):
            spark.read.parquet(f"{SF}/{table}.parquet").limit(0 if name == "none" else 1000).write.parquet(
                f"{out}/{name}/{table}.parquet")
    pages = "page_id long, url string, html string, digest string"
    spark.createDataFrame([(1, "u", None, "d"), (2, None, "", "d"), (3, "u\r\nv", "<p>é</p>", "d"), (4, "u", "<p>é</p>", "d"),
                           (5, "u", "x" * 200000, "d"), (6, "u", "WARC/1.1\r\nbad\r\n\r\n", "d")], pages).write.parquet(
        f"{out}/some/pages.parquet")
    spark.createDataFrame([], pages).write.parquet(f"{out}/none/pages.parquet")
    return str(out)


def table(spark, folder, name, *columns):
    return [tuple(r) for r in spark.read.parquet(f"{folder}/{name}.parquet").select(*columns).collect()]


def result(spark, query, folder, *columns):
    return sorted((tuple(r) for r in QUERIES[query](spark, folder).select(*columns).collect()), key=repr)


CONTRACTS = {
    "op1_secret_scan": (brute.secrets, ("doc_id", "n_assign", "n_access", "n_hex", "base_sha256")),
    "op4_content_sort_dedup": (brute.exact, ("doc_id", "keep_id", "group_size", "kept", "text_sha256")),
    "op5_simhash": (brute.near, ("doc_id", "fingerprint", "component_id")),
    "op9_token_files": (brute.token_files, ("doc_id", "start", "n_tokens", "ids_crc32")),
    "op10_line_dedup": (brute.line_dedup, ("doc_id", "n_lines", "n_dropped", "kept_sha256")),
}


@pytest.mark.parametrize("folder", ["sf", "edge"])
@pytest.mark.parametrize("query", list(CONTRACTS))
def test_contract(spark, edge_dir, query, folder):
    folder = SF if folder == "sf" else f"{edge_dir}/some"
    plain, columns = CONTRACTS[query]
    want = plain(table(spark, folder, "documents", "doc_id", "text"))
    assert result(spark, query, folder, *columns) == sorted(want, key=repr)


@pytest.mark.parametrize("folder", ["sf", "edge"])
def test_added_spans(spark, edge_dir, folder):
    folder = SF if folder == "sf" else f"{edge_dir}/some"
    docs = [(*r[:3], f"{r[2]}/{r[3]}" if r[2] else r[3] or "") for r in table(
        spark, folder, "documents", "doc_id", "text", "source", "lang")]
    added = brute.bare_spans(docs)
    want = [(d[0], ",".join(f"{k}:{s}:{e}" for s, _, k, e in sorted(brute.base_spans(d[1]) + added.get(i, []))))
            for i, d in enumerate(docs)]
    assert result(spark, "op1_secret_scan", folder, "doc_id", "spans") == sorted(want, key=repr)
    assert folder == SF or sum(map(len, added.values())) == 1


@pytest.mark.parametrize("folder", ["sf", "edge"])
def test_warc_round_trip(spark, edge_dir, folder):
    folder = SF if folder == "sf" else f"{edge_dir}/some"
    want = brute.pages(table(spark, folder, "pages", "page_id", "html"))
    got = result(spark, "op3_warc", folder, "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("folder", ["sf", "edge"])
def test_packing_covers_every_id_once(spark, edge_dir, folder):
    folder = SF if folder == "sf" else f"{edge_dir}/some"
    ids = dict(brute.token_ids(table(spark, folder, "documents", "doc_id", "text"), "word_bpe_49k.json", 2))
    pieces, sequences = defaultdict(list), defaultdict(list)
    for p in QUERIES["op8_packing"](spark, folder).collect():
        assert zlib.crc32(ids[p.doc_id][p.start:p.start + p.length].tobytes()) == p.ids_crc32
        assert p.doc_tokens == len(ids[p.doc_id])
        pieces[p.doc_id].append((p.start, p.length))
        sequences[p.sequence_id].append((p.offset, p.length))
    total = sum(map(len, ids.values()))
    assert set(pieces) == set(ids) and len(sequences) == -(-total // 4096)
    for parts, size in [(v, len(ids[k])) for k, v in pieces.items()] + [(v, None) for v in sequences.values()]:
        at = 0
        for start, length in sorted(parts):
            assert start == at
            at += length
        assert at == size if size is not None else at <= 4096


def test_decontamination_finds_what_brute_force_finds(spark):
    want = brute.leaks(table(spark, SF, "documents", "doc_id", "text"), table(spark, SF, "benchmark", "item_id", "text"))
    got = {tuple(r) for r in QUERIES["op6_decontamination"](spark, SF).select("doc_id", "item_id").collect()}
    assert want and got >= want
    assert {d for d, _ in got} == {d for d, _ in want}


def test_toxicity_folds_and_range(spark):
    rows = QUERIES["op7_toxicity"](spark, SF).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in rows) and len(rows) == 200


def test_toxicity_held_out(spark):
    folder = "/root/testdata/sf0.1"
    toxic = dict(table(spark, folder, "labels", "doc_id", "toxic"))
    rows = [(toxic[r.doc_id], r.predicted) for r in QUERIES["op7_toxicity"](spark, folder).where("held_out").collect()
            if r.doc_id in toxic]
    hits = sum(t and p for t, p in rows)
    assert hits >= 0.75 * sum(t for t, _ in rows)
    assert sum(p and not t for t, p in rows) <= 0.01 * len(rows)


def test_factors_learn_a_pair_that_weights_miss():
    import numpy as np
    rng = np.random.default_rng(0)
    a, b, c = (int(toxicity.term_buckets(w)[0]) for w in (b"uno", b"due", b"tre"))
    sets, y = [], []
    for _ in range(3000):
        x, z = rng.random(2) < 0.5
        sets.append(np.array(sorted([c] + [a] * int(x) + [b] * int(z)), "<i4"))
        y.append(float(x and z))
    model = toxicity.fit(sets, np.array(y, np.float32))
    margin = lambda *ids: model.margins(np.array(ids), np.zeros(1, int))[0][0]
    assert margin(a, b, c) > 0 > max(margin(a, c), margin(b, c), margin(c))


def test_quality_keeps_clean_documents(spark):
    folder = "/root/testdata/sf0.01"
    good = dict(table(spark, folder, "labels", "doc_id", "quality"))
    rows = [(good[r.doc_id], r.kept) for r in QUERIES["op2_quality"](spark, folder).collect() if r.doc_id in good]
    assert sum(k for g, k in rows if g) >= 0.98 * sum(g for g, _ in rows)
    assert sum(k for g, k in rows if not g) <= 0.1 * sum(1 - g for g, _ in rows)


@pytest.mark.parametrize("query", sorted(ORACLE))
def test_oracle(spark, query):
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "pages"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF}/{name}.parquet')")
    found = con.execute(ORACLE[query])
    columns = [d[0] for d in found.description]
    assert result(spark, query, SF, *columns) == sorted(found.fetchall(), key=repr)


@pytest.mark.parametrize("query", list(QUERIES))
def test_empty_tables(spark, edge_dir, query):
    assert QUERIES[query](spark, f"{edge_dir}/none").collect() == []


@pytest.mark.parametrize("query", ["op2_quality", "op6_decontamination", "op7_toxicity"])
def test_edge_rows(spark, edge_dir, query):
    rows = QUERIES[query](spark, f"{edge_dir}/some").collect()
    assert len(rows) == (0 if query == "op6_decontamination" else len(edge_documents()))


def test_pipeline_against_brute_force(spark):
    """Every stage's rows on its own input; the toxicity stage's model is tested apart."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = [(r.doc_id, r.text) for r in docs.collect()]
        out = stage(spark, docs, SF)
        kept = {r.doc_id for r in out.collect()}
        assert out.columns == docs.columns
        if name == "exact dedup":
            assert kept == {r[0] for r in brute.exact(before) if r[3]}
        elif name == "simhash near-dedup":
            assert kept == {r[2] for r in brute.near(before)}
        elif name == "benchmark decontamination":
            bad = {d for d, _ in brute.leaks(before, table(spark, SF, "benchmark", "item_id", "text"))}
            assert kept == {d for d, _ in before} - bad
        docs = out
    pieces = corpus_pipeline.STAGES[-1][1](spark, docs, SF).collect()
    assert {p.doc_id for p in pieces} == {r.doc_id for r in docs.collect()}


def test_pipeline_runs_on_edge_and_empty_tables(spark, edge_dir):
    assert corpus_pipeline.run(spark, f"{edge_dir}/none").collect() == []
    assert corpus_pipeline.run(spark, f"{edge_dir}/some").count() > 0


def test_repeated_rows_and_ids(spark):
    rows = [(1, "same text here", "x"), (1, "same text here", "x"), (None, "same text here", "y"), (2, "other", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    found = exact_dedup.decisions(spark, docs).collect()
    assert sorted((r.group_size, r.kept) for r in found) == [(1, True), (3, False), (3, False), (3, True)]
    assert [tuple(r) for r in exact_dedup.dedup(spark, docs).orderBy("doc_id").collect()] == [rows[0], rows[3]]
    assert [tuple(r) for r in simhash.dedup(spark, docs).orderBy("doc_id").collect()] == [rows[0], rows[3]]
