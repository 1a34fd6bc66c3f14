"""Parts of the training-data operators that need no Spark session."""

from __future__ import annotations

import io
import os
import random
import sys

import numpy as np
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import brute  # noqa: E402
from shopstream.llm import simhash, token_files, warc  # noqa: E402
from shopstream.llm.tokens import Encoder  # noqa: E402


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_encoder_equals_the_library(name):
    import public_tokenizers

    from tokenizers import Tokenizer

    encoder, fresh = Encoder(str(public_tokenizers.path(name))), Tokenizer.from_file(str(public_tokenizers.path(name)))
    rnd = random.Random(3)
    letters = "abÉé÷ 'é́가\xa0　\t\n\x0b\x1c\x85.1,!?'sΣ<|endoftext|>"
    for _ in range(1500):
        text = "".join(rnd.choice(letters) for _ in range(rnd.randrange(14)))
        want = fresh.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.encode(text.encode()), "<u4").tolist() == want, text


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_special_tokens_in_a_text_are_what_the_library_makes_of_them(name):
    import public_tokenizers
    from tokenizers import Tokenizer

    path = str(public_tokenizers.path(name))
    texts = ["a <|endoftext|> b", "<|ENDOFTEXT|>", "x<|startoftext|>y", "<|endoftext", "a < b |> c", "many words, " * 50]
    for special in (False, True):
        encoder, fresh = Encoder(path, special_as_text=special), Tokenizer.from_file(path)
        fresh.encode_special_tokens = special
        want = [fresh.encode(t, add_special_tokens=False).ids for t in texts]
        got = encoder.encode_batch([t.encode() for t in texts])
        assert [np.frombuffer(x, "<u4").tolist() for x in got] == want


def test_a_worker_holds_the_caches_of_one_operator():
    from shopstream.llm import common, decontaminate, toxicity

    common.hold("toxicity", toxicity._release)
    toxicity.term_buckets(b"some words")
    common.hold("toxicity", toxicity._release)
    assert toxicity._TERMS
    common.hold("decontamination", decontaminate._HASHES.clear)
    assert not toxicity._TERMS
    decontaminate.token_hashes("some words")
    common.hold("toxicity", toxicity._release)
    assert not decontaminate._HASHES


@pytest.mark.parametrize("bits", [False, True])
def test_token_file_round_trip(bits):
    rng = np.random.default_rng(1)
    docs = [(k, rng.integers(0, 1 << 17, n).astype("<u4").tobytes()) for k, n in enumerate([1, 0, 5, 70000, 3, 200000])]
    sink = io.BytesIO()
    writer = token_files.FileWriter(sink, bits)
    for doc_id, ids in docs:
        writer.add(doc_id, ids)
    size = writer.close()
    assert size == len(sink.getvalue())
    got = list(token_files.FileReader(io.BytesIO(sink.getvalue()), size).documents())
    assert [(d, ids) for d, _, ids in got] == docs


def test_bit_sliced_links_equal_brute_force():
    rng = np.random.default_rng(0)
    for trial in range(40):
        n = int(rng.integers(0, 150))
        groups = np.sort(rng.integers(0, 6, n))
        values = rng.integers(0, 1 << 63, n).astype(np.uint64)
        for k in range(1, n):
            if rng.random() < 0.6:
                x = int(values[rng.integers(0, k)])
                for _ in range(rng.integers(0, 5)):
                    x ^= 1 << int(rng.integers(0, 64))
                values[k] = x
        sides = rng.integers(1, 3, n) if trial % 2 else np.zeros(n, np.int64)

        def sets(edges):
            parent = {}

            def find(v):
                parent.setdefault(v, v)
                while parent[v] != v:
                    v = parent[v]
                return v
            for a, b in edges:
                a, b = sorted((find(a), find(b)))
                parent[b] = a
            found = {v: find(v) for v in list(parent)}
            return {v: r for v, r in found.items() if sum(x == r for x in found.values()) > 1}

        edges = [(int(values[i]), int(values[j])) for i in range(n) for j in range(i + 1, n)
                 if groups[i] == groups[j] and (sides[i] == 0 or sides[i] != sides[j])
                 and (int(values[i]) ^ int(values[j])).bit_count() <= 3]
        a, b = simhash.forest(values, groups, sides, 3)
        assert sets(edges) == sets(zip(a.tolist(), b.tolist()))


@pytest.mark.parametrize("text", ["", " \n", "a", "a b", "A b C", "a b c d", "É x y z\x0b q ", "w1 w2 w3 " * 50])
def test_fingerprint(text):
    assert simhash.fingerprint(text.encode()) == brute.simhash(text)


def records(n):
    bodies = [(f"<p>{k}</p>" * (k + 1)).encode() for k in range(n)]
    return bodies, [warc.record("response", k, "u", b, warc.base32_sha1(b), None, "2024-01-01T00:00:00Z")
                    for k, b in enumerate(bodies)]


@pytest.mark.parametrize("packed", [True, False])
def test_salvage_recovers_after_damage(packed):
    _, plain = records(6)
    members = [warc._member(p) if packed else p for p in plain]
    starts = np.cumsum([0, *map(len, members)])
    data = bytearray(b"".join(members))
    data[starts[2] + len(members[2]) - 12] ^= 0xFF
    del data[starts[4] + 20:starts[4] + 30]
    found = list(warc.salvage(io.BytesIO(bytes(data)), len(data)))
    good = [head["warc-record-id"] for _, _, head, _, _ in found if head]
    gaps = [(at, length) for at, length, head, _, _ in found if head is None]
    assert good == [warc.record_id(k) for k in (0, 1, 3, 5)]
    assert gaps == [(starts[2], len(members[2])), (starts[4], len(members[4]) - 10)]
    assert sum(length for _, length, *_ in found) == len(data)


def test_salvage_of_noise_and_of_nothing():
    noise = bytes(range(256)) * 40
    assert [(at, n, head) for at, n, head, _, _ in warc.salvage(io.BytesIO(noise), len(noise))] == [(0, len(noise), None)]
    assert list(warc.salvage(io.BytesIO(b""), 0)) == []


def test_stores_of_tasks(tmp_path):
    from pyarrow import fs

    from shopstream.llm.common import open_store, task_uri

    for uri in (f"file:{tmp_path}", f"file://{tmp_path}", f"file:///{str(tmp_path).lstrip('/')}"):
        assert open_store(uri) == (fs.LocalFileSystem(), str(tmp_path))
    assert task_uri("s3a://bucket/folder/x") == "s3://bucket/folder/x"
    assert task_uri("hdfs://name:8020/x") == "hdfs://name:8020/x"
    for uri in (str(tmp_path), "relative/path", "odd://x"):
        with pytest.raises(ValueError):
            open_store(uri)


def test_salvage_inside_one_member():
    _, plain = records(5)
    whole = warc._member(b"".join(plain))
    found = list(warc.salvage(io.BytesIO(whole), len(whole)))
    assert [h["warc-record-id"] for _, _, h, _, _ in found] == [warc.record_id(k) for k in range(5)]
    assert sum(n for _, n, *_ in found) == len(whole)
    hurt = bytearray(plain[2])
    hurt[-8] ^= 0xFF  # within the block
    damaged = warc._member(b"".join([*plain[:2], bytes(hurt), b"noise", *plain[3:]])) + warc._member(plain[0])
    found = list(warc.salvage(io.BytesIO(damaged), len(damaged)))
    assert [h["warc-record-id"] for _, _, h, _, _ in found if h] == [warc.record_id(k) for k in (0, 1, 3, 4, 0)]
    gaps = [reason for _, _, h, _, reason in found if h is None]
    assert gaps == [f"bytes {len(plain[0] + plain[1])} to {len(b''.join(plain[:3])) + 5} of the member: the block's digest is wrong"]


@pytest.mark.parametrize("label,sound", [("sha256:{sha256}", True), ("sha256:{wrong}", False), ("blake3:0123", True),
                                         ("sha1:{hex}", True), ("sha1:{short}", True), ("md5:{md5}", True)])
def test_digests_are_checked_by_their_label(label, sound):
    import hashlib

    body = b"<p>body</p>"
    values = {"sha256": hashlib.sha256(body).hexdigest(), "wrong": "0" * 64, "hex": hashlib.sha1(body).hexdigest(),
              "short": "ABC", "md5": hashlib.md5(body).hexdigest()}
    head = (f"WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:x>\r\nWARC-Date: 2024-01-01T00:00:00Z\r\n"
            f"WARC-Block-Digest: {label.format(**values)}\r\nContent-Length: {len(body)}\r\n\r\n").encode()
    data = head + body + b"\r\n\r\n"
    found = [h for _, _, h, _, _ in warc.salvage(io.BytesIO(data), len(data))]
    assert (found[0] is not None) == sound


def test_a_pipeline_run_leaves_the_folder_of_its_result_alone(spark, monkeypatch):
    import corpus_pipeline
    from shopstream.llm import common
    from shopstream.session import local_path

    def first(spark, docs, sf_dir):
        return common.cut(spark, docs.where("doc_id % 2 = 0"), "inner").where("doc_id % 3 = 0")

    def second(spark, docs, sf_dir):
        assert docs.count() > 0
        return common.cut(spark, docs.select("doc_id"), "inner")

    monkeypatch.setattr(corpus_pipeline, "STAGES", [("first", first), ("second", second)])
    with common.cuts_made() as made:
        got = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    want = {r.doc_id for r in common.documents(spark, "/root/testdata/sf0.001").collect() if r.doc_id % 6 == 0}
    assert want and {r.doc_id for r in got.collect()} == want
    assert [os.path.exists(local_path(f)) for f in made] == [False, False, False, True]
    with pytest.raises(ValueError):
        common.remove_cuts(spark, ["/somewhere/else"])
