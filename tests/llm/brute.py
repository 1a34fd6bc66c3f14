"""Plain Python versions of the contracts, for whole small tables."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import defaultdict

import numpy as np
import xxhash

BLANK = r"[\x20\x09-\x0D]"
ASSIGN = re.compile(r"(?:(?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
                    re.ASCII)


def base_spans(text):
    text = text or ""
    spans = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[1]) >= 6]
    spans += [(m.start(), 1, "access", m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, "hex", m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(spans)


def secrets(docs):
    """(doc_id, n_assign, n_access, n_hex, base_sha256) per row of (doc_id, text)."""
    out = []
    for doc_id, text in docs:
        spans = base_spans(text)
        written = ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in spans)
        out.append((doc_id, *(sum(s[1] == k for s in spans) for k in range(3)),
                    hashlib.sha256(written.encode()).hexdigest()))
    return out


def bare_spans(docs, max_owners=4, max_repos=12):
    """Added spans per row of (doc_id, text, owner, repo): bare tokens the corpus shows to be live."""
    found, texts, keyed = [], defaultdict(lambda: defaultdict(set)), set()
    for row, (_, text, owner, repo) in enumerate(docs):
        text = text or ""
        base = base_spans(text)
        for start, rank, kind, end in base:
            value = ASSIGN.match(text, start)[1] if rank == 0 else text[start:end]
            texts[value][text].add((owner, repo))
            keyed.add(value)
        for m in re.finditer(r"[A-Za-z0-9+/_=-]{16,}", text):
            value = m[0]
            if re.search("[0-9]", value) and re.search("[A-Za-z]", value) and not any(
                    b[0] < m.end() and m.start() < b[3] for b in base):
                texts[value][text].add((owner, repo))
                found.append((row, m.start(), m.end(), value))
    out = defaultdict(list)
    for row, start, end, value in found:
        # a text that several hold is one witness; these tables hold none near the limits
        least, most = len({t for t in texts[value]}), len({o for t in texts[value].values() for o, _ in t})
        assert least <= max_owners or most > max_owners
        if most <= max_owners and (
                value in keyed or len(set(value)) >= 10 and re.search("[0-9]", value)):
            out[row].append((start, 3, "bare", end))
    return out


def digest(payload):
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def pages(rows):
    best = {}
    for page_id, html in rows:
        d = digest((html or "").encode())
        best[d] = max(best.get(d, page_id), page_id)
    out = []
    for page_id, html in rows:
        body = (html or "").encode()
        d = digest(body)
        lead = best[d] == page_id
        out.append((page_id, len(body), d, "response" if lead else "revisit", None if lead else best[d]))
    return out


def normal(text):
    return re.sub(BLANK, "", text or "")


def exact(docs):
    groups = defaultdict(list)
    for doc_id, text in docs:
        groups[normal(text)].append((-len(text or ""), doc_id))
    out = []
    for doc_id, text in docs:
        group = groups[normal(text)]
        keep = min(group)[1]
        out.append((doc_id, keep, len(group), keep == doc_id, hashlib.sha256(normal(text).encode()).hexdigest()))
    return out


def simhash(text, size=3):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    if not words:
        return 0
    shingles = [" ".join(words[k:k + size]) for k in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near(docs, radius=3):
    prints = [simhash(text) for _, text in docs]
    values = np.array(sorted(set(prints)), np.uint64)
    parent = list(range(len(values)))

    def find(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for k in range(len(values)):
        x = values[k + 1:] ^ values[k]
        bits = np.unpackbits(x.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=1)
        for j in np.flatnonzero(bits <= radius):
            a, b = sorted((find(k), find(k + 1 + int(j))))
            parent[b] = a
    where = {int(v): k for k, v in enumerate(values)}
    least = {}
    for (doc_id, _), p in zip(docs, prints):
        root = find(where[p])
        least[root] = min(least.get(root, doc_id), doc_id)
    return [(doc_id, f"{p:016x}", least[find(where[p])]) for (doc_id, _), p in zip(docs, prints)]


def words(text):
    return re.findall(r"\w+", (text or "").lower())


def leaks(docs, items, overlap=13, similarity=0.8, run=7):
    """(doc_id, item_id) pairs with a passage of ``run`` equal tokens in a row, then verified as the operator does."""
    out = set()
    tokens = {item: words(text) for item, text in items}
    for doc_id, text in docs:
        own = words(text)
        at = defaultdict(list)
        for k in range(len(own) - run + 1):
            at[tuple(own[k:k + run])].append(k)
        for item, t in tokens.items():
            shifts = {p - k for k in range(len(t) - run + 1) for p in at.get(tuple(t[k:k + run]), ())}
            for shift in shifts:
                lo, hi = max(0, shift), min(len(own), shift + len(t))
                equal = [own[p] == t[p - shift] for p in range(lo, hi)]
                best, since, score, low = None, 0, 0.0, 0.0
                top = -1.0
                for k, e in enumerate(equal):
                    score += 1 - similarity if e else -similarity
                    if score - low > top + 1e-12:
                        top, best = score - low, (since, k + 1)
                    if score < low:
                        low, since = score, k + 1
                if best and best[1] - best[0] >= min(overlap, len(t)) and sum(
                        equal[best[0]:best[1]]) >= similarity * (best[1] - best[0]):
                    out.add((doc_id, item))
    return out


def line_dedup(docs):
    def key(line):
        k = re.sub(rf"^{BLANK}+|{BLANK}+$", "", line)
        return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in k)

    holders = defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            holders[key(line)].add(doc_id)
    out = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        kept = [x for x in lines if not (len(key(x)) >= 10 and len(holders[key(x)]) >= 2
                                         and doc_id != min(holders[key(x)]))]
        out.append((doc_id, len(lines), len(lines) - len(kept),
                    hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def token_ids(docs, name, end):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(str(public_tokenizers.path(name)))
    return [(doc_id, np.array(tokenizer.encode(text or "", add_special_tokens=False).ids + [end], "<u4"))
            for doc_id, text in docs]


def token_files(docs, name="byte_bpe_50k.json", end=0):
    at, out = 0, []
    for doc_id, ids in sorted(token_ids(docs, name, end), key=lambda r: r[0]):
        out.append((doc_id, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out
