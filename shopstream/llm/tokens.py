"""Whole-text token ids by the tokenizers library, one bounded cache per worker.

No token of the two vocabularies crosses from a non-blank to an ASCII blank, so
a text is encoded chunk by chunk (blanks, then non-blanks) and equal chunks are
encoded once. A byte-level vocabulary joins runs of blanks of every script
before it splits them; a text with other blanks than ASCII's goes to the library
whole, as does every text of an unknown vocabulary kind.
"""

from __future__ import annotations

import json
import os
import re
import string
from array import array
from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa

from shopstream.llm.common import hold
from shopstream.llm.text_runs import BLANK, ODD, mix, run_hashes

CACHE = 700_000  # chunks in each of the two generations of a worker's cache
BATCH_BYTES = 1 << 20  # texts that are encoded together
BATCH_TEXTS = 512
_CLOSING = b".,;:!?"
# marks that end a chunk; a byte-level vocabulary parts any ASCII punctuation from the letters and digits before it
_MARK = {False: np.isin(np.arange(256), list(_CLOSING)),
         True: np.isin(np.arange(256), list(string.punctuation.encode()))}
_ALNUM = np.array([bytes([b]).isalnum() for b in range(256)])
# ASCII letters of plain words, without and with capitals
_LETTER = {False: np.array([bytes([b]).isalpha() and bytes([b]).islower() for b in range(256)]),
           True: np.array([bytes([b]).isalpha() for b in range(256)])}
# second bytes of the accented letters of plain words, after \xc3
_SECOND = {False: np.isin(np.arange(256), [*range(0x9F, 0xB7), *range(0xB8, 0xC0)]),
           True: np.isin(np.arange(256), [*range(0x80, 0x97), *range(0x98, 0xB7), *range(0xB8, 0xC0)])}
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], np.uint64)

# U+00DF-U+00FF without the division sign, as UTF-8
_ACCENTED = rb"(?:[a-z]|\xc3[\x9f-\xb6\xb8-\xbf])+"
# a plain word and its closing marks; with one space before it and capitals, if they count
_PLAIN = {False: re.compile(rb"(" + _ACCENTED + rb")([.,;:!?]*)"),
          True: re.compile(rb"( ?(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+)([.,;:!?]*)")}
# byte-level vocabularies write a byte as a visible character: itself, or the next one from U+0100 on
_SHOWN = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_VISIBLE = {b: 0x100 + k for k, b in enumerate(sorted(set(range(256)) - set(_SHOWN)))}
# the other characters that some engine counts as white space
_OTHER_BLANKS = re.compile("[\x1c-\x1f\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]")


def marks_apart(data: np.ndarray, starts: np.ndarray, ends: np.ndarray,
                mark: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The chunks with the marks at their end as chunks of their own, if a letter or digit is before them.

    Such marks never share a token with what they follow, and without them
    fewer chunks differ.
    """
    marked = np.flatnonzero(mark[data[ends - 1]])
    if not len(marked):
        return starts, ends
    others = np.flatnonzero(~mark[data])
    at = np.searchsorted(others, ends[marked]) - 1
    marked, at = marked[at >= 0], at[at >= 0]
    body = others[at]  # the last place before the marks
    apart = (body >= starts[marked]) & _ALNUM[data[body]]
    marked, cuts = marked[apart], body[apart] + 1
    return np.insert(starts, marked + 1, cuts), np.insert(ends, marked, cuts)


def distinct_runs(buffer: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(a run of each kind, the kind of each run); ``buffer`` ends in 16 bytes that are in no run.

    The bytes decide: a run must equal the chosen one of its hash, or all count
    as different. Two integers hold all of a run of up to 16 bytes.
    """
    data = np.frombuffer(buffer, np.uint8, len(buffer) - 16)
    sizes = ends - starts
    eight = np.ndarray(len(data) + 9, "<u8", buffer, strides=(1,))
    low = eight[starts] & _LOW_BYTES[np.minimum(sizes, 8)]
    high = eight[starts + 8] & _LOW_BYTES[np.clip(sizes - 8, 0, 8)]
    hashes = mix(low ^ mix(high + sizes.astype(np.uint64) * ODD))
    long = np.flatnonzero(sizes > 16)
    if len(long):
        hashes[long] = run_hashes(data, starts[long], ends[long])
    kinds = pa.array(hashes).dictionary_encode()
    which = kinds.indices.to_numpy()
    first = np.empty(len(kinds.dictionary), np.int64)
    first[which] = np.arange(len(which))
    same = first[which]
    equal = (np.array_equal(sizes[same], sizes) and np.array_equal(low[same], low) and np.array_equal(high[same], high))
    if equal and len(long):
        before = np.cumsum(sizes[long]) - sizes[long]
        inside = np.arange(sizes[long].sum()) + np.repeat(starts[long] - before, sizes[long])
        away = np.repeat(starts[same[long]] - starts[long], sizes[long])
        equal = np.array_equal(data[inside], data[inside + away])
    return (first, which) if equal else (np.arange(len(starts)), np.arange(len(starts)))


class Encoder:
    """Ids of whole texts as little-endian unsigned 32-bit integers.

    They are those of the library's call with ``add_special_tokens=False`` and
    nothing else set: the string of a special token in a text becomes that token.
    With ``special_as_text`` such strings are ordinary text.
    """

    def __init__(self, path: str, cache: int = CACHE, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs the tasks side by side
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        with open(path, encoding="utf-8") as fh:
            spec = json.load(fh)
        split = json.dumps(spec.get("pre_tokenizer"))
        self.drops_blanks = "</w>" == spec["model"].get("end_of_word_suffix") and '"Removed"' in split
        self.byte_level = not self.drops_blanks and '"use_regex": true' in split
        self.added = [t["content"].lower().encode() for t in spec.get("added_tokens", ())]
        vocab = self.tokenizer.get_vocab()
        # bytes of the text that a token stands for: these vocabularies write one character per byte
        self.lengths = np.zeros(max(vocab.values(), default=0) + 1, np.int64)
        for token, k in vocab.items():
            self.lengths[k] = len(token.removesuffix("</w>"))
        self.cache = cache
        self.new: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _library(self, texts: list[str]) -> list[bytes]:
        return [array("I", e.ids).tobytes()
                for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _words(self, words: list[bytes]) -> list[bytes] | None:
        """Ids of each word from one call: the bytes that tokens stand for tell where a word ends."""
        ids = np.array(self.tokenizer.encode_batch_fast([(b" " if self.drops_blanks else b"").join(words).decode()],
                                                        add_special_tokens=False)[0].ids, "<u4")
        if not len(ids):
            return None
        ends, wanted = np.cumsum(self.lengths[ids]), np.cumsum([len(w) for w in words])
        at = np.minimum(np.searchsorted(ends, wanted), len(ids) - 1)
        if ends[-1] != wanted[-1] or not np.array_equal(ends[at], wanted):
            return None
        raw, stops = ids.tobytes(), ((at + 1) * 4).tolist()
        return [raw[lo:hi] for lo, hi in zip([0, *stops], stops)]

    def encode(self, text: bytes) -> bytes:
        """Ids of one text."""
        return self.encode_batch([text])[0]

    def encode_batch(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each text.

        The chunks of all texts are told apart by their hashes, so each
        different one is looked up once; what the cache lacks goes to the
        library in one call.
        """
        mine = [k for k, text in enumerate(texts) if text and self._by_chunks(text)]
        out = [b""] * len(texts)
        for k in set(range(len(texts))).difference(mine):
            if texts[k]:
                out[k] = self._library([texts[k].decode()])[0]
        if len(self.new) > self.cache:
            self.old, self.new = self.new, {}
        # a blank between texts, where blanks part chunks; nothing where they belong to them
        gap = b" " if self.drops_blanks else b""
        buffer = gap.join([*(texts[k] for k in mine), bytes(16)])
        data = np.frombuffer(buffer, np.uint8, len(buffer) - 16)
        stops = np.cumsum([len(texts[k]) + len(gap) for k in mine], dtype=np.int64)
        blank = BLANK[data]
        if self.drops_blanks:
            edges = np.diff(np.r_[True, blank, True].astype(np.int8))
            starts, ends = np.flatnonzero(edges < 0), np.flatnonzero(edges > 0)
        else:
            last = ~blank & np.r_[blank[1:], True]
            last[stops - 1] = True
            ends = np.flatnonzero(last) + 1
            starts = np.r_[0, ends[:-1]] if len(ends) else ends
        if not len(starts):
            return out
        starts, ends = marks_apart(data, starts, ends, _MARK[not self.drops_blanks])
        first, which = distinct_runs(buffer, starts, ends)
        chunks = [buffer[lo:hi] for lo, hi in zip(starts[first].tolist(), ends[first].tolist())]
        new = self.new
        ids = list(map(new.get, chunks))
        if None in ids:
            gaps = [k for k, known in enumerate(ids) if known is None]
            self._learn(list(dict.fromkeys(chunks[k] for k in gaps)))
            for k in gaps:
                ids[k] = new[chunks[k]]
        flat = np.frombuffer(b"".join(ids), "<u4")
        counts = np.fromiter(map(len, ids), np.int64, len(ids)) >> 2
        offsets = np.cumsum(counts) - counts
        counts = counts[which]
        ends_at = np.cumsum(counts)
        all_ids = flat[np.repeat(offsets[which] - ends_at + counts, counts) + np.arange(ends_at[-1])].tobytes()
        bounds = np.r_[0, ends_at][np.searchsorted(starts, np.r_[0, stops])] * 4
        for k, lo, hi in zip(mine, bounds[:-1].tolist(), bounds[1:].tolist()):
            out[k] = all_ids[lo:hi]
        return out

    def _by_chunks(self, text: bytes) -> bool:
        if self.added and b"<" in text:
            lowered = text.lower()
            if any(token in lowered for token in self.added):
                return False
        return self.drops_blanks or self.byte_level and (text.isascii() or not _OTHER_BLANKS.search(text.decode()))

    def _plain_words(self, chunks: list[bytes]) -> np.ndarray:
        """Whether each chunk is a plain word without marks."""
        data = np.frombuffer(b"".join(chunks), np.uint8)
        sizes = np.fromiter(map(len, chunks), np.int64, len(chunks))
        starts = np.cumsum(sizes) - sizes
        letter = _LETTER[not self.drops_blanks][data]
        accented = (data[:-1] == 0xC3) & _SECOND[not self.drops_blanks][data[1:]]
        letter[:-1] |= accented
        letter[1:] |= accented
        others = np.add.reduceat(~letter, starts, dtype=np.int64)
        if not self.drops_blanks:
            others -= (data[starts] == 0x20) & (sizes > 1)
        return others == 0

    def _learn(self, chunks: list[bytes]) -> None:
        """Adds different chunks to the cache, from the older generation, their parts or the library."""
        new, old, plain = self.new, self.old, _PLAIN[not self.drops_blanks].fullmatch
        parts: list[tuple[bytes, bytes, bytes]] = []
        others: dict[bytes, None] = {}
        if old:
            held = list(map(old.get, chunks))
            new.update((chunk, known) for chunk, known in zip(chunks, held) if known is not None)
            chunks = [chunk for chunk, known in zip(chunks, held) if known is None]
        if not chunks:
            return
        whole = self._plain_words(chunks)
        words = dict.fromkeys(compress(chunks, whole.tolist()))
        for chunk in compress(chunks, (~whole).tolist()):
            match = plain(chunk)
            if match is not None:
                body, tail = match.groups()
                if not tail:
                    words[chunk] = None
                    continue
                missing = words
            else:
                body, tail = self._parts(chunk)
                missing = words if plain(body) else others
            parts.append((chunk, body, tail))
            for part, kind in ((body, missing), (tail, others)):
                if part and part not in new:
                    known = old.get(part)
                    if known is None:
                        kind[part] = None
                    else:
                        new[part] = known
        new.update(zip(others, self._library([c.decode() for c in others])))
        self._learn_words(list(words))
        for chunk, body, tail in parts:
            new[chunk] = new[body] + new[tail] if tail else new[body]

    def _learn_words(self, words: list[bytes]) -> None:
        """A plain Latin word is one piece to the library, so words go there side by side."""
        new, tokenize = self.new, self.tokenizer.model.tokenize
        joined = [c for c in words if self.drops_blanks or c[:1] == b" "]
        for at in range(0, len(joined), 2000):
            some = joined[at:at + 2000]
            new.update(zip(some, self._words(some) or ()))
        for c in words:
            if c not in new:
                new[c] = array("I", [t.id for t in tokenize(c.decode("latin-1").translate(_VISIBLE))]).tobytes()

    def _parts(self, chunk: bytes) -> tuple[bytes, bytes]:
        """A chunk as body and closing marks, which never share a token with a letter or digit before them."""
        if self.drops_blanks:
            chunk = chunk.lower()  # its normaliser lowers every letter
        body = chunk.rstrip(_CLOSING)
        if body and body[-1:].isalnum():
            return body, chunk[len(body):]
        return chunk, b""


_ENCODERS: dict[str, Encoder] = {}


def encoder(path: str, cache: int = CACHE) -> Encoder:
    """This worker's encoder of a vocabulary file."""
    hold("tokens", _ENCODERS.clear)
    if path not in _ENCODERS:
        _ENCODERS[path] = Encoder(path, cache)
    return _ENCODERS[path]


def batches(rows: Iterator[tuple], most_texts: int = BATCH_TEXTS, most_bytes: int = BATCH_BYTES) -> Iterator[list[tuple]]:
    """Lists of rows whose last field is a text: ``most_texts`` texts or about ``most_bytes`` bytes each."""
    held, size = [], 0
    for row in rows:
        held.append(row)
        size += len(row[-1])
        if len(held) >= most_texts or size >= most_bytes:
            yield held
            held, size = [], 0
    if held:
        yield held
