"""Chunks of the encoder: marks apart from words, and ids as the library's."""

import random
from array import array

import numpy as np
import pytest
from tokenizers import Tokenizer

from shopstream.llm.queries import vocabulary
from shopstream.llm.tokens import Encoder, distinct_runs

PIECES = ["word", "Word", "café", "Été", "straße", "x÷y", "12", "7", "it's", "don't'", "a_b_", "日本",
          "###", "***", "$$$", "'", "''", ",", ".", "...", "!?", "-", "_", "<", "\U0001f600", "é", "\x1f", " ",
          "pneumonoultramicroscopic", "a" * 40, "<|endoftext|>"]
GAPS = ["", " ", " ", " ", "  ", "\n", "\n\n", " \n", "\n ", "\t", "\r\n"]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_of_words_and_marks_are_the_librarys(name):
    rng = random.Random(3)
    path = vocabulary(name)
    library, own = Tokenizer.from_file(path), Encoder(path, cache=500)
    for _ in range(60):
        texts = ["".join(rng.choice(PIECES) + rng.choice(GAPS) for _ in range(rng.randrange(40))) for _ in range(20)]
        want = [array("I", library.encode(t, add_special_tokens=False).ids).tobytes() for t in texts]
        assert own.encode_batch([t.encode() for t in texts]) == want


@pytest.mark.parametrize("name, marks", [("word_bpe_49k.json", ".,;:!?"), ("byte_bpe_50k.json", ".,;:!?#*$%&'_-")])
def test_a_word_is_remembered_once_whatever_marks_follow(name, marks):
    own = Encoder(vocabulary(name))
    own.encode(" ".join(["some", *(f"quaintly{m}{m}" for m in marks)]).encode())
    assert [c for c in own.new if b"quaintly" in c] == [b"quaintly" if own.drops_blanks else b" quaintly"]
    assert len(own.new) == 2 + len(marks)


def test_runs_of_one_kind_hold_equal_bytes():
    rng = np.random.default_rng(4)
    runs = [bytes(rng.choice([97, 0], int(n)).astype(np.uint8)) for n in rng.integers(1, 40, 400)]
    runs += [b"a", b"a\0", b"a" * 8, b"a" * 9, b"a" * 16, b"a" * 17, b"a" * 16 + b"b"] * 2
    ends = np.cumsum([len(r) for r in runs])
    first, which = distinct_runs(b"".join(runs) + bytes(16), np.r_[0, ends[:-1]], ends)
    assert len(first) == len(set(runs))
    assert [runs[k] for k in first[which]] == runs
