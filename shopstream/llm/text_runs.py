"""Runs of characters in a buffer of texts, found and hashed for all texts at once.

The hash of a run is a polynomial over its bytes modulo 2**64: prefix sums give
that of every run of a buffer in a few passes of numpy, whatever the number of runs.
"""

from __future__ import annotations

import numpy as np

SEGMENT = 1 << 18  # bytes that are hashed at once; a longer run makes a longer segment
ODD = np.uint64(0x9E3779B97F4A7C15)
BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True  # the ASCII blanks of the contracts


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit of 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0xD1342543DE82EF95
_POWERS: dict[bool, np.ndarray] = {}
VALUES = mix(np.arange(1, 257, dtype=np.uint64) * ODD) | np.uint64(1)  # of the 256 bytes
LOWERED = VALUES[np.frombuffer(bytes(range(256)).lower(), np.uint8)]   # the same with A-Z as a-z


def _powers(n: int, inverse: bool) -> np.ndarray:
    held = _POWERS.get(inverse)
    if held is None or len(held) < n:
        base = pow(_BASE, -1, 1 << 64) if inverse else _BASE
        factors = np.full(max(n, SEGMENT + 4096), base, np.uint64)
        factors[0] = 1
        held = np.cumprod(factors, dtype=np.uint64)
        if n <= SEGMENT + 4096:
            _POWERS[inverse] = held
    return held


def run_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, values: np.ndarray = VALUES) -> np.ndarray:
    """Hash of each run ``data[starts[k]:ends[k]]``; runs are in order and do not overlap."""
    out = np.empty(len(starts), np.uint64)
    at = 0
    while at < len(starts):
        base = int(starts[at])
        stop = max(at + 1, int(np.searchsorted(ends, base + SEGMENT, "right")))
        last = int(ends[stop - 1])
        sums = np.zeros(last - base + 1, np.uint64)
        np.cumsum(values[data[base:last]] * _powers(last - base, False)[:last - base], out=sums[1:], dtype=np.uint64)
        lo, hi = starts[at:stop] - base, ends[at:stop] - base
        out[at:stop] = mix((sums[hi] - sums[lo]) * _powers(last - base + 1, True)[lo] + (hi - lo).astype(np.uint64) * ODD)
        at = stop
    return out


def words(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the words of all texts, A-Z lowered; words before each text and in all)."""
    data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
    blank = BLANK[data]
    edges = np.diff(np.r_[True, blank, True].astype(np.int8))
    starts, ends = np.flatnonzero(edges < 0), np.flatnonzero(edges > 0)
    bounds = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return run_hashes(data, starts, ends, LOWERED), np.searchsorted(starts, bounds)
