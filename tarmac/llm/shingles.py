"""Hashes of words and of word shingles of many texts at once, as flat numpy arrays."""

from __future__ import annotations

import numpy as np

WIDTH = 5
BASE = 0x9E3779B97F4A7C15
BASE_INVERSE = pow(BASE, -1, 1 << 64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    steps = np.full(n, base, np.uint64)
    steps[:1] = 1
    return np.cumprod(steps, dtype=np.uint64)


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word, and the first word of each text (with the number of words as the last entry)."""
    data = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    white = (data == 32) | ((data >= 9) & (data <= 13))
    before = np.r_[True, white[:-1]]
    starts, stops = np.flatnonzero(~white & before), np.flatnonzero(white & ~before)
    sums = np.r_[np.uint64(0), np.cumsum((data.astype(np.uint64) + np.uint64(1)) * _powers(BASE, len(data)), dtype=np.uint64)]
    back = _powers(BASE_INVERSE, len(data) + 1)
    hashes = _mixed((sums[stops] - sums[starts]) * back[starts] + (stops - starts).astype(np.uint64))
    first = np.cumsum([0, *[len(t) + 1 for t in texts]])
    return hashes, np.searchsorted(starts, first)


def shingles(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of all runs of five words, the first shingle of each text (and their number), and a
    code of the whole word sequence of each text. A text of one to four words is one shingle,
    its code; one without words has none and code 0."""
    words, first = word_hashes(texts)
    counts = np.diff(first)
    owner = np.repeat(np.arange(len(texts)), counts)
    place = np.arange(len(words)) - np.repeat(first[:-1], counts)
    longest = int(counts.max(initial=0))
    weighted = words * np.repeat(np.uint64(1), len(words)) * _powers(BASE, longest + 1)[place + 1]
    totals = np.r_[np.uint64(0), np.cumsum(weighted, dtype=np.uint64)]
    codes = _mixed(totals[first[1:]] - totals[first[:-1]] + counts.astype(np.uint64))
    codes[counts == 0] = 0
    windows = max(0, len(words) - WIDTH + 1)
    runs = np.zeros(windows, np.uint64)
    for k in range(WIDTH):
        runs += words[k : k + windows] * np.uint64(pow(BASE, 2 * k + 1, 1 << 64))
    inside = owner[:windows] == owner[WIDTH - 1 :] if windows else np.zeros(0, bool)
    runs, owners = _mixed(runs[inside]), owner[:windows][inside]
    few = np.flatnonzero((counts > 0) & (counts < WIDTH))
    if len(few):
        owners = np.r_[owners, few]
        order = np.argsort(owners, kind="stable")
        runs, owners = np.r_[runs, codes[few]][order], owners[order]
    return runs, np.searchsorted(owners, np.arange(len(texts) + 1)), codes


def min_hashes(runs: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """``n`` MinHash values (32 bits) of each text with shingles, as rows; other rows are 0."""
    some = np.flatnonzero(np.diff(first) > 0)
    result = np.zeros((len(first) - 1, n), np.uint32)
    if len(some):
        for k in range(n):
            factor, term = np.uint64(pow(BASE, 2 * k + 3, 1 << 64) | 1), np.uint64(pow(BASE, 2 * k + 4, 1 << 64))
            result[some, k] = np.minimum.reduceat(runs * factor + term, first[some]) >> np.uint64(32)
    return result
