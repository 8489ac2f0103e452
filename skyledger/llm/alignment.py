"""Ordered similarity of two shingle sequences by banded alignment.

The similarity is L / (n + m - L), with L the length of the longest common subsequence of the
two sequences of n and m shingles: the Jaccard measure of shingles that keep their order and
count as often as they occur. A threshold bounds the number of unmatched shingles, so only a
band of diagonals is walked: furthest-reaching points per number of edits, all diagonals of a
step at once, with runs of equal shingles found by prefix hashes.
"""

from __future__ import annotations

import math

import numpy as np
import xxhash

SHINGLE_WORDS = 5
CACHE_WORDS = 1_000_000
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_STEP = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x5851F42D4C957F2D


class _WordHashes(dict):
    def __missing__(self, word: str) -> int:
        if len(self) > CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_HASHES = _WordHashes()


def mix(values: np.ndarray) -> np.ndarray:
    """A bijective scramble of 64-bit numbers."""
    values = (values ^ (values >> np.uint64(30))) * _MIX[0]
    values = (values ^ (values >> np.uint64(27))) * _MIX[1]
    return values ^ (values >> np.uint64(31))


def shingles(text: str | None, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Hashes of all runs of `words` lower-case words; one run of all words if there are fewer."""
    found = (text or "").lower().split()
    hashes = np.fromiter(map(_HASHES.__getitem__, found), dtype=np.uint64, count=len(found))
    if not len(hashes):
        return hashes
    width = min(words, len(hashes))
    total = np.zeros(len(hashes) - width + 1, dtype=np.uint64)
    for i in range(width):
        total = mix(total + hashes[i : i + len(total)] + _STEP)
    return total


def _powers(count: int) -> np.ndarray:
    powers = np.full(count, _BASE, dtype=np.uint64)
    powers[0] = 1
    return np.multiply.accumulate(powers)


class _Runs:
    """Lengths of equal runs of two sequences from any pair of places."""

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.a, self.b, self.powers = a, b, _powers(max(len(a), len(b)) + 1)
        zero = np.zeros(1, dtype=np.uint64)
        self.sums = [np.concatenate([zero, np.cumsum(x * self.powers[: len(x)], dtype=np.uint64)]) for x in (a, b)]

    def length(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        run = np.zeros(len(x), dtype=np.int64)
        inside = np.nonzero((x < len(self.a)) & (y < len(self.b)) & (x >= 0) & (y >= 0))[0]
        inside = inside[self.a[x[inside]] == self.b[y[inside]]]
        if not len(inside):
            return run
        x, y = x[inside], y[inside]
        room = np.minimum(len(self.a) - x, len(self.b) - y)
        left, right = self.sums[0][x], self.sums[1][y]
        from_a, from_b = self.powers[y], self.powers[x]
        got = np.ones(len(x), dtype=np.int64)
        step = 1 << (int(room.max()).bit_length() - 1)
        while step:
            far = got + step
            may = far <= room
            end = np.where(may, far, got)
            same = (self.sums[0][x + end] - left) * from_a == (self.sums[1][y + end] - right) * from_b
            got = np.where(may & same, far, got)
            step >>= 1
        run[inside] = got
        return run


def unmatched(a: np.ndarray, b: np.ndarray, limit: int) -> int | None:
    """Insertions and deletions that turn a into b, or None if there are more than `limit`."""
    n, m = len(a), len(b)
    if abs(n - m) > limit:
        return None
    runs = _Runs(a, b)
    middle = limit + 1
    reach = np.full(2 * limit + 3, -(1 << 40), dtype=np.int64)
    reach[middle + 1] = 0
    for edits in range(limit + 1):
        k = np.arange(-edits, edits + 1, 2)
        x = np.maximum(reach[middle + k + 1], reach[middle + k - 1] + 1)
        if edits == 0:
            x = np.zeros(1, dtype=np.int64)
        y = x - k
        x = x + runs.length(x, y)
        x[(x > n) | (x - k > m) | (x < 0)] = -(1 << 40)
        reach[middle + k] = x
        if abs(n - m) <= edits and (edits - (n - m)) % 2 == 0 and reach[middle + n - m] >= n:
            return edits
    return None


def similarity(a: np.ndarray, b: np.ndarray, least: float) -> float:
    """The ordered similarity if it is `least` or more, else a number below `least`."""
    n, m = len(a), len(b)
    if n == m and (a == b).all():
        return 1.0
    if not n or not m:
        return 0.0
    if min(n, m) < least * max(n, m):
        return 0.0
    values, counts = np.unique(a, return_counts=True)
    others, more = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(values, others, assume_unique=True, return_indices=True)
    common = int(np.minimum(counts[i], more[j]).sum())
    if common < least * (n + m - common):
        return 0.0
    fewest = math.ceil(least * (n + m) / (1 + least) - 1e-9)
    edits = unmatched(a, b, n + m - 2 * fewest)
    if edits is None:
        return 0.0
    matched = (n + m - edits) // 2
    return matched / (n + m - matched)
