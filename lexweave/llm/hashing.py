"""64-bit hashes of all words of a block of UTF-8 bytes at once."""

from __future__ import annotations

from functools import lru_cache

import numpy as np

STEP = 0x9E3779B97F4A7C15
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, a one-to-one map of 64-bit integers."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def stream(n: int, seed: int) -> np.ndarray:
    """n fixed pseudo-random 64-bit integers."""
    return mix64((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed * 1_000_003)) * np.uint64(STEP))


BYTES = stream(256, 1)
BLOCK = 1 << 16
STRENGTH = stream(8, 2) | np.uint64(1)


@lru_cache(1)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2 ** 64."""
    odd = int(STRENGTH[0])
    up, down = (np.full(n, x, np.uint64) for x in (odd, pow(odd, -1, 1 << 64)))
    up[0] = down[0] = 1
    return np.multiply.accumulate(up), np.multiply.accumulate(down)


def words(raw: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the runs of anything but white space in raw (uint8)."""
    if not len(raw):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inside = np.zeros(len(raw) + 2, np.int8)
    inside[1:-1] = ~SPACES[raw]
    edge = np.diff(inside)
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    table = BYTES[LOWER] if lower else BYTES
    hashes = np.empty(len(start), np.uint64)
    at = 0
    while at < len(start):  # a block of words of BLOCK bytes, or one longer word
        until = max(at + 1, int(np.searchsorted(end, start[at] + BLOCK, "right")))
        first, size = start[at], int(end[until - 1] - start[at])
        up, down = powers(BLOCK) if size <= BLOCK else powers.__wrapped__(size)
        total = np.zeros(size + 1, np.uint64)
        np.cumsum(table[raw[first : first + size]] * up[:size], out=total[1:])
        s, e = start[at:until] - first, end[at:until] - first
        hashes[at:until] = (total[e] - total[s]) * down[s]
        at = until
    return start, end, mix64(hashes ^ (end - start).astype(np.uint64) * np.uint64(STEP))


def shingles(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words; entry i is of words i to i + n - 1."""
    count = max(0, len(hashes) - n + 1)
    total = np.zeros(count, np.uint64)
    for k in range(n):
        total += hashes[k : k + count] * STRENGTH[k + 1]
    return mix64(total)
