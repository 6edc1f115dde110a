"""Words of UTF-8 bytes and their hashes, without a loop or a cache over words."""

from __future__ import annotations

import numpy as np

#: Bytes whose words are hashed at a time.
PIECE = 1 << 20

# Odd multipliers for hashing.
LETTER = 0x9E3779B97F4A7C15
MIX = np.array([0xBF58476D1CE4E5B9, 0x94D049BB133111EB], np.uint64)

WHITE = np.zeros(256, bool)
WHITE[[32, *range(9, 14)]] = True


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * MIX[0]
    x = (x ^ (x >> np.uint64(27))) * MIX[1]
    return x ^ (x >> np.uint64(31))


_BYTES = mixed(np.arange(1, 257, dtype=np.uint64))


class Powers:
    """Powers of an odd number and of its inverse modulo 2^64; grown to the longest run asked for."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(0, np.uint64)

    def to(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > len(self.up):
            factor = np.full(n, self.base, np.uint64)
            factor[0] = 1
            self.up = np.cumprod(factor, dtype=np.uint64)
            factor[1:] = self.inverse
            self.down = np.cumprod(factor, dtype=np.uint64)
        return self.up[:n], self.down[:n]


_LETTERS = Powers(LETTER)


def word_places(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words in UTF-8 bytes."""
    white = np.concatenate([[True], WHITE[raw], [True]])
    flips = np.flatnonzero(white[1:] != white[:-1])
    return flips[0::2], flips[1::2]


def word_hashes(raw: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every word, piece by piece."""
    found = np.empty(len(starts), np.uint64)
    cuts = np.unique(np.append(np.searchsorted(starts, np.arange(0, len(raw), PIECE)), len(starts)))
    for a, b in zip(cuts[:-1], cuts[1:]):
        low, high = int(starts[a]), int(ends[b - 1])
        up, down = _LETTERS.to(high - low + 1)
        sums = np.zeros(high - low + 1, np.uint64)
        np.cumsum(_BYTES[raw[low:high]] * up[:-1], out=sums[1:])
        s, e = starts[a:b] - low, ends[a:b] - low
        found[a:b] = mixed((sums[e] - sums[s]) * down[s] + (e - s).astype(np.uint64))
    return found


def run_hashes(hashes: np.ndarray, length: int, powers: Powers) -> np.ndarray:
    """A hash of every run of ``length`` words, from sums of prefixes; nothing for fewer words."""
    n = len(hashes)
    if n < length:
        return np.empty(0, np.uint64)
    up, down = powers.to(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(mixed(hashes + np.uint64(powers.base)) * up, out=sums[1:])
    return mixed((sums[length:] - sums[:-length]) * down[: n - length + 1])
