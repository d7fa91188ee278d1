"""Words and word windows as 64-bit numbers."""

from __future__ import annotations

import numpy as np
import xxhash

#: Distinct words that a worker remembers before it starts afresh.
REMEMBERED = 400_000
_ODD = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """A 64-bit hash per word, remembered."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > REMEMBERED:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mixed(h: np.ndarray) -> np.ndarray:
    """Spread a hash over all its bits."""
    h = h ^ (h >> np.uint64(32))
    h = h * _ODD
    return h ^ (h >> np.uint64(29))


def windows(hashes: np.ndarray, size: int) -> np.ndarray:
    """A hash of every run of ``size`` numbers, its order included; none if there are fewer."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.full(n, size, np.uint64)
    for k in range(size):
        out = mixed(out * _ODD + hashes[k : k + n])
    return out
