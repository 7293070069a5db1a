"""Words of whole texts as 64-bit hashes, for numpy."""

from __future__ import annotations

import sys

import numpy as np
import xxhash
from pyspark import cloudpickle

KEPT_WORDS = 500_000


class WordHashes(dict):
    """Hash of a word; recent ones are kept."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        self[word] = value
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def split(text: str | None) -> list[bytes]:
    """Runs of other bytes than space, tab, line feed, form feeds and returns."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def mixed(values: np.ndarray) -> np.ndarray:
    """Bits of 64-bit values spread (a bijection)."""
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xFF51AFD7ED558CCD)
    values = values ^ (values >> np.uint64(33))
    values = values * np.uint64(0xC4CEB9FE1A85EC53)
    return values ^ (values >> np.uint64(33))


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of `size` words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    total = np.full(n, size, np.uint64)
    for i in range(size):
        total = total * np.uint64(0x9E3779B97F4A7C15) + hashes[i:i + n]
    return mixed(total)


# Workers need not have this package installed.
cloudpickle.register_pickle_by_value(sys.modules[__name__])
