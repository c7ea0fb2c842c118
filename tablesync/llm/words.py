"""Words as numbers.

A word is a run of bytes outside ``[\\x20\\x09-\\x0D]``, which is what
``bytes.split()`` gives.
"""

from __future__ import annotations

import numpy as np
import xxhash

_KEPT = 150_000


class WordHashes(dict):
    """64-bit hash per word; memory is bounded by forgetting all words now and then."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _KEPT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hash = WordHashes().__getitem__


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hash, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))
