"""Words and word shingles of whole texts as 64-bit hashes.

A word is a maximal run of bytes other than space and \\x09-\\x0D, with A-Z lower-cased. bytes.split()
cuts at exactly these six bytes.
"""

from __future__ import annotations

import numpy as np
import xxhash

LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
#: Words remembered by one Python worker before it starts anew; bounds memory, never results.
CACHE_WORDS = 100_000

_MIX1 = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xBF58476D1CE4E5B9)
_MIX3 = np.uint64(0x94D049BB133111EB)


class WordHashes(dict):
    """Word to 64-bit hash; computes what it has not seen."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_hashes = WordHashes()


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer."""
    x = (x ^ (x >> np.uint64(30))) * _MIX2
    x = (x ^ (x >> np.uint64(27))) * _MIX3
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str | None) -> np.ndarray:
    """Hash of each word in order; empty for null and for text without words."""
    words = text.encode("utf-8", "surrogatepass").translate(LOWER).split() if text else []
    return np.fromiter(map(_hashes.__getitem__, words), dtype=np.uint64, count=len(words))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Sorted distinct hashes of runs of `width` words; a shorter text counts as one shingle, no words as none."""
    words = word_hashes(text)
    if not len(words):
        return words
    width = min(width, len(words))
    n = len(words) - width + 1
    out = np.full(n, width, dtype=np.uint64)
    for k in range(width):
        out = mixed(out * _MIX1 + words[k : k + n])
    return np.unique(out)
