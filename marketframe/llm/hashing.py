"""64-bit hashes of words and of word sequences, in numpy."""

from __future__ import annotations

import numpy as np
import xxhash

from .caching import Recent, held


def scrambled(h: np.ndarray) -> np.ndarray:
    """Spreads differences of 64-bit numbers over all bits (the finaliser of a common generator)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes() -> Recent:
    """Hashes of recent words, one table for a worker process."""
    return held("word hashes", lambda: Recent(xxhash.xxh3_64_intdigest, 150_000))


def lower_words(text: str | None) -> list[bytes]:
    """Words of a text with A-Z in lower case; bytes.split() parts at just the characters x20 and x09 to x0D."""
    return text.encode().lower().split() if text else []


def shingles(text: str | None, words: int = 5) -> np.ndarray:
    """Sorted distinct hashes of a text's sequences of ``words`` words; fewer words are one sequence, none are none."""
    found = lower_words(text)
    if not found:
        return np.empty(0, np.int64)
    known = word_hashes()
    h = np.fromiter((known[w] for w in found), np.uint64, len(found))
    size = min(words, len(h))
    n = len(h) - size + 1
    out = np.full(n, size, np.uint64)
    for i in range(size):
        out = scrambled(out * np.uint64(0x9E3779B97F4A7C15) + h[i : i + n])
    return np.unique(out.view(np.int64))
