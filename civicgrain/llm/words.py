"""Words and word-sequence hashes of whole texts, as numpy arrays.

A word is a longest run of letters or digits, compared in lower case.
"""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORD = re.compile(r"[^\W_]+")
_MIX = np.uint64(0x9E3779B97F4A7C15)
_MIX2 = np.uint64(0xD6E8FEB86659FD93)
_CACHE: dict[str, int] = {}
_CACHE_WORDS = 400_000  # memory bound only: beyond it the cache starts anew, hashes stay the same


def words(text: str) -> list[str]:
    return WORD.findall(text.lower())


def word_hashes(text: str) -> np.ndarray:
    found = words(text)
    if len(_CACHE) > _CACHE_WORDS:
        _CACHE.clear()
    get, out = _CACHE.get, []
    for w in found:
        v = get(w)
        if v is None:
            v = _CACHE[w] = xxhash.xxh64_intdigest(w)
        out.append(v)
    return np.array(out, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(32))
    h = h * _MIX2
    return h ^ (h >> np.uint64(29))


def sequence_hashes(hashes: np.ndarray, width: int) -> np.ndarray:
    """One 64-bit hash for each run of ``width`` consecutive words, in text order."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for k in range(width):
        part = hashes[k : k + n]
        h = (h ^ (h >> np.uint64(31))) * _MIX + (part ^ (part >> np.uint64(30)))
    return mix(h)


def shingles(text: str, width: int) -> np.ndarray:
    """The distinct sequences of ``width`` consecutive words of a text, as sorted hashes."""
    return np.unique(sequence_hashes(word_hashes(text), width))
