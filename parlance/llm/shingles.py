"""Word shingles as 64-bit hashes: what the n-gram join and the decontamination compare."""

from __future__ import annotations

import re

import numpy as np
import xxhash

WORD = re.compile(r"\w+")
#: Shingles are of five words unless a caller says otherwise.
SIZE = 5
MULTIPLY = np.uint64(0x9E3779B97F4A7C15)


class WordHashes(dict):
    """Word to 64-bit hash. Emptied when full: it only saves hashing a word again."""

    def __init__(self, most: int = 400_000):
        self.most = most

    def __missing__(self, word: str) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = h = xxhash.xxh64_intdigest(word)
        return h


def mixed(h: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def words(text: str) -> list[str]:
    """The words of a text, in lower case; punctuation and white space only part them."""
    return WORD.findall(text.lower())


def word_hashes(text: str, known: WordHashes) -> np.ndarray:
    found = words(text)
    return np.fromiter(map(known.__getitem__, found), dtype=np.uint64, count=len(found))


def shingles(hashes: np.ndarray, size: int = SIZE) -> np.ndarray:
    """The hash of every run of `size` words, in order. Of fewer words there is one, of all of them; of none, none."""
    size = min(size, len(hashes))
    if not size:
        return hashes
    count = len(hashes) - size + 1
    total = hashes[:count].copy()
    for k in range(1, size):
        total = total * MULTIPLY + hashes[k : k + count]
    return mixed(total + np.uint64(size))
