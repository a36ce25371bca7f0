"""Word shingles and MinHash values in numpy, shared by operators 8 and 10.

A shingle is five consecutive words (between white space); a text of one to four
words has one shingle of them all, a text without words has none.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import xxhash

WORDS = 5
#: Characters split at a time, words that a worker keeps, shingles hashed at a time.
CHARS, KEPT, BLOCK = 1_000_000, 200_000, 1024
BLANK = re.compile(r"\s")
_rng = np.random.default_rng(20_240_917)
FACTORS = _rng.integers(0, 2**63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


class WordHashes(dict):
    """64-bit hashes of words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= KEPT:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return h


WORD_HASHES = WordHashes()


def _pieces(text: str) -> Iterator[list[str]]:
    if len(text) <= CHARS:
        yield text.split()
        return
    at = 0
    while at < len(text):
        cut = BLANK.search(text, at + CHARS)
        end = cut.start() if cut else len(text)
        yield text[at:end].split()
        at = end


def shingle_hashes(text: str) -> Iterator[np.ndarray]:
    """64-bit hashes of a text's shingles, repeats included, piece by piece."""
    kept = np.zeros(0, np.uint64)
    any_full = False
    for words in _pieces(text):
        new = np.fromiter(map(WORD_HASHES.__getitem__, words), np.uint64, len(words))
        hashes = np.append(kept, new) if len(kept) else new
        n = len(hashes) - WORDS + 1
        if n > 0:
            any_full = True
            mixed = hashes[:n] * FACTORS[0]
            for k in range(1, WORDS):
                mixed += hashes[k : k + n] * FACTORS[k]
            yield scrambled(mixed)
        kept = hashes[-(WORDS - 1) :]
    if not any_full and len(kept):
        yield scrambled(np.array([(kept * FACTORS[: len(kept)]).sum() + np.uint64(len(kept))], np.uint64))


def scrambled(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str) -> np.ndarray:
    """The distinct shingle hashes of a text, sorted."""
    parts = [np.unique(h) for h in shingle_hashes(text)]
    return np.unique(np.concatenate(parts)) if parts else np.zeros(0, np.uint64)


class MinHash:
    """``size`` universal hash permutations ``a x + b`` modulo 2^64."""

    def __init__(self, size: int, seed: int):
        rng = np.random.default_rng(seed)
        self.a = (rng.integers(0, 2**63, size, dtype=np.uint64) * np.uint64(2) + np.uint64(1))[:, None]
        self.b = rng.integers(0, 2**63, size, dtype=np.uint64)[:, None]

    def minima(self, text: str) -> np.ndarray:
        """The least value of each permutation over the text's shingles (all
        ones without any)."""
        low = np.full(len(self.a), np.iinfo(np.uint64).max)
        for hashes in shingle_hashes(text):
            for i in range(0, len(hashes), BLOCK):
                np.minimum(low, (self.a * hashes[None, i : i + BLOCK] + self.b).min(axis=1), out=low)
        return low


def folded(minima: np.ndarray, dtype: type) -> np.ndarray:
    """Minima reduced to a few bits each."""
    x = minima ^ (minima >> np.uint64(32))
    return (x ^ (x >> np.uint64(16))).astype(dtype)
