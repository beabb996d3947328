"""Sets of word shingles of whole texts as sorted 64-bit hashes, on arrays."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from hashlib import blake2b
from itertools import chain

import numpy as np

WIDTH = 5
MOST_KNOWN = 1_000_000
_TOGETHER = 2_000_000  # bytes of text that are hashed in one go; a longer text is hashed alone

_LOWER = bytes(range(65)) + bytes(range(97, 123)) + bytes(range(91, 256))


def _constants(n: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, np.uint64(base))
    out[:1] = 1
    return np.cumprod(out, dtype=np.uint64)


class WordHashes(dict):
    """64-bit hashes of words as bytes, from a cryptographic digest, so that no two words are made to share one."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = int.from_bytes(blake2b(word, digest_size=8).digest(), "little")
        return found


def _hashed(texts: list[bytes], width: int, known: WordHashes) -> Iterator[np.ndarray]:
    if len(known) > MOST_KNOWN:  # known words are only a cache
        known.clear()
    words = [t.split() for t in texts]  # bytes are split at the gaps of the contract and nowhere else
    ends = np.cumsum([len(w) for w in words])
    word = np.fromiter(map(known.__getitem__, chain.from_iterable(words)), np.uint64, ends[-1])
    factors = _constants(width, 3)
    windows = np.zeros(max(0, len(word) - width + 1), np.uint64)
    for k in range(width):
        windows += word[k:len(word) - width + 1 + k] * factors[k]
    windows = mixed(windows)
    for a, b in zip(np.concatenate([[0], ends[:-1]]), ends):
        if b - a >= width:
            yield np.unique(windows[a:b - width + 1])
        elif b > a:
            yield mixed((word[a:b] * factors[:b - a]).sum(dtype=np.uint64, keepdims=True) + np.uint64(b - a))
        else:
            yield np.zeros(0, np.uint64)


def shingle_sets(texts: Iterable[str], width: int = WIDTH) -> Iterator[np.ndarray]:
    """Per text, the sorted distinct hashes of its windows of `width` words, with A-Z in lower case.

    A text with fewer words has one, of all its words; a text without words has none.
    """
    known = WordHashes()
    some, size = [], 0
    for text in texts:
        raw = text.encode().translate(_LOWER)
        if some and size + len(raw) > _TOGETHER:
            yield from _hashed(some, width, known)
            some, size = [], 0
        some.append(raw)
        size += len(raw) + 1
    if some:
        yield from _hashed(some, width, known)
