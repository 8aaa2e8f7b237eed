"""Word shingles as 64-bit hashes, many texts at a time."""

from __future__ import annotations

from collections.abc import Iterable

import numpy as np
import xxhash

_MIX = (np.uint64(0xFF51AFD7ED558CCD), np.uint64(0xC4CEB9FE1A85EC53))
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Words kept with their hashes; beyond it the memory is emptied and filled anew.
MEMO_WORDS = 500_000


class _Memo(dict):
    """word -> hash; a word is hashed once while it stays in here."""

    def __missing__(self, word: str) -> int:
        if len(self) >= MEMO_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value


_memo = _Memo()


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(33))) * _MIX[0]
    h = (h ^ (h >> np.uint64(33))) * _MIX[1]
    return h ^ (h >> np.uint64(33))


def word_hashes(text: str) -> np.ndarray:
    """One hash per word: what stands between white space in the lower-cased text."""
    words = text.lower().split()
    return np.fromiter(map(_memo.__getitem__, words), dtype=np.uint64, count=len(words))


def runs(words: np.ndarray, width: int) -> np.ndarray:
    """The hashes of all runs of `width` consecutive words, in order; of a shorter text, the one run of all its words."""
    width = min(width, len(words))
    if width == 0:
        return words
    count = len(words) - width + 1
    h = np.zeros(count, dtype=np.uint64)
    for i in range(width):
        h = mix(h * _STEP + words[i : i + count])
    return h


def shingle_set(words: np.ndarray, width: int) -> np.ndarray:
    """The distinct runs, sorted by hash."""
    return np.unique(runs(words, width))


def content_hash(words: np.ndarray) -> tuple[int, int]:
    """Two independent signed 64-bit hashes of a sequence of words: equal sequences, equal hashes."""
    data = words.tobytes()
    return tuple(h - (1 << 64) if h >= 1 << 63 else h for h in (xxhash.xxh64_intdigest(data, 1), xxhash.xxh64_intdigest(data, 2)))


def similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Distinct runs in both divided by distinct runs in either, of two sorted sets."""
    common = np.intersect1d(a, b, assume_unique=True).size
    either = a.size + b.size - common
    return common / either if either else 1.0


def all_shingle_sets(texts: Iterable[str | None], width: int) -> list[np.ndarray | None]:
    return [None if t is None else shingle_set(word_hashes(t), width) for t in texts]
