"""Words of many texts at once, as 64-bit hashes, by numpy over their bytes."""

from __future__ import annotations

import hashlib

import numpy as np

_RANDOM = np.random.default_rng(2024)
_VALUES = _RANDOM.integers(1, 1 << 63, 256, dtype=np.uint64)
_VALUES[65:91] = _VALUES[97:123]
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
LONG = 4096
_POWERS = np.cumprod(np.full(LONG, 0x9E3779B97F4A7C15 | 1, np.uint64))


def mixed(h: np.ndarray) -> np.ndarray:
    """A one-to-one scrambling of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of all words (runs of bytes other than space and \\x09-\\x0D; A-Z as a-z) in order, and how many words
    each text has."""
    counts = np.zeros(len(texts), np.int64)
    joined = b" ".join(texts)
    a = np.frombuffer(joined, np.uint8)
    if not len(a):
        return np.zeros(0, np.uint64), counts
    inside = ~_SPACE[a]
    opens = inside.copy()
    opens[1:] &= ~inside[:-1]
    starts = np.flatnonzero(opens)
    if not len(starts):
        return np.zeros(0, np.uint64), counts
    begins = np.cumsum([0, *(len(t) + 1 for t in texts[:-1])])
    counts = np.diff(np.append(np.searchsorted(starts, begins), len(starts)))
    kept = np.flatnonzero(inside)
    first = np.flatnonzero(opens[kept])
    lengths = np.diff(np.append(first, len(kept)))
    place = np.arange(len(kept)) - np.repeat(first, lengths)
    h = np.add.reduceat(_VALUES[a[kept]] * _POWERS[np.minimum(place, LONG - 1)], first)
    for i in np.flatnonzero(lengths > LONG):
        word = joined[starts[i] : starts[i] + lengths[i]].lower()
        h[i] = int.from_bytes(hashlib.blake2b(word, digest_size=8).digest(), "little")
    return mixed(h + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)), counts


def slices(texts: list[bytes], most: int) -> list[slice]:
    """Consecutive runs of texts of about `most` bytes at least, so that working memory is bounded; a text stays whole."""
    out, lo, size = [], 0, 0
    for i, t in enumerate(texts):
        size += len(t) + 1
        if size >= most:
            out.append(slice(lo, i + 1))
            lo, size = i + 1, 0
    if lo < len(texts):
        out.append(slice(lo, len(texts)))
    return out
