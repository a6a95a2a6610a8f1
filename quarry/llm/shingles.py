"""Word shingles of a text and their SimHash fingerprint."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import xxhash

SHINGLES_AT_ONCE = 1 << 15


def _mixed(h: np.ndarray, word: int) -> np.ndarray:
    """A further 64 bits from a hash (the finaliser of splitmix64); word 0 is the hash itself."""
    if not word:
        return h
    with np.errstate(over="ignore"):
        z = h + np.uint64(0x9E3779B97F4A7C15) * np.uint64(word)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return z ^ (z >> np.uint64(31))


def shingles(text: bytes, shingle: int) -> Iterator[np.ndarray]:
    """The hashes of the word shingles of one UTF-8 text, in pieces."""
    parts = text.lower().split()  # on bytes: A-Z and the blanks of ASCII alone
    if not parts:
        return
    joined = b" ".join(parts)
    lengths = np.fromiter(map(len, parts), np.int64, len(parts))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    size = min(shingle, len(parts))
    n = len(parts) - size + 1
    digest = xxhash.xxh64_intdigest
    for lo in range(0, n, SHINGLES_AT_ONCE):
        hi = min(n, lo + SHINGLES_AT_ONCE)
        spans = zip(starts[lo:hi].tolist(), ends[lo + size - 1 : hi + size - 1].tolist())
        yield np.array([digest(joined[a:b], 42) for a, b in spans], np.uint64)


def fingerprint(text: bytes, shingle: int, words: int) -> np.ndarray:
    """``words`` numbers of 64 bits for one UTF-8 text."""
    return signed_by(shingles(text, shingle), words)


def signed_by(pieces: Iterable[np.ndarray], words: int) -> np.ndarray:
    """The fingerprint of shingle hashes."""
    counts, n = np.zeros((words, 64), np.int64), 0
    for h in pieces:
        n += len(h)
        for k in range(words):
            bits = np.unpackbits(_mixed(h, k).view(np.uint8), bitorder="little").reshape(-1, 64)
            counts[k] += bits.sum(axis=0, dtype=np.int64)
    return np.packbits(counts * 2 > n, axis=1, bitorder="little").view(np.uint64)[:, 0]


def distance(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Differing bits; ``x`` and ``y`` hold the words of a fingerprint in their last axis."""
    d = np.bitwise_count(x[..., 0] ^ y[..., 0])
    for k in range(1, x.shape[-1]):
        d = d + np.bitwise_count(x[..., k] ^ y[..., k])
    return d
