"""Word shingles of whole texts as sorted arrays of 64-bit hashes.

Words are maximal runs of bytes other than ASCII white space, A-Z lower-cased.
A word's hash is a mixed sum of its bytes with random weights by position, a
shingle's a mixed chain of its words' hashes; all in numpy over a whole text.
"""

from __future__ import annotations

import hashlib

import numpy as np

_WEIGHTS = np.random.default_rng(20240229).integers(0, 2**64, 4096, dtype=np.uint64)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of uint64 (two multiply-and-shift rounds)."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_hashes(raw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, start and end of each word of the UTF-8 bytes ``raw``."""
    inside = ~_SPACE[raw]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    start, end = edge[::2], edge[1::2]
    if not len(start):
        return np.zeros(0, np.uint64), start, end
    body = _FOLD[raw].astype(np.uint64) + np.uint64(1)
    place = np.arange(len(raw)) - np.repeat(np.append(start, len(raw)), np.diff(np.concatenate([[0], start[1:], [len(raw), len(raw)]])))
    weights = _WEIGHTS
    if (longest := int((end - start).max())) > len(weights):
        weights = mix(np.arange(longest, dtype=np.uint64) ^ weights[0]) | np.uint64(1)
        weights[:len(_WEIGHTS)] = _WEIGHTS
    terms = body * weights[np.clip(place, 0, len(weights) - 1)]
    terms[~inside] = 0
    sums = np.add.reduceat(terms, start)
    return mix(sums + mix((end - start).astype(np.uint64))), start, end


def shingle_hashes(text: str, k: int) -> np.ndarray:
    """The hash of each k-word shingle in order; of the whole sequence if there are fewer words."""
    h, _, _ = word_hashes(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8))
    if not len(h):
        return h
    k = min(k, len(h))
    out = mix(h[:len(h) - k + 1] + np.uint64(k))
    for i in range(1, k):
        out = mix(out * np.uint64(3) + h[i:len(h) - k + 1 + i])
    return out


def shingle_set(text: str, k: int) -> np.ndarray:
    return np.unique(shingle_hashes(text, k))


def set_digest(hashes: np.ndarray) -> bytes:
    return hashlib.blake2b(hashes.astype("<u8").tobytes(), digest_size=16).digest()
