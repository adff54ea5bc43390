"""Circulant MinHash kernel: word shingles, signatures, band keys, exact Jaccard (numpy)."""

from __future__ import annotations

import numpy as np

from ._text import Words, mix, rolled

_U = np.uint64
_SIGMA, _PI = _U(0x6A09E667F3BCC909), _U(0xBB67AE8584CAA73B)


def shingle_sets(words: Words, n: int, lower: bool = True) -> list[np.ndarray]:
    """Each text's sorted distinct n-word shingle hashes (fewer words: the whole sequence is one)."""
    h = words.hashes(lower)
    grams = rolled(h, n)
    first = words.first
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= n:
            out.append(np.unique(grams[a : b - n + 1]))
        elif b > a:
            value = np.array([b - a], _U)
            for x in h[a:b]:
                value = mix(value * _U(31) + x)
            out.append(value)
        else:
            out.append(np.empty(0, _U))
    return out


def signatures(sets: list[np.ndarray], k: int) -> np.ndarray:
    """k circulant MinHash coordinates of each non-empty set.

    sigma and pi are two fixed permutations of the 64-bit integers; coordinate j is the
    least pi(sigma(x) + j), which is pi shifted circularly by j places.
    """
    sizes = np.array([len(s) for s in sets])
    out = np.empty((len(sets), k), _U)
    lo = 0
    while lo < len(sets):  # sets of about 16,384 values at a time stay in the cache
        hi = lo + 1
        total = sizes[lo]
        while hi < len(sets) and total + sizes[hi] <= 16384:
            total += sizes[hi]
            hi += 1
        sigma = mix(np.concatenate(sets[lo:hi]) ^ _SIGMA)
        at = np.zeros(hi - lo, np.int64)
        np.cumsum(sizes[lo : hi - 1], out=at[1:])
        for j in range(k):
            out[lo:hi, j] = np.minimum.reduceat(mix((sigma + _U(j)) ^ _PI), at)
        lo = hi
    return out


def band_keys(signature: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of `rows` coordinates; a band's number is part of its key."""
    n, k = signature.shape
    out = np.empty((n, k // rows), _U)
    for b in range(k // rows):
        value = np.full(n, b + 1, _U)
        for j in range(b * rows, (b + 1) * rows):
            value = mix(value * _U(0x9E3779B97F4A7C15) + signature[:, j])
        out[:, b] = value
    return out


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = len(b) - 1 if len(b) else 0
    return int((b[at] == a).sum()) if len(b) else 0
