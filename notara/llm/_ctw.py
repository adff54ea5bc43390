"""Context-tree weighting over bytes, from counts of (context, byte) grams (numpy).

A byte is eight binary decisions.  Each context of 0 to `depth` preceding bytes has, for each of the
255 places in the tree of decisions, a Krichevsky-Trofimov estimate, and a node's weighted
probability is half its own estimate plus half the product of its longer contexts' probabilities.
The tree is frozen after training; a path ends at the longest context that training has seen.
A gram is an integer: `depth` context bytes (0 before the text's start), then the coded byte.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np

_U = np.uint64


def grams(data: np.ndarray, offsets: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Grams of each text followed by an end byte 0, and their offsets."""
    n = len(offsets) - 1
    ends = offsets[1:] + np.arange(n)
    flow = np.zeros(len(data) + n, np.uint64)
    kept = np.ones(len(flow), bool)
    kept[ends] = False
    flow[kept] = data
    starts = np.concatenate(([0], ends[:-1] + 1)) if n else np.empty(0, np.int64)
    out = flow.copy()
    for k in range(1, depth + 1):
        before = np.zeros_like(flow)
        before[k:] = flow[:-k]
        for j in range(k):  # nothing of the text before
            at = starts + j
            before[at[at < np.minimum(ends + 1, len(flow))]] = 0
        out |= before << _U(8 * k)
    return out, np.concatenate((starts, [len(flow)]))


def _log_gamma(x: np.ndarray) -> np.ndarray:
    """ln of the gamma function by Stirling's series, x > 0."""
    shift = np.zeros_like(x)
    for _ in range(7):
        small = x < 7
        shift[small] += np.log(x[small])
        x = np.where(small, x + 1, x)
    return (x - 0.5) * np.log(x) - x + 0.9189385332046727 + 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - shift


def _log_kt(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _log_gamma(a + 0.5) + _log_gamma(b + 0.5) - _log_gamma(a + b + 1.0) - np.log(np.pi)


def _sums(keys: np.ndarray, *columns: np.ndarray) -> tuple[np.ndarray, ...]:
    node, inverse = np.unique(keys, return_inverse=True)
    return node, *(np.bincount(inverse, c, len(node)) for c in columns)


def leaves(gram: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nodes of the grams' whole contexts, and how often each saw a 0 and a 1."""
    gram, n = gram.astype(_U), np.tile(count.astype(np.float64), 8)
    byte, context = gram & _U(255), (gram >> _U(8)) << _U(8)
    keys = np.concatenate([context | (_U(1 << k) | (byte >> _U(8 - k))) for k in range(8)])
    ones = np.concatenate([(byte >> _U(7 - k)) & _U(1) for k in range(8)]).astype(bool)
    return _sums(keys, n * ~ones, n * ones)


def climb(node: np.ndarray, a: np.ndarray, b: np.ndarray, longer: np.ndarray | None, deep: int, low: int):
    """Levels (node, estimate, share) of contexts of `low` to `deep` bytes, shortest first, from the nodes of `deep` bytes.

    longer: log probability of each node's longer contexts, or None where there are none.  Also gives
    (node, a, b, longer) of the contexts one byte shorter than `low`; these are sums, so that parts
    of the tree that share no context of `low` bytes can be added up.
    """
    levels = []
    for d in range(deep, low - 1, -1):
        own = _log_kt(a, b)
        if longer is None:
            weighted, share = own, np.ones(len(node))
        else:
            weighted = np.logaddexp(own, longer) - np.log(2)
            share = 1 / (1 + np.exp(np.clip(longer - own, -700, 700)))
        levels.append((node, (b + 0.5) / (a + b + 1), share))
        # a longer context's key without its first byte is its parent's key
        node, a, b, longer = _sums(node & _U((1 << (8 * d)) - 1), a, b, weighted)
    return levels[::-1], (node, a, b, longer)


class Tree:
    """Frozen weighted tree; score() gives log2 of the probability of each gram's byte.

    top: the levels of the shortest contexts, where the grams are only a part of all; a part has all
    grams of its contexts of len(top) bytes.
    """

    def __init__(self, gram: np.ndarray, count: np.ndarray, depth: int, top: Sequence = ()):
        self.depth = depth
        self.nodes = [*top, *climb(*leaves(gram, count), None, depth, len(top))[0]]

    def score(self, gram: np.ndarray) -> np.ndarray:
        total = np.zeros(len(gram))
        byte = gram & _U(255)
        for k in range(8):
            bit = ((byte >> _U(7 - k)) & _U(1)).astype(bool)
            place = _U(1 << k) | (byte >> _U(8 - k))
            p = np.full(len(gram), 0.5)
            met = np.zeros(len(gram), bool)
            for d in range(self.depth, -1, -1):
                node, estimate, share = self.nodes[d]
                key = (((gram >> _U(8)) & _U((1 << (8 * d)) - 1)) << _U(8)) | place
                at = np.minimum(np.searchsorted(node, key), max(0, len(node) - 1))
                seen = node[at] == key if len(node) else np.zeros(len(gram), bool)
                w = np.where(met, share[at], 1.0) if len(node) else 0.0
                p = np.where(seen, w * (estimate[at] if len(node) else 0.5) + (1 - w) * p, p)
                met |= seen
            total += np.log2(np.where(bit, p, 1 - p))
        return total


class Values:
    """Values of distinct grams in an open-addressed table."""

    def __init__(self, gram: np.ndarray, values: np.ndarray):
        bits = max(10, int(np.ceil(np.log2(max(1, len(gram)) * 4))))
        self._shift = _U(64 - bits)
        self._keys = np.full(1 << bits, np.iinfo(np.uint64).max, _U)
        self._values = np.zeros(1 << bits, np.float32)
        left, at = np.arange(len(gram)), self._slot(gram)
        while len(left):  # all grams at once
            free = self._keys[at] == np.iinfo(np.uint64).max
            self._keys[at[free]] = gram[left[free]]
            won = self._keys[at] == gram[left]
            self._values[at[won]] = values[left[won]]
            left, at = left[~won], (at[~won] + 1) & (len(self._keys) - 1)

    def _slot(self, gram: np.ndarray) -> np.ndarray:
        return ((gram * _U(0x9E3779B97F4A7C15)) >> self._shift).astype(np.int64)

    def find(self, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Each gram's value (0 if it is not there), and the places of those that are not there."""
        at = self._slot(gram)
        found = self._keys[at]
        out = self._values[at].astype(np.float64)
        left = np.flatnonzero(found != gram)
        at, found = at[left], found[left]
        out[left] = 0.0
        new: list[np.ndarray] = []
        while len(left):
            empty = found == np.iinfo(np.uint64).max
            new.append(left[empty])
            left, at = left[~empty], (at[~empty] + 1) & (len(self._keys) - 1)
            found = self._keys[at]
            hit = found == gram[left]
            out[left[hit]] = self._values[at[hit]]
            left, at, found = left[~hit], at[~hit], found[~hit]
        return out, np.sort(np.concatenate(new)) if new else np.empty(0, np.int64)
