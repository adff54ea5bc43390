"""Vectorised word work on Arrow string columns (numpy, no per-word Python).

Words are ``[^\\x20\\x09-\\x0D]+``.  A batch of texts is cut into pieces of about
``CHUNK`` bytes that end at text boundaries, so memory is bounded by the piece
or by the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK = 1 << 20
_U = np.uint64
_BASE = 0x9E3779B97F4A7C15
_INV = pow(_BASE, -1, 1 << 64)
SPACES = np.zeros(256, bool)
SPACES[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers with good avalanche (overwrites x)."""
    x ^= x >> _U(30)
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def _byte_values(lower: bool) -> np.ndarray:
    values = mix(np.arange(1, 257, dtype=_U) * _U(_BASE)) | _U(1)
    values[SPACES] = 0
    if lower:
        values[65:91] = values[97:123]
    return values


_VALUES = {lower: _byte_values(lower) for lower in (False, True)}
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. n - 1 modulo 2 ** 64, kept for the next call up to CHUNK."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, CHUNK + 1), base, _U)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if len(have) <= 4 * CHUNK:
            _powers[base] = have
    return have[:n]


@dataclass
class Words:
    """Words of consecutive texts: bytes, word bounds, and each text's first word."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # len(texts) + 1
    lo: int  # the texts' places in their batch
    hi: int

    def hashes(self, lower: bool = False) -> np.ndarray:
        """64-bit hash of each word; with lower, A-Z count as a-z."""
        if not len(self.starts):
            return np.empty(0, _U)
        values = _VALUES[lower][self.data]
        values *= powers(_BASE, len(values))
        h = np.add.reduceat(values, self.starts)
        h *= powers(_INV, len(values))[self.starts]
        return mix(h)


def prefix_hashes(p: Words, which: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of those words cut at `ends`; a cut word hashes like the whole word that it is."""
    total = np.zeros(len(p.data) + 1, _U)
    np.cumsum(_VALUES[False][p.data] * powers(_BASE, len(p.data)), out=total[1:])
    h = total[ends] - total[p.starts[which]]
    h *= powers(_INV, len(p.data))[p.starts[which]]
    return mix(h)


def bytes_of(column) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and n + 1 offsets of a string column; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column, "").cast(pa.large_string())
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def pieces(column, size: int = CHUNK) -> Iterator[Words]:
    """The words of a string column, a bounded piece of whole texts at a time."""
    raw, at = bytes_of(column)
    lo, n = 0, len(at) - 1
    while lo < n:
        hi = min(n, max(lo + 1, int(np.searchsorted(at, at[lo] + size, "right")) - 1))
        data, own = raw[at[lo] : at[hi]], at[lo : hi + 1] - at[lo]
        blank = SPACES[data]
        before, after = np.empty_like(blank), np.empty_like(blank)
        before[1:], after[:-1] = blank[:-1], blank[1:]
        full = own[1:] > own[:-1]
        before[own[:-1][full]] = True
        after[own[1:][full] - 1] = True
        word = ~blank
        starts = np.flatnonzero(word & before)
        yield Words(data, starts, np.flatnonzero(word & after) + 1, np.searchsorted(starts, own), lo, hi)
        lo = hi


def rolled(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive values of h (bounds of texts are the caller's)."""
    if len(h) < n:
        return np.empty(0, _U)
    total = np.zeros(len(h) + 1, _U)
    np.cumsum(h * powers(_BASE, len(h)), out=total[1:])
    out = total[n:] - total[:-n]
    out *= powers(_INV, len(out))
    return mix(out)


def inside(first: np.ndarray, n_words: int, n: int) -> np.ndarray:
    """For each place of rolled(): whether its n words lie in one text."""
    count = max(0, n_words - n + 1)
    ok = np.ones(count, bool)
    for k in range(1, n):
        at = first[1:] - k
        ok[at[(at >= 0) & (at < count)]] = False
    return ok
