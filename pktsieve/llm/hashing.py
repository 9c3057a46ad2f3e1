"""Vectorised content hashes of byte strings: prefix sums of a polynomial modulo 2^64.

Equal strings have equal hashes wherever they stand. Bytes are first mapped to
random 64-bit values, and results are mixed, so that hashes of different
strings look independent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_BASE = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_VALUES = np.random.default_rng(20).integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)

_powers: dict[str, np.ndarray] = {}


def _power(n: int, inverse: bool) -> np.ndarray:
    """Powers 0..n-1 of the base (or of its inverse) modulo 2^64; kept up to 2^20."""
    key = "i" if inverse else "b"
    have = _powers.get(key)
    if have is None or len(have) < n:
        size = max(1 << 16, 1 << (n - 1).bit_length())
        have = np.full(size, _INV if inverse else _BASE, dtype=np.uint64)
        have[0] = 1
        np.multiply.accumulate(have, out=have)
        if size <= 1 << 20:
            _powers[key] = have
    return have[:n]


def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit."""
    h = (h ^ (h >> np.uint64(30))) * _M1
    h = (h ^ (h >> np.uint64(27))) * _M2
    return h ^ (h >> np.uint64(31))


class Prefix:
    """Hashes of any substrings of one byte string, or of one sequence of 64-bit hashes."""

    def __init__(self, a: np.ndarray):
        n = len(a)
        self.sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum((a if a.dtype == np.uint64 else _VALUES[a]) * _power(n, False), out=self.sums[1:])
        self.inverse = _power(n + 1, True)

    def spans(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.inverse[start])

    def windows(self, k: int) -> np.ndarray:
        """Hashes of all k-byte windows, in order."""
        return mixed((self.sums[k:] - self.sums[:-k]) * self.inverse[: len(self.sums) - k])


_WHITE = np.zeros(256, dtype=bool)
_WHITE[[0x20, *range(0x09, 0x0E)]] = True


def word_edges(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end bytes of the words ``[^\\x20\\x09-\\x0D]+`` of a byte string."""
    edge = np.diff(np.concatenate(([True], _WHITE[a], [True])).astype(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def word_hashes(text: str) -> np.ndarray:
    """Hashes of the words ``[^\\x20\\x09-\\x0D]+`` of a text, A-Z in lower case."""
    raw = text.encode("utf-8", "surrogatepass").lower()
    if not raw:
        return np.zeros(0, dtype=np.uint64)
    a = np.frombuffer(raw, dtype=np.uint8)
    return Prefix(a).spans(*word_edges(a))


def batches(sizes, limit: int = 1 << 18) -> Iterator[tuple[int, int]]:
    """Ranges of neighbours whose sizes add up to ``limit`` at most (or that are one)."""
    lo, total = 0, 0
    for i, n in enumerate(sizes):
        if i > lo and total + n > limit:
            yield lo, i
            lo, total = i, 0
        total += n
    if lo < len(sizes):
        yield lo, len(sizes)


def words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """The :func:`word_hashes` of some texts, one after another, and how many each has."""
    raws = [t.encode("utf-8", "surrogatepass").lower() for t in texts]
    a = np.frombuffer(b"\n".join(raws), dtype=np.uint8)
    if not len(a):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(raws), dtype=np.int64)
    starts, ends = word_edges(a)
    heads = np.cumsum([0, *(len(r) + 1 for r in raws)])
    return Prefix(a).spans(starts, ends), np.diff(np.searchsorted(starts, heads))


def shingle_set(text: str, width: int = 3) -> np.ndarray:
    """Sorted distinct hashes of the ``width``-word shingles; with fewer words, the whole sequence as one."""
    w = word_hashes(text)
    if not len(w):
        return w
    k = min(width, len(w))
    h = np.full(len(w) - k + 1, k, dtype=np.uint64)
    for i in range(k):
        h = mixed(h * _BASE + w[i : len(w) - k + 1 + i])
    return np.unique(h)
