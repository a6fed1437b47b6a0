"""Word shingles of many texts at once, as arrays of 64-bit hashes.

Bytes are hashed by position with a polynomial modulo 2**64 over random byte codes and
mixed; two different shingles of one comparison share a hash with a chance of 2**-64.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

_U = np.uint64
_STEP = 0x9E3779B97F4A7C15
_ODD = 0xD6E8FEB86659FD93
# Positions of one polynomial; longer texts are hashed in their own, longer run.
_RUN = 1 << 20


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit numbers."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _codes(lower: bool) -> np.ndarray:
    codes = mix(np.arange(1, 257, dtype=_U) * _U(_STEP))
    if lower:
        codes[65:91] = codes[97:123]
    return codes


def _powers(base: int, n: int) -> np.ndarray:
    return np.multiply.accumulate(np.r_[_U(1), np.full(n, base, dtype=_U)])


_INVERSE = pow(_ODD, -1, 1 << 64)
_CODES = {lower: _codes(lower) for lower in (False, True)}
_POWER: dict[int, tuple[np.ndarray, np.ndarray]] = {}

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = _RUN if n <= _RUN else 1 << n.bit_length()
    if size not in _POWER:
        if size > _RUN:  # for a very long text only; not kept
            return _powers(_ODD, size), _powers(_INVERSE, size)
        _POWER[size] = _powers(_ODD, size), _powers(_INVERSE, size)
    return _POWER[size]


def words(buffer: np.ndarray, lower: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes, starts and ends of the words of a UTF-8 buffer (white space: ASCII)."""
    space = _SPACE[buffer]
    edge = np.flatnonzero(np.diff(np.r_[True, space, True].astype(np.int8)))
    start, end = edge[0::2], edge[1::2]
    power, inverse = tables(len(buffer))
    sums = np.zeros(len(buffer) + 1, dtype=_U)
    np.cumsum(_CODES[lower][buffer] * power[: len(buffer)], out=sums[1:])
    return mix((sums[end] - sums[start]) * inverse[start]), start, end


def shingle_hashes(w: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all runs of `size` words."""
    n = len(w) - size + 1
    out = np.zeros(max(n, 0), dtype=_U)
    for k in range(size):
        out = mix(out * _U(_ODD) + w[k : k + len(out)])
    return out


def text_runs(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of texts with together at most _RUN bytes, or a single longer one."""
    first, total = 0, 0
    for i, n in enumerate(lengths):
        if i > first and total + n + 1 > _RUN:
            yield first, i
            first, total = i, 0
        total += n + 1
    if first < len(lengths):
        yield first, len(lengths)


def word_runs(texts: list[bytes], lower: bool) -> Iterator[np.ndarray]:
    """Word hashes of each text."""
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    for i, j in text_runs(lengths):
        hashes, start, _ = words(np.frombuffer(b" ".join(texts[i:j]), dtype=np.uint8), lower)
        ends = np.cumsum(lengths[i:j] + 1)
        yield from np.split(hashes, np.searchsorted(start, ends[:-1]))


def shingle_sets(texts: list[bytes], size: int, lower: bool = True) -> Iterator[np.ndarray]:
    """Sorted distinct shingle hashes of each text; fewer words make one shingle."""
    for w in word_runs(texts, lower):
        if 0 < len(w) < size:
            yield shingle_hashes(np.r_[w, _U(len(w))], len(w) + 1)
        else:
            yield np.unique(shingle_hashes(w, size))


def jaccard(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """Sizes of intersection and union of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0, len(b)
    at = np.searchsorted(b, a)
    same = int(np.count_nonzero(b[np.minimum(at, len(b) - 1)] == a))
    return same, len(a) + len(b) - same
