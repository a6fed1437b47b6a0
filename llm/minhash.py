"""One-permutation MinHash with optimal densification, and bands of it."""

from __future__ import annotations

import numpy as np

from llm.shingles import mix

_U = np.uint64
# Draws of a donor bin before the next filled bin is taken.
_DRAWS = 64


class Bands:
    """Bucket keys of sets of 64-bit hashes: `bands` keys of `rows` bins each.

    One pass over a set finds the smallest hash of every bin (equal ranges of the hash
    space).  An empty bin takes over a filled one, drawn for it by a hash that is the
    same for all sets (optimal densification), so that equal bins stay as likely
    as the sets are similar.
    """

    def __init__(self, bands: int, rows: int):
        self.bands, self.rows, self.bins = bands, rows, bands * rows
        draw = np.arange(self.bins * _DRAWS, dtype=_U).reshape(self.bins, _DRAWS)
        self.donors = (mix(draw + _U(0x51ED270B)) % _U(self.bins)).astype(np.int64)
        # A band takes bins from all over the hash space.
        self.order = np.argsort(mix(np.arange(self.bins, dtype=_U) + _U(77)))

    def miss(self, similarity: float) -> float:
        """Chance that two sets of this similarity share no bucket."""
        return (1 - similarity**self.rows) ** self.bands

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        """Bucket keys of one sorted, distinct, non-empty set."""
        at = ((hashes >> _U(32)) * _U(self.bins) >> _U(32)).astype(np.int64)
        first = np.flatnonzero(np.r_[True, at[1:] != at[:-1]])
        value = np.zeros(self.bins, dtype=_U)
        filled = np.zeros(self.bins, dtype=bool)
        value[at[first]], filled[at[first]] = hashes[first], True
        empty = np.flatnonzero(~filled)
        if len(empty):
            found = filled[self.donors[empty]]
            pick = found.argmax(axis=1)
            donor = self.donors[empty, pick]
            lost = ~found[np.arange(len(empty)), pick]
            if lost.any():
                known = at[first]
                nxt = np.searchsorted(known, empty[lost]) % len(known)
                donor[lost] = known[nxt]
            value[empty] = value[donor]
        grid = value[self.order].reshape(self.bands, self.rows)
        key = np.arange(1, self.bands + 1, dtype=_U) * _U(0x9E3779B97F4A7C15)
        for k in range(self.rows):
            key = mix(key * _U(31) + grid[:, k])
        return key.view(np.int64)
