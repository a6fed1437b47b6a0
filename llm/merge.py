"""k-way merging with a tree of losers."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import Any


class _End:
    """Greater than every key."""


def merged(runs: Iterable[Iterable[tuple[Any, Any]]]) -> Iterator[tuple[Any, Any]]:
    """(key, value) of sorted runs in one sorted sequence; equal keys by run.

    Inner nodes of the tree hold the loser of the match below them, so that the next winner is
    found by one match per level.
    """
    sources = [iter(r) for r in runs]
    k = len(sources)
    if not k:
        return
    heads: list[Any] = [next(s, _End) for s in sources]

    def beats(i: int, j: int) -> bool:
        if heads[j] is _End:
            return True
        if heads[i] is _End:
            return False
        return (heads[i][0], i) < (heads[j][0], j)

    losers = [-1] * k

    def replay(i: int) -> int:
        """Plays `i` up the tree; while it is built, the first to come waits."""
        node = (i + k) // 2
        while node:
            other = losers[node]
            if other < 0:
                losers[node] = i
                return -1
            if beats(other, i):
                losers[node], i = i, other
            node //= 2
        return i

    winner = -1
    for i in range(k):
        winner = max(winner, replay(i))
    while heads[winner] is not _End:
        yield heads[winner]
        heads[winner] = next(sources[winner], _End)
        winner = replay(winner)
