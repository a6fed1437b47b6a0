"""Minimum-cost flow between old and new shards."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Sequence


def transfers(
    held: Sequence[int], wanted: Sequence[int], cost: Callable[[int, int], int]
) -> dict[tuple[int, int], int]:
    """Units to go from each old shard to each new one at least total cost.

    `held` are the old shards' units, `wanted` the new ones'; both have the same sum.
    `cost(i, j)` is what one unit from i to j costs, 0 or more.  Successive shortest paths with
    potentials (Dijkstra) over the shards: the work depends on their number alone, each
    path filling a shard, emptying one or using a transfer up.
    """
    if sum(held) != sum(wanted):
        raise ValueError("old and new shards must hold the same in total")
    n, m = len(held), len(wanted)
    price = [[cost(i, j) for j in range(m)] for i in range(n)]
    left, room = list(held), list(wanted)
    flow: dict[tuple[int, int], int] = {}
    potential = [0] * (n + m)
    while any(left):
        start = next(i for i in range(n) if left[i])
        distance: list[int | None] = [None] * (n + m)
        came = [-1] * (n + m)
        done = [False] * (n + m)
        distance[start] = 0
        queue = [(0, start)]
        while queue:
            d, u = heapq.heappop(queue)
            if done[u]:
                continue
            done[u] = True
            if u < n:
                steps = [(n + j, price[u][j]) for j in range(m)]
            else:
                steps = [(i, -price[i][u - n]) for i in range(n) if flow.get((i, u - n))]
            for v, c in steps:
                through = d + c + potential[u] - potential[v]
                if not done[v] and (distance[v] is None or through < distance[v]):
                    distance[v], came[v] = through, u
                    heapq.heappush(queue, (through, v))
        reached = [j for j in range(m) if room[j]]
        end = min(reached, key=lambda j: (distance[n + j] + potential[n + j] - potential[start], j))
        most = max(d for d in distance if d is not None)
        potential = [
            p + (most if d is None else d) for p, d in zip(potential, distance, strict=True)
        ]
        path = [n + end]
        while path[-1] != start:
            path.append(came[path[-1]])
        hops = list(zip(path[1:], path, strict=False))
        amount = min(
            left[start], room[end], *[flow[v, u - n] for u, v in hops if u >= n], left[start]
        )
        for u, v in hops:
            if u < n:
                flow[u, v - n] = flow.get((u, v - n), 0) + amount
            else:
                flow[v, u - n] -= amount
        left[start] -= amount
        room[end] -= amount
    return {k: v for k, v in flow.items() if v}
