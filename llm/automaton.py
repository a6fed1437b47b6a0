"""A generalised suffix automaton over word sequences."""

from __future__ import annotations

from collections.abc import Iterable, Sequence


class SuffixAutomaton:
    """All runs of words of several items, matched word by word.

    State 0 is the empty run.  `step` keeps, for each document position, the longest
    run of words ending there that some item contains.  A window is a run of
    `window` words of an item, or all of a shorter item.
    """

    def __init__(self, items: Iterable[tuple[int, Sequence[bytes], bool]], window: int):
        """items: (number, words, whole); a short run is a window only if whole."""
        self.window = window
        self.words: dict[bytes, int] = {}
        self.moves: list[dict[int, int]] = [{}]
        self.links: list[int] = [-1]
        self.lengths: list[int] = [0]
        rows = [
            (number, [self.words.setdefault(w, len(self.words)) for w in words], whole)
            for number, words, whole in items
        ]
        for _, word_ids, _ in rows:
            last = 0
            for w in word_ids:
                last = self._extend(last, w)
        self._mark(rows)

    def _extend(self, last: int, w: int) -> int:
        """The state of the run that ends with `w` after `last`."""
        moves, links, lengths = self.moves, self.links, self.lengths
        known = moves[last].get(w)
        if known is not None:
            # Another item begins alike: no new run, at most a state to divide.
            return known if lengths[known] == lengths[last] + 1 else self._divide(last, w, known)
        state = self._state({}, lengths[last] + 1)
        at = last
        while at >= 0 and w not in moves[at]:
            moves[at][w] = state
            at = links[at]
        if at < 0:
            links[state] = 0
        else:
            target = moves[at][w]
            fits = lengths[target] == lengths[at] + 1
            links[state] = target if fits else self._divide(at, w, target)
        return state

    def _divide(self, at: int, w: int, target: int) -> int:
        """Split the runs that fit `at` off `target`."""
        part = self._state(dict(self.moves[target]), self.lengths[at] + 1)
        self.links[part], self.links[target] = self.links[target], part
        while at >= 0 and self.moves[at].get(w) == target:
            self.moves[at][w] = part
            at = self.links[at]
        return part

    def _state(self, moves: dict[int, int], length: int) -> int:
        self.moves.append(moves)
        self.links.append(0)
        self.lengths.append(length)
        return len(self.moves) - 1

    def _mark(self, rows: list[tuple[int, list[int], bool]]) -> None:
        """Which items each window belongs to, and the nearest window above each state."""
        window, links, lengths = self.window, self.links, self.lengths
        holders: dict[int, set[int]] = {}
        for number, word_ids, whole in rows:
            if len(word_ids) < window and not whole:
                continue
            state = 0
            for i, w in enumerate(word_ids):
                state = self.moves[state][w]
                if i + 1 >= window:
                    at = state
                    while lengths[links[at]] >= window:
                        at = links[at]
                    holders.setdefault(at, set()).add(number)
            if 0 < len(word_ids) < window:
                # A whole item follows no other word somewhere: it is its state's longest run.
                holders.setdefault(-state, set()).add(number)
        self.holders = {abs(k): tuple(sorted(v)) for k, v in holders.items()}
        short = {-k for k in holders if k < 0}
        order = sorted(range(1, len(links)), key=lengths.__getitem__)
        # By state: the state of its window of full length (0: none), and the
        # longest whole short item that ends it (0: none).
        self.full = [0] * len(links)
        self.short = [0] * len(links)
        for s in order:
            up = links[s]
            if lengths[s] >= window:
                self.full[s] = self.full[up] or s
            self.short[s] = s if s in short else self.short[up]
        self.any_short = bool(short)

    def hits(self, word_ids: Sequence[int | None]) -> tuple[list[tuple[int, int]], set[int]]:
        """Hit positions as disjoint (start, end) ranges, and numbers of items with windows.

        `word_ids` has None for words of no item.
        """
        moves, links, lengths, window = self.moves, self.links, self.lengths, self.window
        full, short = self.full, self.short
        state = length = 0
        spans: list[tuple[int, int]] = []
        seen: set[int] = set()
        for i, w in enumerate(word_ids):
            if w is None:
                state = length = 0
                continue
            after = moves[state].get(w)
            while after is None and state:
                state = links[state]
                length = lengths[state]
                after = moves[state].get(w)
            if after is None:
                length = 0
                continue
            state = after
            length += 1
            start = i + 1
            if length >= window and full[state]:
                seen.add(full[state])
                start = i + 1 - length
            if self.any_short:
                # Walk up the short items that end here and fit in what is matched.
                at = short[state]
                while at and lengths[at] > length:
                    at = short[links[at]]
                while at:
                    seen.add(at)
                    start = min(start, i + 1 - lengths[at])
                    at = short[links[at]]
            if start <= i:
                while spans and spans[-1][1] >= start:
                    start = min(start, spans.pop()[0])
                spans.append((start, i + 1))
        return spans, {n for s in seen for n in self.holders[s]}
