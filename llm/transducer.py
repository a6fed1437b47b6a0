"""SentencePiece models as weighted finite-state transducers."""

from __future__ import annotations

import heapq
import re
from array import array
from collections.abc import Iterator

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = range(1, 7)
UNIGRAM, BPE = 1, 2
# What a character without a piece costs beyond the least likely piece.
_UNKNOWN_COST = 10.0
# Longer words are composed anew each time.
_LONGEST_KNOWN = 48


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and raw values of a protocol buffer message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
            continue
        size = number() if tag & 7 == 2 else {1: 8, 5: 4}[tag & 7]
        yield tag >> 3, data[at : at + size]
        at += size


def _float(raw: bytes) -> float:
    import struct

    return struct.unpack("<f", raw)[0]


class Transducer:
    """Normaliser, pieces and byte fallback in one machine from text to piece ids.

    The normaliser maps a space to the sign U+2581, which also goes before a text.
    The piece machine reads a piece's characters and writes its id, for the weight
    -score (unigram models) or 0 (BPE models).  A character without a piece is read as its
    UTF-8 bytes.  For BPE, a third machine accepts only pieces that may follow each other:
    a and b where merging the text of ab leads to a, b.  By that rule a text has exactly one
    accepted path, the one that merging finds, so that the lightest path is right for
    both kinds of model.

    No piece contains certain pairs of characters.  There all paths pass one state, so a
    text is composed part by part, and a part's shortest path is looked up if known.
    """

    def __init__(self, model: bytes, most_known: int = 150_000):
        self.most_known = most_known
        self.ids: dict[str, int] = {}
        self.scores: dict[int, float] = {}
        self.byte_ids: dict[int, int] = {}
        self.texts: list[bytes] = []
        self.prefix, self.squeeze, self.kind = True, True, UNIGRAM
        self.unknown = 0
        escape = True
        for field, value in fields(model):
            if field == 1:
                self._piece(dict(fields(value)))
            elif field == 2:
                self.kind = dict(fields(value)).get(3, UNIGRAM)
            elif field == 3:
                spec = dict(fields(value))
                if spec.get(2):
                    raise ValueError("character maps of a normaliser are not supported")
                self.prefix = bool(spec.get(3, 1))
                self.squeeze = bool(spec.get(4, 1))
                escape = bool(spec.get(5, 1))
        if not escape or self.kind not in (UNIGRAM, BPE):
            raise ValueError("only unigram and BPE models with escaped spaces are supported")
        self._compile()

    def _piece(self, piece: dict) -> None:
        number, kind, text = len(self.texts), piece.get(3, NORMAL), piece[1].decode()
        if kind in (USER, UNUSED):
            raise ValueError("user-defined and unused pieces are not supported")
        self.texts.append(text.replace(SPACE, " ").encode() if kind == NORMAL else b"")
        if kind == NORMAL:
            self.ids[text] = number
            self.scores[number] = _float(piece.get(2, b"\0\0\0\0"))
        elif kind == BYTE:
            value = int(text[3:5], 16)
            self.byte_ids[value] = number
            self.texts[number] = bytes([value])
        elif kind == UNKNOWN:
            self.unknown = number

    def _compile(self) -> None:
        self.inside = {p[i : i + 2] for p in self.ids for i in range(len(p) - 1)}
        # No piece has the sign after another character, and none has two and a character.
        self.words_apart = self.prefix and not any(
            SPACE in p[1:] and p.strip(SPACE) for p in self.ids
        )
        self.penalty = _UNKNOWN_COST - min(self.scores.values(), default=0.0)
        # Ranks of pieces by score; equal scores are told apart by place, not by rank.
        by_score = sorted(self.ids.values(), key=lambda i: (-self.scores[i], i))
        self.rank = {piece: k for k, piece in enumerate(by_score)}
        count: dict[float, int] = {}
        for score in self.scores.values():
            count[score] = count.get(score, 0) + 1
        self.tied = {i for i, s in self.scores.items() if count[s] > 1}
        self.strings = {i: p for p, i in self.ids.items()}
        self.halves: dict[int, tuple[int, int]] = {}
        self.reached: set[int] = set()
        self.pairs: dict[int, bool] = {}
        self.parts: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        if self.kind == BPE:
            for piece, text in self.strings.items():
                trace: list[tuple[str, str]] = []
                if self.merged(text, trace) == [text]:
                    self.reached.add(piece)
                    if trace:
                        self.halves[piece] = self.ids[trace[-1][0]], self.ids[trace[-1][1]]
        # Pieces as a tree of beginnings; -1: a beginning that is no piece.
        self.tree = {p[:n]: -1 for p in self.ids for n in range(1, len(p))}
        usable = self.reached if self.kind == BPE else self.scores.keys()
        self.tree |= {p: i for p, i in self.ids.items() if i in usable}

    # Composition

    def normalised(self, text: str) -> str:
        if self.squeeze:
            text = re.sub(" +", " ", text.strip(" "))
        if not text:
            return ""
        return ((" " if self.prefix else "") + text).replace(" ", SPACE)

    def encode(self, text: str) -> list[int]:
        """Ids along the lightest path of the composition with `text`."""
        return array("i", self.encode_packed(text)).tolist()

    def encode_packed(self, text: str) -> bytes:
        """The same as 32-bit numbers in machine order."""
        if not self.words_apart or SPACE in text or "  " in text or text[:1] == " ":
            return b"".join(map(self._known_part, self._parts(self.normalised(text))))
        # Single spaces: every space begins a word that no piece reaches across.
        known, words = self.words, (text.rstrip(" ") if self.squeeze else text).split(" ")
        if words == [""]:
            return b""
        found = list(map(known.get, words))
        if None in found:
            for i, packed in enumerate(found):
                if packed is None:
                    found[i] = self._word(words[i])
        return b"".join(found)

    def _word(self, word: str) -> bytes:
        packed = b"".join(map(self._known_part, self._parts(SPACE + word)))
        if len(word) <= _LONGEST_KNOWN:
            if len(self.words) >= self.most_known:
                self.words.clear()
            self.words[word] = packed
        return packed

    def _parts(self, text: str) -> Iterator[str]:
        """`text` cut between characters that no piece holds side by side."""
        inside, start = self.inside, 0
        for i in range(1, len(text)):
            if text[i - 1 : i + 1] not in inside:
                yield text[start:i]
                start = i
        if text:
            yield text[start:]

    def _known_part(self, part: str) -> bytes:
        packed = self.parts.get(part)
        if packed is None:
            packed = array("i", self.shortest(part)).tobytes()
            if len(part) <= _LONGEST_KNOWN:
                if len(self.parts) >= self.most_known:
                    self.parts.clear()
                self.parts[part] = packed
        return packed

    def shortest(self, part: str) -> list[int]:
        """The lightest path over states (position, last piece)."""
        n, tree, scores, pairs = len(part), self.tree, self.scores, self.pairs
        weight: list[float | None] = [0.0, *[None] * n]
        came: list[int] = [0] * (n + 1)
        last: list[int] = [-1] * (n + 1)
        unigram = self.kind == UNIGRAM
        for i in range(n):
            here = weight[i]
            if here is None:
                continue
            before, single = last[i], False
            for end in range(i + 1, n + 1):
                # The arc that reads part[i:end]; None: no piece begins like this.
                piece = tree.get(part[i:end])
                if piece is None:
                    break
                if piece < 0:
                    continue
                single = single or end == i + 1
                if unigram:
                    cost = here - scores[piece]
                    if weight[end] is not None and weight[end] <= cost:
                        continue
                else:
                    # Weights are 0 and accepted paths to a position unique.
                    if weight[end] is not None:
                        continue
                    if before >= 0:
                        allowed = pairs.get(before << 32 | piece)
                        if allowed is None:
                            allowed = self.follows(before, piece)
                        if not allowed:
                            continue
                    cost = 0.0
                weight[end], came[end], last[end] = cost, i, piece
            if not single and weight[i + 1] is None:
                weight[i + 1], came[i + 1], last[i + 1] = here + self.penalty, i, -1
        out: list[int] = []
        at = n
        while at:
            start = came[at]
            if last[at] < 0:
                out += reversed(self._bytes(part[start:at]))
            else:
                out.append(last[at])
            at = start
        return out[::-1]

    def _bytes(self, character: str) -> list[int]:
        raw = character.encode()
        if all(b in self.byte_ids for b in raw):
            return [self.byte_ids[b] for b in raw]
        return [self.unknown]

    # What may follow what (BPE)

    def follows(self, a: int, b: int) -> bool:
        """Whether merging the text of the two pieces ends with just these two."""
        key = a << 32 | b
        known = self.pairs.get(key)
        if known is None:
            if a in self.tied or b in self.tied:
                known = self.merged(self.strings[a] + self.strings[b]) == [
                    self.strings[a],
                    self.strings[b],
                ]
            else:
                known = self._stable(a, b)
            if len(self.pairs) >= 2 * self.most_known:
                self.pairs.clear()
            self.pairs[key] = known
        return known

    def _stable(self, a: int, b: int) -> bool:
        """Undo the later merge of both sides again and again, looking for a merge across.

        A merge across the border happens if its rank comes before that of the merge
        that would make one of its sides part of a larger piece.
        """
        rank, strings, ids, halves = self.rank, self.strings, self.ids, self.halves
        # Ranks of the merges that consume the current right end of a and left end of b.
        until_a = until_b = len(rank)
        while True:
            across = ids.get(strings[a] + strings[b])
            if across is not None:
                # Of equal merges the leftmost comes first.
                if rank[across] < until_a and rank[across] <= until_b:
                    return False
            rank_a = rank[a] if a in halves else -1
            rank_b = rank[b] if b in halves else -1
            if rank_a < 0 and rank_b < 0:
                return True
            if rank_a >= rank_b:
                until_a, a = rank_a, halves[a][1]
            else:
                until_b, b = rank_b, halves[b][0]

    def merged(self, text: str, trace: list[tuple[str, str]] | None = None) -> list[str]:
        """Merge neighbours by best score, leftmost first among equals, until none is a piece."""
        part: list[str | None] = list(text)
        after = list(range(1, len(part) + 1))
        before = list(range(-1, len(part) - 1))
        queue: list[tuple[float, int, str]] = []

        def offer(i: int, j: int) -> None:
            if 0 <= i and j < len(part):
                piece = self.ids.get(part[i] + part[j])
                if piece is not None:
                    heapq.heappush(queue, (-self.scores[piece], i, part[i] + part[j]))

        for i in range(len(part) - 1):
            offer(i, i + 1)
        while queue:
            _, i, whole = heapq.heappop(queue)
            if part[i] is None or (j := after[i]) >= len(part) or part[i] + part[j] != whole:
                continue
            if trace is not None:
                trace.append((part[i], part[j]))
            part[i], part[j] = whole, None
            after[i] = after[j]
            if after[i] < len(part):
                before[after[i]] = i
            offer(before[i], i)
            offer(i, after[i])
        return [p for p in part if p is not None]

    # Back to text

    def decode(self, ids: list[int]) -> str:
        """The text of the pieces, without the sign that the normaliser put before it."""
        raw = b"".join([self.texts[i] for i in ids])
        if self.prefix and raw[:1] == b" " and ids and ids[0] not in self.byte_ids.values():
            raw = raw[1:]
        return raw.decode(errors="replace")
