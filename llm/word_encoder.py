"""Byte-level BPE ids of many texts at once, each distinct word encoded once."""

from __future__ import annotations

import os
import re
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Words whose ids are remembered, by their number and bytes; beyond, memory starts anew.
WORDS_HELD, BYTES_HELD = 300_000, 12 << 20
_BLANK = "\\s\\x0b\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}"
# A run of blanks in which a space stands at third place or later, or ends the text.
_LONG_RUN = f"[{_BLANK}] [{_BLANK}]|[{_BLANK}] $"
_CHUNK = re.compile(r"\s*\S+|\s+")
# Words of these letters, and marks behind them, are cut where the tokenizer would cut them.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_MARKS = ".,!?;:%$*&#|<>"


def _plain(column: pa.Array) -> list:
    """A column without nulls as a list; faster than going through Arrow's scalars."""
    return column.to_numpy(zero_copy_only=False).tolist()


class WordEncoder:
    """Encodes texts with a tokenizer that never joins what stands before and after blanks.

    Byte-level BPE of the GPT-2 kind cuts a text into pieces before merging: a piece holds
    blanks at its start only, or is nothing but blanks.  A text can therefore be cut before
    each space that follows no blank, and its ids are those of its parts one after another.
    Texts with runs of blanks that such cuts would break are cut where runs begin.  A word of
    letters and marks behind them is two pieces, to which the tokenizer's model is applied as it stands;
    all other words go through the whole tokenizer.

    A tokenizer of another kind encodes whole texts.
    """

    def __init__(self, model: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer, models, pre_tokenizers

        self.tokenizer = Tokenizer.from_str(model)
        size = self.tokenizer.get_vocab_size(with_added_tokens=True)
        # Ids are kept as bytes, in this machine's order of bytes.
        self.code = "H" if size <= 1 << 16 else "I"
        self.dtype = np.dtype(self.code)
        cutter, added = self.tokenizer.pre_tokenizer, self.tokenizer.get_added_tokens_decoder()
        self.by_words = (
            self.tokenizer.normalizer is None
            and isinstance(cutter, pre_tokenizers.ByteLevel)
            and cutter.use_regex
            and not cutter.add_prefix_space
            and isinstance(self.tokenizer.model, models.BPE)
            and not self.tokenizer.model.dropout
            and not any(
                re.search(r"\s", t.content) or re.fullmatch(f"[{_LETTERS}]*[{_MARKS}]*", t.content)
                for t in added.values()
            )
        )
        if self.by_words:
            self.model = self.tokenizer.model
            # What is remembered here need not be remembered there.
            self.model._resize_cache(0)
            letters = [c for c in map(chr, range(33, 256)) if re.match(f"[{_LETTERS}]", c)]
            spelled = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.space = spelled.pre_tokenize_str(" ")[0][0]
            self.bytes = {
                ord(c): spelled.pre_tokenize_str(c)[0][0] for c in [" ", *letters, *_MARKS]
            }
        self._forget()

    def _forget(self) -> None:
        self.known: dict[str, bytes] = {}
        self.held = 0

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after another, where each text ends); null is the empty text."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        if not self.by_words:
            return self._whole(texts.to_pylist())
        odd = pc.match_substring_regex(texts, _LONG_RUN).to_numpy(zero_copy_only=False)
        plain = pc.if_else(pa.array(odd), "", texts) if odd.any() else texts
        lists = pc.split_pattern(plain, " ")
        offsets = lists.offsets.to_numpy()
        offsets = offsets - offsets[0]
        words = lists.flatten().dictionary_encode()
        at = words.indices.to_numpy().astype(np.int64)
        variants = 2 * at + 1
        # A word at the start of a text has no space before it; every text has such a word.
        variants[offsets[:-1]] -= 1
        there = np.zeros(2 * len(words.dictionary), bool)
        there[variants] = True
        used = np.flatnonzero(there)
        place = np.cumsum(there) - 1
        spelled = words.dictionary.take(pa.array(used // 2))
        spaced = pc.binary_join_element_wise(
            pa.array(np.where(used & 1, " ", ""), pa.large_string()), spelled, pa.scalar("", pa.large_string())
        )
        found = self._ids(spaced)
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // self.dtype.itemsize
        starts = np.cumsum(sizes) - sizes
        values = np.frombuffer(b"".join(found), self.dtype)
        rows = place[variants]
        sizes = sizes[rows]
        after = np.cumsum(sizes)
        shift = np.repeat(starts[rows] - (after - sizes), sizes)
        shift += np.arange(len(shift))
        ids, ends = values[shift], np.r_[0, after][offsets[1:]]
        if not odd.any():
            return ids, ends
        pieces = np.split(ids, ends[:-1])
        for i in np.flatnonzero(odd):
            chunks = self._ids(pa.array(_CHUNK.findall(texts[i].as_py()), pa.large_string()))
            pieces[i] = np.frombuffer(b"".join(chunks), self.dtype)
        return np.concatenate(pieces), np.cumsum([len(p) for p in pieces], dtype=np.int64)

    def _whole(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids = [self._library([t])[0] for t in texts]
        return (
            np.concatenate([np.zeros(0, self.dtype), *ids]).astype(self.dtype, copy=False),
            np.cumsum([len(i) for i in ids], dtype=np.int64),
        )

    def _library(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _ids(self, words: pa.Array) -> list[bytes]:
        """The ids of each word; those of new words are found and remembered."""
        if len(self.known) > WORDS_HELD or self.held > BYTES_HELD:
            self._forget()
        listed = _plain(words)
        out = list(map(self.known.get, listed))
        new = [i for i, ids in enumerate(out) if ids is None]
        if new:
            self._learn([listed[i] for i in new], words.take(pa.array(new, pa.int64())))
            for i in new:
                out[i] = self.known[listed[i]]
        return out

    def _learn(self, listed: list[str], words: pa.Array) -> None:
        stems = pc.utf8_rtrim(words, characters=_MARKS)
        simple = _plain(pc.match_substring_regex(stems, f"^ ?[{_LETTERS}]+$"))
        known, others = self.known, []
        for word, stem, cut in zip(listed, _plain(stems), simple, strict=True):
            if not cut:
                others.append(word)
                continue
            ids = known.get(stem) or self._piece(stem)
            if len(stem) < len(word):
                marks = word[len(stem) :]
                known[word] = ids + (known.get(marks) or self._piece(marks))
        for k in range(0, len(others), 4_096):
            some = others[k : k + 4_096]
            for word, ids in zip(some, self._library(some), strict=True):
                known[word] = array(self.code, ids).tobytes()
        self.held += words.nbytes

    def _piece(self, text: str) -> bytes:
        """Ids of one piece, by the tokenizer's model alone."""
        if text.isascii() and text[0] == " ":
            spelled = self.space + text[1:]
        else:
            spelled = text.translate(self.bytes)
        found = self.model.tokenize(spelled)
        self.known[text] = ids = array(self.code, [t.id for t in found]).tobytes()
        return ids
