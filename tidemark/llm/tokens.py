"""Token ids of whole texts by a public tokenizer, encoding each distinct word once."""

from __future__ import annotations

import gc
import os

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words kept between batches unless a caller says otherwise; beyond that those seen in one
#: batch only are dropped.
CACHED_WORDS = 800_000
#: Words that one call of the tokenizer encodes as a text of their own.
_RUN = 1000

#: A text with any of these is encoded whole: white space other than single
#: inner spaces and line feeds, or one of the marks below.
_ODD = (
    "[\\x00\\x01\\t\\r\\v\\f\\x1c-\\x1f\\x{85}\\x{a0}\\x{1680}\\x{2000}-\\x{200a}"
    "\\x{2028}\\x{2029}\\x{202f}\\x{205f}\\x{3000}]|[ \\n][ \\n]|\\A[ \\n]|[ \\n]\\z"
)

#: A full stop or comma between a letter and a space is a token of its own.
_STOP = "([\\pL\\pN])([.,]) "


class Encoder:
    """Encodes texts exactly as ``Tokenizer.encode(text, add_special_tokens=False)`` does.

    Both families of files split text before a white-space run, so a text whose
    words are divided by single spaces and line feeds is encoded word by word,
    each distinct word once.  Any other text goes to the tokenizer whole.
    ``spaced`` says that a word's leading space belongs to its tokens; ``cached``
    is the number of words kept between batches.
    """

    def __init__(self, path: str, spaced: bool, cached: int = CACHED_WORDS) -> None:
        self.cached = cached
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        self.spaced = spaced
        # tokens that begin a spaced word, or end a word of letters
        names = self.tokenizer.get_vocab(with_added_tokens=False)
        self.edges = np.zeros(max(names.values(), default=0) + 1, dtype=bool)
        for name, i in names.items():
            self.edges[i] = name.startswith("\u0120") if spaced else name.endswith("</w>")
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.ids = np.zeros(1 << 16, dtype=np.uint32)
        self.bounds = np.zeros(1 << 16, dtype=np.int64)
        self.used = np.zeros(1 << 16, dtype=np.uint8)

    def _thin(self) -> None:
        """Keep the words of more than one batch, or none if they are still too many."""
        kept = [(w, i) for w, i in self.place.items() if self.used[i] > 1]
        if 2 * len(kept) > self.cached:
            self._forget()
            return
        at = np.array([i for _, i in kept], dtype=np.int64)
        low, size = self.bounds[at], self.bounds[at + 1] - self.bounds[at]
        end = np.cumsum(size)
        total = int(end[-1]) if len(end) else 0
        ids = self.ids[np.arange(total) + np.repeat(low - (end - size), size)]
        self._forget()
        self._append([w for w, _ in kept], ids, size)

    def _append(self, words: list[str], ids: np.ndarray, size: np.ndarray) -> None:
        n, m = len(self.place), len(words)
        while len(self.bounds) < n + m + 1:
            self.bounds = np.concatenate((self.bounds, np.zeros_like(self.bounds)))
            self.used = np.concatenate((self.used, np.zeros_like(self.used)))
        low = self.bounds[n]
        while len(self.ids) < low + len(ids):
            self.ids = np.concatenate((self.ids, np.zeros_like(self.ids)))
        self.ids[low : low + len(ids)] = ids
        self.bounds[n + 1 : n + 1 + m] = low + np.cumsum(size)
        self.place.update(zip(words, range(n, n + m), strict=True))

    def whole(self, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _text(self, word: str) -> str:
        """NUL marks a first word, \\1 a full stop or comma; a line's first word begins with it."""
        if not self.spaced:
            return word
        return word[1:] if word[0] < "\2" else word if word[0] == "\n" else " " + word

    def _learn(self, words: list[str]) -> None:
        """Encode words in runs of letters, or one by one where ends cannot be told."""
        runs = [w for w in words if w.isalpha()]
        rest = [w for w in words if not w.isalpha()]
        gc.disable()  # hundreds of thousands of small objects, none of them in cycles
        lead = " " if self.spaced else ""
        for at in range(0, len(runs), 20 * _RUN):
            part = runs[at : at + 20 * _RUN]
            texts = [lead + " ".join(part[i : i + _RUN]) for i in range(0, len(part), _RUN)]
            ids = np.concatenate([np.array(x, dtype=np.uint32) for x in self.whole(texts)])
            edge = np.flatnonzero(self.edges[ids])
            ends = np.append(edge[1:], len(ids)) if self.spaced else edge + 1
            if len(ends) == len(part):
                self._append(part, ids, np.diff(ends, prepend=0))
            else:
                rest += part
        for at in range(0, len(rest), 10_000):
            part = rest[at : at + 10_000]
            found = self.whole([self._text(w) for w in part])
            size = np.fromiter(map(len, found), dtype=np.int64, count=len(found))
            ids = np.fromiter((i for x in found for i in x), dtype=np.uint32, count=int(size.sum()))
            self._append(part, ids, size)
        gc.enable()

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """``(ids, bounds)``: the ids of text ``i`` are ``ids[bounds[i]:bounds[i + 1]]``."""
        texts = pc.fill_null(texts, "")
        odd = pc.match_substring_regex(texts, _ODD).to_numpy(zero_copy_only=False)
        plain = texts if not odd.any() else pc.if_else(pa.array(odd), "", texts)
        if self.spaced:
            plain = pc.binary_join_element_wise("\0", pc.replace_substring(plain, "\n", " \n"), "")
            plain = pc.replace_substring_regex(plain, _STOP, "\\1 \1\\2 ")
        else:
            plain = pc.replace_substring(plain, "\n", " ")
            plain = pc.replace_substring_regex(plain, _STOP, "\\1 \\2 ")
        lists = pc.split_pattern(plain, " ")
        count = pc.list_value_length(lists).to_numpy(zero_copy_only=False).astype(np.int64)
        words = lists.flatten().dictionary_encode()
        distinct = words.dictionary.to_pylist()
        nothing = "\0" if self.spaced else ""  # the word of an empty text
        known = self.place.get
        at = np.fromiter((known(w, -1) for w in distinct), dtype=np.int64, count=len(distinct))
        fresh = [distinct[i] for i in np.flatnonzero(at < 0) if distinct[i] != nothing]
        if fresh:
            self._learn(fresh)
            known = self.place.get
            for i in np.flatnonzero(at < 0):
                at[i] = known(distinct[i], -1)
        seen = at[at >= 0]
        self.used[seen] = np.minimum(self.used[seen], 254) + 1
        low = np.where(at >= 0, self.bounds[at], 0)
        long = np.where(at >= 0, self.bounds[at + 1] - low, 0)
        place = words.indices.to_numpy(zero_copy_only=False)
        size = long[place]
        end = np.cumsum(size)
        total = int(end[-1]) if len(end) else 0
        ids = self.ids[np.arange(total) + np.repeat(low[place] - (end - size), size)]
        bounds = np.concatenate(([0], end))[np.concatenate(([0], np.cumsum(count)))]
        if len(self.place) > self.cached:
            self._thin()
        if not odd.any():
            return ids, bounds
        at_odd = np.flatnonzero(odd)
        whole = iter(self.whole(texts.take(pa.array(at_odd)).to_pylist()))
        parts = [
            np.array(next(whole), dtype=np.uint32) if o else ids[bounds[i] : bounds[i + 1]]
            for i, o in enumerate(odd)
        ]
        sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
        return np.concatenate(parts), np.concatenate(([0], np.cumsum(sizes)))


_ENCODERS: dict[tuple[str, bool, int], Encoder] = {}


def encoder(path: str, spaced: bool, cached: int = CACHED_WORDS) -> Encoder:
    """The encoder of this Python worker."""
    if (path, spaced, cached) not in _ENCODERS:
        _ENCODERS[path, spaced, cached] = Encoder(path, spaced, cached)
    return _ENCODERS[path, spaced, cached]
