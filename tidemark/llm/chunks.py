"""Texts as sequences of chunks that a tokenizer treats independently, each distinct chunk encoded once per worker.

Cut at single spaces between two characters that are not white space: the public split pattern never matches across such a place
except for the space itself, which opens the next chunk. Ids of a text are then gathered from a flat table by numpy.

A chunk is written as its string; one that opens with such a space is written without it, any other chunk as a one-element tuple.
Where every space of a text is such a place, Arrow cuts it and numbers the distinct strings of the whole slice, so that Python only
sees each string once a slice.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

Chunk = str | tuple[str]
# White space as str.isspace() knows it, in the syntax of Arrow's patterns.
_WHITE = r"[\s\x0b\x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_LOOSE_SPACE = f"(?:^|{_WHITE}) | (?:$|{_WHITE})"


class Codes(dict):
    """key -> number; new keys are listed in `new`."""

    def __init__(self) -> None:
        self.new: list = []

    def of(self, keys: list, distinct: bool = False) -> np.ndarray:
        """Numbers of the keys; distinct: no key stands twice."""
        code = np.fromiter(map(self.get, keys, repeat(-1)), np.int64, len(keys))
        at = np.flatnonzero(code < 0)
        missing = [keys[i] for i in at.tolist()]
        new = missing if distinct else list(dict.fromkeys(missing))
        numbers = range(len(self), len(self) + len(new))
        self.update(zip(new, numbers, strict=True))
        self.new += new
        code[at] = numbers if len(new) == len(missing) else np.fromiter(map(self.__getitem__, missing), np.int64, len(missing))
        return code


def ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ... (size[0] of them), start[1], ..."""
    ends = np.cumsum(size)
    return np.repeat(start - (ends - size), size) + np.arange(ends[-1] if len(ends) else 0)


class Lists:
    """Numbered lists of ids in one flat array."""

    def __init__(self) -> None:
        self.flat, self.used = np.empty(1 << 16, np.int32), 0
        self.start, self.size, self.n = np.zeros(1 << 12, np.int64), np.zeros(1 << 12, np.int64), 0

    def add(self, ids: np.ndarray, sizes: np.ndarray) -> None:
        end = self.n + len(sizes)
        while self.used + len(ids) > len(self.flat):
            self.flat = np.concatenate([self.flat, np.empty_like(self.flat)])
        while end > len(self.size):
            self.start = np.concatenate([self.start, np.zeros_like(self.start)])
            self.size = np.concatenate([self.size, np.zeros_like(self.size)])
        self.start[self.n:end] = self.used + np.cumsum(sizes) - sizes
        self.size[self.n:end] = sizes
        self.flat[self.used:self.used + len(ids)] = ids
        self.used, self.n = self.used + len(ids), end

    def take(self, code: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the numbered lists one after another, the size of each)."""
        size = self.size[code]
        return self.flat[ranges(self.start[code], size)], size


class ChunkTable:
    """Remembers the ids of chunks. encode(list of texts) -> (ids of all of them, number of ids of each).

    opener: what the first kind of chunk opens with. Emptied when it holds `limit` chunks.
    """

    def __init__(self, encode: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], opener: str = " ", limit: int = 400_000) -> None:
        self.encode, self.opener, self.limit = encode, opener, limit
        self.codes, self.lists = Codes(), Lists()

    def _room(self) -> None:
        if len(self.codes) > self.limit:
            self.codes, self.lists = Codes(), Lists()

    def _gather(self, code: np.ndarray, chunks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if self.codes.new:
            self.lists.add(*self.encode([self.opener + c if isinstance(c, str) else c[0] for c in self.codes.new]))
            self.codes.new = []
        flat, size = self.lists.take(code)
        ends = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])
        return flat, ends[np.concatenate([np.zeros(1, np.int64), np.cumsum(chunks)])]

    def gather(self, texts: list[list[Chunk]]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, where each text begins and the last ends); texts are chunk lists."""
        self._room()
        code = np.concatenate([self.codes.of(t) for t in texts]) if texts else np.empty(0, np.int64)
        return self._gather(code, np.array([*map(len, texts)], np.int64))

    def ids(self, texts: list[list[Chunk]]) -> list[np.ndarray]:
        flat, cut = self.gather(texts)
        return [flat[a:b] for a, b in zip(cut[:-1], cut[1:], strict=True)]

    def ids_of(self, texts: Iterable[str | None], cut: Callable[[str | None], list[Chunk]]) -> list[np.ndarray]:
        """Ids of whole texts; the same as ids() of their chunks."""
        a = pc.fill_null(pa.array(texts, pa.large_string(), from_pandas=True), "")
        if not len(a):
            return []
        self._room()
        if cut is spaceless_chunks:
            loose = np.zeros(len(a), bool)
            parts = pc.split_pattern(pc.replace_substring(a, "\n", " "), " ")
        else:
            loose = pc.match_substring_regex(a, _LOOSE_SPACE).to_numpy(zero_copy_only=False)
            parts = pc.split_pattern(a.filter(pa.array(~loose)), " ")
        offset = parts.offsets.to_numpy().astype(np.int64)
        words = parts.flatten().dictionary_encode()
        index, known = words.indices.to_numpy(), words.dictionary.to_numpy(zero_copy_only=False).tolist()
        code = self.codes.of(known, distinct=True)[index] if known else np.empty(0, np.int64)
        if cut is not spaceless_chunks and len(offset) > 1:
            code[offset[:-1]] = self.codes.of([(known[i],) for i in index[offset[:-1]]])
        if not loose.any():
            flat, at = self._gather(code, np.diff(offset))
        else:
            lists = [cut(t) for t in a.filter(pa.array(loose)).to_pylist()]
            start, size = np.empty(len(a), np.int64), np.empty(len(a), np.int64)
            start[~loose], size[~loose] = offset[:-1], np.diff(offset)
            size[loose] = [*map(len, lists)]
            start[loose] = len(code) + np.cumsum(size[loose]) - size[loose]
            code = np.concatenate([code, *(self.codes.of(x) for x in lists)])
            flat, at = self._gather(code[ranges(start, size)], size)
        return [flat[i:j] for i, j in zip(at[:-1], at[1:], strict=True)]


def spaced_chunks(text: str | None) -> list[Chunk]:
    """Chunks of a text, cut before every single space between two other characters; joined they are the text."""
    if not text:
        return []
    parts = text.split(" ")
    words = text.split()
    if len(text) - sum(map(len, words)) == len(words) - 1:  # white space only ever stands alone and between words
        parts[0] = (parts[0],)
        return parts
    out, last, opened = [], parts[0], False
    open_end = not last or last[-1].isspace()
    for x in parts[1:]:
        if open_end or not x or x[0].isspace():
            last += " " + x
        else:
            out.append(last if opened else (last,))
            last, opened = x, True
        open_end = not x or x[-1].isspace()
    out.append(last if opened else (last,))
    return out


def spaceless_chunks(text: str | None) -> list[Chunk]:
    """Pieces between spaces and line feeds, for tokenizers that drop white space."""
    parts = text.replace("\n", " ").split(" ") if text else []
    return [x for x in parts if x] if "" in parts else parts


def slices(texts, chars: int = 4_000_000):
    """Index ranges of a series of texts with about `chars` characters each, so that memory follows text, not row counts."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t) if t else 0
        if size >= chars:
            yield at, i + 1
            at, size = i + 1, 0
    if at < len(texts):
        yield at, len(texts)
