"""Encoding by the tokenizers library, one call per distinct chunk and worker.

Most chunks hold only ASCII and Latin-1 letters. For these the two public split patterns are spelt out below in plain character
classes, all new chunks of a slice are split by one search, and each distinct piece goes to the library's model by itself, which
leaves out the library's slow alignment of every character. All other chunks, and any tokenizer of another layout, go through the
whole library. Both ways give the same ids.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from tokenizers import Tokenizer

from tidemark.llm.chunks import Chunk, ChunkTable, Codes, Lists, slices

# Latin-1's letters, and the split patterns of the two public layouts over these and ASCII.
_LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
_BYTE_PIECE = re.compile(rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTERS}]+| ?[0-9]+| ?[^\t\n\r {_LETTERS}0-9]+|[\t\n\r ]+(?![^\t\n\r ])|[\t\n\r ]+")
_WORD_PIECE = re.compile(rf"'(?:s|t|re|ve|m|ll|d)|[{_LETTERS}]+|[0-9]|[^ {_LETTERS}0-9]+| ")
_BYTE_PLAIN = re.compile(rf" [!-~{_LETTERS}](?:[\t\n\r -~{_LETTERS}]*[!-~{_LETTERS}])?")
_WORD_PLAIN = re.compile(rf"[!-~{_LETTERS}]+")
_WORD_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
PIECES = 200_000


def read_tokenizer(path: str) -> str:
    """The tokenizer file's text. It is read once by the driver and sent with the task; its size does not depend on the data."""
    with open(path, encoding="utf-8") as f:
        return f.read()


def _byte_lengths(tokenizer: str) -> np.ndarray | None:
    """Bytes per id where tokens spell the text byte by byte: byte-level splitting, no normaliser, no word ends. Else None."""
    spec = json.loads(tokenizer)
    if spec["normalizer"] or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel" or spec["model"].get("end_of_word_suffix"):
        return None
    ids = {**spec["model"]["vocab"], **{a["content"]: a["id"] for a in spec["added_tokens"]}}
    size = np.zeros(max(ids.values()) + 1, np.int64)
    size[list(ids.values())] = list(map(len, ids))
    return size


def _whole(t: Tokenizer, spelt: np.ndarray | None) -> Callable[[list[str]], tuple[np.ndarray, np.ndarray]]:
    """Chunks are given to the library as separate words of one input, so that one call serves many of them.

    Ids fall to their chunks by the bytes they spell where that is exact, else by the library's word numbers.
    """
    def encode(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids, sizes = [np.empty(0, np.int32)], [np.empty(0, np.int64)]
        for at in range(0, len(chunks), 512):
            group = chunks[at:at + 512]
            if spelt is None:
                e = t.encode(group, is_pretokenized=True, add_special_tokens=False)
                ids.append(np.array(e.ids, np.int32))
                sizes.append(np.bincount(np.array(e.word_ids, np.int64), minlength=len(group)))
                continue
            ids.append(np.array(t.encode_batch_fast([group], is_pretokenized=True, add_special_tokens=False)[0].ids, np.int32))
            chunk_ends = np.cumsum([len(c.encode()) for c in group])
            last = np.searchsorted(np.cumsum(spelt[ids[-1]]), chunk_ends, "right")
            sizes.append(np.diff(last, prepend=0))
        return np.concatenate(ids), np.concatenate(sizes)

    return encode


def _byte_signs() -> dict[int, str]:
    """The byte-level alphabet: a printable sign for every byte, further ones from 256 on for the rest."""
    printable = [*range(ord("!"), ord("~") + 1), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {**{b: chr(b) for b in printable}, **{b: chr(256 + i) for i, b in enumerate(rest)}}


def _layout(tokenizer: str) -> str | None:
    """'byte' or 'word' where the file is laid out as one of the two public tokenizers whose split is written out above."""
    spec = json.loads(tokenizer)
    model, pre = spec["model"], spec["pre_tokenizer"] or {}
    if model["type"] != "BPE" or model.get("dropout") or model.get("unk_token") or model.get("continuing_subword_prefix"):
        return None
    if any(not a["content"].startswith("<|") or a["normalized"] or a["lstrip"] or a["rstrip"] or a["single_word"] for a in spec["added_tokens"]):
        return None
    level = {"type": "ByteLevel", "add_prefix_space": False}
    if not spec["normalizer"] and {**level, "use_regex": True}.items() <= pre.items():
        return "byte"
    steps = pre.get("pretokenizers", [])
    norms = (spec["normalizer"] or {}).get("normalizers", [])
    split = {"type": "Split", "pattern": {"Regex": _WORD_SPLIT}, "behavior": "Removed", "invert": True}
    if ([n["type"] for n in norms] == ["NFC", "Replace", "Lowercase"] and norms[1]["content"] == " " and len(steps) == 2
            and split.items() <= steps[0].items() and {**level, "use_regex": False}.items() <= steps[1].items()):
        return "word"
    return None


def chunk_encoder(tokenizer: str) -> Callable[[list[str]], tuple[np.ndarray, np.ndarray]]:
    """encode(chunks) -> (ids of all of them, number of ids of each)."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    t = Tokenizer.from_str(tokenizer)
    whole, layout = _whole(t, _byte_lengths(tokenizer)), _layout(tokenizer)
    if layout is None:
        return whole
    plain, piece = (_BYTE_PLAIN, _BYTE_PIECE) if layout == "byte" else (_WORD_PLAIN, _WORD_PIECE)
    spell, signs = t.model.tokenize, _byte_signs()
    codes, lists = Codes(), Lists()

    def signed(new: list[str]) -> list[str]:
        """The pieces in the byte-level alphabet, all at once; plain chunks hold no zero byte."""
        text = "\0".join(new).encode().decode("latin-1")
        for b, s in signs.items():
            if b and s != chr(b):
                text = text.replace(chr(b), s)
        return text.split("\0") if new else []

    def pieces(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        nonlocal codes, lists
        if len(codes) > PIECES:
            codes, lists = Codes(), Lists()
        joined = "".join(chunks) if layout == "byte" else " ".join(chunks).lower()
        found = piece.findall(joined)
        code = codes.of(found)
        ids, sizes = [], []
        for x, sign in zip(codes.new, signed(codes.new), strict=True):
            tokens = [] if layout == "word" and x == " " else spell(sign)
            ids += [k.id for k in tokens]
            sizes.append(len(tokens))
        lists.add(np.array(ids, np.int32), np.array(sizes, np.int64))
        codes.new = []
        ids, size = lists.take(code)
        ends = np.cumsum([len(c) + (layout == "word") for c in chunks])  # in characters of `joined`
        upto = np.searchsorted(np.cumsum(np.fromiter(map(len, found), np.int64, len(found))), ends, "right")
        if layout == "word":
            upto[-1] = len(found)
        total = np.concatenate([np.zeros(1, np.int64), np.cumsum(size)])
        return ids, np.diff(total[upto], prepend=0)

    def encode(chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        easy = np.fromiter((plain.fullmatch(c) is not None and "<|" not in c for c in chunks), bool, len(chunks))
        if easy.all() and len(chunks):
            return pieces(chunks)
        hard_ids, hard_size = whole([c for c, e in zip(chunks, easy, strict=True) if not e])
        if not easy.any():
            return hard_ids, hard_size
        easy_ids, easy_size = pieces([c for c, e in zip(chunks, easy, strict=True) if e])
        both = Lists()
        both.add(easy_ids, easy_size)
        both.add(hard_ids, hard_size)
        place = np.empty(len(chunks), np.int64)
        place[easy], place[~easy] = np.arange(len(easy_size)), len(easy_size) + np.arange(len(hard_size))
        return both.take(place)

    return encode


_tables: dict[tuple[int, str], ChunkTable] = {}


def _table(tokenizer: str, opener: str) -> ChunkTable:
    """The worker's table for a tokenizer; tasks of one worker share what they have encoded."""
    key = (hash(tokenizer), opener)
    if key not in _tables:
        _tables.clear()
        _tables[key] = ChunkTable(chunk_encoder(tokenizer), opener)
    return _tables[key]


def encoded(texts: Iterator[pd.Series], tokenizer: str, cut: Callable[[str | None], list[Chunk]], opener: str) -> Iterator[tuple[int, list[np.ndarray]]]:
    """(index of the series' row, ids of the rows from there on) for slices of every series; a series ends with (its length, []).

    cut: text to chunks; opener: what a chunk that is a plain string opens with.
    """
    table = _table(tokenizer, opener)
    for series in texts:
        for a, b in slices(series):
            yield a, table.ids_of(series.iloc[a:b], cut)
        yield len(series), []
