"""The quick way through the encoder against the whole library, on every kind of chunk it takes or leaves."""

from __future__ import annotations

import random

import pandas as pd
import public_tokenizers
import pytest

from tidemark.llm.chunks import spaced_chunks, spaceless_chunks
from tidemark.llm.library import chunk_encoder, encoded, read_tokenizer

KINDS = [("byte_bpe_50k.json", spaced_chunks, " "), ("word_bpe_49k.json", spaceless_chunks, "")]


def texts() -> list[str | None]:
    rnd = random.Random(8)
    parts = ["word", "Été", "ÀÖØÿ", "ª", "µ", "é", "'s", "'LL", "it's", "12", "3a", "--", "%%%", ".", "\n", "\r\n", "\t", " ", "  ", "\x0b", "\x1c", "\x85", "\xa0", " ", "　",
             "汉字", "ŉ", "İ", "ſ", "<|endoftext|>", "<|", "|>", "\x00", "\x7f", "ß", "ÿ", "×", "÷", "_", "é", "😀"]
    out = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12))) for _ in range(600)]
    out += [" ".join(rnd.choice(parts) for _ in range(rnd.randint(0, 12))) for _ in range(600)]
    out += ["".join(chr(c) for c in range(a, a + 64)) for a in range(0, 0x250, 64)]
    out += [f"a{chr(c)}b {chr(c)} c{chr(c)}" for c in range(0x180)]
    return [None, "", *out]


@pytest.mark.parametrize(("name", "cut", "opener"), KINDS)
def test_ids_of_every_kind_of_text(name, cut, opener):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(public_tokenizers.path(name))
    got = [r.tolist() for _, rows in encoded(iter([pd.Series(texts(), dtype=object)]), read_tokenizer(public_tokenizers.path(name)), cut, opener) for r in rows]
    want = [t.encode(x or "", add_special_tokens=False).ids for x in texts()]
    assert [(x, g) for x, g in zip(texts(), got, strict=True)] == [(x, w) for x, w in zip(texts(), want, strict=True)]


@pytest.mark.parametrize(("name", "cut", "opener"), KINDS)
def test_other_layouts_go_through_the_library(name, cut, opener):
    plain, other = read_tokenizer(public_tokenizers.path(name)), read_tokenizer(public_tokenizers.path(name)).replace('"special": true', '"special": false', 1).replace('"lstrip": false', '"lstrip": true', 1)
    chunks = [opener + x for x in ("word", "two.\nLines", "it's", "naïve,", "7up")] if opener else ["word", "it's", "naïve,", "7up"]
    for a, b in zip(chunk_encoder(plain)(chunks), chunk_encoder(other)(chunks), strict=True):
        assert a.tolist() == b.tolist()
