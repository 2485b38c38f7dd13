"""Keyword gate of the license scan against its rules."""

import re

import pytest

from tidemark.llm import licenses

SENTENCES = [s for group in licenses.SENTENCES.values() for s in group]


@pytest.mark.parametrize("text", [*SENTENCES, *licenses.BASE])
def test_every_sentence_passes_the_gate(text):
    assert any(g in text for g in licenses.GATE) or re.search(licenses.GATE_CC, text)
