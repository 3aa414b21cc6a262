"""Helpers of the operator tests: words and shingles by plain Python."""

import re

import pytest

_WORD = re.compile("[^\x20\x09-\x0d]+")


def plain_words(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return _WORD.findall(low)


def plain_shingles(text, width):
    w = plain_words(text)
    if len(w) < width:
        return {tuple(w)} if w else set()
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)}


@pytest.fixture()
def shingles_of():
    return plain_shingles


@pytest.fixture()
def words_of():
    return plain_words
