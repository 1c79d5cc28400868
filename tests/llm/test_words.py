import re

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from marquee.llm.words import LONG_WORD, shingles, words_of

WORD = re.compile("[^\x20\x09-\x0d]+")


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text)


def cut(texts, **how):
    out = []
    for words in words_of(pa.array(texts, pa.string()), **how):
        for i in range(len(words)):
            spans = zip(words.starts, words.ends, strict=True)
            own = list(spans)[words.ptr[i] : words.ptr[i + 1]]
            out.append(([words.data[a:b].tobytes().decode() for a, b in own], words.hashes[words.ptr[i] : words.ptr[i + 1]]))
    return out


@settings(deadline=None)
@given(st.lists(st.text(alphabet="aB é\t\n\x0b \U0001f600x", max_size=30), min_size=1, max_size=6), st.integers(1, 50))
def test_words_and_equal_hashes(texts, size):
    got = cut(texts, chunk_bytes=size)
    assert [g[0] for g in got] == [WORD.findall(t) for t in texts]
    seen = {}
    for text, (_, hashes) in zip(texts, got, strict=True):
        for word, value in zip(WORD.findall(lowered(text)), hashes, strict=True):
            assert seen.setdefault(word, value) == value
    assert len(set(seen.values())) == len(seen)


def test_null_empty_and_long_texts():
    long = "x" * (3 * LONG_WORD)
    got = cut([None, "", long + " " + long + "y", "a " * 5000, long])
    assert [len(g[0]) for g in got] == [0, 0, 2, 5000, 1]
    assert got[2][1][0] == got[4][1][0] != got[2][1][1]
    assert list(words_of(pa.array([], pa.string()))) == []
    assert [g[0] for g in cut([None, None])] == [[], []]


@pytest.mark.parametrize("count,width,runs", [(0, 3, 0), (1, 3, 1), (2, 3, 1), (3, 3, 1), (5, 3, 3)])
def test_shingles(count, width, runs):
    assert len(shingles(np.arange(count, dtype=np.uint64), width)) == runs
