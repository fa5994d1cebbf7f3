import random

import numpy as np
import pyarrow as pa
import pytest
from cases import shingles, words

from trendloom.llm import hashing as h

TEXTS = ["A b  c d e f", "", None, " x", "hello World\n", "é ü ", "a B c d e f a b c d e",
         "\x0b\x0c", "end\x1fone", "z" * 70_000 + " tail"]


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
def test_words_and_shingles(kind):
    column = pa.array(["skipped"] + TEXTS, kind).slice(1)
    data, offsets = h.text_bytes(column)
    _, bounds = h.word_hashes(data[offsets[0]:offsets[-1]], offsets - offsets[0])
    assert np.diff(bounds).tolist() == [len(words(t)) for t in TEXTS]
    for row, found in h.batch_shingles(column, 5):
        assert len(np.unique(found)) == len(shingles(TEXTS[row]))


def test_equal_words_have_equal_hashes():
    column = pa.array(["One two THREE", "zz one  TWO three", "two one three"])
    found = dict(h.batch_shingles(column, 1))
    assert found[0].tolist() == found[1].tolist()[1:] == [found[2][1], found[2][0], found[2][2]]


def test_slabs_do_not_change_results():
    rng = random.Random(1)
    texts = [" ".join(rng.choices("abcdefg", k=rng.randrange(30))) for _ in range(200)]
    data, offsets = h.text_bytes(pa.array(texts))
    whole, bounds = h.shingle_hashes(*h.word_hashes(data, offsets), 5)
    parts = [h.shingle_hashes(*h.word_hashes(part, inner), 5)[0]
             for _, _, part, inner in h.slabs(data, offsets, 50)]
    assert np.array_equal(np.concatenate(parts), whole)
    assert np.diff(bounds).tolist() == [
        max(len(words(t)) - 4, min(1, len(words(t)))) for t in texts]
