"""Flat text arrays against plain Python."""

import random

import numpy as np
import pyarrow as pa

from pitchlake.llm import arrays


def test_words_are_never_cut_and_never_cross_texts(monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab \n\té") for _ in range(rng.randint(0, 60))) for _ in range(80)] + [None, "", "x" * 300]
    data, offsets = arrays.flat(pa.array(texts, pa.string()))
    for limit in (7, 64, 1 << 20):
        found = []
        for lo, hi in arrays.slices(data, offsets, limit):
            a, b = arrays.words(data, offsets, lo, hi)
            found += [bytes(data[s:e]) for s, e in zip(a, b)]
        assert found == [w for t in texts for w in (t or "").encode().split()]


def test_sliced_arrays_and_equal_hashes():
    column = pa.array(["zz", "a b a", None, "B a"]).slice(1)
    hashes, offsets = arrays.word_hashes(*arrays.flat(column))
    assert offsets.tolist() == [0, 3, 3, 5]
    assert hashes[0] == hashes[2] == hashes[4] and hashes[1] == hashes[3] != hashes[0]
    shingles, at = arrays.shingle_hashes(hashes, offsets, 2)
    assert at.tolist() == [0, 1, 3] and shingles[1] == shingles[2] != shingles[0]


def test_no_text():
    hashes, offsets = arrays.word_hashes(*arrays.flat(pa.array([], pa.string())))
    assert len(hashes) == 0 and offsets.tolist() == [0]
    assert np.array_equal(arrays.shingle_hashes(hashes, offsets, 3)[1], [])
