from __future__ import annotations

import random

import numpy as np
import pyarrow as pa
import pytest
from text_cases import words

from clickloom.llm import common

LETTERS = "ab C\n\t é中 9.X\x0b\U0001f600"


@pytest.fixture(params=[5, 64])
def pieces(request, monkeypatch):
    """Helpers that take so many bytes at a time."""
    monkeypatch.setattr(common, "PIECE_BYTES", request.param)
    common._power_tables.cache_clear()
    yield
    common._power_tables.cache_clear()


def random_texts(seed):
    rng = random.Random(seed)
    for _ in range(150):
        yield [
            "".join(rng.choices(LETTERS, k=rng.randint(0, 90))) if rng.random() > 0.1 else None
            for _ in range(rng.randint(1, 6))
        ]


def test_words_of_any_piece_size(pieces):
    hashes = {}
    for texts in random_texts(1):
        found = common.words_of(pa.array(texts, pa.string()), stems=(2,))
        spans = [found.data[a:b].tobytes().decode() for a, b in zip(found.start, found.end)]
        assert spans == [w for t in texts for w in words(t)]
        assert found.count.tolist() == [len(words(t)) for t in texts]
        for word, number in zip(spans, found.hash.tolist()):
            assert hashes.setdefault(word, number) == number
        if all(word.isascii() for word in spans):
            stems = common.words_of(pa.array([" ".join(word[:2] for word in spans)]))
            assert np.array_equal(stems.hash, found.stems[0])
    assert len(set(hashes.values())) == len(hashes)


def test_lines_of_any_piece_size(pieces):
    blank = " \t\n\v\f\r"
    hashes = {}
    for texts in random_texts(2):
        found = common.lines_of(pa.array(texts, pa.string()))
        lines = [line for t in texts for line in (t or "").split("\n")]
        keys = [line.strip(blank) for line in lines]
        assert found.length.tolist() == [len(k) for k in keys]
        assert found.count.tolist() == [(t or "").count("\n") + 1 for t in texts]
        for key, *numbers in zip(keys, found.hash.tolist(), found.second.tolist()):
            key = "".join(c.lower() if c.isascii() else c for c in key)
            assert hashes.setdefault(key, numbers) == numbers
    assert len({tuple(n) for n in hashes.values()}) == len(hashes)


def test_a_hash_does_not_depend_on_the_piece_size(monkeypatch):
    texts = pa.array([t for texts in random_texts(3) for t in texts], pa.string())
    want = common.words_of(texts).hash, common.lines_of(texts).hash
    monkeypatch.setattr(common, "PIECE_BYTES", 11)
    common._power_tables.cache_clear()
    assert all(np.array_equal(a, b) for a, b in zip(want, (common.words_of(texts).hash, common.lines_of(texts).hash)))
    common._power_tables.cache_clear()
