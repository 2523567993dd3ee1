import random

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from minutelake.llm.words import Words, slices

from . import helpers

TEXT = st.one_of(st.none(), st.text(alphabet="ab \n\t\x0b\x1c é漢", max_size=60))


@settings(max_examples=150, deadline=None)
@given(st.lists(TEXT, min_size=1, max_size=8), st.integers(1, 5))
def test_words_and_shingles_are_those_of_the_pattern(texts, n):
    coded = [None if x is None else x.encode() for x in texts]
    w = Words(coded)
    assert w.count.tolist() == [len(helpers.words_of(x)) for x in texts]
    hashes, at, seen = w.hashes().tolist(), 0, {}
    for x in texts:
        for word in helpers.words_of(x):
            assert seen.setdefault(word, hashes[at]) == hashes[at]
            at += 1
    assert len(set(seen.values())) == len(seen)
    for found, x in zip(w.shingles(n), texts, strict=True):
        kept = {tuple(y) for y in helpers.shingles(x, n)} if (x or "").islower() or not x else None
        assert len(found) == len(np.unique(found))
        if kept is not None:
            assert len(found) == len(kept)


def test_slices_cover_all_rows():
    rng = random.Random(3)
    texts = [None if rng.random() < 0.1 else b"x" * rng.choice([0, 5, 400_000, 3_000_000]) for _ in range(60)]
    found = list(slices(texts))
    assert [a for a, _ in found] == [0, *[b for _, b in found[:-1]]] and found[-1][1] == len(texts)
    assert list(slices([])) == []
