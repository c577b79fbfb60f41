"""Names of a shard's words come to their places by a table where they are ids, by search elsewhere."""

from __future__ import annotations

import numpy as np

from runsight.llm.lm import START, _places, name_of


def test_places_are_those_of_a_search():
    rare = [name_of(w) for w in (b"alpha", b"beta", b"gamma")]
    for dense, names in ((1, [0]), (5, [START, 0, 3, 4, *rare]), (9, [2, 8]), (4, [START]), (3, rare), (2, [START, *rare[:1]])):
        every = np.unique(np.array(names, np.int64))
        x = np.random.default_rng(0).choice(every, 50)
        assert np.array_equal(_places(every, dense)(x), np.searchsorted(every, x))
    assert len(_places(np.array([0, 1]), 3)(np.zeros(0, np.int64))) == 0
