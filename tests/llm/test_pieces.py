"""Pieces of texts: what tells them apart, and the memory that this takes."""

import tracemalloc

import numpy as np

from barlight.llm.pieces import HEAD, Pieces


def some_pieces(n, rng):
    head = np.zeros(n, HEAD)
    head["windows"] = rng.integers(1, 20, n)
    units = head["windows"].astype(np.int64) + 34
    return Pieces(head, rng.integers(0, 256, int(units.sum()) * 5).astype(np.uint8), 35, 5)


def test_pieces_are_told_apart_in_little_memory():
    rng = np.random.default_rng(1)
    one = some_pieces(20_000, rng)
    twice = one.take(np.r_[np.arange(20_000), np.arange(20_000)])
    tracemalloc.start()
    got = twice.different()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.tolist() == list(range(20_000))
    assert peak < 4 * len(twice.body)
