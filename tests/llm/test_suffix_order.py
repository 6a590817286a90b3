"""Windows of op4 against a plain dictionary, and the rounds that their boundaries take."""

from __future__ import annotations

import numpy as np
import pytest

from tidemark.llm import suffixes


def pieces_of(rng, length):
    base = rng.integers(0, int(rng.choice([1, 2, 256])), 4 * length).astype(np.uint8)
    cuts = [(int(rng.integers(0, 2 * length)), int(rng.integers(0, 3 * length))) for _ in range(8)]
    return [base[a : a + n] for a, n in cuts]


@pytest.mark.parametrize("length", [1, 3, 4, 7, 8, 17, 50, 65])
def test_equal_windows_share_a_group(length):
    rng = np.random.default_rng(length)
    for _ in range(20):
        pieces = pieces_of(rng, length)
        sizes = np.array([len(p) for p in pieces])
        end = np.cumsum(sizes)
        group, doc, place, name = suffixes._windows(length)(np.concatenate(pieces), end - sizes, end, np.arange(8), np.zeros(8, np.int64), True)
        want: dict[bytes, list] = {}
        for i, piece in enumerate(pieces):
            for j in range(len(piece) - length + 1):
                want.setdefault(piece[j : j + length].tobytes(), []).append((i, j))
        found: dict[int, list] = {}
        for g, d, at in zip(group, doc, place):
            found.setdefault(int(g), []).append((int(d), int(at)))
        assert sorted(map(sorted, found.values())) == sorted(map(sorted, want.values())) and len(name) == len(want)


def test_boundaries_begin_at_the_prefix_that_the_order_knows():
    rng = np.random.default_rng(0)
    symbols = np.tile(rng.integers(1, 3, 90), 3).astype(np.uint16)
    symbols[[100, 200, -1]] = 0
    order, known, at = suffixes._suffix_array(symbols, 50)
    assert 25 <= at < 50  # so at most half of the rounds are left
    begun = suffixes.common_prefixes(symbols, order, 50, known, at)
    prefix = [tuple(symbols[i : i + 50]) for i in order]
    inside = [0 not in p and len(p) == 50 for p in prefix]
    assert all(b == (p != q) for b, p, q, i in zip(begun[1:], prefix[1:], prefix, inside[1:]) if i)
