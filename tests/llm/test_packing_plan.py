"""The packing plan: prices, configurations and the choice among numbers of groups."""

from bisect import bisect_left, insort
from collections import Counter
from itertools import combinations_with_replacement

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from raillark.llm import packing


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(8, 40), st.floats(-0.2, 1), min_size=1, max_size=5))
def test_dearest_is_the_best_multiset(prices):
    sizes = sorted(prices, reverse=True)
    times, worth = packing.dearest(sizes, np.array([prices[s] for s in sizes]), 40)
    sets = [c for k in range(6) for c in combinations_with_replacement(sizes, k) if sum(c) <= 40]
    assert worth == pytest.approx(max(sum(prices[s] for s in c) for c in sets))
    assert sum(s * k for s, k in zip(sizes, times)) <= 40
    assert worth == pytest.approx(sum(prices[s] * k for s, k in zip(sizes, times)))


def test_configurations_reach_a_known_optimum():
    # 40 + 35 + 25 and 60 + 25 + 15 fill a sequence; taking the fullest at each step can strand the 35s
    stock = {60: 1000, 40: 500, 35: 500, 25: 1500, 15: 1000}
    found = packing.configurations(stock, 100)
    held = Counter()
    for config, times in found:
        assert sum(s * k for s, k in config.items()) <= 100
        for s, k in config.items():
            held[s] += k * times
    assert all(held[s] <= c for s, c in stock.items())
    left = sum(s * (c - held[s]) for s, c in stock.items())
    assert sum(t for _, t in found) + left / 100 <= 1500 + 1e-9 and left <= 100 * len(stock)


@pytest.mark.parametrize("scale", [1, 10**9])
def test_plan_is_near_the_bound(scale):
    rng = np.random.default_rng(3)
    counts = Counter(np.clip(rng.lognormal(6.2, 1.1, 20_000).astype(int), 1, 4096).tolist())
    counts = {n: c * scale for n, c in counts.items()}
    plan = packing.best_plan(counts, 4096)
    placed = Counter()
    for times, used, lengths in plan.bins:
        assert used == sum(lengths) <= 4096
        for n in lengths:
            placed[n] += times
    assert placed == counts
    assert plan.sequences <= 1.002 * sum(n * c for n, c in counts.items()) / 4096 + 1


def test_plan_of_no_lengths():
    assert packing.best_plan({}, 4096).tables() == {}


@pytest.mark.parametrize("lo, hi", [(1600, 1800), (1300, 1500), (1300, 2100), (900, 1500)])
def test_never_more_sequences_than_best_fit(lo, hi):
    lengths = np.random.default_rng(lo + hi).integers(lo, hi, 20_000)
    counts = {int(n): int(c) for n, c in zip(*np.unique(lengths, return_counts=True), strict=True)}
    rooms: list[int] = []
    opened = 0
    for n in sorted(lengths.tolist(), reverse=True):
        at = bisect_left(rooms, n)
        if at == len(rooms):
            opened += 1
            insort(rooms, 4096 - n)
        else:
            insort(rooms, rooms.pop(at) - n)
    assert packing.best_plan(counts, 4096).sequences <= opened
