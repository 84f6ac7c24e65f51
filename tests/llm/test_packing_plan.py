"""The packing plan on histograms where best-fit decreasing is far off."""

import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sigflow.llm import packing


def sequences(counts, capacity=1024):
    plan = packing.plan_sequences(counts, capacity)
    held = Counter()
    for filling, times in plan:
        assert sum(filling) <= capacity
        for n in filling:
            held[n] += times
    assert held == Counter(counts)
    return sum(times for _, times in plan)


def test_hot_lengths_of_a_third():
    counts = {n: 300 for n in range(300, 401)}
    # 300..382 in triples and 383..400 in pairs need 11,000.
    _, prices = packing.round_relaxed(counts, 1024, packing.best_fit_decreasing(counts, 1024), [packing.PIVOTS])
    assert prices.bound(counts) <= sequences(counts) <= min(11_000, prices.bound(counts) + 1)


def test_one_hot_length_among_others():
    r = random.Random(3)
    counts = Counter(r.randint(250, 420) for _ in range(5_000)) + Counter({341: 20_000})
    _, prices = packing.round_relaxed(counts, 1024, packing.best_fit_decreasing(counts, 1024), [packing.PIVOTS])
    assert max(prices.bound(counts), packing.lower_bound(counts, 1024)) <= sequences(counts) <= prices.bound(counts) + 1


@pytest.mark.parametrize("seed", range(6))
def test_prices_give_a_bound(seed):
    r = random.Random(seed)
    counts = Counter(r.randint(5, 20) for _ in range(40))
    prices = packing.relaxed(counts, 20, [3], 1 << 30)[1]
    assert max(packing.lower_bound(counts, 20), prices.bound(counts)) <= sequences(counts, 20)


def test_no_filling_is_left_out():
    counts = {n: 2 for n in range(1, 9)}
    found = packing.fillings(counts, 12, 10_000, [10_000])
    assert len(found) > 16 and len(set(found)) == len(found)


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 5), max_size=12), st.sampled_from(packing.WASTES))
def test_descent_places_every_piece_once(counts, waste):
    plan = packing.descend(counts, 40, waste)
    placed = Counter()
    for filling, times in plan:
        assert sum(filling) <= 40
        assert times > 0
        for n in filling:
            placed[n] += times
    assert placed == Counter(counts)


def test_descent_keeps_short_pieces_for_later():
    """The bin of 70 takes 28 and wastes 2, not 15 and 15: those complete the bins of 60."""
    counts = {70: 1, 60: 3, 28: 1, 25: 3, 15: 3}
    assert packing.sequences(packing.descend(counts, 100, 2)) == 4
    assert packing.sequences(packing.descend(counts, 100, 0)) == 5
