"""Best fit where the attention capacity binds before the tokens do."""

from __future__ import annotations

import numpy as np
import pytest

from duepulse.llm import packing


@pytest.mark.parametrize("rule", ["norm", "dot"])
def test_attention_binds(rule):
    lengths = np.random.default_rng(3).integers(1, 400, 1500)
    capacity = packing.Capacity(2048, 2048, 160_000)
    bins, _ = packing.best_fit(lengths, capacity, rule)
    cost = np.bincount(bins, weights=lengths.astype(float) ** 2)
    tokens = np.bincount(bins, weights=lengths)
    assert cost.max() <= capacity.attention and tokens.max() <= capacity.tokens
    free, _ = packing.best_fit(lengths, packing.Capacity(), rule)
    assert np.bincount(free, weights=lengths.astype(float) ** 2).max() > capacity.attention
    assert bins.max() > free.max()
    assert bins.max() + 1 <= 1.1 * -(-cost.sum() // capacity.attention) + 1 or rule == "dot"
