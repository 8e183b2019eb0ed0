"""Counts of phrases leave a task in batches of bounded size."""

import numpy as np
import pytest

from recallset.llm.phrases import tallied


@pytest.mark.parametrize("most", [1, 7, 1000])
def test_counts_are_whole_in_bounded_batches(most):
    rng = np.random.default_rng(4)
    parts = [rng.integers(0, 50, n).astype(np.uint64) << np.uint64(58) for n in (0, 90, 400)]
    keys, n = np.unique(np.concatenate(parts), return_counts=True)
    found = list(tallied(parts, most))
    assert not parts and all(0 < len(k) == len(c) <= most for k, c in found)
    assert np.concatenate([k for k, _ in found]).tolist() == keys.tolist()
    assert np.concatenate([c for _, c in found]).tolist() == n.tolist()


def test_no_keys_give_no_batch():
    assert list(tallied([np.zeros(0, np.uint64)])) == []
