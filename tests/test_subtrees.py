from __future__ import annotations

import numpy as np
import pytest

from loadcast.operators import deep_forests as df


def test_siblings_by_difference_make_the_same_subtree(monkeypatch):
    """Few nodes at once, or siblings summed from their rows, or from their parents: one subtree."""
    rng = np.random.default_rng(1)
    bins = np.stack([rng.integers(0, k, 6000) for k in (30, 30, 5, 1)]).astype(np.uint8)
    y = bins[0] * 3.0 + np.where(bins[2] > 2, bins[1], 7) + rng.normal(size=6000)
    w = np.maximum(rng.poisson(1, 6000), 1).astype(np.uint8)
    found = []
    for many, nodes in ((1, 512), (10**9, 512), (1, 8), (128, 16)):
        monkeypatch.setattr(df, "MANY_ROWS", many)
        monkeypatch.setattr(df, "NODES_AT_ONCE", nodes)
        feature, cut, left, value, gains = df.grow(bins, y, w, [30, 30, 5, 1], 9, 2)
        assert (left[cut < df.LEAF] > np.flatnonzero(cut < df.LEAF)).all() and left[cut < df.LEAF].max() + 2 == len(left)
        found.append((len(cut), value[df.walk(bins, feature, cut, left)], gains))
    for n, values, gains in found[1:]:
        assert n == pytest.approx(found[0][0], rel=0.01) and (abs(values - found[0][1]) < 1e-9).mean() > 0.99
        assert gains == pytest.approx(found[0][2], rel=1e-3)
