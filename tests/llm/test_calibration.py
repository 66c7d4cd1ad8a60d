"""Calibration converges on balanced, separable and constant scores."""

import numpy as np
import pytest

from raillark.llm.toxicity import platt


@pytest.mark.parametrize("scale", [0.01, 1.0, 300.0])
@pytest.mark.parametrize("apart", [0.0, 1.0, 50.0])
def test_platt_converges(scale, apart):
    for seed in range(5):
        rng = np.random.default_rng(seed)
        y = np.repeat([0.0, 1.0], 117)
        z = scale * (rng.normal(size=234) + apart * (2 * y - 1) + 7)
        a, b = platt(z, y, np.ones(234))
        p = 1 / (1 + np.exp(-(a * z + b)))
        assert abs(p.mean() - 0.5) < 0.02
        assert apart == 0 or p[y == 1].mean() > 0.65 > 0.35 > p[y == 0].mean()


def test_platt_of_equal_scores():
    a, b = platt(np.full(40, 3.0), np.repeat([0.0, 1.0], [30, 10]), np.ones(40))
    assert 1 / (1 + np.exp(-(3 * a + b))) == pytest.approx(0.25, abs=0.05)
