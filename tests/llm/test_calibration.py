from __future__ import annotations

import numpy as np
import pytest

from vendaval.llm.calibration import fit_logistic


@pytest.mark.parametrize("seed", range(8))
def test_nearly_separable_features(seed):
    """Skewed, correlated features that part the classes almost whole, as compression does."""
    chance = np.random.default_rng(seed)
    labels = (chance.random(6000) < 0.87).astype(float)
    base = chance.exponential(0.15, 6000) + (1 - labels) * chance.uniform(0.3, 6, 6000)
    features = np.column_stack([base, base * 0.5 + chance.normal(0, 0.001, 6000), np.exp(base), np.log1p(base)])
    scores = fit_logistic(features, labels)(features)
    assert ((scores >= 0.5) == labels).mean() > 0.97
    assert scores[labels == 0].mean() < 0.2 and scores.mean() == pytest.approx(labels.mean(), abs=0.01)


def test_one_class_and_none():
    ones = fit_logistic(np.ones((3, 2)), np.ones(3))(np.zeros((2, 2)))
    assert (ones == ones[0]).all() and ones[0] == pytest.approx(3.5 / 4)
    assert fit_logistic(np.zeros((0, 2)), np.zeros(0))(np.zeros((1, 2)))[0] == 0.5
