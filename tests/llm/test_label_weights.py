"""Scores keep the labels' true rate where the sample takes equally many of either."""

import random

import numpy as np
import pytest

from raillark.llm import co_training, toxicity


@pytest.mark.parametrize(("module", "target"), [(toxicity, "toxic"), (co_training, "quality")])
def test_rate_of_a_capped_sample(spark, module, target):
    rng = random.Random(2)
    rows = [(d, " ".join(rng.choices("abcdefghijkl", k=30)), "en", "s") for d in range(1600)]
    labels = spark.createDataFrame([(d, int(d % 10 == 0)) for d, *_ in rows], f"doc_id long, {target} int")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    got = [r.score for r in module.scored(docs, module.fit(docs, labels, per_class=100)).collect()]
    assert 0.04 < np.mean(got) < 0.2  # a tenth of the labels are 1; half of the sample is


def test_weighted_threshold_and_calibration():
    z, y = np.array([2.0, 1.0, 0.5, -1.0]), np.array([1.0, 0.0, 1.0, 0.0])
    many = np.array([1.0, 9.0, 1.0, 9.0])
    p = 1 / (1 + np.exp(-z))
    assert toxicity.best_threshold(p, y, many) == (p[0] + p[1]) / 2
    assert toxicity.best_threshold(p, y, np.ones(4)) != toxicity.best_threshold(p, y, many)
    assert toxicity.platt(z, y, many)[1] < toxicity.platt(z, y, np.ones(4))[1] - 0.5
