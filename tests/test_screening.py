"""Removal of predictors by sweeping against refitting the variance inflations."""

import math
import random

import numpy as np
import pytest

from eventloom.plans import models, screening


def test_sweeping_is_an_inverse_and_undoes_itself():
    draw = np.random.default_rng(1)
    for n in (1, 2, 5, 9):
        a = draw.normal(size=(n, 40))
        matrix = a @ a.T / 40
        now = matrix
        for k in range(n):
            now = screening.sweep(now, k)
        assert np.allclose(now, np.linalg.inv(matrix))
        back = screening.sweep(screening.sweep(matrix, n - 1), n - 1)
        assert np.allclose(back, matrix)


@pytest.fixture
def rows(spark):
    draw = random.Random(4)
    out = []
    for i in range(400):
        a, b, c = (draw.gauss(0, 1) for _ in range(3))
        out.append((a, b, c, a + b + draw.gauss(0, 0.1), a - c + draw.gauss(0, 0.2), draw.gauss(0, 1) + 0.3 * b, None if i % 50 == 0 else 1.0 * i))
    return spark.createDataFrame(out, "a double, b double, c double, d double, e double, f double, g double").repartition(4)


def test_order_of_removals_is_that_of_refitting(rows):
    names = ["a", "b", "c", "d", "e", "f", "g"]
    for limit in (1.5, 4.0, 10.0, 1e9):
        left, order = list(names), []
        while True:
            known = {r.feature: r.vif for r in models.variance_inflation(models.complete_rows(rows, names), left).collect()}
            worst = max(left, key=lambda n: (known[n], names.index(n)))
            if known[worst] <= limit or len(left) == 1:
                break
            order.append((worst, known[worst]))
            left.remove(worst)
        got = screening.screen_predictors(rows, names, limit).collect()
        gone = sorted((r for r in got if r.removed is not None), key=lambda r: r.removed)
        assert [(r.feature, r.removed) for r in gone] == [(n, i) for i, (n, _) in enumerate(order, 1)]
        assert [r.vif for r in gone] == pytest.approx([v for _, v in order], rel=1e-6)
        assert {r.feature: r.vif for r in got if r.removed is None} == pytest.approx({n: known[n] for n in left}, rel=1e-6)


def test_determined_and_constant_features(spark):
    draw = random.Random(5)
    data = [(x, y, x + y, 3.0, 2 * x) for x, y in ((draw.gauss(0, 1), draw.gauss(0, 1)) for _ in range(100))]
    frame = spark.createDataFrame(data, "x double, y double, s double, one double, twice double")
    got = {r.feature: r for r in screening.screen_predictors(frame, ["x", "y", "s", "one", "twice"]).collect()}
    assert [got[n].removed for n in ("s", "one", "twice")] == [1, 2, 3]
    assert math.isinf(got["s"].vif) and got["one"].vif is None and math.isinf(got["twice"].vif)
    assert got["x"].removed is None and got["x"].vif < 1.2
    assert screening.screen_predictors(frame.limit(0), ["x"]).first().removed == 1
