"""Elastic nets from one pass of statistics."""

from __future__ import annotations

import numpy as np
import pytest

from modelyard.operators import gram, linear


@pytest.fixture(scope="module")
def table(spark):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(500, 7)) * [1, 5, 0.3, 1, 2, 1, 0] + [3, 1e5, 0, 0, 1, 1, 4]
    y = x @ [1.0, -0.2, 2.0, 0.0, 0.0, 0.5, 0.0] + draw.normal(size=500)
    rows = [([float(v) for v in r], float(t)) for r, t in zip(x, y)]
    rows += [(None, 1.0), ([1.0] * 7, None), ([None] + [1.0] * 6, 1.0)]
    return spark.createDataFrame(rows, "features array<double>, y double").repartition(5).cache(), x, y


def test_moments_do_not_depend_on_partitions(table):
    df, x, y = table
    z = np.column_stack([x, y])
    around = z - z.mean(axis=0)
    for n in (1, 4, 40):
        m = gram.moments(df.repartition(n), "features", "y")
        assert m.n == 500 and np.allclose(m.mean, z.mean(axis=0), rtol=1e-12)
        assert np.allclose(m.scatter, around.T @ around, rtol=1e-5, atol=1e-2)


@pytest.mark.parametrize("rho", [0.0, 0.5, 1.0])
def test_path_meets_the_optimality_conditions(table, rho):
    df, x, y = table
    alphas = [0.01, 1.0, 0.2, 0.2]
    models = gram.fit_path(df, "features", "y", alphas, rho)
    assert models[2] == models[3]
    for alpha, model in zip(alphas, models):
        w = np.array(model.weights)
        xc, yc = x - x.mean(axis=0), y - y.mean()
        slope = xc.T @ (yc - xc @ w) / len(y) - alpha * (1 - rho) * w
        active = w != 0
        assert np.abs(slope[active] - alpha * rho * np.sign(w[active])).max() < 1e-4
        assert not (~active).any() or np.abs(slope[~active]).max() <= alpha * rho + 1e-4
        assert model.intercept == pytest.approx(y.mean() - x.mean(axis=0) @ w, abs=1e-6)


def test_path_equals_the_other_fit(spark, base):
    from modelyard.plans import standins

    df = standins.features(spark, base)
    (model,) = gram.fit_path(df, "features", "quality", [0.002])
    other = linear.fit_elastic_net(df, "features", "quality", alpha=0.002)
    assert any(model.weights) and not all(model.weights)
    assert np.allclose(model.weights, other.weights, atol=1e-7) and model.intercept == pytest.approx(other.intercept, abs=1e-7)


def test_one_pass_for_all_penalties(spark, table):
    from unittest import mock

    with mock.patch.object(gram, "moments", wraps=gram.moments) as asked:
        gram.fit_path(table[0], "features", "y", [0.1, 0.2, 0.3])
    assert asked.call_count == 1


def test_what_cannot_be_fitted(spark):
    df = spark.createDataFrame([([1.0, 2.0], 1.0), ([1.0], 2.0)], "features array<double>, y double")
    with pytest.raises(Exception, match="same number"):
        gram.fit_path(df.coalesce(1), "features", "y", [0.1])
    with pytest.raises(Exception, match="same number"):
        gram.fit_path(df.repartition(2, "y"), "features", "y", [0.1])
    with pytest.raises(ValueError, match="no rows"):
        gram.fit_path(df.where("y > 2"), "features", "y", [0.1])
    with pytest.raises(ValueError, match="alphas"):
        gram.fit_path(df, "features", "y", [-0.1])


def test_constant_label_and_single_row(spark):
    df = spark.createDataFrame([([1.0, 2.0], 3.0)], "features array<double>, y double")
    assert gram.fit_path(df, "features", "y", [0.5, 0.0])[0] == linear.LinearModel((0.0, 0.0), 3.0)


def test_path_table(spark):
    rows = gram.path_table(spark, [0.5], [linear.LinearModel((1.0, 0.0), 2.0)]).collect()
    assert sorted(tuple(r) for r in rows) == [(0.5, -1, 2.0), (0.5, 0, 1.0), (0.5, 1, 0.0)]
