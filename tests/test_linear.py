from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelyard.operators import linear, metrics


def _coordinate_descent(x, y, alpha, rho, sweeps=3000):
    """Direct minimisation of the penalised objective, as the thing to compare with."""
    n, d = x.shape
    xc, yc = x - x.mean(axis=0), y - y.mean()
    w, rest = np.zeros(d), yc.copy()
    scale = (xc**2).sum(axis=0) / n
    for _ in range(sweeps):
        for j in range(d):
            rest += xc[:, j] * w[j]
            pull = xc[:, j] @ rest / n
            w[j] = np.sign(pull) * max(abs(pull) - alpha * rho, 0) / (scale[j] + alpha * (1 - rho))
            rest -= xc[:, j] * w[j]
    return w, y.mean() - x.mean(axis=0) @ w


@pytest.fixture(scope="module")
def table(spark):
    draw = np.random.default_rng(1)
    x = draw.normal(size=(400, 6)) * [1, 5, 0.3, 1, 2, 1] + 3
    y = x @ [1.0, -0.2, 2.0, 0.0, 0.0, 0.5] + draw.normal(size=400)
    rows = [([float(v) for v in r], float(t)) for r, t in zip(x, y)]
    return spark.createDataFrame(rows, "features array<double>, y double").cache(), x, y


@pytest.mark.parametrize(("alpha", "rho"), [(0.5, 0.5), (0.05, 0.9), (0.3, 0.0), (0.2, 1.0), (0.0, 0.5)])
def test_fit_equals_coordinate_descent(table, alpha, rho):
    df, x, y = table
    model = linear.fit_elastic_net(df, "features", "y", alpha, rho)
    w, b = _coordinate_descent(x, y, alpha, rho)
    assert np.allclose(model.weights, w, atol=1e-6)
    assert model.intercept == pytest.approx(b, abs=1e-5)


def test_optimality_conditions_on_given_vectors(spark, base):
    from modelyard.plans import standins

    df = standins.features(spark, base)
    alpha, rho = 0.002, 0.5
    model = linear.fit_elastic_net(df, "features", "quality", alpha, rho)
    rows = df.select("features", "quality").toPandas()
    x, y = np.vstack(rows["features"]).astype(float), rows["quality"].to_numpy(float)
    w = np.array(model.weights)
    slope = x.T @ (y - x @ w - model.intercept) / len(y) - alpha * (1 - rho) * w
    active = w != 0
    assert active.any() and not active.all()
    assert np.abs(slope[active] - alpha * rho * np.sign(w[active])).max() < 1e-6
    assert np.abs(slope[~active]).max() <= alpha * rho + 1e-9


def test_strong_penalty_leaves_the_mean(spark, base):
    from modelyard.plans import standins

    df = standins.features(spark, base)
    model = linear.fit_elastic_net(df, "features", "quality")
    assert not any(model.weights)
    assert metrics.evaluate(linear.score(df, "features", model), "quality", "prediction").first()["r2"] == pytest.approx(0.0)


def test_constant_target_and_no_rows(spark):
    df = spark.createDataFrame([([1.0, 2.0], 3.0), ([2.0, 0.0], 3.0)], "features array<double>, y double")
    assert linear.fit_elastic_net(df, "features", "y") == linear.LinearModel((0.0, 0.0), 3.0)
    with pytest.raises(ValueError):
        linear.fit_elastic_net(df.where("y > 3"), "features", "y")


def test_round_trip_predicts_identically(spark, table):
    df, _, _ = table
    model = linear.LinearModel((0.1, -2.0, 0.0, 3.5, 1e-9, 7.0), -0.3)
    assert linear.load_model(model.to_table(spark, "m"), "m") == model
    with pytest.raises(LookupError):
        linear.load_model(model.to_table(spark, "m"), "other")


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_assigned_scoring_both_ways(spark, broadcast_bytes):
    rows = spark.createDataFrame(
        [("train", 1, [1.0, 2.0]), ("train", 2, [0.0, 1.0]), ("test", 3, [5.0, 5.0]), ("none", 4, [9.0, 9.0])],
        "dataset string, row_key bigint, features array<double>",
    )
    tables = linear.LinearModel((1.0, 0.0), 0.5).to_table(spark, "a").unionByName(
        linear.LinearModel((0.0, 2.0), 0.0).to_table(spark, "b")
    )
    assignments = spark.createDataFrame([("train", "a"), ("train", "b"), ("test", "b"), ("test", "b")], "dataset string, model_id string")
    scored = linear.score_assigned(rows, assignments, linear.packed_models(tables), broadcast_bytes=broadcast_bytes)
    got = {(r["model_id"], r["row_key"]): r["prediction"] for r in scored.collect()}
    assert got == {("a", 1): 1.5, ("b", 1): 4.0, ("a", 2): 0.5, ("b", 2): 2.0, ("b", 3): 10.0}
    assert scored.count() == 5


def test_scoring_stays_in_generated_code(table):
    df, _, _ = table
    plan = linear.score(df, "features", linear.LinearModel((1.0,) * 6, 0.0))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Lambda" not in plan


def test_score_skips_null_features(spark):
    df = spark.createDataFrame([([1.0],), (None,)], "features array<double>")
    got = [r["prediction"] for r in linear.score(df, "features", linear.LinearModel((2.0,), 1.0)).collect()]
    assert got == [3.0, None]
    assert df.select(F.lit(1)).count() == 2


def test_wide_rows_and_rows_without_features(spark):
    from modelyard.functions.scalars import dot_literals

    width = 5000
    weights = [float(i % 7 - 3) for i in range(width)]
    df = spark.createDataFrame([(1, [0.5] * width), (2, None)], "id int, features array<double>")
    rows = {r["id"]: r["p"] for r in df.select("id", dot_literals(df.features, weights, 0.25).alias("p")).collect()}
    assert abs(rows[1] - (0.25 + 0.5 * sum(weights))) < 1e-9 and rows[2] is None
    zero = {r["id"]: r["p"] for r in df.select("id", dot_literals(df.features, [0.0], 0.25).alias("p")).collect()}
    assert zero == {1: 0.25, 2: None}
