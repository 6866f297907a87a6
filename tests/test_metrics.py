from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from modelyard.functions.scalars import argmax_index, binary_label
from modelyard.operators import metrics

SCHEMA = "y double, p double"


def _one(spark, rows, model_type="regressor"):
    return metrics.evaluate(spark.createDataFrame(rows, SCHEMA), "y", "p", model_type).first()


def test_regression_values(spark):
    got = _one(spark, [(1.0, 2.0), (2.0, 2.0), (4.0, 1.0)])
    assert got["n"] == 3
    assert got["mse"] == pytest.approx(10 / 3)
    assert got["rmse"] == pytest.approx(math.sqrt(10 / 3))
    assert got["mae"] == pytest.approx(4 / 3)
    assert got["r2"] == pytest.approx(1 - 10 / (14 / 3))
    assert got["max_error"] == 3.0
    assert got["target_sum"] == 7.0


def test_published_rmse_key_is_mean_squared_error(spark):
    df = spark.createDataFrame([(1.0, 3.0), (1.0, 1.0)], SCHEMA)
    compat = metrics.compat_metrics(F.col("y"), F.col("p"))
    assert list(compat) == ["rmse", "r2", "mae"]
    assert df.agg(compat["rmse"].alias("v")).first()["v"] == 2.0


@pytest.mark.parametrize(
    ("rows", "expected"),
    [
        ([(1.0, 2.0), (3.0, 2.0)], 0.0),  # prediction is the mean
        ([(1.0, 1.0), (3.0, 3.0)], 1.0),
        ([(2.0, 2.0), (2.0, 2.0)], 1.0),  # constant target, perfect
        ([(2.0, 1.0), (2.0, 2.0)], 0.0),  # constant target, not perfect
        ([(5.0, 5.0)], 1.0),
    ],
)
def test_r2_limits(spark, rows, expected):
    assert _one(spark, rows)["r2"] == pytest.approx(expected)


def test_rows_without_prediction_do_not_count(spark):
    got = _one(spark, [(1.0, 2.0), (100.0, None), (None, 1.0), (3.0, 2.0)])
    assert (got["n"], got["mse"], got["target_mean"], got["r2"]) == (2, 1.0, 2.0, 0.0)


def test_empty_input(spark):
    got = metrics.evaluate(spark.createDataFrame([], SCHEMA), "y", "p").first()
    assert got["n"] == 0 and got["mse"] is None and got["r2"] is None
    assert metrics.evaluate(spark.createDataFrame([], SCHEMA), "y", "p", "classifier").first()["accuracy"] is None


def test_unknown_model_type(spark):
    with pytest.raises(ValueError):
        metrics.evaluate(spark.createDataFrame([], SCHEMA), "y", "p", "poet")


def test_all_metrics_share_one_aggregation(spark):
    df = spark.createDataFrame([(1.0, 2.0)], SCHEMA)
    plan = metrics.evaluate(df, "y", "p", extra={"bias": lambda y, p: F.avg(y - p)})._jdf.queryExecution().optimizedPlan()
    assert plan.toString().count("Aggregate") == 1


def test_cross_entropy_is_shifted_and_skips_bad_labels(spark):
    df = spark.createDataFrame(
        [([1000.0, 1001.0], 1), ([0.0, 0.0], 0), ([0.0, 0.0], 9), (None, 0)], "z array<double>, y int"
    )
    got = metrics.cross_entropy(df, "z", "y").first()
    assert got["n"] == 2
    assert got["loss"] == pytest.approx((math.log(1 + math.exp(-1)) + math.log(2)) / 2)


def test_argmax_first_on_ties_nan_largest_null_for_none(spark):
    rows = [([1.0, 3.0, 3.0],), ([float("nan"), 9.0],), ([],), (None,)]
    df = spark.createDataFrame(rows, "z array<double>")
    assert [r[0] for r in df.select(argmax_index(F.col("z"))).collect()] == [1, 0, None, None]


def test_binary_label_keeps_null(spark):
    df = spark.createDataFrame([(2,), (1,), (None,)], "c int")
    assert [r[0] for r in df.select(binary_label(F.col("c"), 2)).collect()] == [1, 0, None]


def test_metric_rows_and_gap(spark):
    df = spark.createDataFrame([("m", "train", 1.0, 5.0), ("m", "test", 3.0, 4.0)], "model_id string, dataset string, a double, b double")
    gap = metrics.train_test_gap(metrics.metric_rows(df, ["a", "b"], ["model_id", "dataset"]))
    assert {(r["key"], r["gap"]) for r in gap.collect()} == {("a", 2.0), ("b", -1.0)}


def test_classifier_bundle_takes_text_labels(spark):
    df = spark.createDataFrame([("a", "a"), ("a", "b"), (None, "b")], "y string, p string")
    row = metrics.evaluate(df, "y", "p", model_type="classifier").first()
    assert row["n"] == 2 and row["accuracy"] == 0.5
