"""Many models scored and measured in one pass."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelyard.operators import linear, metrics, scoring

COLUMNS = ("n", "mse", "rmse", "mae", "r2", "max_error", "target_sum", "target_mean")


@pytest.fixture(scope="module")
def tables(spark):
    draw = np.random.default_rng(9)
    rows = []
    for i, x in enumerate(draw.normal(size=(700, 4))):
        dataset = "hot" if i % 3 else f"d{i % 5}"
        rows.append((i, dataset, [float(v) for v in x], float(x[0] + 1e6 + draw.normal()), str(i % 3)))
    df = spark.createDataFrame(rows, "row_key bigint, dataset string, features array<double>, y double, label string").repartition(6)
    models = [(f"m{i}", [float(v) for v in draw.normal(size=4)], float(i), str(i % 3)) for i in range(17)]
    packed = spark.createDataFrame(models, "model_id string, weights array<double>, intercept double, class string")
    names = ["hot", "d0", "d1", "d2", "d3", "d4", "absent"]
    assignments = spark.createDataFrame(
        [(d, f"m{i}") for k, d in enumerate(names) for i in range(17) if (i + k) % 4] + [("hot", "m1"), ("hot", "gone")],
        "dataset string, model_id string",
    )
    return df.cache(), packed, assignments


def _wanted(tables, by_class):
    df, packed, assignments = tables
    scored = linear.score_assigned(df, assignments, packed, keep=["y", "label"])
    if by_class:
        scored = scored.join(packed.select("model_id", "class"), "model_id").withColumn("y", (F.col("label") == F.col("class")).cast("double"))
    return {(r["model_id"], r["dataset"]): r for r in metrics.evaluate(scored, "y", "prediction", by=["model_id", "dataset"]).collect()}


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 300])
@pytest.mark.parametrize("by_class", [False, True])
def test_metrics_equal_those_of_single_predictions(tables, by_class, broadcast_bytes):
    df, packed, assignments = tables
    target = {"target": "label", "one_of": "class"} if by_class else {"target": "y"}
    got = scoring.evaluate_models(df, assignments, packed, **target, broadcast_bytes=broadcast_bytes, slice_rows=100)
    got = {(r["model_id"], r["dataset"]): r for r in got.collect()}
    wanted = _wanted(tables, by_class)
    assert got.keys() == wanted.keys()
    for key, row in wanted.items():
        assert [got[key][c] for c in COLUMNS] == pytest.approx([row[c] for c in COLUMNS], rel=1e-9, abs=1e-9)


def test_plan_has_no_row_for_a_prediction(tables):
    df, packed, assignments = tables
    plan = scoring.evaluate_models(df, assignments, packed, "y")._jdf.queryExecution().toString()
    assert "MapInArrow" in plan and "Join" not in plan.split("== Physical Plan ==")[1]


def test_rows_that_count_nowhere(spark, tables):
    rows = [("d", [1.0, 2.0], 1.0), ("d", None, 1.0), ("d", [1.0], 1.0), ("d", [None, 1.0], 1.0), ("d", [1.0, 1.0], None),
            (None, [1.0, 1.0], 1.0), ("d", [3.0, 0.0, 9.0], 5.0)]
    df = spark.createDataFrame(rows, "dataset string, features array<double>, y double")
    models = spark.createDataFrame([("a", [1.0, 1.0], 0.0)], "model_id string, weights array<double>, intercept double")
    assigned = spark.createDataFrame([("d", "a")], "dataset string, model_id string")
    for bytes_ in (1 << 20, 0):
        (row,) = scoring.evaluate_models(df, assigned, models, "y", broadcast_bytes=bytes_).collect()
        assert (row["n"], row["target_sum"], row["max_error"]) == (2, 6.0, 2.0)
        assert scoring.evaluate_models(df.limit(0), assigned, models, "y", broadcast_bytes=bytes_).count() == 0
    assert scoring.evaluate_models(df, assigned.limit(0), models, "y").count() == 0
