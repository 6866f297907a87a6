from __future__ import annotations

import numpy as np
import pytest

from modelyard.operators import network

SHAPE = network.Shape(5, 4, 3)


@pytest.fixture(scope="module")
def data():
    draw = np.random.default_rng(2)
    x = draw.normal(size=(300, 5)).astype(np.float32)
    y = (x[:, 0] + x[:, 1] > 0).astype(np.int64) + (x[:, 2] > 1)
    return x, y


@pytest.fixture(scope="module")
def table(spark, data):
    x, y = data
    rows = [([float(v) for v in r], int(c)) for r, c in zip(x, y)]
    return spark.createDataFrame(rows, "features array<float>, label int").repartition(3).cache()


def _loss(flat, x, y):
    sums = network.gradient_sum(SHAPE, flat, x.astype(float), y)
    return sums[-2] / sums[-1]


def test_gradient_equals_finite_differences(data):
    x, y = data
    flat = network.initial_weights(SHAPE, 1)
    gradient = network.gradient_sum(SHAPE, flat, x.astype(float), y)[:-2] / len(y)
    for i in range(SHAPE.size):
        step = np.zeros(SHAPE.size)
        step[i] = 1e-6
        slope = (_loss(flat + step, x, y) - _loss(flat - step, x, y)) / 2e-6
        assert slope == pytest.approx(gradient[i], abs=1e-6)


def test_gradient_does_not_depend_on_partitions(table, data):
    x, y = data
    flat = network.initial_weights(SHAPE, 1)
    whole = network.gradient_sum(SHAPE, flat, x.astype(float), y)
    for n in (1, 7, 40):
        rows = network.training_rows(table.repartition(n), "features", "label")
        gradient, loss, count = network._gradient(rows, SHAPE, flat)
        assert count == 300
        assert np.allclose(gradient, whole[:-2] / 300, atol=1e-9, rtol=0)
        assert loss == pytest.approx(whole[-2] / 300, abs=1e-9)


def test_training_checkpoints_and_loss(table):
    training = network.train(table, "features", "label", SHAPE, seed=3)
    assert [step for step, _ in training.checkpoints] == list(range(0, 101, 10))
    assert len(training.losses) == 101
    assert training.losses[-1] < 0.5 * training.losses[0]
    start = network.initial_weights(SHAPE, 3)
    assert not np.array_equal(training.checkpoints[0][1], start)  # step 0 holds one update
    accuracy = {r["step"]: r for r in network.checkpoint_accuracy(table, "features", "label", training).collect()}
    assert sorted(accuracy) == list(range(0, 101, 10))
    assert accuracy[100]["accuracy"] > max(0.75, accuracy[0]["accuracy"]) and accuracy[100]["n"] == 300


def test_updates_follow_the_published_rule(table, data):
    x, y = data
    flat = network.initial_weights(SHAPE, 3)
    first, second = np.zeros(SHAPE.size), np.zeros(SHAPE.size)
    for t in range(1, 12):
        g = network.gradient_sum(SHAPE, flat, x.astype(float), y)[:-2] / len(y)
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        flat = flat - 0.01 * (first / (1 - 0.9**t)) / (np.sqrt(second / (1 - 0.999**t)) + 1e-8)
    training = network.train(table, "features", "label", SHAPE, epochs=11, seed=3)
    assert np.allclose(training.checkpoints[-1][1], flat, atol=1e-7)


def test_prediction_equals_forward(table, data):
    flat = network.initial_weights(SHAPE, 3)
    got = network.predict(table, "features", SHAPE, flat).toPandas()
    x = np.vstack(got["features"]).astype(np.float32).astype(float)
    assert np.allclose(np.vstack(got["scores"]), network.forward(SHAPE, flat, x))


def test_no_rows(table):
    with pytest.raises(ValueError):
        network.train(table.where("label > 9"), "features", "label", SHAPE)


def test_incomplete_rows_are_left_out(spark):
    rows = [([1.0] * 5, 1), (None, 1), ([1.0] * 5, None)]
    df = spark.createDataFrame(rows, "features array<float>, label int")
    assert network.training_rows(df, "features", "label").count() == 1


@pytest.mark.parametrize(
    "x, y, message", [([1.0, 2.0], 3, "class outside"), ([1.0, 2.0], -1, "class outside"), ([1.0, None], 0, "must be 2 numbers"), ([1.0], 0, "must be 2 numbers")]
)
def test_rows_that_do_not_fit_the_network_are_an_error(spark, x, y, message):
    df = spark.createDataFrame([([1.0, 2.0], 1), (x, y)], "features array<double>, label int")
    with pytest.raises(Exception, match=message):
        network.train(df, "features", "label", network.Shape(2, 2, 3), epochs=1)


def test_a_stopped_training_goes_on_to_the_same_weights(spark, table):
    whole = network.train(table, "features", "label", SHAPE, seed=3)
    kept = []
    half = network.train(table, "features", "label", SHAPE, epochs=51, seed=3, keep=kept.append)
    assert half.state.step == 51 and [s.step for s in kept] == [1, 11, 21, 31, 41, 51]
    stored = network.state_table(spark, "net", kept[2]).unionByName(network.state_table(spark, "net", half.state))
    torn = network.state_table(spark, "net", network.State(77, *[half.state.weights] * 3)).where("pos <> 3")
    state = network.load_state(stored.unionByName(torn), "net")
    assert state.step == 51 and np.array_equal(state.second, half.state.second)
    rest = network.train(table, "features", "label", SHAPE, resume=state)
    assert half.losses + rest.losses == whole.losses
    assert np.array_equal(rest.state.weights, whole.state.weights)
    assert [s for s, _ in half.checkpoints + rest.checkpoints] == [s for s, _ in whole.checkpoints]
    assert network.load_state(stored, "other") is None
    with pytest.raises(ValueError, match="do not fit"):
        network.train(table, "features", "label", network.Shape(5, 5, 3), resume=state)


def test_rows_that_get_no_scores(spark):
    shape = network.Shape(2, 3, 2)
    flat = network.initial_weights(shape, 1)
    rows = [(1, [1.0, 2.0]), (2, None), (3, [1.0]), (4, [None, 1.0]), (5, []), (6, [0.5, 0.5])]
    df = spark.createDataFrame(rows, "id int, features array<double>").coalesce(1)
    got = {r["id"]: r["scores"] for r in network.predict(df, "features", shape, flat).collect()}
    assert [got[i] for i in (2, 3, 4, 5)] == [None] * 4
    assert np.allclose([got[1], got[6]], network.forward(shape, flat, np.array([[1.0, 2.0], [0.5, 0.5]])))
    assert network.predict(df.limit(0), "features", shape, flat).count() == 0


def test_a_gradient_that_is_not_finite_is_an_error(spark):
    df = spark.createDataFrame([([1.0, 2.0], 1)], "features array<double>, label int")
    with pytest.raises(Exception, match="not finite"):
        network.train(df, "features", "label", network.Shape(2, 2, 2), epochs=1, start=np.full(12, np.inf))
