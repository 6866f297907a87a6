"""Models of several kinds: read back by address, scored together."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelyard.operators import linear, models, network
from modelyard.plans import lifecycle
from modelyard.sources.tables import NamedDataset
from modelyard.sources.tracking_store import TrackingStore

SHAPE = network.Shape(3, 4, 2)


@pytest.fixture
def store(spark, tmp_path):
    return TrackingStore(spark, str(tmp_path / "store"))


@pytest.fixture(scope="module")
def table(spark):
    draw = np.random.default_rng(5)
    rows = [(i, [float(v) for v in x], int(x[0] > 0)) for i, x in enumerate(draw.normal(size=(200, 3)))]
    return spark.createDataFrame(rows, "row bigint, features array<double>, label int").repartition(3).cache()


def test_a_network_read_back_predicts_identically(store, spark, table):
    logged = lifecycle.train_with_checkpoints(store, table, "features", "label", SHAPE, "net", epochs=11, seed=2)
    training = network.train(table, "features", "label", SHAPE, epochs=11, seed=2)
    store.register(logged[-1].model_id, "main.default.net")
    model_id, read = lifecycle.load_by_uri(store, "models:/main.default.net/1")
    assert model_id == logged[-1].model_id and isinstance(read, models.Network) and read.shape == SHAPE
    assert np.array_equal(read.weights, training.checkpoints[-1][1])
    own = {r["row"]: r["scores"] for r in network.predict(table, "features", SHAPE, training.checkpoints[-1][1]).collect()}
    again = {r["row"]: r["scores"] for r in read.score(table, "features").collect()}
    asked = table.withColumn("uri", F.lit("models:/main.default.net/1"))
    scored = {r["row"]: r for r in lifecycle.predict_by_uri(store, asked).collect()}
    assert own == again
    for row, scores in own.items():
        assert scored[row]["scores"] == pytest.approx(scores, abs=1e-12)
        assert scored[row]["prediction"] == int(np.argmax(scores)) and scored[row]["status"] == "ok"


def test_another_kind_is_an_error(store, spark, table):
    (net,) = lifecycle.train_with_checkpoints(store, table, "features", "label", SHAPE, "net", epochs=1)
    with pytest.raises(TypeError, match="network"):
        lifecycle.load_by_uri(store, net.model_uri, models.LINEAR)
    with pytest.raises(TypeError, match="network"):
        lifecycle.evaluate_version(store, net.model_uri, NamedDataset(table, "x"), "features", "label")
    (line,) = store.log_models([{"name": "line", "model_type": models.LINEAR}])
    store.append("coefficients", linear.LinearModel((1.0, 2.0), 3.0).to_table(spark, line.model_id))
    assert lifecycle.load_by_uri(store, line.model_uri)[1] == linear.LinearModel((1.0, 2.0), 3.0)
    with pytest.raises(TypeError, match="linear"):
        lifecycle.load_by_uri(store, line.model_uri, models.NETWORK)
    (strange,) = store.log_models([{"name": "tree", "model_type": "tree"}])
    store.append("coefficients", linear.LinearModel((1.0,), 0.0).to_table(spark, strange.model_id))
    with pytest.raises(TypeError, match="tree"):
        lifecycle.load_by_uri(store, strange.model_uri)
    (empty,) = store.log_models([{"name": "none"}])
    with pytest.raises(LookupError):
        lifecycle.load_by_uri(store, empty.model_uri)


def test_kind_of_rows_without_one(spark):
    logged = spark.createDataFrame(
        [("a", None, None), ("b", None, {"layer_widths": "1-1-1"})], "model_id string, model_type string, params map<string,string>"
    )
    values = spark.createDataFrame([("a", 0, 2.0), *[("b", i, float(i)) for i in range(4)]], "model_id string, idx int, value double")
    typed = models.typed_models(logged, values)
    assert models.load(typed, "a") == linear.LinearModel((2.0,), 0.0)
    assert models.load(typed, "b").weights.tolist() == [0.0, 1.0, 2.0, 3.0]


def test_weights_that_do_not_fit():
    for widths, message in ((None, "three"), ([1, 2], "three"), ([1, None, 2], "three"), ([2, 2, 2], "do not fit")):
        with pytest.raises(ValueError, match=message):
            models.unpacked(models.NETWORK, widths, [0.0] * 5)


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_requests_for_many_models(spark, broadcast_bytes):
    draw = np.random.default_rng(7)
    flat = network.initial_weights(SHAPE, 4)
    typed = [("net", "network", [3, 4, 2], flat.tolist())]
    typed += [(f"l{i}", "linear", None, [float(i), *draw.normal(size=3).tolist()]) for i in range(5)]
    typed = spark.createDataFrame(typed, models._MODEL)
    rows = []
    for i, x in enumerate(draw.normal(size=(300, 3)).tolist()):
        wanted = "net" if i % 3 == 0 else f"l{i % 5}"
        rows.append((i, wanted, [None, [1.0], x[:2] + [None], []][i % 4] if i % 50 < 4 else x, "kept"))
    rows += [(1000, None, [1.0, 2.0, 3.0], "kept"), (1001, "absent", [1.0, 2.0, 3.0], "kept"), (1000, None, None, None)]
    requests = spark.createDataFrame(rows, "id int, model_id string, features array<double>, note string")
    got = models.score_requests(requests, typed, broadcast_bytes=broadcast_bytes, slice_rows=16).collect()
    assert len(got) == len(rows)
    weights = {r["model_id"]: r["values"] for r in typed.collect()}
    for r in got:
        x = r["features"]
        if r["model_id"] in (None, "absent"):
            assert (r["status"], r["prediction"], r["scores"]) == ("no_model", None, None)
        elif x is None or len(x) != 3 or None in x:
            assert (r["status"], r["prediction"], r["scores"]) == ("features_do_not_fit", None, None)
        elif r["model_id"] == "net":
            scores = network.forward(SHAPE, flat, np.array([x], np.float32).astype(float))[0]
            assert r["scores"] == pytest.approx(scores.tolist(), abs=1e-12) and r["prediction"] == scores.argmax()
        else:
            w = weights[r["model_id"]]
            assert r["prediction"] == pytest.approx(w[0] + np.dot(w[1:], x), abs=1e-12) and r["scores"] is None
    assert models.score_requests(requests.limit(0), typed, broadcast_bytes=broadcast_bytes).count() == 0
    nothing = models.score_requests(requests, typed.limit(0), broadcast_bytes=broadcast_bytes)
    assert {r["status"] for r in nothing.collect()} == {"no_model"}


def test_a_stored_training_goes_on(store, spark, table):
    options = {"seed": 2, "resume_as": "run-a"}
    first = lifecycle.train_with_checkpoints(store, table, "features", "label", SHAPE, "net", epochs=15, **options)
    rest = lifecycle.train_with_checkpoints(store, table, "features", "label", SHAPE, "net", epochs=31, **options)
    whole = network.train(table, "features", "label", SHAPE, epochs=31, seed=2)
    names = [r["name"] for r in store.read("models").orderBy("search_order").collect()]
    assert names == ["net-0", "net-10", "net-20", "net-30"] and len(first) == 2 and len(rest) == 2
    _, last = lifecycle.load_by_uri(store, rest[-1].model_uri)
    assert np.array_equal(last.weights, whole.checkpoints[-1][1])
    assert lifecycle.train_with_checkpoints(store, table, "features", "label", SHAPE, "net", epochs=31, **options) == []
