from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from modelyard.operators import projections, tracking

METRICS = "model_id string, dataset string, key string, value double, step bigint, log_seq bigint"
MODELS = "model_id string, name string, search_order bigint"


@pytest.fixture(scope="module")
def models(spark):
    names = ["tie1", "tie2", "nan", "null", "missing", "low"]
    return spark.createDataFrame([(m, "f" if i < 3 else "g", i) for i, m in enumerate(names)], MODELS)


@pytest.fixture(scope="module")
def log(spark):
    rows = [
        ("tie2", "train", "accuracy", 0.9, 0, 1),
        ("tie1", "train", "accuracy", 0.9, 0, 2),
        ("nan", "train", "accuracy", float("nan"), 0, 3),
        ("null", "train", "accuracy", None, 0, 4),
        ("missing", "train", "loss", 0.1, 0, 5),
        ("low", "train", "accuracy", 0.2, 0, 6),
        ("low", "test", "accuracy", 0.99, 1, 7),
    ]
    return spark.createDataFrame(rows, METRICS)


def test_ranking_ties_nan_null_missing(models, log):
    ranked = tracking.rank_models(models, log, "accuracy").collect()
    assert [r["model_id"] for r in ranked] == ["tie1", "tie2", "low", "nan", "null", "missing"]
    assert [r["value"] for r in ranked] == [0.9, 0.9, 0.2, None, None, None]
    assert [r["has_metric"] for r in ranked] == [True] * 3 + [False] * 3


def test_first_value_wins_unless_a_dataset_is_given(models, log):
    assert {r["value"] for r in tracking.first_metric(log.where("model_id = 'low'"), "accuracy").collect()} == {0.2}
    by_test = tracking.rank_models(models, log, "accuracy", dataset="test").first()
    assert (by_test["model_id"], by_test["value"]) == ("low", 0.99)


def test_best_and_worst_agree_with_the_ranking(models, log):
    scored = tracking.score_models(models, log, "accuracy")
    got = {r["place"]: r["model_id"] for r in tracking.best_and_worst(scored).collect()}
    assert got == {"best": "tie1", "worst": "missing"}


def test_best_per_group(models, log):
    scored = tracking.score_models(models, log, "accuracy")
    got = {r["name"]: r["model_id"] for r in tracking.best_per_group(scored, ["name"]).collect()}
    assert got == {"f": "tie1", "g": "low"}


def test_empty_search_gives_no_rows(spark, log):
    nothing = spark.createDataFrame([], MODELS)
    scored = tracking.score_models(nothing, log, "accuracy")
    assert tracking.best_and_worst(scored).count() == 0
    assert tracking.rank_models(nothing, log, "accuracy").count() == 0


def test_single_model_is_best_and_worst(spark, models, log):
    scored = tracking.score_models(models.where("model_id = 'low'"), log, "accuracy")
    assert [r["model_id"] for r in tracking.best_and_worst(scored).collect()] == ["low", "low"]


def test_latest_prefers_step_then_log_position(spark):
    rows = [
        ("m", "d", "k", 1.0, 5, 1),
        ("m", "d", "k", 2.0, 4, 2),
        ("m", "d", "k", 3.0, 5, 0),
        ("m", "d", "k", 4.0, None, 9),
    ]
    assert tracking.latest_metric(spark.createDataFrame(rows, METRICS)).first()["value"] == 1.0


def test_curve_uses_last_value_of_a_step(spark):
    rows = [("m", "d", "k", v, s, q) for s, v, q in [(0, 1.0, 1), (10, 9.0, 2), (10, 3.0, 3), (20, 2.0, 4)]]
    got = tracking.metric_curve(spark.createDataFrame(rows, METRICS)).orderBy("step").collect()
    assert [(r["step"], r["value"], r["change"], r["best"]) for r in got] == [
        (0, 1.0, None, 1.0),
        (10, 3.0, 2.0, 3.0),
        (20, 2.0, -1.0, 3.0),
    ]


def test_documents_come_in_parts_and_keep_everything(spark):
    models = spark.createDataFrame([("m", "n", 0), ("bare", "n", 1)], MODELS)
    rows = [("m", "d", "k", float(i), i, i) for i in range(50)]
    documents = tracking.model_documents(models, spark.createDataFrame(rows, METRICS), part_bits=4).collect()
    parts = [json.loads(r["document"]) for r in documents if r["model_id"] == "m"]
    assert max(len(p["metrics"]) for p in parts) == 16
    assert sorted(m["log_seq"] for p in parts for m in p["metrics"]) == list(range(50))
    (bare,) = [json.loads(r["document"]) for r in documents if r["model_id"] == "bare"]
    assert bare["metrics"] == [] and bare["name"] == "n"


def test_one_document_however_far_apart_the_log_positions(spark):
    models = spark.createDataFrame([("m", "n", 0)], MODELS)
    rows = [("m", "d", "k", float(i), i, 1_700_000_000_000_000 + i * 60_000_000) for i in range(40)]
    (document,) = tracking.model_documents(models, spark.createDataFrame(rows, METRICS)).collect()
    assert document["part"] == 0 and len(json.loads(document["document"])["metrics"]) == 40


def test_lineage_keeps_models_without_metrics(spark, models, log):
    datasets = spark.createDataFrame([("train", 10)], "name string, n_rows bigint")
    runs = spark.createDataFrame([("r", "x")], "run_id string, run_name string")
    linked = tracking.lineage(models, log.where("key = 'loss'").withColumn("run_id", F.lit("r")), datasets, runs)
    got = {r["model_id"]: (r["dataset"], r["n_rows"], r["run_name"]) for r in linked.collect()}
    assert got["missing"] == ("train", 10, "x")
    assert got["low"] == (None, None, None) and len(got) == 6


def test_lookup(models, spark):
    wanted = spark.createDataFrame([("low",), ("low",), ("absent",)], "model_id string")
    assert [r["model_id"] for r in tracking.lookup_models(models, wanted).collect()] == ["low"]
    assert tracking.lookup_model(models, "nan").count() == 1


def test_every_tenth_step_of_101_gives_eleven(spark):
    steps = spark.range(101).withColumnRenamed("id", "step")
    assert projections.every_nth_step(steps, "step", 10).count() == 11


def test_arrays_of_another_length_are_an_error(spark):
    rows = spark.createDataFrame([([1.0, 2.0], 1), (None, 2)], "x array<double>, id int")
    assert [tuple(r) for r in projections.unpack_features(rows, "x", 2).orderBy("id").collect()] == [(1.0, 2.0, 1), (None, None, 2)]
    with pytest.raises(Exception, match="3 elements expected, found 2"):
        projections.unpack_features(rows, "x", 3).collect()


def test_ranks_follow_the_order_over_partitions(spark):
    ordered = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v")).repartitionByRange(5, "v").sortWithinPartitions("v")
    assert [(r["v"], r["rank"]) for r in tracking.with_rank(ordered).orderBy("rank").collect()] == [(i, i + 1) for i in range(1000)]
    assert tracking.with_rank(ordered.where("v < 0").orderBy("v")).count() == 0
