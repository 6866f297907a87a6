from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from modelyard.operators import linear, network, registry, tracking
from modelyard.plans import lifecycle, standins
from modelyard.schemas import ENDPOINTS
from modelyard.sources.shared import cut_lineage, scratch_path, shared_dir
from modelyard.sources.tables import NamedDataset, dataset_profile
from modelyard.sources.tracking_store import TrackingStore


@pytest.fixture()
def store(spark):
    return TrackingStore(spark, scratch_path(spark, "store"))


def test_empty_store_reads_as_empty_tables(store):
    assert store.read("metrics").count() == 0
    assert lifecycle.best_checkpoint(store).count() == 0


def test_round_trip(store):
    with store.run("evaluation") as run:
        (model,) = store.log_models([{"name": "elasticnet", "params": {"alpha": 0.5, "l1_ratio": 0.5}, "run_id": run.run_id}])
        store.log_metrics({"rmse": 1, "mae": 0.5}, model.model_id, "train", run.run_id)
    row = store.read("models").first()
    assert re.fullmatch(r"m-[0-9a-f]{32}", row["model_id"]) and row["model_uri"] == f"models:/{model.model_id}"
    assert row["params"] == {"alpha": "0.5", "l1_ratio": "0.5"} and row["step"] is None
    assert {(r["key"], r["value"], r["dataset"]) for r in store.read("metrics").collect()} == {
        ("rmse", 1.0, "train"),
        ("mae", 0.5, "train"),
    }
    got = store.read("runs").first()
    assert (got["run_name"], got["status"]) == ("evaluation", "FINISHED") and got["end_ts"] >= got["start_ts"]


def test_failed_run_is_recorded(store):
    with pytest.raises(RuntimeError):
        with store.run():
            raise RuntimeError("no")
    assert store.read("runs").first()["status"] == "FAILED"


def test_append_checks_columns(store, spark):
    with pytest.raises(ValueError, match="no such columns"):
        store.append("runs", spark.createDataFrame([("r", 1)], "run_id string, colour int"))
    with pytest.raises(ValueError, match="columns missing"):
        store.append("metrics", spark.createDataFrame([("m",)], "model_id string"))


def test_metrics_are_pruned_by_key(store):
    store.log_metrics({"a": 1.0, "b": 2.0}, "m")
    plan = store.read("metrics").where("key = 'a'")._jdf.queryExecution().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*key", plan)


def test_train_evaluate_register(store, spark, base):
    table = standins.features(spark, base)
    model, version = lifecycle.train_and_register(store, table, "features", "quality", "main.default.m", alpha=0.002)
    assert version == 1
    assert store.read("runs").count() == 2 and store.read("models").count() == 1
    wide = store.read("metrics").groupBy("dataset").pivot("key", ["rmse", "r2", "mae"]).agg(F.first("value"))
    got = {r["dataset"]: r for r in wide.collect()}
    assert set(got) == {"train", "test"}
    assert 0 < got["train"]["r2"] < 1 and got["train"]["rmse"] < 0.25
    assert store.register(model.model_id, "main.default.m") == 2
    assert store.register(model.model_id, "main.default.other") == 1
    assert {r["name"] for r in store.read("datasets").collect()} == {"train", "test"}


def test_version_is_evaluated_by_its_address(store, spark):
    rows = spark.createDataFrame([([float(i)], 2.0 * i + 1) for i in range(5)], "x array<double>, y double")
    (model,) = store.log_models([{"name": "line", "params": {}}])
    store.append("coefficients", linear.LinearModel((2.0,), 1.0).to_table(spark, model.model_id))
    version = store.register(model.model_id, "main.default.line")
    address = f"models:/main.default.line/{version}"
    assert lifecycle.evaluate_version(store, address, NamedDataset(rows, "check"), "x", "y") == model.model_id
    logged = store.read("metrics").where("dataset = 'check'").collect()
    assert {r["value"] for r in logged if r["key"] in ("rmse", "mae")} == {0.0}
    (run,) = store.read("runs").where("run_name = 'evaluation'").collect()
    assert {r["run_id"] for r in logged} == {run["run_id"]}
    for absent in ("models:/main.default.line/9", "runs:/x"):
        with pytest.raises(LookupError):
            lifecycle.evaluate_version(store, absent, NamedDataset(rows, "check"), "x", "y")


def test_checkpoints_rank_and_promote(store, spark, base):
    table = standins.features(spark, base)
    shape = network.Shape(64, 16, 10)
    logged = lifecycle.train_with_checkpoints(store, table, "features", "label", shape, "net", epochs=31, seed=1)
    assert len(logged) == 4
    assert [r["name"] for r in store.read("models").orderBy("search_order").collect()] == ["net-0", "net-10", "net-20", "net-30"]
    ranked = tracking.rank_models(store.read("models"), store.read("metrics"), "accuracy").collect()
    ends = {r["place"]: r["name"] for r in lifecycle.best_checkpoint(store).collect()}
    assert ends == {"best": ranked[0]["name"], "worst": ranked[-1]["name"]}
    best = ranked[0]["model_id"]
    assert store.read("models").first()["params"] == {"layer_widths": "64-16-10", "epochs": "31", "seed": "1"}
    store.register(best, "main.default.net", {"Approval_Check": "Approved"})
    store.register(best, "main.default.net", {"Approval_Check": "Rejected"})
    assert lifecycle.promote(store, spark.createDataFrame([], ENDPOINTS)).isEmpty()  # trained, not evaluated
    with store.run("evaluation") as run:
        store.log_metrics({"accuracy": 0.5}, best, "test", run.run_id)
    state = lifecycle.promote(store, spark.createDataFrame([], ENDPOINTS)).collect()
    assert [(r["endpoint_name"], r["entity_version"], r["action"]) for r in state] == [
        ("main-default-net-serving-endpoint", 1, "create")
    ]


def test_profile_ignores_row_order_but_not_content(spark):
    rows = [(1, "a", 1.5), (2, None, 2.5), (3, "c", None)]
    df = spark.createDataFrame(rows, "i int, s string, d double")
    one = NamedDataset(df, "x").profile().first()
    assert one["n_rows"] == 3 and one["n_null_cells"] == 2
    assert dataset_profile(df.orderBy(F.desc("i")).repartition(3), "x").first() == one
    for other in ([(1, "a", 1.5), (2, "", 2.5), (3, "c", None)], [(1, "a", 1.5), (2, None, 2.5), (3, "c", 0.0)]):
        assert dataset_profile(spark.createDataFrame(other, df.schema), "x").first()["digest"] != one["digest"]
    assert dataset_profile(df.where("i > 5"), "x").first()["digest"] == "0"


def test_shared_folder_is_the_configured_one(spark):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    assert scratch_path(spark, "a") != scratch_path(spark, "a")
    cut = cut_lineage(spark.range(5).selectExpr("id * 2 AS x"))
    assert sorted(r["x"] for r in cut.collect()) == [0, 2, 4, 6, 8]
    assert "RDD" in cut._jdf.queryExecution().toString()


def _evaluation_metrics(store):
    evaluated = registry.evaluations(store.read("metrics"), store.read("runs"))
    return {(r["model_id"], r["dataset"], r["key"]): r["value"] for r in evaluated.collect()}


def test_an_agent_is_answered_scored_and_logged_in_an_evaluation_run(store, spark):
    (agent,) = store.log_models([{"name": "agent", "model_type": "agent"}])
    with store.run("training") as training:
        store.log_metrics({"f1": 1.0}, agent.model_id, "items", training.run_id)
    requests = spark.createDataFrame(
        [(1, "a b", "A B c"), (2, "x", "y"), (3, None, "z"), (4, "a", None)], "id int, request string, expected string"
    )
    asked = spark.sparkContext.accumulator(0)

    def upper(texts):
        asked.add(len(texts))
        return texts.str.upper()

    longest = {"longest": F.max(F.length("response")), "none": F.max(F.lit(None).cast("double"))}
    run_id, rows = lifecycle.evaluate_agent(store, agent.model_id, NamedDataset(requests, "items"), upper, extra=longest)
    assert [r["response"] for r in rows.orderBy("id").collect()] == ["A B", "X", None, "A"]
    assert asked.value == 4
    logged = _evaluation_metrics(store)
    assert {m for m, _, _ in logged} == {agent.model_id} and {d for _, d, _ in logged} == {"items"}
    by_key = {k: v for (_, _, k), v in logged.items()}
    assert (by_key["n_rows"], by_key["longest"]) == (4.0, 3.0) and "none" not in by_key
    # Articles do not count: "b" against "b c" gives 2/3, the other rows nothing.
    assert by_key["f1"] == pytest.approx(2 / 3 / 4)
    run = store.read("runs").where(F.col("run_id") == run_id).first()
    assert (run["run_name"], run["status"]) == ("evaluation", "FINISHED")
    version = store.register(agent.model_id, "main.default.agent", {"Approval_Check": "approved"})
    endpoints = lifecycle.promote(store, spark.createDataFrame([], ENDPOINTS)).collect()
    assert [(r["entity_name"], r["entity_version"]) for r in endpoints] == [("main.default.agent", version)]


def test_an_agent_without_requests_or_with_a_failing_responder(store, spark):
    (agent,) = store.log_models([{"name": "agent"}])
    requests = spark.createDataFrame([("r", "e")], "request string, expected string")

    def broken(texts):
        raise RuntimeError("no answer")

    with pytest.raises(Exception, match="no answer"):
        lifecycle.evaluate_agent(store, agent.model_id, NamedDataset(requests, "items"), broken)
    assert store.read("runs").first()["status"] == "FAILED" and not _evaluation_metrics(store)
    lifecycle.evaluate_agent(store, agent.model_id, NamedDataset(requests.limit(0), "none"), lambda texts: texts)
    assert {k: v for (_, d, k), v in _evaluation_metrics(store).items() if d == "none"} == {"n_rows": 0.0, "n_empty_responses": 0.0}
