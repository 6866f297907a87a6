"""Whole workflows: train and evaluate, train with checkpoints, promote."""

from __future__ import annotations

from collections.abc import Callable, Mapping

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from modelyard.operators import agents, evaluation, linear, metrics, models, network, registry, signatures, tracking
from modelyard.sources.parameters import require
from modelyard.sources.shared import cut_lineage
from modelyard.sources.tables import NamedDataset
from modelyard.sources.tracking_store import LoggedModel, TrackingStore

EVALUATION = registry.EVALUATION


def evaluate_splits(df: DataFrame, model: linear.LinearModel, features: str, label: str, dataset: str) -> DataFrame:
    """Metrics of one model on every dataset of a table, in one pass."""
    scored = linear.score(df, features, model)
    return metrics.evaluate(scored, label, "prediction", by=[dataset])


def train_and_register(
    store: TrackingStore,
    df: DataFrame,
    features: str,
    label: str,
    name: str,
    alpha: float = linear.ALPHA,
    l1_ratio: float = linear.L1_RATIO,
    dataset: str = "dataset",
) -> tuple[LoggedModel, int]:
    """Fit on `train`, log model and train metrics; in a second run score `test` with the model read
    back from the store; register the model.  Two runs, one model."""
    train = NamedDataset(df.where(F.col(dataset) == "train"), "train")
    test = NamedDataset(df.where(F.col(dataset) == "test"), "test")
    with store.run("training") as run:
        model = linear.fit_elastic_net(train.df, features, label, alpha, l1_ratio)
        (logged,) = store.log_models(
            [
                {
                    "run_id": run.run_id,
                    "name": "elasticnet",
                    "model_type": models.LINEAR,
                    "params": {"alpha": alpha, "l1_ratio": l1_ratio},
                    "signature_json": signatures.signature_of(df, features),
                }
            ]
        )
        store.append("coefficients", model.to_table(store.spark, logged.model_id))
        _log_evaluation(store, train, model, features, label, logged.model_id, run.run_id)
    with store.run(EVALUATION) as run:
        loaded = linear.load_model(store.read("coefficients"), logged.model_id)
        _log_evaluation(store, test, loaded, features, label, logged.model_id, run.run_id)
    return logged, store.register(logged.model_id, name)


def _log_evaluation(
    store: TrackingStore,
    data: NamedDataset,
    model: linear.LinearModel,
    features: str,
    label: str,
    model_id: str,
    run_id: str,
) -> None:
    scored = linear.score(data.df, features, model)
    y, p = F.col(label), F.col("prediction")
    row = scored.agg(*[c.alias(k) for k, c in metrics.compat_metrics(y, p).items()]).first()
    store.append("datasets", data.profile().drop("n_null_cells"))
    store.log_metrics(row.asDict(), model_id, data.name, run_id)


def train_with_checkpoints(
    store: TrackingStore,
    df: DataFrame,
    features: str,
    label: str,
    shape: network.Shape,
    name_prefix: str,
    resume_as: str | None = None,
    **options,
) -> list[LoggedModel]:
    """Training run that logs a model and its accuracy on the training rows for every checkpoint.

    With `resume_as` the state of every checkpoint is stored under that name, and a training that finds
    one goes on from it; it logs the checkpoints it makes itself.

    The logged parameters are those of this run: its layer widths and the options it was given.
    """
    params = {models.WIDTHS: f"{shape.inputs}-{shape.hidden}-{shape.classes}"}
    params |= {k: v for k, v in options.items() if isinstance(v, (int, float, str))}
    state = network.load_state(store.read("states"), resume_as) if resume_as else None

    def keep(now: network.State) -> None:
        store.append("states", network.state_table(store.spark, resume_as, now))

    with store.run("training") as run:
        training = network.train(df, features, label, shape, resume=state, keep=keep if resume_as else None, **options)
        if not training.checkpoints:
            return []
        accuracy = {
            r["step"]: r["accuracy"] for r in network.checkpoint_accuracy(df, features, label, training).collect()
        }
        logged = store.log_models(
            [
                {
                    "run_id": run.run_id,
                    "name": f"{name_prefix}-{step}",
                    "model_type": models.NETWORK,
                    "step": step,
                    "params": params,
                }
                for step, _ in training.checkpoints
            ]
        )
        order = store.next_log_seq(len(logged))
        rows = [
            (run.run_id, model.model_id, "train", "accuracy", float(accuracy[step]), step, order + i)
            for i, (model, (step, _)) in enumerate(zip(logged, training.checkpoints))
        ]
        schema = "run_id string, model_id string, dataset string, key string, value double, step bigint, log_seq bigint"
        store.append("metrics", store.spark.createDataFrame(rows, schema))
        weights = [
            (model.model_id, i, float(v))
            for model, (_, flat) in zip(logged, training.checkpoints)
            for i, v in enumerate(flat)
        ]
        store.append("coefficients", store.spark.createDataFrame(weights, "model_id string, idx int, value double"))
    return logged


def best_checkpoint(store: TrackingStore, key: str = "accuracy") -> DataFrame:
    """First and last of all logged models by their first value of `key`."""
    scored = tracking.score_models(store.read("models"), store.read("metrics"), key)
    return tracking.best_and_worst(scored, ["model_id", "name", "value", "has_metric"])


def load_by_uri(store: TrackingStore, uri: str, kind: str | None = None) -> tuple[str, models.Model]:
    """Id and model behind `models:/<id>` or `models:/<name>/<version>`: a `LinearModel` or a `Network`.

    With `kind`, a model of another kind is an error.
    """
    asked = store.spark.createDataFrame([(require(uri=uri)["uri"],)], "uri string")
    (found,) = registry.resolve_uris(asked, store.read("models"), store.read("versions")).collect()
    if found["model_id"] is None:
        raise LookupError(f"no model at {uri}")
    own = F.col("model_id") == found["model_id"]
    typed = models.typed_models(store.read("models").where(own), store.read("coefficients").where(own))
    return found["model_id"], models.load(typed, found["model_id"], kind)


def predict_by_uri(store: TrackingStore, requests: DataFrame, features: str = "features", **options) -> DataFrame:
    """`requests` (with an address in `uri`) scored, each by the model at its address, whatever its kind."""
    resolved = registry.resolve_uris(requests, store.read("models"), store.read("versions"))
    typed = models.typed_models(store.read("models"), store.read("coefficients"))
    return models.score_requests(resolved, typed, features, **options)


def check_input(store: TrackingStore, uri: str, df: DataFrame, **lengths: int) -> tuple[DataFrame, DataFrame]:
    """(rows that keep the signature stored with the model at an address, rows set aside with `violations`).

    A model without signature, and columns that are missing or of another type, are errors.
    """
    model_id, _ = load_by_uri(store, uri)
    found = store.read("models").where(F.col("model_id") == model_id).select("signature_json").first()
    if found["signature_json"] is None:
        raise LookupError(f"no signature is stored with {uri}")
    return signatures.conform(df, signatures.read_signature(found["signature_json"]), lengths)


def search(
    store: TrackingStore, key: str, name: str | None = None, run_id: str | None = None, dataset: str | None = None
) -> DataFrame:
    """Logged models, best first by their first value of `key`; of one name, one run, or all there are.

    Only the partitions of the key and the run are read.  Within a run, models it measured count.
    """
    logged = store.read("models")
    if name is not None:
        logged = logged.where(F.col("name") == name)
    found = store.read_metrics(key, None if run_id is None else [run_id])
    if run_id is not None:
        logged = logged.join(found.select("model_id").distinct(), "model_id", "left_semi")
    return tracking.rank_models(logged, found, key, dataset)


def evaluate_version(store: TrackingStore, uri: str, data: NamedDataset, features: str, label: str) -> str:
    """Score `data` with the model at an address and log its metrics in an evaluation run; the model's id."""
    model_id, model = load_by_uri(store, uri, models.LINEAR)
    with store.run(EVALUATION) as run:
        _log_evaluation(store, data, model, features, label, model_id, run.run_id)
    return model_id


def evaluate_agent(
    store: TrackingStore,
    model_id: str,
    data: NamedDataset,
    predict: Callable[[pd.Series], pd.Series],
    request: str = "request",
    expected: str = "expected",
    extra: Mapping[str, Column] | None = None,
) -> tuple[str, DataFrame]:
    """(run id, result table): every request answered and scored, the means logged in an evaluation run.

    The result table is written once, below the store's scratch folder, so a responder is asked once a
    row.  `extra` are further aggregates over its columns; one that is NULL is not logged, and without
    any request only the number of rows is.
    """
    with store.run(EVALUATION) as run:
        answered = agents.predict_once(data.df, predict, request)
        rows = cut_lineage(evaluation.token_overlap(answered, "response", expected))
        summary = evaluation.summarise(rows, extra=extra).first().asDict()
        store.append("datasets", data.profile().drop("n_null_cells"))
        logged = {key: float(value) for key, value in summary.items() if value is not None}
        store.log_metrics(logged, model_id, data.name, run.run_id)
    return run.run_id, rows


def promote(
    store: TrackingStore, endpoints: DataFrame, tag: str = registry.DEFAULT_APPROVAL_TAG
) -> DataFrame:
    """Evaluation present -> approved -> endpoint state that should hold.

    Only metrics of evaluation runs count; a model that was merely trained is not promoted.
    """
    evaluated = registry.evaluations(store.read("metrics"), store.read("runs"))
    deployable = registry.deployable_versions(store.read("versions"), evaluated, tag)
    return registry.upsert_endpoints(endpoints, registry.desired_endpoints(deployable))
