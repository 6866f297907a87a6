"""Models of several kinds in one table, and rows scored by the model their address names.

A model is its kind, its layer widths and one list of numbers; what the list means follows from the kind.
Requests for many models are scored together: the models asked for travel to the requests when they are
few, else requests and models meet by model, a hot model's requests dealt over slices.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from modelyard.operators import linear, network

LINEAR, NETWORK = "linear", "network"
WIDTHS = "layer_widths"
BROADCAST_BYTES = 32 << 20
SLICE_ROWS = 1 << 16

_MODEL = "model_id string, kind string, widths array<int>, values array<double>"


@dataclass(frozen=True)
class Network:
    """A stored network: its widths and weights."""

    shape: network.Shape
    weights: np.ndarray

    def score(self, df: DataFrame, features: str, out: str = "scores") -> DataFrame:
        return network.predict(df, features, self.shape, self.weights, out)


Model = linear.LinearModel | Network


def kind_of(model_type: Column, params: Column) -> Column:
    """The stored kind; rows written without one are networks if they have layer widths, else linear."""
    return F.coalesce(model_type, F.when(F.try_element_at(params, F.lit(WIDTHS)).isNotNull(), NETWORK).otherwise(LINEAR))


def typed_models(models: DataFrame, coefficients: DataFrame) -> DataFrame:
    """(model_id, kind, widths, values) from (model_id, model_type, params) and coefficient rows.

    `values` is in order of the index; a linear model's begins with its intercept, index -1, which is
    0 where it is not stored.
    """
    pairs = F.array_sort(F.collect_list(F.struct("idx", "value")))
    packed = coefficients.groupBy("model_id").agg(
        F.transform(pairs, lambda p: p["value"]).alias("_values"), F.min("idx").alias("_first")
    )
    kind = kind_of(F.col("model_type"), F.col("params"))
    widths = F.transform(F.split(F.try_element_at("params", F.lit(WIDTHS)), "-"), lambda w: w.try_cast("int"))
    intercept = F.when((F.col("kind") == LINEAR) & (F.col("_first") != linear.INTERCEPT), F.array(F.lit(0.0))).otherwise(
        F.array().cast("array<double>")
    )
    return (
        models.select("model_id", kind.alias("kind"), widths.alias("widths"))
        .join(packed, "model_id")
        .select("model_id", "kind", "widths", F.concat(intercept, "_values").alias("values"))
    )


def unpacked(kind: str, widths: list[int] | None, values: list[float], expected: str | None = None) -> Model:
    """One model of the table as an object; a kind that is unknown or not the expected one is an error."""
    if expected is not None and kind != expected:
        raise TypeError(f"a {kind} model is stored where a {expected} model is asked for")
    if kind == LINEAR:
        return linear.LinearModel(tuple(values[1:]), values[0])
    if kind != NETWORK:
        raise TypeError(f"unknown kind of model: {kind}")
    if widths is None or len(widths) != 3 or None in widths:
        raise ValueError(f"a network needs three layer widths, not {widths}")
    shape = network.Shape(*widths)
    if shape.size != len(values):
        raise ValueError(f"{len(values)} weights do not fit a network of {shape.size}")
    return Network(shape, np.array(values))


def load(typed: DataFrame, model_id: str, expected: str | None = None) -> Model:
    """One model read back; the one row fetched holds its weights."""
    found = typed.where(F.col("model_id") == model_id).first()
    if found is None:
        raise LookupError(f"no weights for {model_id}")
    return unpacked(found["kind"], found["widths"], found["values"], expected)


def _scored(x: pa.ListArray, model: Model) -> tuple[np.ndarray, np.ndarray, list]:
    """(fits, prediction, scores) of rows that ask for one model; a network predicts its largest class."""
    if isinstance(model, Network):
        fits = network.fitting(x, model.shape.inputs)
        rows = x.filter(pa.array(fits)).flatten().to_numpy().reshape(-1, model.shape.inputs)
        # Features are kept as single-precision numbers in training, so they are here.
        found = network.forward(model.shape, model.weights, rows.astype(np.float32).astype(np.float64))
        return fits, found.argmax(axis=1).astype(float), list(found)
    width = len(model.weights)
    fits = network.fitting(x, width)
    rows = x.filter(pa.array(fits)).flatten().to_numpy().reshape(-1, width)
    found = rows @ np.array(model.weights) + model.intercept
    return fits, found, [None] * len(found)


def _with_scores(batch: pa.RecordBatch, columns: list[str], models: dict[str, Model]) -> pa.RecordBatch:
    n, ids = batch.num_rows, batch.column("model_id").to_numpy(zero_copy_only=False)
    status = np.full(n, "no_model", object)
    prediction, scores = np.full(n, np.nan), np.full(n, None, object)
    x = batch.column("_x")
    for model_id in {i for i in ids if i in models}:
        at = np.flatnonzero(ids == model_id)
        fits, found, lists = _scored(x.take(pa.array(at)), models[model_id])
        status[at] = np.where(fits, "ok", "features_do_not_fit")
        prediction[at[fits]] = found
        scores[at[fits]] = lists if not lists or lists[0] is None else np.fromiter(lists, object, len(lists))
    known = status == "ok"
    return pa.RecordBatch.from_arrays(
        [
            *[batch.column(c) for c in columns],
            pa.array(prediction, mask=~known),
            pa.array(list(scores), pa.list_(pa.float64())),
            pa.array(list(status)),
        ],
        [*columns, "prediction", "scores", "status"],
    )


def _objects(table: pa.Table | pa.RecordBatch) -> dict[str, Model]:
    return {r["model_id"]: unpacked(r["kind"], r["widths"], r["values"]) for r in table.to_pylist()}


def score_requests(
    requests: DataFrame,
    typed: DataFrame,
    features: str = "features",
    broadcast_bytes: int = BROADCAST_BYTES,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """`requests` (with a `model_id`, NULL for none) and prediction, scores, status.

    A linear model predicts a number and has no scores; a network's scores are those of its classes and
    its prediction is the index of the largest.  Status is `ok`, `no_model`, or `features_do_not_fit`
    for features that are NULL, hold a NULL or are not as many as the model's inputs.
    """
    columns = requests.columns
    new = T.StructType.fromDDL("prediction double, scores array<double>, status string")
    schema = T.StructType([*requests.schema.fields, *new.fields])
    prepared = requests.withColumn("_x", F.col(features).cast("array<double>"))
    load = requests.groupBy("model_id").agg(F.count(F.lit(1)).alias("_asked"))
    asked = typed.join(load.select("model_id"), "model_id", "left_semi")
    size = asked.agg(F.coalesce(F.sum(F.size("values").cast("bigint") * 8 + 128), F.lit(0))).first()[0]
    if size <= broadcast_bytes:
        shared = requests.sparkSession.sparkContext.broadcast(asked.toArrow())

        def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            models = _objects(shared.value)
            for batch in batches:
                yield _with_scores(batch, columns, models)

        return prepared.mapInArrow(send, schema)

    # A model's requests are dealt over slices, so that a hot one is not a task of its own.
    sliced = load.where(F.col("model_id").isNotNull()).join(typed.select("model_id"), "model_id").select(
        F.col("model_id"), F.ceil(F.col("_asked") / slice_rows).cast("bigint").alias("_slices")
    )
    spread = prepared.join(sliced, "model_id", "left")
    slice_ = F.pmod(F.monotonically_increasing_id(), F.col("_slices"))
    known = spread.where(F.col("_slices").isNotNull()).withColumn("_slice", slice_)
    unknown = spread.where(F.col("_slices").isNull())
    copies = asked.join(sliced, "model_id").select(
        "model_id", "kind", "widths", "values", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("_slices") - 1)).alias("_slice")
    )
    names = [*columns, "prediction", "scores", "status"]

    def meet(rows: pa.Table, models: pa.Table) -> pa.Table:
        made = [_with_scores(b, columns, _objects(models)) for b in rows.combine_chunks().to_batches()]
        return pa.Table.from_batches(made) if made else pa.table({n: [] for n in names})

    met = (
        known.select(*columns, "_x", "_slice").groupBy("model_id", "_slice")
        .cogroup(copies.groupBy("model_id", "_slice"))
        .applyInArrow(meet, schema)
    )
    left = unknown.select(
        *columns, F.lit(None).cast("double").alias("prediction"), F.lit(None).cast("array<double>").alias("scores"), F.lit("no_model").alias("status")
    )
    return met.unionByName(left)
