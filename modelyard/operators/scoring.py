"""Metrics of many linear models on many datasets without a row for every prediction.

A task multiplies an Arrow batch of features with the weight matrix of the models assigned to its
dataset and keeps sums for every (model, dataset); only those leave it.  A set of models too large to
send along is cut into blocks of bounded size, and each dataset's rows, cut into slices, meet the
blocks; rows are copied once for a block of models, never for a model.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

BROADCAST_BYTES = 32 << 20
SLICE_ROWS = 1 << 16
_FIELDS = ("n", "total", "spread", "squares", "absolute", "largest")
_SUMS = "model_id string, dataset string, " + ", ".join(f"{f} double" for f in _FIELDS)


class _Models:
    """The models of each dataset as one weight matrix."""

    def __init__(self, table: pa.Table) -> None:
        self.names, self.weights, self.intercepts, self.classes = {}, {}, {}, {}
        rows: dict[str, list[dict]] = {}
        for row in table.to_pylist():
            rows.setdefault(row["dataset"], []).append(row)
        for dataset, found in rows.items():
            width = max(len(r["weights"]) for r in found)
            self.names[dataset] = [r["model_id"] for r in found]
            self.weights[dataset] = np.array([r["weights"] + [0.0] * (width - len(r["weights"])) for r in found])
            self.intercepts[dataset] = np.array([r["intercept"] for r in found])
            self.classes[dataset] = [r["one_of"] for r in found]
        self.sums: dict[str, np.ndarray] = {}

    def add(self, dataset: str, x: np.ndarray, y: np.ndarray | None, label: np.ndarray | None) -> None:
        """Sums over some rows of a dataset; the spread of the target is kept around its own mean, so
        that it does not drown in a large mean."""
        weights = self.weights[dataset]
        width = max(x.shape[1], weights.shape[1])
        pad = lambda a: a if a.shape[1] == width else np.pad(a, ((0, 0), (0, width - a.shape[1])))
        predicted = pad(x) @ pad(weights).T + self.intercepts[dataset]
        if label is None:
            target = np.broadcast_to(y[:, None], predicted.shape)
        else:
            target = (label[:, None] == np.array(self.classes[dataset], label.dtype)[None, :]).astype(float)
        error = target - predicted
        mean = target.mean(axis=0)
        fresh = np.stack(
            [
                np.full(len(weights), float(len(x))), target.sum(axis=0), ((target - mean) ** 2).sum(axis=0),
                (error**2).sum(axis=0), np.abs(error).sum(axis=0), np.abs(error).max(axis=0),
            ]
        )
        held = self.sums.get(dataset)
        if held is None:
            self.sums[dataset] = fresh
            return
        apart = fresh[1] / fresh[0] - held[1] / held[0]
        held[2] += fresh[2] + apart**2 * held[0] * fresh[0] / (held[0] + fresh[0])
        held[[0, 1, 3, 4]] += fresh[[0, 1, 3, 4]]
        held[5] = np.maximum(held[5], fresh[5])

    def rows(self) -> Iterator[pa.RecordBatch]:
        for dataset, sums in self.sums.items():
            names = self.names[dataset]
            yield pa.RecordBatch.from_arrays(
                [pa.array(names), pa.array([dataset] * len(names)), *[pa.array(s) for s in sums]], ["model_id", "dataset", *_FIELDS]
            )


def _add_batch(models: _Models, batch: pa.RecordBatch | pa.Table, by_class: bool) -> None:
    """Rows of one batch, dataset by dataset and width by width."""
    datasets = batch.column("dataset").to_numpy(zero_copy_only=False) if isinstance(batch, pa.RecordBatch) else batch["dataset"].to_numpy()
    column = batch.column("x")
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    offsets, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    y = np.asarray(batch.column("y"))
    lengths = np.diff(offsets)
    for dataset in set(datasets) & models.names.keys():
        own = datasets == dataset
        for width in np.unique(lengths[own]).tolist():
            at = np.flatnonzero(own & (lengths == width))
            x = flat[offsets[at][:, None] + np.arange(width)[None, :]].reshape(len(at), width)
            models.add(dataset, x, *((None, y[at]) if by_class else (y[at].astype(float), None)))


def _prepared(rows: DataFrame, features: str, target: str, dataset: str, by_class: bool, width: Column) -> DataFrame:
    """(dataset, x, y) of the rows that have a target and as many features as the models, none NULL."""
    x = F.col(features).cast("array<double>")
    whole = F.forall(x, lambda v: v.isNotNull())
    y = F.col(target).cast("string" if by_class else "double")
    return rows.select(F.col(dataset).alias("dataset"), x.alias("x"), y.alias("y")).where(
        F.col("dataset").isNotNull() & F.col("y").isNotNull() & F.coalesce(whole & (F.size(x) >= width), F.lit(False))
    )


def evaluate_models(
    rows: DataFrame,
    assignments: DataFrame,
    models: DataFrame,
    target: str,
    features: str = "features",
    dataset: str = "dataset",
    one_of: str | None = None,
    broadcast_bytes: int = BROADCAST_BYTES,
    slice_rows: int = SLICE_ROWS,
) -> DataFrame:
    """The regressor bundle for every assigned (model_id, dataset) that has rows.

    `models` has (model_id, weights, intercept), `assignments` (`dataset`, model_id).  The target is a number,
    or, with `one_of`, a class: 1 where it equals that column of `models`, else 0.  Rows without target,
    or with fewer features than the widest model or a NULL among them, count nowhere; additional features meet no
    weight.
    """
    one = F.col(one_of).cast("string") if one_of else F.lit(None).cast("string")
    packed = models.select("model_id", F.col("weights").cast("array<double>"), "intercept", one.alias("one_of"))
    assigned = assignments.select(F.col(dataset).alias("dataset"), "model_id").distinct().join(packed, "model_id")
    size = assigned.agg(
        F.coalesce(F.sum(F.size("weights").cast("bigint") * 8 + 64), F.lit(0)).alias("bytes"),
        F.coalesce(F.max(F.size("weights")), F.lit(0)).alias("width"),
    ).first()
    by_class = one_of is not None
    data = _prepared(rows, features, target, dataset, by_class, F.lit(size["width"]))
    if size["bytes"] <= broadcast_bytes:
        shared = rows.sparkSession.sparkContext.broadcast(assigned.orderBy("dataset", "model_id").toArrow())

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held = _Models(shared.value)
            for batch in batches:
                _add_batch(held, batch, by_class)
            yield from held.rows()

        sums = data.mapInArrow(score, _SUMS)
    else:
        sums = _by_block(data, assigned, -(-size["bytes"] // max(1, broadcast_bytes)), by_class, slice_rows)
    return _merged(sums)


def _by_block(data: DataFrame, assigned: DataFrame, blocks: int, by_class: bool, slice_rows: int) -> DataFrame:
    """Every slice of a dataset's rows meets every block of its models."""
    counted = data.groupBy("dataset").agg(F.ceil(F.count(F.lit(1)) / slice_rows).cast("bigint").alias("slices"))
    numbers = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))
    left = (
        data.join(counted, "dataset")
        .withColumn("slice", F.pmod(F.xxhash64("x", "y", F.monotonically_increasing_id()), F.col("slices")))
        .select("dataset", "slice", numbers(F.lit(blocks).cast("bigint")).alias("block"), "x", "y")
    )
    right = (
        assigned.join(counted, "dataset")
        .withColumn("block", F.pmod(F.xxhash64("model_id"), F.lit(blocks).cast("bigint")))
        .select("dataset", numbers(F.col("slices")).alias("slice"), "block", "model_id", "weights", "intercept", "one_of")
    )

    def meet(rows: pa.Table, models: pa.Table) -> pa.Table:
        held = _Models(models)
        if rows.num_rows and models.num_rows:
            _add_batch(held, rows, by_class)
        empty = [pa.array([], pa.string())] * 2 + [pa.array([], pa.float64())] * len(_FIELDS)
        return pa.Table.from_batches(list(held.rows()) or [pa.RecordBatch.from_arrays(empty, ["model_id", "dataset", *_FIELDS])])

    keys = ("dataset", "slice", "block")
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, _SUMS)


def _merged(sums: DataFrame) -> DataFrame:
    """Sums of tasks to metrics: spreads add up, plus the distances of the tasks' means from the whole one.

    The window and the aggregate share one shuffle, of as many rows as tasks have sums.
    """
    group = Window.partitionBy("model_id", "dataset")
    apart = F.col("total") / F.col("n") - F.sum("total").over(group) / F.sum("n").over(group)
    merged = sums.withColumn("between", F.col("n") * apart * apart).groupBy("model_id", "dataset").agg(
        F.sum("n").alias("n"),
        F.sum("total").alias("target_sum"),
        (F.sum("spread") + F.sum("between")).alias("sst"),
        F.sum("squares").alias("sse"),
        F.sum("absolute").alias("sae"),
        F.max("largest").alias("max_error"),
    )
    flat = F.when(F.col("sse") == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return merged.select(
        "model_id",
        "dataset",
        F.col("n").cast("bigint").alias("n"),
        (F.col("sse") / F.col("n")).alias("mse"),
        F.sqrt(F.col("sse") / F.col("n")).alias("rmse"),
        (F.col("sae") / F.col("n")).alias("mae"),
        F.when(F.col("sst") == 0, flat).otherwise(1.0 - F.try_divide("sse", "sst")).alias("r2"),
        "max_error",
        "target_sum",
        (F.col("target_sum") / F.col("n")).alias("target_mean"),
    )
