"""A two-layer ReLU classifier trained with full-batch gradients computed by the executors.

The two training columns are kept by the executors.  Each update is one job: every task sums its
gradient over Arrow batches, the sums meet element by element in an aggregation, and the driver only
ever sees one gradient, whose size is that of the model.  The second sum is one of decimals, so it does
not depend on the order in which tasks end, and a training that was stopped goes on to the same weights.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from modelyard.schemas import TRAINING_STATES as STATES

# Layer width, step size, number of updates, checkpoint distance, Adam constants.
HIDDEN = 16
LEARNING_RATE = 0.01
EPOCHS = 101
CHECKPOINT_EVERY = 10
ADAM_BETA1 = 0.9
ADAM_BETA2 = 0.999
ADAM_EPSILON = 1e-8

_EXACT = "decimal(38,18)"


@dataclass(frozen=True)
class Shape:
    inputs: int
    hidden: int
    classes: int

    @property
    def size(self) -> int:
        return self.hidden * (self.inputs + 1) + self.classes * (self.hidden + 1)

    def unpack(self, flat: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Weights and biases of both layers as views of one vector."""
        cuts = np.cumsum([self.hidden * self.inputs, self.hidden, self.classes * self.hidden])
        w1, b1, w2, b2 = np.split(flat, cuts)
        return w1.reshape(self.hidden, self.inputs), b1, w2.reshape(self.classes, self.hidden), b2


@dataclass(frozen=True)
class State:
    """All that a training needs to go on: updates made, weights, and the optimiser's two moments."""

    step: int
    weights: np.ndarray
    first: np.ndarray
    second: np.ndarray

    @staticmethod
    def start(weights: np.ndarray) -> State:
        return State(0, weights, np.zeros(len(weights)), np.zeros(len(weights)))


@dataclass
class Training:
    """Loss before each update, the weights after every n-th one, and the state after the last."""

    shape: Shape
    losses: list[float] = field(default_factory=list)
    checkpoints: list[tuple[int, np.ndarray]] = field(default_factory=list)
    state: State | None = None

    def checkpoint_rows(self, name_prefix: str) -> list[tuple[str, int, list[float]]]:
        return [(f"{name_prefix}-{step}", step, [float(v) for v in flat]) for step, flat in self.checkpoints]


def initial_weights(shape: Shape, seed: int) -> np.ndarray:
    """Uniform in +-1/sqrt(fan-in) for weights and biases of each layer."""
    draw = np.random.default_rng(seed)
    first, second = 1 / np.sqrt(shape.inputs), 1 / np.sqrt(shape.hidden)
    return np.concatenate(
        [
            draw.uniform(-first, first, shape.hidden * (shape.inputs + 1)),
            draw.uniform(-second, second, shape.classes * (shape.hidden + 1)),
        ]
    )


def forward(shape: Shape, flat: np.ndarray, x: np.ndarray) -> np.ndarray:
    w1, b1, w2, b2 = shape.unpack(flat)
    return np.maximum(x @ w1.T + b1, 0.0) @ w2.T + b2


def gradient_sum(shape: Shape, flat: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """[gradient..., loss, rows] summed over the rows."""
    w1, b1, w2, b2 = shape.unpack(flat)
    hidden = np.maximum(x @ w1.T + b1, 0.0)
    logits = hidden @ w2.T + b2
    shifted = logits - logits.max(axis=1, keepdims=True)
    exponents = np.exp(shifted)
    total = exponents.sum(axis=1, keepdims=True)
    rows = np.arange(len(y))
    loss = (np.log(total[:, 0]) - shifted[rows, y]).sum()
    delta = exponents / total
    delta[rows, y] -= 1.0
    back = (delta @ w2) * (hidden > 0)
    return np.concatenate(
        [(back.T @ x).ravel(), back.sum(axis=0), (delta.T @ hidden).ravel(), delta.sum(axis=0), [loss, len(y)]]
    )


def adam(state: State, gradient: np.ndarray, rate: float) -> State:
    """The state after one more update."""
    step = state.step + 1
    first = ADAM_BETA1 * state.first + (1 - ADAM_BETA1) * gradient
    second = ADAM_BETA2 * state.second + (1 - ADAM_BETA2) * gradient**2
    mean = first / (1 - ADAM_BETA1**step)
    spread = np.sqrt(second / (1 - ADAM_BETA2**step))
    return State(step, state.weights - rate * mean / (spread + ADAM_EPSILON), first, second)


_SUMS = T.StructType([T.StructField("pos", T.IntegerType()), T.StructField("v", T.DoubleType())])


def training_rows(df: DataFrame, features: str, label: str, shape: Shape | None = None) -> DataFrame:
    """FLOAT features and BIGINT class; rows that lack one are left out.

    With a shape, a class outside of its range, another number of features or a NULL among them is an error.
    """
    rows = df.select(F.col(features).cast("array<float>").alias("x"), F.col(label).cast("bigint").alias("y")).where(
        "x is not null and y is not null"
    )
    if shape is None:
        return rows
    y_fits = F.col("y").between(0, shape.classes - 1)
    x_fits = (F.size("x") == shape.inputs) & ~F.exists("x", lambda e: e.isNull())
    bad_y = F.concat(F.lit(f"class outside of 0..{shape.classes - 1}: "), F.col("y").cast("string"))
    bad_x = F.lit(f"features must be {shape.inputs} numbers")
    return rows.select(
        F.when(x_fits, F.col("x")).otherwise(F.raise_error(bad_x)).alias("x"),
        F.when(y_fits, F.col("y")).otherwise(F.raise_error(bad_y)).alias("y"),
    )


def _matrix(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """Features and classes of an Arrow batch; the list column is one buffer, so no row is touched."""
    y = batch.column("y").to_numpy(zero_copy_only=False)
    x = batch.column("x").flatten().to_numpy(zero_copy_only=False)
    return x.reshape(len(y), -1).astype(np.float64), y


def _partial_sums(rows: DataFrame, shape: Shape, flat: np.ndarray) -> DataFrame:
    """(pos, v): [gradient..., loss, rows] summed over each task's rows."""
    size = shape.size + 2

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = np.zeros(size)
        for batch in batches:
            if batch.num_rows:
                held += gradient_sum(shape, flat, *_matrix(batch))
        if not np.isfinite(held).all():
            raise ValueError("the gradient is not finite")
        if held[-1] > 0:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(size, dtype=np.int32)), pa.array(held)], ["pos", "v"])

    return rows.mapInArrow(partial, _SUMS)


def gradient_table(df: DataFrame, features: str, label: str, shape: Shape, flat: np.ndarray) -> DataFrame:
    """(pos, v) over all rows: one row per weight, then the loss and the number of rows, all as sums."""
    return _whole_sums(training_rows(df, features, label, shape), shape, flat)


def _whole_sums(rows: DataFrame, shape: Shape, flat: np.ndarray) -> DataFrame:
    """The tasks' sums added on the executors, exactly: whatever the order, the result is the same."""
    sums = _partial_sums(rows, shape, flat)
    return sums.groupBy("pos").agg(F.sum(F.col("v").cast(_EXACT)).cast("double").alias("v"))


def _gradient(rows: DataFrame, shape: Shape, flat: np.ndarray) -> tuple[np.ndarray, float, int]:
    collected = _whole_sums(rows, shape, flat).toArrow()
    summed = np.zeros(shape.size + 2)
    summed[collected["pos"].to_numpy()] = collected["v"].to_numpy()
    n_rows = int(summed[-1])
    if n_rows == 0:
        raise ValueError("no rows to train on")
    return summed[:-2] / n_rows, summed[-2] / n_rows, n_rows


def train(
    df: DataFrame,
    features: str,
    label: str,
    shape: Shape,
    epochs: int = EPOCHS,
    every: int = CHECKPOINT_EVERY,
    rate: float = LEARNING_RATE,
    seed: int = 0,
    start: np.ndarray | None = None,
    resume: State | None = None,
    keep: Callable[[State], None] | None = None,
) -> Training:
    """Full-batch training; a checkpoint holds the weights after the update of its step.

    `resume` goes on from a stored state up to `epochs` updates in all, over the same rows in the same
    partitions to the very weights of an unbroken training.  `keep` gets the state at every checkpoint, to
    store it.
    """
    state = resume or State.start(initial_weights(shape, seed) if start is None else start)
    if len(state.weights) != shape.size:
        raise ValueError(f"{len(state.weights)} weights do not fit a network of {shape.size}")
    result = Training(shape, state=state)
    rows = training_rows(df, features, label, shape).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for epoch in range(state.step, epochs):
            gradient, loss, _ = _gradient(rows, shape, state.weights)
            state = adam(state, gradient, rate)
            result.losses.append(loss)
            if epoch % every == 0:
                result.checkpoints.append((epoch, state.weights))
                if keep:
                    keep(state)
    finally:
        rows.unpersist()
    result.state = state
    return result


def state_table(spark: SparkSession, name: str, state: State) -> DataFrame:
    """(name, step, pos, weight, first, second): one row for each weight."""
    rows = zip(state.weights.tolist(), state.first.tolist(), state.second.tolist())
    return spark.createDataFrame([(name, state.step, i, *r) for i, r in enumerate(rows)], STATES)


def load_state(states: DataFrame, name: str) -> State | None:
    """The furthest stored state of a training, if there is one; states with rows missing do not count."""
    own = states.where(F.col("name") == name)
    whole = own.groupBy("step").agg(F.count(F.lit(1)).alias("n"), F.max("pos").alias("last"))
    step = whole.where(F.col("n") == F.col("last") + 1).agg(F.max("step")).first()[0]
    if step is None:
        return None
    found = own.where(F.col("step") == step).orderBy("pos").select("weight", "first", "second").toPandas()
    return State(step, *(found[c].to_numpy(np.float64) for c in ("weight", "first", "second")))


def checkpoint_table(spark: SparkSession, training: Training, name_prefix: str) -> DataFrame:
    schema = "name string, step bigint, weights array<double>"
    return spark.createDataFrame(training.checkpoint_rows(name_prefix), schema)


def predict(df: DataFrame, features: str, shape: Shape, flat: np.ndarray, out: str = "scores") -> DataFrame:
    """Class scores of every row by an Arrow-batched forward pass; NULL where the features are
    NULL, hold a NULL or are not as many as the network has inputs."""

    @F.arrow_udf(T.ArrayType(T.DoubleType()))
    def scores(x: pa.Array) -> pa.Array:
        x = x.cast(pa.list_(pa.float32()))
        whole = fitting(x, shape.inputs)
        rows = x.filter(pa.array(whole)).flatten().to_numpy().reshape(-1, shape.inputs).astype(np.float64)
        ends = np.append(0, np.cumsum(whole)) * shape.classes
        made = pa.array(forward(shape, flat, rows).ravel())
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), made, mask=pa.array(~whole))

    return df.withColumn(out, scores(F.col(features).cast("array<float>")))


def fitting(x: pa.ListArray, width: int) -> np.ndarray:
    """Which rows are lists of `width` numbers, none of them NULL."""
    right = pc.fill_null(pc.equal(pc.list_value_length(x), width), False).to_numpy(zero_copy_only=False)
    flat = x.flatten()
    if flat.null_count:
        lengths = pc.fill_null(pc.list_value_length(x), 0).to_numpy()
        owner = np.repeat(np.arange(len(x)), lengths)
        right = right.copy()
        right[owner[flat.is_null().to_numpy(zero_copy_only=False)]] = False
    return right


def checkpoint_accuracy(df: DataFrame, features: str, label: str, training: Training) -> DataFrame:
    """(step, n, accuracy) of all checkpoints from one pass: tasks count hits per checkpoint."""
    shape, checkpoints = training.shape, training.checkpoints
    schema = "step bigint, hits bigint, n bigint"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hits, n_rows = np.zeros(len(checkpoints), np.int64), 0
        for batch in batches:
            if batch.num_rows:
                x, y = _matrix(batch)
                hits += [int((forward(shape, flat, x).argmax(axis=1) == y).sum()) for _, flat in checkpoints]
                n_rows += len(y)
        if n_rows:
            steps = np.array([step for step, _ in checkpoints], np.int64)
            yield pa.RecordBatch.from_pydict({"step": steps, "hits": hits, "n": np.full(len(steps), n_rows)})

    return (
        training_rows(df, features, label)
        .mapInArrow(count, schema)
        .groupBy("step")
        .agg(F.sum("n").alias("n"), F.sum("hits").alias("hits"))
        .select("step", "n", (F.col("hits") / F.col("n")).alias("accuracy"))
    )
