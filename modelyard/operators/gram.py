"""Elastic nets from sufficient statistics: one pass over the rows, any number of penalties.

The pass leaves counts, means and the scatter matrix of features and label, whose size depends on the
width only.  Coordinate descent then works on that matrix alone, with covariance updates and warm
starts along a path of penalties.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from modelyard.operators.linear import INTERCEPT, LinearModel

#: The statistics hold the square of this many numbers.
MAX_WIDTH = 4096


@dataclass(frozen=True)
class Moments:
    """`scatter`: sums of products of deviations from `mean`; the label is the last component."""

    n: int
    mean: np.ndarray
    scatter: np.ndarray

    @property
    def width(self) -> int:
        return len(self.mean) - 1


def _prepared(df: DataFrame, features: str, label: str) -> DataFrame:
    x = F.col(features).cast("array<double>")
    return df.select(x.alias("x"), F.col(label).cast("double").alias("y")).where(
        F.col("y").isNotNull() & F.coalesce(F.forall(x, lambda v: v.isNotNull()), F.lit(False))
    )


def moments(df: DataFrame, features: str, label: str) -> Moments:
    """Statistics of the rows that have a label and no NULL feature, in one pass.

    Every task centres its rows on their own mean; what the tasks' means add is put together on the
    executors, and the driver sees one matrix.  Rows of different widths are an error.
    """
    rows = _prepared(df, features, label)

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, mean, scatter = 0, None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            lengths = np.diff(batch.column("x").offsets.to_numpy())
            width = int(lengths[0])
            if (lengths != width).any() or (mean is not None and len(mean) != width + 1) or width > MAX_WIDTH:
                raise ValueError(f"rows need the same number of features, at most {MAX_WIDTH}")
            x = batch.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, width)
            z = np.column_stack([x, batch.column("y").to_numpy(zero_copy_only=False)])
            own = z.mean(axis=0)
            around = (z - own).T @ (z - own)
            if mean is None:
                n, mean, scatter = len(z), own, around
                continue
            apart = own - mean
            both = n + len(z)
            scatter = scatter + around + np.outer(apart, apart) * (n * len(z) / both)
            mean, n = mean + apart * (len(z) / both), both
        if n:
            d = len(mean)
            sums = np.concatenate([[n], n * mean, (scatter + n * np.outer(mean, mean)).ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums))), pa.array(np.full(len(sums), d)), pa.array(sums)], ["pos", "d", "v"])

    # Sums as exact decimals would not hold every scale; the order of summation moves the last digits only.
    summed = rows.mapInArrow(partial, "pos bigint, d bigint, v double").groupBy("pos").agg(
        F.sum("v").alias("v"), F.min("d").alias("least"), F.max("d").alias("most")
    )
    found = summed.toArrow()
    if not found.num_rows:
        raise ValueError("no rows to fit")
    d = found["least"][0].as_py()
    if set(found["least"].to_pylist()) | set(found["most"].to_pylist()) != {d}:
        raise ValueError("rows need the same number of features")
    flat = np.zeros(1 + d + d * d)
    flat[found["pos"].to_numpy()] = found["v"].to_numpy()
    n, mean = flat[0], flat[1 : d + 1] / flat[0]
    return Moments(int(n), mean, flat[d + 1 :].reshape(d, d) - n * np.outer(mean, mean))


def descend(
    covariance: np.ndarray, pull: np.ndarray, alpha: float, l1_ratio: float, start: np.ndarray, tol: float, sweeps: int
) -> np.ndarray:
    """Weights that minimise w'Cw/2 - c'w + alpha*l1_ratio*|w|_1 + alpha*(1-l1_ratio)/2*|w|^2.

    The products of the matrix with the weights are kept up to date, so a coordinate that stays zero
    costs nothing but a comparison.
    """
    w, product = start.copy(), covariance @ start
    diagonal = np.diag(covariance)
    absolute, squared = alpha * l1_ratio, alpha * (1 - l1_ratio)
    for _ in range(sweeps):
        largest = 0.0
        for j in range(len(w)):
            if diagonal[j] + squared <= 0:
                continue
            slope = pull[j] - product[j] + diagonal[j] * w[j]
            new = np.sign(slope) * max(abs(slope) - absolute, 0.0) / (diagonal[j] + squared)
            step = new - w[j]
            if step:
                w[j] = new
                product += step * covariance[j]
                largest = max(largest, abs(step) * diagonal[j] ** 0.5)
        if largest <= tol:
            return w
    raise RuntimeError("coordinate descent did not settle")


def fit_path(
    df: DataFrame,
    features: str,
    label: str,
    alphas: Sequence[float],
    l1_ratio: float = 0.5,
    tol: float = 1e-12,
    sweeps: int = 100_000,
) -> list[LinearModel]:
    """One model for each penalty strength, in the order given, all from one pass over the rows.

    Each minimises 1/(2n) |y - Xw - b|^2 + alpha*l1_ratio*|w|_1 + alpha*(1-l1_ratio)/2*|w|^2.
    """
    if min(alphas, default=0) < 0 or not 0 <= l1_ratio <= 1:
        raise ValueError("alphas must not be negative and l1_ratio must lie in [0, 1]")
    m = moments(df, features, label)
    covariance, pull = m.scatter[:-1, :-1] / m.n, m.scatter[:-1, -1] / m.n
    found, w = {}, np.zeros(m.width)
    for alpha in sorted(set(alphas), reverse=True):  # each start is the solution of a stronger penalty
        w = descend(covariance, pull, alpha, l1_ratio, w, tol, sweeps)
        found[alpha] = LinearModel(tuple(float(v) for v in w), float(m.mean[-1] - m.mean[:-1] @ w))
    return [found[a] for a in alphas]


def path_table(spark: SparkSession, alphas: Sequence[float], models: Sequence[LinearModel]) -> DataFrame:
    """(alpha, idx, value); the intercept has index -1."""
    rows = []
    for alpha, model in zip(alphas, models):
        rows.append((float(alpha), INTERCEPT, model.intercept))
        rows += [(float(alpha), i, w) for i, w in enumerate(model.weights)]
    return spark.createDataFrame(rows, "alpha double, idx int, value double")
