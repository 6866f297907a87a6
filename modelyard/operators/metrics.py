"""Evaluation metrics as aggregate expressions: any number of them in one pass."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F

Metric = Callable[[Column, Column], Column]


def _error(y: Column, p: Column) -> Column:
    return y.cast("double") - p.cast("double")


def _paired_target(y: Column, p: Column) -> Column:
    """Target of rows that have both sides, so that every metric sees the same rows."""
    return F.when(_error(y, p).isNotNull(), y.cast("double"))


def paired_rows(y: Column, p: Column) -> Column:
    """Rows that have both sides; labels may be text."""
    return F.count(F.when(y.isNotNull() & p.isNotNull(), F.lit(1)))


def mse(y: Column, p: Column) -> Column:
    return F.avg(_error(y, p) * _error(y, p))


def rmse(y: Column, p: Column) -> Column:
    return F.sqrt(mse(y, p))


def mae(y: Column, p: Column) -> Column:
    return F.avg(F.abs(_error(y, p)))


def r2(y: Column, p: Column) -> Column:
    """1 - SSE/SST around the mean.  A constant target gives 1 for a perfect prediction, else 0."""
    sse = F.sum(_error(y, p) * _error(y, p))
    sst = F.var_pop(_paired_target(y, p)) * F.count(_error(y, p))
    degenerate = F.when(sse == 0, F.lit(1.0)).otherwise(F.lit(0.0))
    return F.when(sst == 0, degenerate).otherwise(F.lit(1.0) - F.try_divide(sse, sst))


def max_error(y: Column, p: Column) -> Column:
    return F.max(F.abs(_error(y, p)))


def target_mean(y: Column, p: Column) -> Column:
    return F.avg(_paired_target(y, p))


def target_sum(y: Column, p: Column) -> Column:
    return F.sum(_paired_target(y, p))


def accuracy(y: Column, p: Column) -> Column:
    """Share of equal pairs; NULL without rows."""
    return F.avg((y == p).cast("double"))


METRICS: dict[str, Metric] = {
    "n": paired_rows,
    "mse": mse,
    "rmse": rmse,
    "mae": mae,
    "r2": r2,
    "max_error": max_error,
    "target_sum": target_sum,
    "target_mean": target_mean,
    "accuracy": accuracy,
}

BUNDLES: dict[str, tuple[str, ...]] = {
    "regressor": ("n", "mse", "rmse", "mae", "r2", "max_error", "target_sum", "target_mean"),
    "classifier": ("n", "accuracy"),
}


def compat_metrics(y: Column, p: Column) -> dict[str, Column]:
    """The three keys of the published training log.  There `rmse` holds the mean squared error."""
    return {"rmse": mse(y, p), "r2": r2(y, p), "mae": mae(y, p)}


def evaluate(
    df: DataFrame,
    target: str,
    prediction: str,
    model_type: str = "regressor",
    by: Sequence[str] = (),
    extra: Mapping[str, Metric] | None = None,
) -> DataFrame:
    """Metric bundle of a model type, plus caller-supplied metrics, in a single aggregation."""
    if model_type not in BUNDLES:
        raise ValueError(f"unknown model type: {model_type!r}")
    chosen = {name: METRICS[name] for name in BUNDLES[model_type]} | dict(extra or {})
    y, p = F.col(target), F.col(prediction)
    return df.groupBy(*by).agg(*[metric(y, p).alias(name) for name, metric in chosen.items()])


def metric_rows(wide: DataFrame, keys: Sequence[str], constants: Sequence[str]) -> DataFrame:
    """Metric columns to (key, value) rows; the constants travel along."""
    pairs = F.array(
        *[F.struct(F.lit(k).alias("key"), F.col(k).cast("double").alias("value")) for k in keys]
    )
    return wide.select(*constants, F.inline(pairs))


def map_rows(df: DataFrame, metric_map: str, constants: Sequence[str]) -> DataFrame:
    """A metric map to (key, value) rows."""
    return df.select(*constants, F.explode(metric_map).alias("key", "value"))


def train_test_gap(
    metrics: DataFrame, model: str = "model_id", key: str = "key", dataset: str = "dataset", value: str = "value"
) -> DataFrame:
    """Train and test value side by side with their difference; one value per (model, key, dataset)."""
    return (
        metrics.groupBy(model, key)
        .agg(
            F.max(F.when(F.col(dataset) == "train", F.col(value))).alias("train"),
            F.max(F.when(F.col(dataset) == "test", F.col(value))).alias("test"),
        )
        .withColumn("gap", F.col("test") - F.col("train"))
    )


def cross_entropy_term(logits: Column, label: Column) -> Column:
    """log(sum(exp z)) - z[label], shifted by the maximum."""
    top = F.array_max(logits).cast("double")
    total = F.aggregate(logits, F.lit(0.0), lambda acc, z: acc + F.exp(z.cast("double") - top))
    return top + F.log(total) - F.get(logits, label.cast("int")).cast("double")


def cross_entropy(df: DataFrame, logits: str, label: str) -> DataFrame:
    """Mean loss over the rows that have a valid label."""
    term = cross_entropy_term(F.col(logits), F.col(label))
    return df.agg(F.count(term).alias("n"), F.avg(term).alias("loss"))
