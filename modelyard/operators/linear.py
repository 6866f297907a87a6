"""Linear models: fitting, coefficient tables, scoring one model or many."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import LinearRegression
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from modelyard.functions.scalars import dot_arrays, dot_literals
from modelyard.schemas import COEFFICIENTS

# Penalty strength and share of the absolute-value part.
ALPHA = 0.5
L1_RATIO = 0.5

INTERCEPT = -1
BROADCAST_BYTES = 32 << 20
_SALTS = 1024


@dataclass(frozen=True)
class LinearModel:
    weights: tuple[float, ...]
    intercept: float

    def score(self, features: Column) -> Column:
        return dot_literals(features, list(self.weights), self.intercept)

    def to_table(self, spark: SparkSession, model_id: str) -> DataFrame:
        """(model_id, idx, value); the intercept has index -1."""
        rows = [(model_id, INTERCEPT, float(self.intercept))]
        rows += [(model_id, i, float(w)) for i, w in enumerate(self.weights)]
        return spark.createDataFrame(rows, COEFFICIENTS)


def load_model(coefficients: DataFrame, model_id: str) -> LinearModel:
    """One model read back; the rows fetched are its features, not its data."""
    values = {r["idx"]: r["value"] for r in coefficients.where(F.col("model_id") == model_id).collect()}
    if not values:
        raise LookupError(f"no coefficients for {model_id}")
    width = max(values) + 1
    return LinearModel(tuple(values.get(i, 0.0) for i in range(width)), values.get(INTERCEPT, 0.0))


def fit_elastic_net(
    df: DataFrame,
    features: str,
    label: str,
    alpha: float = ALPHA,
    l1_ratio: float = L1_RATIO,
    max_iter: int = 1000,
    tol: float = 1e-12,
) -> LinearModel:
    """Minimise 1/(2n) |y - Xw - b|^2 + alpha*l1_ratio*|w|_1 + alpha*(1-l1_ratio)/2*|w|^2.

    Spark fits against the label divided by its standard deviation s, which scales the two penalty
    parts differently; the parameters passed on undo that.
    """
    if alpha < 0 or not 0 <= l1_ratio <= 1:
        raise ValueError("alpha must not be negative and l1_ratio must lie in [0, 1]")
    rows = df.select(F.col(features), F.col(label).cast("double").alias("_y")).where(
        F.col(features).isNotNull() & F.col("_y").isNotNull()
    )
    facts = rows.agg(
        F.count(F.lit(1)).alias("n"), F.avg("_y").alias("mean"), F.stddev_samp("_y").alias("s"), F.max(F.size(features)).alias("d")
    ).first()
    if facts["n"] == 0:
        raise ValueError("no rows to fit")
    if not facts["s"]:
        return LinearModel((0.0,) * facts["d"], facts["mean"])
    absolute = alpha * l1_ratio
    squared = alpha * (1 - l1_ratio) * facts["s"]
    strength = absolute + squared
    fitted = LinearRegression(
        featuresCol="_x",
        labelCol="_y",
        regParam=strength,
        elasticNetParam=absolute / strength if strength else 0.0,
        standardization=False,
        solver="l-bfgs",
        maxIter=max_iter,
        tol=tol,
    ).fit(rows.select(array_to_vector(F.col(features).cast("array<double>")).alias("_x"), "_y"))
    return LinearModel(tuple(float(w) for w in fitted.coefficients), float(fitted.intercept))


def score(df: DataFrame, features: str, model: LinearModel, out: str = "prediction") -> DataFrame:
    """Linear prediction as generated arithmetic, no Python."""
    return df.withColumn(out, model.score(F.col(features)))


def packed_models(coefficients: DataFrame) -> DataFrame:
    """Coefficient rows to one row per model: (model_id, weights, intercept)."""
    pair = F.when(F.col("idx") >= 0, F.struct("idx", "value"))
    return (
        coefficients.groupBy("model_id")
        .agg(
            F.array_sort(F.collect_list(pair)).alias("_pairs"),
            F.max(F.when(F.col("idx") == INTERCEPT, F.col("value"))).alias("_b"),
        )
        .select(
            "model_id",
            F.transform("_pairs", lambda p: p["value"]).alias("weights"),
            F.coalesce("_b", F.lit(0.0)).alias("intercept"),
        )
    )


def score_assigned(
    rows: DataFrame,
    assignments: DataFrame,
    models: DataFrame,
    features: str = "features",
    dataset: str = "dataset",
    row_key: str = "row_key",
    keep: Sequence[str] = (),
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Every row scored by the models assigned to its dataset.

    The models are joined on the dataset.  They are broadcast when their measured size allows it;
    otherwise both sides are spread over salts, because a dataset key is always a hot key.
    """
    assigned = assignments.select(dataset, "model_id").distinct().join(models, "model_id")
    size = assigned.agg(
        F.coalesce(F.sum(F.size("weights").cast("bigint") * 8 + 64), F.lit(0)).alias("bytes")
    ).first()["bytes"]
    narrow = rows.select(dataset, row_key, features, *keep)
    if size <= broadcast_bytes:
        joined = narrow.join(F.broadcast(assigned), dataset)
    else:
        salted = narrow.withColumn("_salt", F.pmod(F.xxhash64(row_key), F.lit(_SALTS)))
        copies = assigned.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(_SALTS - 1).cast("bigint"))))
        joined = salted.join(copies, [dataset, "_salt"]).drop("_salt")
    prediction = dot_arrays(F.col(features), F.col("weights")) + F.col("intercept")
    return joined.select("model_id", dataset, row_key, *keep, prediction.alias("prediction"))
