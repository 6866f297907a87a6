"""Feature and label preparation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from modelyard.functions.scalars import binary_label


def features_of(df: DataFrame, label: str) -> DataFrame:
    """Everything but the label column."""
    return df.drop(label)


def label_of(df: DataFrame, label: str) -> DataFrame:
    return df.select(label)


def positional_split(df: DataFrame) -> DataFrame:
    """All columns but the last as one FLOAT array, the last as BIGINT class index."""
    *features, target = df.columns
    return df.select(
        F.array(*[F.col(f"`{c}`").cast("float") for c in features]).alias("features"),
        F.col(f"`{target}`").cast("bigint").alias("target"),
    )


def unpack_features(df: DataFrame, array_column: str, width: int, prefix: str = "f") -> DataFrame:
    """One DOUBLE column per array element, in place of the array.

    An array of another length than `width` is an error; a NULL array gives NULLs.
    """
    kept = [c for c in df.columns if c != array_column]
    array = F.col(array_column)
    fits = array.isNull() | (F.size(array) == width)
    found = F.concat(F.lit(f"{array_column}: {width} elements expected, found "), F.size(array).cast("string"))
    checked = F.when(fits, array).otherwise(F.raise_error(found))
    elements = [F.get(checked, F.lit(i)).cast("double").alias(f"{prefix}{i}") for i in range(width)]
    return df.select(*elements, *kept)


def with_binary_label(df: DataFrame, target: str, positive: int, out: str = "quality") -> DataFrame:
    return df.withColumn(out, binary_label(F.col(target), positive))


def shape_summary(df: DataFrame, features: Column, label: Column) -> DataFrame:
    """Rows, feature counts and distinct classes; the class count sizes a network's output."""
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.min(F.size(features)).cast("bigint").alias("min_features"),
        F.max(F.size(features)).cast("bigint").alias("max_features"),
        F.countDistinct(label).alias("n_classes"),
    )


def every_nth_step(df: DataFrame, step: str, n: int) -> DataFrame:
    """Rows whose step is a multiple of n, step 0 included."""
    if n < 1:
        raise ValueError("n must be positive")
    return df.where(F.col(step) % n == 0)
