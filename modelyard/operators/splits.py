"""Reproducible train/test splits by row key.  The key must identify a row."""

from __future__ import annotations

from decimal import ROUND_CEILING, Decimal

from pyspark.sql import Column, DataFrame, Window, functions as F

from modelyard.functions.hashing import HASH_BITS, seeded_hash60

# Share of the test part and seed.
TEST_SHARE = "0.2"
SEED = 42

_BUCKET_BITS = 16


def _threshold(share: str) -> int:
    value = Decimal(str(share))
    if not 0 < value < 1:
        raise ValueError("test share must lie between 0 and 1")
    return int((value * (1 << HASH_BITS)).to_integral_value(ROUND_CEILING))


def is_test(key: Column, share: str = TEST_SHARE, seed: int = SEED) -> Column:
    """True for test rows: depends on key and seed only, costs no shuffle."""
    return seeded_hash60(key, seed) < F.lit(_threshold(share))


def hash_split(
    df: DataFrame, key: str, share: str = TEST_SHARE, seed: int = SEED, out: str = "dataset"
) -> DataFrame:
    """Adds `train` / `test`; the test share is met in expectation."""
    return df.withColumn(out, F.when(is_test(F.col(key), share, seed), F.lit("test")).otherwise(F.lit("train")))


def exact_split(
    df: DataFrame, key: str, share: str = TEST_SHARE, seed: int = SEED, out: str = "dataset"
) -> DataFrame:
    """Test part of exactly ceil(share * n) rows: those with the smallest key hash.

    A histogram over the top 16 hash bits finds the one bucket that the border falls into; the keys of
    that bucket (n / 2^16) are sorted to find the last test row.  Both passes read the key alone.  Then
    every row is compared with that last one, in place.
    """
    row_hash = seeded_hash60(F.col(key), seed)
    hashed = df.select(key, row_hash.alias("_h")).withColumn("_b", F.shiftright("_h", HASH_BITS - _BUCKET_BITS))
    ordered = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, 0)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    histogram = hashed.groupBy("_b").agg(F.count(F.lit(1)).alias("_n"))
    # One row per bucket, so this unpartitioned window sees 2^16 rows at most.
    border = (
        histogram.select("_b", "_n", F.sum("_n").over(ordered).alias("_upto"), F.sum("_n").over(whole).alias("_total"))
        .withColumn("_want", F.ceil(F.col("_total").cast("decimal(30,0)") * F.lit(Decimal(str(share)))).cast("bigint"))
        .where(F.col("_upto") >= F.col("_want"))
        .select("_b", (F.col("_want") - F.col("_upto") + F.col("_n")).alias("_room"))
        .agg(F.min(F.struct("_b", "_room")))
        .scalar()
    )
    last = (
        hashed.where(F.col("_b") == border["_b"])
        .withColumn("_r", F.row_number().over(Window.partitionBy("_b").orderBy("_h", key)))
        .where(F.col("_r") == border["_room"])
        .select("_h", F.col(key).alias("_key"))
        .first()
    )
    if last is None:
        return df.withColumn(out, F.lit("train"))
    last_key = F.lit(last["_key"]).cast(df.schema[key].dataType)
    inside = (row_hash < last["_h"]) | ((row_hash == last["_h"]) & (F.col(key) <= last_key))
    return df.withColumn(out, F.when(inside, F.lit("test")).otherwise(F.lit("train")))
