"""Ordered computations over groups of any size.

A window partitioned by the group alone sorts a whole group in one task.  Here a group is cut into
blocks of its integer order column: the window runs per (group, block), one summary row per block is
carried forward by a window over the summaries, and the carry is joined back.  The largest task
holds one block, or the block summaries of one group.

The (group, block) pair is one struct column: it is the partitioning of the window, of the summary
and of the join, so the rows are shuffled once, and NULL group keys match each other.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

BLOCK_BITS = 16
_PLACE = "_place"
_SLICES = 1024


def _placed(df: DataFrame, keys: Sequence[str], order: str, bits: int) -> DataFrame:
    """Block numbers are monotone in the order, also below zero."""
    block = F.shiftright(F.col(order).cast("bigint"), bits)
    return df.withColumn(_PLACE, F.struct(*keys, block.alias("_block")))


def _between_blocks(keys: Sequence[str]):
    """Window over block summaries of a group, in block order."""
    return Window.partitionBy(*[F.col(f"{_PLACE}.{k}") for k in keys]).orderBy(f"{_PLACE}._block")


def numbered(df: DataFrame, keys: Sequence[str], order: str, out: str, bits: int = BLOCK_BITS) -> DataFrame:
    """Dense 1..n per group in the order of a unique integer column."""
    placed = _placed(df, keys, order, bits)
    offsets = (
        placed.groupBy(_PLACE)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(
            _PLACE,
            F.coalesce(
                F.sum("_n").over(_between_blocks(keys).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)
            ).alias("_offset"),
        )
    )
    return (
        placed.withColumn("_in_block", F.row_number().over(Window.partitionBy(_PLACE).orderBy(order)))
        .join(offsets, _PLACE)
        .withColumn(out, (F.col("_offset") + F.col("_in_block")).cast("bigint"))
        .drop(_PLACE, "_in_block", "_offset")
    )


def with_next(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    columns: Sequence[str],
    prefix: str = "next_",
    bits: int = BLOCK_BITS,
) -> DataFrame:
    """The given columns of the next row of the group, prefixed; NULL on the group's last row."""
    placed = _placed(df, keys, order, bits)
    in_block = Window.partitionBy(_PLACE).orderBy(order)
    firsts = (
        placed.groupBy(_PLACE)
        .agg(F.min_by(F.struct(*columns), order).alias("_first"))
        .select(_PLACE, F.lead("_first").over(_between_blocks(keys)).alias("_after"))
    )
    inside = placed.select(
        "*",
        F.lead(F.lit(1)).over(in_block).isNull().alias("_closes"),
        *[F.lead(c).over(in_block).alias(f"{prefix}{c}") for c in columns],
    )
    joined = inside.join(firsts, _PLACE)
    for c in columns:
        joined = joined.withColumn(
            f"{prefix}{c}", F.when(F.col("_closes"), F.col(f"_after.{c}")).otherwise(F.col(f"{prefix}{c}"))
        )
    return joined.drop(_PLACE, "_closes", "_after")


def with_previous_and_best(
    df: DataFrame, keys: Sequence[str], order: str, value: str, previous: str, best: str, bits: int = BLOCK_BITS
) -> DataFrame:
    """Value of the preceding row and largest value so far, per group in the order of a unique column."""
    placed = _placed(df, keys, order, bits)
    in_block = Window.partitionBy(_PLACE).orderBy(order)
    earlier = _between_blocks(keys)
    carries = (
        placed.groupBy(_PLACE)
        .agg(F.max_by(value, order).alias("_last"), F.max(value).alias("_top"))
        .select(
            _PLACE,
            F.lag("_last").over(earlier).alias("_before"),
            F.max("_top").over(earlier.rowsBetween(Window.unboundedPreceding, -1)).alias("_best_before"),
        )
    )
    inside = placed.select(
        "*",
        F.lag(value).over(in_block).alias(previous),
        F.max(value).over(in_block.rowsBetween(Window.unboundedPreceding, 0)).alias(best),
        (F.row_number().over(in_block) == 1).alias("_opens"),
    )
    return (
        inside.join(carries, _PLACE)
        .withColumn(previous, F.when(F.col("_opens"), F.col("_before")).otherwise(F.col(previous)))
        .withColumn(best, F.greatest(best, "_best_before"))
        .drop(_PLACE, "_opens", "_before", "_best_before")
    )


def top_k(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], k: int, spread: Column, out: str = "rank"
) -> DataFrame:
    """First k rows per group.

    Each group is first cut into slices by `spread` (a hash of a row key) and reduced to k rows per
    slice, so no task sorts a whole hot group.
    """
    per_slice = Window.partitionBy(*keys, "_slice").orderBy(*order)
    per_group = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn("_slice", F.pmod(F.xxhash64(spread), F.lit(_SLICES)))
        .withColumn("_r", F.row_number().over(per_slice))
        .where(F.col("_r") <= k)
        .withColumn(out, F.row_number().over(per_group).cast("bigint"))
        .where(F.col(out) <= k)
        .drop("_slice", "_r")
    )
