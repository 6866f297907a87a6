"""The tracking log as tables: linkage, lookup, ranking, curves, documents.

A metric log is long: (model_id, dataset, key, value, step, log_seq).  `log_seq` is unique and grows
with time of logging.  A single model may own a large part of it, so everything per model is an
aggregate with map-side combine; windows only see data already reduced to one row per step.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from modelyard.operators.blocks import BLOCK_BITS, numbered, with_previous_and_best
from modelyard.sources.shared import cut_lineage

MISSING = float("-inf")
PART_BITS = 12


def first_metric(metrics: DataFrame, key: str | None = None, dataset: str | None = None) -> DataFrame:
    """Earliest logged value per model: of one key, or of any key when none is given.

    The log itself is only aggregated over numbers, which Spark does by hashing and without a sort.
    """
    chosen = metrics
    if key is not None:
        chosen = chosen.where(F.col("key") == key)
    if dataset is not None:
        chosen = chosen.where(F.col("dataset") == dataset)
    per_key = chosen.groupBy("model_id", "key").agg(
        F.min_by("value", "log_seq").alias("value"), F.min("log_seq").alias("_seq")
    )
    if key is not None:
        return per_key.drop("_seq")
    return (
        per_key.groupBy("model_id")
        .agg(F.min_by(F.struct("key", "value"), "_seq").alias("m"))
        .select("model_id", "m.key", "m.value")
    )


def latest_metric(metrics: DataFrame, by: Sequence[str] = ("model_id", "key", "dataset")) -> DataFrame:
    """Value with the highest (step, log_seq) per group; a NULL step counts as the lowest.

    First the last value of every step, then the last step; both by hashing.
    """
    per_step = metrics.groupBy(*by, "step").agg(F.max_by("value", "log_seq").alias("value"))
    position = F.coalesce("step", F.lit(-(2**63)))
    return per_step.groupBy(*by).agg(F.max_by("value", position).alias("value"), F.max("step").alias("step"))


def score_models(models: DataFrame, metrics: DataFrame, key: str, dataset: str | None = None) -> DataFrame:
    """Every model with its first value of `key`; NaN counts as missing."""
    first = first_metric(metrics, key, dataset).select(F.col("model_id").alias("_m"), F.col("value").alias("_v"))
    value = F.when(~F.isnan("_v"), F.col("_v"))
    return (
        models.join(first, F.col("model_id") == F.col("_m"), "left")
        .withColumn("value", value)
        .withColumn("has_metric", F.col("value").isNotNull())
        .drop("_m", "_v")
    )


def sort_value(value: Column) -> Column:
    """Missing values rank below every number."""
    return F.coalesce(value, F.lit(MISSING))


def rank_models(models: DataFrame, metrics: DataFrame, key: str, dataset: str | None = None) -> DataFrame:
    """All models, best first; ties keep search order.  A range-partitioned sort, not one task."""
    return score_models(models, metrics, key, dataset).orderBy(
        sort_value(F.col("value")).desc(), F.col("search_order").asc()
    )


def with_rank(ordered: DataFrame, out: str = "rank") -> DataFrame:
    """1..n in the order of a globally sorted table, without a window over all rows.

    The sorted table is cut off from its plan, so that its partitions stay as they are; a row's number is
    its place in its partition plus the rows of the partitions before.
    """
    placed = cut_lineage(ordered).withColumn("_id", F.monotonically_increasing_id())
    # The id holds the partition in its upper bits and the place, from 0, in the lower 33.
    part, place = F.shiftright("_id", 33), F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    # One row per partition.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy(part.alias("_part"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    )
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(out, (F.col("_offset") + place + 1).cast("bigint"))
        .drop("_id", "_part", "_offset")
    )


def best_and_worst(scored: DataFrame, columns: Sequence[str] = ("model_id", "value", "has_metric")) -> DataFrame:
    """First and last of the ranking from one aggregate, without sorting.  No models, no rows."""
    place = F.struct(sort_value(F.col("value")).alias("s"), (-F.col("search_order")).alias("o"))
    row = F.struct(*columns)
    return (
        scored.agg(F.max_by(row, place).alias("best"), F.min_by(row, place).alias("worst"))
        .select(
            F.inline(
                F.array(
                    F.struct(F.lit("best").alias("place"), F.col("best").alias("m")),
                    F.struct(F.lit("worst").alias("place"), F.col("worst").alias("m")),
                )
            )
        )
        .where(F.col("m").isNotNull())
        .select("place", *[F.col(f"m.{c}").alias(c) for c in columns])
    )


def best_per_group(
    scored: DataFrame, group: Sequence[str], columns: Sequence[str] = ("model_id", "value", "has_metric")
) -> DataFrame:
    """Best model of every group, as an aggregate."""
    place = F.struct(sort_value(F.col("value")).alias("s"), (-F.col("search_order")).alias("o"))
    return (
        scored.groupBy(*group)
        .agg(F.max_by(F.struct(*columns), place).alias("m"))
        .select(*group, *[F.col(f"m.{c}").alias(c) for c in columns])
    )


def metric_curve(metrics: DataFrame, by: Sequence[str] = ("model_id", "key")) -> DataFrame:
    """One point per step (its last logged value), change from the previous point, best so far.

    The log is first reduced to one row per step, so a hot model costs as many rows as it has steps.
    """
    points = metrics.groupBy(*by, "step").agg(F.max_by("value", "log_seq").alias("value"))
    return (
        with_previous_and_best(points, by, "step", "value", "previous", "best")
        .withColumn("change", F.col("value") - F.col("previous"))
        .drop("previous")
    )


def with_facts(models: DataFrame, facts: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """Models with their facts; a model without facts stays, once, with NULLs.

    `known` is a cheaper table of the models that have facts, repeats allowed, where there is one: facts
    that are aggregates would be computed a second time only to see whose they are.

    As an inner join plus the models that have none: an inner join may broadcast the models or
    split a hot model's facts, an outer join from the models could do neither.
    """
    known = (facts if known is None else known).select("model_id").distinct()
    bare = models.join(known, "model_id", "left_anti")
    return models.join(facts, "model_id").unionByName(bare, allowMissingColumns=True)


def lineage(models: DataFrame, metrics: DataFrame, datasets: DataFrame, runs: DataFrame) -> DataFrame:
    """Models with the datasets and runs their metrics came from; a model without metrics stays.

    The log is reduced to one row per (model, run, dataset, key) before it is joined.  Small
    dimension tables are broadcast by Spark's own size check.
    """
    linked = metrics.groupBy("model_id", "run_id", "dataset", "key").agg(
        F.count(F.lit(1)).alias("n_metrics"), F.max_by("value", "log_seq").alias("last_value")
    )
    return (
        with_facts(models, linked, known=metrics)
        .join(datasets.withColumnRenamed("name", "dataset"), "dataset", "left")
        .join(runs, "run_id", "left")
    )


def lookup_models(models: DataFrame, wanted: DataFrame) -> DataFrame:
    """Models whose id is in `wanted` (batch form of fetching one by id)."""
    return models.join(wanted.select("model_id").distinct(), "model_id", "left_semi")


def lookup_model(models: DataFrame, model_id: str) -> DataFrame:
    return models.where(F.col("model_id") == F.lit(model_id))


def _block_bits(log: DataFrame) -> int:
    """Width of blocks of log positions that hold about 2^BLOCK_BITS rows, however sparse the positions are."""
    facts = log.agg(F.min("log_seq").alias("low"), F.max("log_seq").alias("high"), F.count("log_seq").alias("n")).first()
    if not facts["n"]:
        return BLOCK_BITS
    return ((facts["high"] - facts["low"] + 1) // max(1, facts["n"] >> BLOCK_BITS)).bit_length()


def model_documents(models: DataFrame, metrics: DataFrame, part_bits: int = PART_BITS) -> DataFrame:
    """Models as JSON documents with their metrics.

    A model has one document unless it has more than 2^part_bits metrics; then they come, in the order
    of the log, in parts of that many, each its own document (`part`).  A model without metrics has one
    document.
    """
    entry = F.struct("log_seq", "key", "value", "step", "dataset")
    counted = numbered(metrics, ["model_id"], "log_seq", "_number", bits=_block_bits(metrics))
    parts = (
        counted.withColumn("part", F.shiftright(F.col("_number") - 1, part_bits))
        .groupBy("model_id", "part")
        .agg(F.array_sort(F.collect_list(entry)).alias("metrics"))
    )
    attributes = [c for c in models.columns if c != "model_id"]
    empty = F.from_json(F.lit("[]"), parts.schema["metrics"].dataType)
    return with_facts(models, parts, known=metrics).select(
        "model_id",
        "part",
        F.to_json(
            F.struct("model_id", *attributes, F.coalesce("metrics", empty).alias("metrics"))
        ).alias("document"),
    )
