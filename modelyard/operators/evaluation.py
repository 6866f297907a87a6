"""Scoring text responses and tool calls against what was expected."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from modelyard.functions.text import lcs_lengths, shared_counts, tokens


def ratio(part: Column, whole: Column) -> Column:
    """part / whole, and 0 for an empty whole."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def f1(precision: Column, recall: Column) -> Column:
    return ratio(F.lit(2.0) * precision * recall, precision + recall)


@F.arrow_udf(T.LongType())
def _common_tokens(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array(shared_counts(a, b))


def token_overlap(df: DataFrame, response: str, expected: str) -> DataFrame:
    """Exact match and multiset token precision, recall and F1 of every row.

    Both texts are in the row, so nothing is shuffled: counting tokens by (row, token) across the
    cluster would move more bytes than the texts have.  Batches are counted in Arrow and numpy.
    """
    r, e = F.col("_r"), F.col("_e")
    return (
        df.select("*", tokens(F.col(response)).alias("_r"), tokens(F.col(expected)).alias("_e"))
        .withColumn("n_common", _common_tokens(r, e))
        .withColumn("n_response", F.size(r).cast("bigint"))
        .withColumn("n_expected", F.size(e).cast("bigint"))
        .withColumn("exact_match", (r == e).cast("int"))
        .drop("_r", "_e")
        .withColumn("precision", ratio(F.col("n_common"), F.col("n_response")))
        .withColumn("recall", ratio(F.col("n_common"), F.col("n_expected")))
        .withColumn("f1", f1(F.col("precision"), F.col("recall")))
    )


@F.arrow_udf(T.LongType())
def _common_subsequence(a: pa.Array, b: pa.Array) -> pa.Array:
    return pa.array(lcs_lengths(a, b))


def rouge_l(df: DataFrame, response: str, expected: str) -> DataFrame:
    """Longest common token subsequence of whole texts with its precision, recall and F1.  No shuffle."""
    return (
        df.select("*", tokens(F.col(response)).alias("_r"), tokens(F.col(expected)).alias("_e"))
        .withColumn("lcs", _common_subsequence("_r", "_e"))
        .withColumn("lcs_precision", ratio(F.col("lcs"), F.size("_r")))
        .withColumn("lcs_recall", ratio(F.col("lcs"), F.size("_e")))
        .withColumn("lcs_f1", f1(F.col("lcs_precision"), F.col("lcs_recall")))
        .drop("_r", "_e")
    )


def tool_call_scores(df: DataFrame, predicted: str, expected: str) -> DataFrame:
    """Precision and recall of called tools as sets; NULL counts as no calls."""
    none = F.array().cast("array<string>")
    p = F.array_distinct(F.coalesce(F.col(predicted), none))
    e = F.array_distinct(F.coalesce(F.col(expected), none))
    common = F.size(F.array_intersect(p, e))
    return (
        df.withColumn("n_common", common.cast("bigint"))
        .withColumn("n_missed", F.size(F.array_except(e, p)).cast("bigint"))
        .withColumn("n_extra", F.size(F.array_except(p, e)).cast("bigint"))
        .withColumn("tool_precision", ratio(common, F.size(p)))
        .withColumn("tool_recall", ratio(common, F.size(e)))
    )


def summarise(rows: DataFrame, by: Sequence[str] = (), extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Means of the per-row scores, plus caller-supplied aggregates, in one pass."""
    return rows.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.avg(F.col("exact_match").cast("double")).alias("exact_match"),
        F.avg("precision").alias("precision"),
        F.avg("recall").alias("recall"),
        F.avg("f1").alias("f1"),
        F.count_if(F.col("n_response") == 0).alias("n_empty_responses"),
        *[column.alias(name) for name, column in (extra or {}).items()],
    )


def schema_conformance(df: DataFrame, signature: T.StructType) -> DataFrame:
    """Each column of the signature or the table: expected and actual type, status, NULL count, range.

    Types are compared from metadata; the facts about all columns come from one aggregate.
    """
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    expected = {f.name: f.dataType.simpleString() for f in signature.fields}

    def status(name: str) -> str:
        if name not in actual:
            return "missing"
        if name not in expected:
            return "unexpected"
        return "ok" if actual[name] == expected[name] else "type_mismatch"

    names = sorted(actual.keys() | expected.keys())
    present = [n for n in names if n in actual]
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    facts = [F.count(F.lit(1)).alias("_rows")]
    for i, n in enumerate(present):
        column = F.col(f"`{n}`")
        facts.append(F.count(column).alias(f"_n{i}"))
        if n in numeric:
            facts += [F.min(column).cast("double").alias(f"_low{i}"), F.max(column).cast("double").alias(f"_high{i}")]
    counts = df.agg(*facts)

    def entry(n: str) -> Column:
        i = present.index(n) if n in actual else None
        ranged = i is not None and n in numeric
        return F.struct(
            F.lit(n).alias("column"),
            F.lit(expected.get(n)).cast("string").alias("expected"),
            F.lit(actual.get(n)).cast("string").alias("actual"),
            F.lit(status(n)).alias("status"),
            (F.col("_rows") - F.col(f"_n{i}") if i is not None else F.lit(None).cast("bigint")).alias("n_null"),
            (F.col(f"_low{i}") if ranged else F.lit(None).cast("double")).alias("lowest"),
            (F.col(f"_high{i}") if ranged else F.lit(None).cast("double")).alias("highest"),
        )

    entries = [entry(n) for n in names]
    return counts.select(F.col("_rows").alias("n_rows"), F.inline(F.array(*entries)))
