"""Metrics that no single expression gives: a state per Arrow batch, merged by group.

A metric says how a batch of rows becomes a state of fixed size, how states add up and what a finished
state means.  Tasks keep one state for each group they see; what meets in the shuffle is states.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T


@dataclass(frozen=True)
class Mergeable:
    """`state` maps the value columns of some rows, as numpy arrays without NULLs, to `size` numbers; states
    of the same group are added element by element; `finish` maps the added state, an array column, to
    the metric."""

    size: int
    state: Callable[..., np.ndarray]
    finish: Callable[[Column], Column]


def _groups(columns: list[pa.Array], n: int) -> tuple[np.ndarray, np.ndarray]:
    """(first row, group number of each row) of rows that agree in all columns, NULL being a value."""
    if not columns:
        return np.zeros(1, np.int64), np.zeros(n, np.int64)
    codes = np.stack([pc.dictionary_encode(c, null_encoding="encode").indices.to_numpy() for c in columns])
    _, first, group = np.unique(codes, axis=1, return_index=True, return_inverse=True)
    return first, group.ravel()


def aggregate(df: DataFrame, by: Sequence[str], metrics: dict[str, tuple[Mergeable, Sequence[str]]]) -> DataFrame:
    """`by` and one column for each metric, from one pass: {name: (metric, its value columns)}.

    A row with a NULL in one of a metric's columns does not count for that metric; a group of which no row
    counts has the metric of an empty state; NULL is a group of its own.  Without `by` the whole table is
    one group, which has a row even if the table has none.  Groups are columns of plain types.
    """
    if not metrics:
        raise ValueError("no metrics")
    values = list(dict.fromkeys(c for _, columns in metrics.values() for c in columns))
    place = {c: f"_v{i}" for i, c in enumerate(values)}
    keys = [f"_k{i}" for i in range(len(by))]
    size = sum(m.size for m, _ in metrics.values())
    table = df.select(
        *[F.col(c).alias(k) for c, k in zip(by, keys)], *[F.col(c).cast("double").alias(p) for c, p in place.items()]
    )
    schema = T.StructType([*[table.schema[k] for k in keys], T.StructField("_s", T.ArrayType(T.DoubleType()))])

    def states(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            first, group = _groups([batch.column(k) for k in keys], batch.num_rows)
            order = np.argsort(group, kind="stable")
            edges = np.searchsorted(group[order], np.arange(len(first) + 1))
            columns = {c: batch.column(p).to_numpy(zero_copy_only=False) for c, p in place.items()}
            known = {c: ~batch.column(p).is_null().to_numpy(zero_copy_only=False) for c, p in place.items()}
            found = np.zeros((len(first), size))
            for g in range(len(first)):
                rows, at = order[edges[g] : edges[g + 1]], 0
                for metric, names in metrics.values():
                    whole = rows[np.all([known[c][rows] for c in names], axis=0)]
                    if len(whole):
                        found[g, at : at + metric.size] = metric.state(*[columns[c][whole] for c in names])
                    at += metric.size
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(k).take(pa.array(first)) for k in keys], pa.array(list(found), pa.list_(pa.float64()))], [*keys, "_s"]
            )

    # States of a task's batches are added before the shuffle; a group ends as `size` numbers.
    added = table.mapInArrow(states, schema).select(*keys, F.posexplode("_s").alias("_i", "_x")).groupBy(*keys, "_i").agg(F.sum("_x").alias("_x"))
    whole = F.transform(F.array_sort(F.collect_list(F.struct("_i", "_x"))), lambda e: e["_x"])
    merged = added.groupBy(*keys).agg(whole.alias("_s"))
    state = F.when(F.size("_s") > 0, F.col("_s")).otherwise(F.array_repeat(F.lit(0.0), size))
    at, out = 0, []
    for name, (metric, _) in metrics.items():
        out.append(metric.finish(F.slice("_s", at + 1, metric.size)).alias(name))
        at += metric.size
    return merged.withColumn("_s", state).select(*[F.col(k).alias(c) for c, k in zip(by, keys)], *out)


def area_under_curve(bins: int = 100) -> Mergeable:
    """Area under the ROC curve from scores between 0 and 1 in equal bins: (label 0 or 1, score).

    Exact for the binned scores: pairs within a bin count as ties.  NULL without both labels; scores beyond the
    ends count in the outer bins.
    """

    def state(label: np.ndarray, score: np.ndarray) -> np.ndarray:
        place = np.clip(np.floor(score * bins), 0, bins - 1).astype(int)
        return np.bincount(place + bins * (label > 0.5), minlength=2 * bins)

    def finish(s: Column) -> Column:
        zeros, ones = F.slice(s, 1, bins), F.slice(s, bins + 1, bins)
        start = F.struct(F.lit(0.0).alias("below"), F.lit(0.0).alias("won"), F.lit(0.0).alias("ones"))
        step = lambda a, p: F.struct(
            (a["below"] + p["z"]).alias("below"),
            (a["won"] + p["o"] * (a["below"] + p["z"] / 2)).alias("won"),
            (a["ones"] + p["o"]).alias("ones"),
        )
        pairs = F.zip_with(zeros, ones, lambda z, o: F.struct(z.alias("z"), o.alias("o")))
        return F.aggregate(pairs, start, step, lambda a: F.try_divide(a["won"], a["below"] * a["ones"]))

    return Mergeable(2 * bins, state, finish)


def calibration_error(bins: int = 10) -> Mergeable:
    """Mean distance of score and share of label 1, over equal bins of the score: (label, score)."""

    def state(label: np.ndarray, score: np.ndarray) -> np.ndarray:
        place = np.clip(np.floor(score * bins), 0, bins - 1).astype(int)
        return np.concatenate([np.bincount(place, weights, bins) for weights in (None, label, score)])

    def finish(s: Column) -> Column:
        n, apart = F.slice(s, 1, bins), F.zip_with(F.slice(s, bins + 1, bins), F.slice(s, 2 * bins + 1, bins), lambda y, p: F.abs(y - p))
        total = lambda a: F.aggregate(a, F.lit(0.0), lambda x, y: x + y)
        return F.try_divide(total(apart), total(n))

    return Mergeable(3 * bins, state, finish)
