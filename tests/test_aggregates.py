"""Mergeable metrics against plain computations."""

from __future__ import annotations

from datetime import datetime

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelyard.operators import aggregates


def _auc(label, score, bins):
    b = np.clip(np.floor(np.array(score) * bins), 0, bins - 1)
    ones, zeros = b[np.array(label) == 1], b[np.array(label) == 0]
    if not len(ones) or not len(zeros):
        return None
    return float((ones[:, None] > zeros[None]).mean() + (ones[:, None] == zeros[None]).mean() / 2)


def test_area_by_group_equals_all_pairs(spark):
    draw = np.random.default_rng(3)
    rows = []
    for i in range(900):
        group = "hot" if i % 3 else f"g{i % 4}"
        y = int(draw.random() < 0.4)
        rows.append((group, datetime(2024, 1, 1 + i % 2, 3, 4, 5, 678901), y, float(np.clip(draw.normal(0.4 + 0.2 * y, 0.3), 0, 1))))
    rows += [(None, None, 1, 0.5), (None, None, 0, 0.7), ("one", None, 1, 0.5), ("none", None, None, 0.5), ("none", None, 1, None)]
    df = spark.createDataFrame(rows, "g string, t timestamp, y int, p double").repartition(6)
    chosen = {"auc": (aggregates.area_under_curve(20), ["y", "p"]), "off": (aggregates.calibration_error(5), ["y", "p"])}
    got = {(r["g"], r["t"]): r for r in aggregates.aggregate(df, ["g", "t"], chosen).collect()}
    groups = {(g, t) for g, t, _, _ in rows}
    assert got.keys() == groups
    for key in groups:
        own = [(y, p) for g, t, y, p in rows if (g, t) == key and y is not None and p is not None]
        y, p = [o[0] for o in own], [o[1] for o in own]
        assert got[key]["auc"] == pytest.approx(_auc(y, p, 20)) if own and _auc(y, p, 20) is not None else got[key]["auc"] is None
        if own:
            c = np.clip(np.floor(np.array(p) * 5), 0, 4)
            off = sum(abs(np.array(y)[c == b].sum() - np.array(p)[c == b].sum()) for b in range(5)) / len(y)
            assert got[key]["off"] == pytest.approx(off)
        else:
            assert got[key]["off"] is None


def test_whole_table_and_no_rows(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.2)], "y int, p double")
    chosen = {"auc": (aggregates.area_under_curve(), ["y", "p"])}
    assert aggregates.aggregate(df, [], chosen).collect()[0]["auc"] == 1.0
    assert [r["auc"] for r in aggregates.aggregate(df.limit(0), [], chosen).collect()] == [None]
    assert aggregates.aggregate(df.limit(0), ["y"], chosen).collect() == []
    with pytest.raises(ValueError):
        aggregates.aggregate(df, [], {})


def test_a_metric_of_ones_own(spark):
    """Moments of two columns, states of different metrics side by side."""
    covariance = aggregates.Mergeable(
        4,
        lambda a, b: np.array([len(a), a.sum(), b.sum(), (a * b).sum()]),
        lambda s: F.get(s, F.lit(3)) / F.get(s, F.lit(0)) - F.get(s, F.lit(1)) * F.get(s, F.lit(2)) / (F.get(s, F.lit(0)) * F.get(s, F.lit(0))),
    )
    count = aggregates.Mergeable(1, lambda a: np.array([len(a)]), lambda s: F.get(s, F.lit(0)))
    df = spark.range(1000).selectExpr("id % 3 AS g", "CAST(id AS double) AS a", "CAST(id * id % 17 AS double) AS b").repartition(7)
    got = aggregates.aggregate(df, ["g"], {"c": (covariance, ["a", "b"]), "n": (count, ["a"])}).collect()
    wanted = {r["g"]: r for r in df.groupBy("g").agg(F.covar_pop("a", "b").alias("c"), F.count("*").alias("n")).collect()}
    assert len(got) == 3
    for r in got:
        assert r["c"] == pytest.approx(wanted[r["g"]]["c"]) and r["n"] == wanted[r["g"]]["n"]
