from __future__ import annotations

import random

import pytest
from pyspark.sql import Window, functions as F

from modelyard.operators.blocks import numbered, top_k, with_next, with_previous_and_best


@pytest.fixture(scope="module")
def rows(spark):
    """One hot group with gaps and negative order values, some small ones, a NULL group key."""
    draw = random.Random(5)
    data = [("hot", n, draw.uniform(-5, 5)) for n in draw.sample(range(-300, 3000), 900)]
    data += [(f"g{i}", n, draw.uniform(-5, 5)) for i in range(20) for n in draw.sample(range(0, 100000), 5)]
    data += [(None, n, float(n)) for n in (3, 70, 71)]
    return spark.createDataFrame(data, "g string, n bigint, v double").cache()


def _as_set(df):
    return {tuple(r) for r in df.collect()}


@pytest.mark.parametrize("bits", [1, 4, 16])
def test_numbered_equals_window(rows, bits):
    plain = rows.withColumn("i", F.row_number().over(Window.partitionBy("g").orderBy("n")).cast("bigint"))
    assert _as_set(numbered(rows, ["g"], "n", "i", bits)) == _as_set(plain)


@pytest.mark.parametrize("bits", [1, 4, 16])
def test_with_next_equals_lead(rows, bits):
    plain = rows.withColumn("next", F.lead("v").over(Window.partitionBy("g").orderBy("n")))
    assert _as_set(with_next(rows, ["g"], "n", ["v"], bits=bits)) == _as_set(plain)


def test_with_next_passes_null_values(spark):
    df = spark.createDataFrame([("a", 1, None), ("a", 2, None), ("a", 40, 1.0)], "g string, n bigint, v double")
    got = {r["n"]: r["next_v"] for r in with_next(df, ["g"], "n", ["v"], bits=2).collect()}
    assert got == {1: None, 2: 1.0, 40: None}


@pytest.mark.parametrize("bits", [1, 4, 16])
def test_previous_and_best_equal_windows(rows, bits):
    w = Window.partitionBy("g").orderBy("n")
    plain = rows.withColumn("prev", F.lag("v").over(w)).withColumn(
        "best", F.max("v").over(w.rowsBetween(Window.unboundedPreceding, 0))
    )
    assert _as_set(with_previous_and_best(rows, ["g"], "n", "v", "prev", "best", bits)) == _as_set(plain)


def test_top_k_equals_window(rows):
    order = [F.desc("v"), F.asc("n")]
    plain = (
        rows.withColumn("rank", F.row_number().over(Window.partitionBy("g").orderBy(*order)).cast("bigint"))
        .where("rank <= 7")
    )
    assert _as_set(top_k(rows, ["g"], order, 7, F.col("n"))) == _as_set(plain)
