from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from modelyard.operators.splits import exact_split, hash_split


def _members(df):
    return {r["k"] for r in df.where("dataset = 'test'").collect()}


@pytest.mark.parametrize("n", [1, 2, 5, 101, 5000])
def test_exact_size_disjoint_complete(spark, n):
    got = exact_split(spark.range(n).withColumnRenamed("id", "k"), "k").collect()
    assert sorted(r["k"] for r in got) == list(range(n))
    assert sum(r["dataset"] == "test" for r in got) == math.ceil(n * 0.2)


def test_exact_split_of_nothing(spark):
    assert exact_split(spark.range(0).withColumnRenamed("id", "k"), "k").count() == 0


def test_splits_do_not_depend_on_partitioning(spark):
    keys = spark.range(3000).withColumnRenamed("id", "k")
    for split in (hash_split, exact_split):
        assert _members(split(keys, "k")) == _members(split(keys.repartition(7, F.rand(3)), "k"))


def test_seed_changes_members_and_share_is_met(spark):
    keys = spark.range(20000).withColumnRenamed("id", "k")
    one, other = _members(hash_split(keys, "k")), _members(hash_split(keys, "k", seed=43))
    assert one != other
    assert abs(len(one) / 20000 - 0.2) < 0.01


def test_exact_share_without_float_error(spark):
    # 0.07 * 100 is 7.000000000000001 in binary floating point; the ceiling must still be 7.
    keys = spark.range(100).withColumnRenamed("id", "k")
    assert len(_members(exact_split(keys, "k", share="0.07"))) == 7


@pytest.mark.parametrize("share", ["0", "1", "-0.1", "2"])
def test_bad_share(spark, share):
    with pytest.raises(ValueError):
        hash_split(spark.range(3), "id", share)


def test_exact_split_of_text_keys(spark):
    rows = spark.range(101).select(F.concat(F.lit("key "), F.col("id").cast("string")).alias("k"), "id")
    got = exact_split(rows, "k")
    assert got.where("dataset = 'test'").count() == 21 and got.count() == 101
