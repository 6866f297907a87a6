"""Every query against its SQL on the smallest tables, plus the contract of the entry module."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_oracle import compare, connect
from conftest import BASE

ROWS_ONLY = {"q_mlp_train", "q_checkpoint_accuracy", "q_rouge_l", "q_vector_lsh", "q_vector_index"}


@pytest.fixture(scope="module")
def duck():
    return connect(BASE)


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    assert compare(spark, duck, queries()[name], oracle_sql()[name], BASE) is None


def test_only_known_queries_lack_sql():
    assert {n for n in set(queries()) - set(oracle_sql()) if n.startswith("q_")} == ROWS_ONLY
    assert set(oracle_sql()) <= set(queries())


def test_entry_gives_one_best_and_one_worst(spark):
    assert sorted(r["place"] for r in entry(spark).collect()) == ["best", "worst"]


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) - {n for n in oracle_sql() if "stream" in n}))
def test_no_cross_joins(spark, name):
    plan = queries()[name](spark, BASE)._jdf.queryExecution().toString()
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
