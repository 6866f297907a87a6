"""Tags that held at a time."""

from __future__ import annotations

from datetime import datetime

import pytest

from modelyard.operators import tags

HISTORY = "name string, version bigint, key string, value string, set_at timestamp, seq bigint"
ASKED = "name string, version bigint, asked_at timestamp, note string"


def _day(n):
    return datetime(2024, 1, n)


@pytest.fixture(scope="module")
def history(spark):
    rows = [
        ("m", 1, "Approval_Check", "Rejected", _day(2), 1),
        ("m", 1, "Approval_Check", "Approved", _day(5), 2),
        ("m", 1, "Approval_Check", None, _day(8), 3),
        ("m", 1, "owner", "a", _day(5), 4),
        ("m", 1, "owner", "b", _day(5), 5),  # the same time: the larger seq is newer
        ("m", 2, "APPROVAL_CHECK", "Approved", _day(1), 6),
        ("m", 2, None, "x", _day(1), 7),
        ("m", 2, "late", "x", None, 8),
        (None, 1, "Approval_Check", "Approved", _day(1), 9),
    ]
    return spark.createDataFrame(rows, HISTORY).repartition(3)


def test_gate_at_different_times(spark, history):
    asked = [("m", 1, _day(d), "n") for d in (1, 2, 4, 5, 6, 9)] + [("m", 2, _day(3), "n"), ("absent", 1, _day(9), "n")]
    asked += [("m", 1, _day(6), "again"), ("m", None, _day(6), "n"), ("m", 1, None, "n"), (None, 1, _day(6), "n")]
    got = tags.gate_as_of(spark.createDataFrame(asked, ASKED), history).collect()
    assert len(got) == len(asked)
    by = {(r["name"], r["version"], r["asked_at"], r["note"]): (r["tags"], r["reason"]) for r in got}
    assert by["m", 1, _day(1), "n"] == ({}, "missing")
    assert by["m", 1, _day(2), "n"] == ({"Approval_Check": "Rejected"}, "rejected")
    assert by["m", 1, _day(4), "n"][1] == "rejected"
    assert by["m", 1, _day(5), "n"] == ({"Approval_Check": "Approved", "owner": "b"}, "approved")
    assert by["m", 1, _day(6), "again"] == by["m", 1, _day(6), "n"] == by["m", 1, _day(5), "n"]
    assert by["m", 1, _day(9), "n"] == ({"owner": "b"}, "missing")
    assert by["m", 2, _day(3), "n"] == ({"APPROVAL_CHECK": "Approved"}, "key_case_mismatch")
    for nothing in (("absent", 1, _day(9), "n"), ("m", None, _day(6), "n"), ("m", 1, None, "n"), (None, 1, _day(6), "n")):
        assert by[nothing] == ({}, "missing")


def test_current_tags_join_versions(spark, history):
    versions = spark.createDataFrame([("m", 1, "a"), ("m", 2, "b"), ("m", 3, "c")], "name string, version bigint, model_id string")
    got = {r["version"]: r["tags"] for r in tags.with_tags(versions, tags.current_tags(history)).collect()}
    assert got == {1: {"owner": "b"}, 2: {"APPROVAL_CHECK": "Approved"}, 3: {}}


def test_empty_tables(spark, history):
    asked = spark.createDataFrame([("m", 1, _day(6), "n")], ASKED)
    assert tags.gate_as_of(asked.limit(0), history).count() == 0
    assert tags.gate_as_of(asked, history.limit(0)).first()["reason"] == "missing"
    assert tags.current_tags(history.limit(0)).count() == 0


def test_history_is_neither_sorted_nor_windowed(spark, history):
    asked = spark.createDataFrame([("m", 1, _day(6), "n")], ASKED)
    plan = tags.tags_as_of(asked, history)._jdf.queryExecution().toString().split("== Physical Plan ==")[1]
    assert "Window" not in plan and "partial_max_by" in plan
