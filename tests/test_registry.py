from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from modelyard.functions import scalars
from modelyard.operators import registry
from modelyard.sources.parameters import parse_version, query_with, require

ENDPOINTS = "endpoint_name string, entity_name string, entity_version bigint, workload_size string, scale_to_zero boolean"


def test_approval_cases(spark):
    rows = [
        (1, {}),
        (2, {"Approval_Check": "APPROVED"}),
        (3, {"Approval_Check": "Rejected"}),
        (4, {"approval_check": "Approved"}),
        (5, {"other": "Approved"}),
        (6, None),
        (7, {"approval_check": "Approved", "Approval_Check": "approved"}),
        (8, {"Approval_Check": None}),
    ]
    df = spark.createDataFrame(rows, "version int, tags map<string,string>")
    got = {r["version"]: (r["approved"], r["reason"]) for r in registry.approval_gate(df).collect()}
    assert got == {
        1: (False, "missing"),
        2: (True, "approved"),
        3: (False, "rejected"),
        4: (False, "key_case_mismatch"),
        5: (False, "missing"),
        6: (False, "missing"),
        7: (True, "approved"),
        8: (False, "rejected"),
    }


def test_other_tag_name_and_empty_one(spark):
    df = spark.createDataFrame([(1, {"gate": "approved"})], "version int, tags map<string,string>")
    assert registry.approval_gate(df, "gate").first()["approved"]
    with pytest.raises(ValueError):
        registry.approval_gate(df, "")


def test_versions_continue_after_existing_ones(spark):
    arrivals = spark.createDataFrame([("a", 30), ("a", 10), ("b", 20)], "name string, arrival bigint")
    existing = spark.createDataFrame([("a", 1), ("a", 4)], "name string, version bigint")
    got = {(r["name"], r["arrival"]): r["version"] for r in registry.register_versions(arrivals, existing).collect()}
    assert got == {("a", 10): 5, ("a", 30): 6, ("b", 20): 1}


def test_resolve_both_forms_and_malformed(spark):
    models = spark.createDataFrame([("m-1",), ("m-2",)], "model_id string")
    versions = spark.createDataFrame([("c.s.m", 3, "m-2")], "name string, version bigint, model_id string")
    uris = ["models:/m-1", "models:/c.s.m/3", "models:/c.s.m/4", "models:/c.s.m", "runs:/m-1", "models:/a/b/c", "", None]
    requests = spark.createDataFrame([(i, u) for i, u in enumerate(uris)], "i int, uri string")
    got = [r["model_id"] for r in registry.resolve_uris(requests, models, versions).orderBy("i").collect()]
    assert got == ["m-1", "m-2", None, None, None, None, None, None]


def test_upsert_is_idempotent_and_replaces_rows_as_a_whole(spark):
    existing = spark.createDataFrame([("keep", "k", 1, "Large", False), ("both", "b", 1, "Large", False)], ENDPOINTS)
    incoming = spark.createDataFrame(
        [("both", "b", 2, "Small", True), ("both", "b", 3, None, True), ("new", "n", 1, "Small", True)], ENDPOINTS
    )
    once = registry.upsert_endpoints(existing, incoming)
    got = {r["endpoint_name"]: (r["entity_version"], r["workload_size"], r["action"]) for r in once.collect()}
    assert got == {"keep": (1, "Large", "keep"), "both": (3, None, "update"), "new": (1, "Small", "create")}
    twice = registry.upsert_endpoints(once.drop("action"), incoming).drop("action")
    assert set(twice.collect()) == set(once.drop("action").collect())


def test_deployable_needs_evaluation_and_approval(spark):
    versions = spark.createDataFrame(
        [("n", 1, "m1", {"Approval_Check": "Approved"}), ("n", 2, "m2", {"Approval_Check": "Approved"}), ("n", 3, "m3", {})],
        "name string, version bigint, model_id string, tags map<string,string>",
    )
    evaluations = spark.createDataFrame([("m1", "r2", 0.5), ("m3", "r2", 0.9), ("m1", "r2", 0.7)], "model_id string, key string, value double")
    assert [r["version"] for r in registry.deployable_versions(versions, evaluations).collect()] == [1]
    assert registry.deployable_versions(versions, evaluations, required=("r2", 0.8)).count() == 0


def test_manifest(spark):
    tools = spark.createDataFrame(
        [("idx", "index", ["i1", "i2"]), ("fn", "function", []), ("local", "local", ["x"]), ("odd", None, ["x"])],
        "tool_name string, kind string, resources array<string>",
    )
    base = spark.createDataFrame([("endpoint", "e")], "resource_kind string, resource_name string")
    got = sorted((r["resource_kind"], r["resource_name"]) for r in registry.resource_manifest(tools, base).collect())
    assert got == [("endpoint", "e"), ("function", "fn"), ("index", "i1"), ("index", "i2")]


def test_names(spark):
    df = spark.createDataFrame([("main", "default", "m"), ("", None, "m"), ("", "", "")], "a string, b string, c string")
    full = scalars.qualified_name(F.col("a"), F.col("b"), F.col("c"))
    got = df.select(full.alias("n"), scalars.is_complete_name(full).alias("ok"), scalars.endpoint_name(full).alias("e")).collect()
    assert [tuple(r) for r in got] == [
        ("main.default.m", True, "main-default-m-serving-endpoint"),
        ("..m", False, "--m-serving-endpoint"),
        ("..", False, "---serving-endpoint"),
    ]


def test_parameters(spark):
    assert require(model_name="m") == {"model_name": "m"}
    for missing in ("", "  ", None):
        with pytest.raises(ValueError, match="model_version"):
            require(model_name="m", model_version=missing)
    assert parse_version("12") == 12
    for bad in ("", "x", "0", "-1", "1.5"):
        with pytest.raises(ValueError):
            parse_version(bad)
    hostile = "x' OR '1'='1"
    assert query_with(spark, "SELECT :model_name AS n", model_name=hostile).first()["n"] == hostile
