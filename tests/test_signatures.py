"""Signatures, and the store's positions, compaction and pruning."""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F, types as T

from modelyard.operators import linear, signatures
from modelyard.plans import lifecycle
from modelyard.sources.tracking_store import TrackingStore


@pytest.fixture
def store(spark, tmp_path):
    return TrackingStore(spark, str(tmp_path / "store"))


@pytest.mark.parametrize(
    ("actual", "expected", "status"),
    [("int", "int", "ok"), ("int", "bigint", "widened"), ("bigint", "int", "type_mismatch"), ("int", "float", "type_mismatch"),
     ("smallint", "float", "widened"), ("int", "double", "widened"), ("bigint", "double", "type_mismatch"), ("float", "double", "widened"),
     ("double", "float", "type_mismatch"), ("date", "timestamp", "widened"), ("string", "int", "type_mismatch"),
     ("array<float>", "array<double>", "widened"), ("array<double>", "array<float>", "type_mismatch"), ("array<int>", "int", "type_mismatch")],
)
def test_order_of_types(spark, actual, expected, status):
    parse = lambda t: T.StructType.fromDDL(f"x {t}")["x"].dataType
    assert signatures.fit(parse(actual), parse(expected)) == status


def test_rows_are_set_aside_and_columns_widened(spark):
    rows = [(1, 2, [1.0, 2.0], "k"), (2, None, [1.0, 2.0], "k"), (3, 4, [1.0, None], "k"), (4, 5, [1.0], "k"), (5, None, None, "k")]
    df = spark.createDataFrame(rows, "id int, n int, x array<float>, note string")
    signature = T.StructType(
        [T.StructField("n", T.LongType(), False), T.StructField("x", T.ArrayType(T.DoubleType(), False), False)]
    )
    good, aside = signatures.conform(df, signature, {"x": 2})
    assert good.schema["n"].dataType == T.LongType() and good.columns == df.columns
    assert [tuple(r) for r in good.collect()] == [(1, 2, [1.0, 2.0], "k")]
    assert {r["id"]: r["violations"] for r in aside.collect()} == {
        2: ["n: null"], 3: ["x: null inside"], 4: ["x: not 2 items"], 5: ["n: null", "x: null"],
    }
    for wrong in (df.drop("n"), df.withColumn("n", F.col("note"))):
        with pytest.raises(ValueError, match="n'"):
            signatures.conform(wrong, signature)
    assert signatures.conform(df.limit(0), signature)[0].count() == 0


def test_input_of_a_registered_version_is_checked(store, spark):
    rows = [([float(i), 1.0], 2.0 * i, "train" if i % 4 else "test") for i in range(40)]
    df = spark.createDataFrame(rows, "x array<double>, y double, dataset string")
    lifecycle.train_and_register(store, df, "x", "y", "main.default.line", alpha=0.01)
    asked = spark.createDataFrame([(1, [1.0, 1.0]), (2, None), (3, [None, 1.0]), (4, [1.0])], "id int, x array<float>")
    good, aside = lifecycle.check_input(store, "models:/main.default.line/1", asked, x=2)
    assert [r["id"] for r in good.collect()] == [1]
    assert {r["id"]: r["violations"] for r in aside.collect()} == {2: ["x: null"], 3: ["x: null inside"], 4: ["x: not 2 items"]}
    with pytest.raises(ValueError, match="missing"):
        lifecycle.check_input(store, "models:/main.default.line/1", asked.drop("x"))
    (bare,) = store.log_models([{"name": "bare"}])
    store.append("coefficients", linear.LinearModel((1.0,), 0.0).to_table(spark, bare.model_id))
    with pytest.raises(LookupError, match="signature"):
        lifecycle.check_input(store, bare.model_uri, asked)


def test_writers_never_share_a_position(spark, store):
    others = [TrackingStore(spark, store.root) for _ in range(4)]
    with ThreadPoolExecutor(4) as pool:
        firsts = [f for part in pool.map(lambda s: [s.next_log_seq(n) for n in (1, 5, (1 << 20) + 1, 1)], others) for f in part]
    assert len(set(firsts)) == len(firsts)
    for i, writer in enumerate(others[:2]):
        for step in range(3):
            writer.log_metrics({"a": float(step), "b": 1.0}, f"m{i}", "train", f"run-{i}", step)
    log = store.read("metrics")
    assert log.count() == 12 and log.select("log_seq").distinct().count() == 12
    own = [r["value"] for r in log.where("key = 'a' AND model_id = 'm0'").orderBy("log_seq").collect()]
    assert own == [0.0, 1.0, 2.0]


def test_compaction_keeps_the_rows_and_leaves_fewer_files(spark, store):
    for step in range(6):
        store.log_metrics({"a": float(step), "b": 1.0}, "m", "train", f"run-{step % 2}", step)
    store.log_metrics({"c": 1.0}, "m", "train", "run-0", 1)
    rows = lambda: sorted(tuple(r) for r in store.read("metrics").collect())
    before, files = rows(), store.n_files("metrics")
    assert files == 13 and store.compact() == 4
    assert rows() == before and store.n_files("metrics") == 5
    assert store.compact() == 0 and rows() == before
    assert TrackingStore(spark, store.root + "-none").compact() == 0


def test_runs_and_keys_prune_partitions(spark, store):
    for i in range(8):
        store.log_metrics({"a": float(i), "b": -float(i)}, f"m{i}", "train", f"run-{i}", 0)
    rows = store.read_metrics("a", ["run-3", "run-5"])
    plan = rows._jdf.queryExecution().executedPlan().toString()
    filters = plan[plan.index("PartitionFilters") :].splitlines()[0]
    assert "key" in filters and "run_bucket" in filters
    assert sorted(r["model_id"] for r in rows.collect()) == ["m3", "m5"]
    asked = spark.createDataFrame([("run-2",), ("run-2",), ("absent",)], "run_id string")
    some = store.read_metrics(runs=asked)
    assert sorted((r["model_id"], r["key"]) for r in some.collect()) == [("m2", "a"), ("m2", "b")]
    assert store.read_metrics("a", []).count() == 0
    assert TrackingStore(spark, store.root + "-none").read_metrics("a").count() == 0


def test_search_with_predicates(store):
    first, second = store.log_models([{"name": "x"}, {"name": "y"}])
    store.log_metrics({"a": 1.0}, first.model_id, "train", "r1")
    store.log_metrics({"a": 2.0}, second.model_id, "train", "r2")
    ids = lambda **o: [r["model_id"] for r in lifecycle.search(store, "a", **o).collect()]
    assert ids() == [second.model_id, first.model_id]
    assert ids(name="x") == ids(run_id="r1") == [first.model_id]
    assert ids(run_id="absent") == [] and ids(name="x", run_id="r2") == []
