from __future__ import annotations

import datetime
import decimal
import math

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from modelyard.sources.shared import scratch_path
from modelyard.streaming import arrivals, metric_log

LOG = "key string, value double, n bigint, log_seq bigint, ts timestamp, at timestamp_ntz, price decimal(20,4), raw binary, ok boolean"


def _row(seq, value=1.0, key="k", n=None):
    instant = datetime.datetime(2024, 1, 1, 0, 0, 0, 123457)
    return (key, value, n, seq, instant, instant, decimal.Decimal("1234567890123456.7891"), bytearray(b"\x00\xff"), None)


def _follow(spark, path, out, **options):
    log = metric_log.read_log(spark, path, max_files_per_trigger=1)
    query = metric_log.append_to(arrivals.first_arrivals(log, **options), f"{out}/rows", f"{out}/progress")
    query.awaitTermination()
    return spark.read.schema(log.schema).parquet(f"{out}/rows")


def _write(spark, path, *batches):
    for batch in batches:
        spark.createDataFrame(batch, LOG).coalesce(1).write.mode("append").parquet(path)


def _state(spark, out):
    state = spark.read.format("statestore").load(f"{out}/progress")
    field = state.schema["value"].dataType.fields[0].name
    return state.select(f"value.{field}.n", F.length(f"value.{field}.seen").alias("bytes")).collect()


def test_any_order_overlap_and_repeats_across_batches_and_a_restart(spark):
    path, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    _write(spark, path, [_row(s) for s in (900, 17, 17, -5)], [_row(s) for s in (3, 900, 17)], [_row(s) for s in (-5, 2**62, 3)])
    assert sorted(r["log_seq"] for r in _follow(spark, path, out).collect()) == [-5, 3, 17, 900, 2**62]
    _write(spark, path, [_row(s) for s in (900, 4, 2**62, 4)])
    assert sorted(r["log_seq"] for r in _follow(spark, path, out).collect()) == [-5, 3, 4, 17, 900, 2**62]


def test_values_come_back_as_they_were(spark):
    path, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    rows = [_row(1, float("nan"), n=2**60 + 1), _row(2, None), _row(3, 0.1 + 0.2, key=None), _row(4, -0.0, key=""), _row(5, float("inf"))]
    _write(spark, path, rows)
    got = _follow(spark, path, out).orderBy("log_seq").collect()
    assert math.isnan(got[0]["value"]) and got[0]["n"] == 2**60 + 1
    assert [tuple(r) for r in got[1:]] == rows[1:] and math.copysign(1, got[3]["value"]) == -1
    assert tuple(got[0])[2:] == rows[0][2:]


def test_rows_without_position_are_all_kept(spark):
    path, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    _write(spark, path, [_row(None), _row(None), _row(1)], [_row(None), _row(1)])
    got = [r["log_seq"] for r in _follow(spark, path, out).collect()]
    assert got.count(None) == 3 and got.count(1) == 1 and len(got) == 4


def test_no_rows(spark):
    path, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    _write(spark, path, [])
    assert _follow(spark, path, out).count() == 0


def test_the_state_of_a_complete_block_has_no_bits(spark):
    path, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    _write(spark, path, [_row(s) for s in range(0, 16, 2)], [_row(20)])
    assert _follow(spark, path, out, bits=4).count() == 9
    assert sorted((r["n"], r["bytes"]) for r in _state(spark, out)) == [(1, 2), (8, 2)]
    _write(spark, path, [_row(s) for s in range(16)], [_row(s) for s in range(21)])
    got = _follow(spark, path, out, bits=4)
    assert sorted(r["log_seq"] for r in got.collect()) == list(range(21))
    assert sorted((r["n"], r["bytes"]) for r in _state(spark, out)) == [(5, 2), (16, 0)]


def _timed(seq, hours):
    row = list(_row(seq))
    row[4] = datetime.datetime(2024, 1, 1) + datetime.timedelta(hours=hours)
    return tuple(row)


def test_a_block_behind_the_watermark_leaves_the_state_and_no_copy_passes(spark):
    path, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    _write(spark, path, [_timed(1, 0), _timed(2, 1)], [_timed(5000, 100)])
    aged = dict(ts="ts", expiry="10 hours")
    assert _follow(spark, path, out, **aged).count() == 3
    assert [r["n"] for r in _state(spark, out)] == [1]
    _write(spark, path, [_timed(1, 0), _timed(5000, 100), _timed(3, 95)])
    assert sorted(r["log_seq"] for r in _follow(spark, path, out, **aged).collect()) == [1, 2, 3, 5000]
    lasting = scratch_path(spark, "out")
    assert _follow(spark, path, lasting, ts="ts", expiry="1000 days").count() == 4
    assert sorted(r["n"] for r in _state(spark, lasting)) == [1, 3]


def test_repeats_within_an_arrow_batch_do_not_reach_the_shuffle():
    batch = pa.RecordBatch.from_pydict({"_position": pa.array([5, None, 5, 7, None, 5], pa.int64()), "_c0": list("abcdef")})
    (got,) = arrivals._one_per_batch(iter([batch]))
    assert got.column("_c0").to_pylist() == ["a", "b", "d", "e"]
    empty = batch.slice(0, 0)
    assert next(arrivals._one_per_batch(iter([empty]))).num_rows == 0


def test_nested_columns_and_odd_blocks_are_errors(spark):
    nested = spark.createDataFrame([(1, [1])], "log_seq bigint, a array<int>")
    with pytest.raises(TypeError, match="array<int>"):
        arrivals.first_arrivals(nested)
    with pytest.raises(ValueError, match="blocks"):
        arrivals.first_arrivals(nested.drop("a"), bits=2)
    with pytest.raises(ValueError, match="expiry"):
        arrivals.first_arrivals(nested.drop("a"), expiry="1 day")
