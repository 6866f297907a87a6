from __future__ import annotations

from datetime import datetime, timedelta

import duckdb
import pytest
from pyspark.sql import functions as F

from check_oracle import compare
from modelyard.operators.messages import flatten_updates
from modelyard.plans import standins
from modelyard.plans.catalog import QUERIES
from modelyard.plans.oracle import ORACLE
from modelyard.sources.shared import scratch_path
from modelyard.streaming import deltas, metric_log

LOG = "model_id string, key string, value double, log_seq bigint, ts timestamp"
START = datetime(2024, 1, 1)


def _row(seq, minutes, value=1.0, model="m", key="k"):
    return (model, key, value, seq, START + timedelta(minutes=minutes))


def _write(spark, path, *batches):
    for batch in batches:
        spark.createDataFrame(batch, LOG).coalesce(1).write.mode("append").parquet(path)


def test_repeats_are_dropped_within_the_delay(spark):
    path = scratch_path(spark, "in")
    _write(spark, path, [_row(1, 0), _row(2, 5)], [_row(1, 10), _row(3, 12)], [_row(2, 20), _row(3, 21)])
    out = scratch_path(spark, "out")
    log = metric_log.read_log(spark, path, max_files_per_trigger=1)
    kept = metric_log.deduplicated(log, ["model_id", "key", "log_seq"])
    metric_log.append_to(kept, f"{out}/rows", f"{out}/progress").awaitTermination()
    assert sorted(r["log_seq"] for r in spark.read.parquet(f"{out}/rows").collect()) == [1, 2, 3]


def test_dedup_keeps_all_rows_of_many_files_with_overlapping_times(spark, base, tmp_path):
    files = 2 * metric_log.FILES_PER_TRIGGER + 6  # a watermark drops rows from the third batch on
    events = spark.read.parquet(f"{base}/events.parquet").limit(700)
    events.repartition(files).write.parquet(f"{tmp_path}/events.parquet")
    duck = duckdb.connect()
    duck.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{tmp_path}/events.parquet/*.parquet')")
    assert compare(spark, duck, QUERIES["q_stream_dedup"], ORACLE["q_stream_dedup"], str(tmp_path)) is None


def test_dedup_of_no_rows(spark, base, tmp_path):
    spark.read.parquet(f"{base}/events.parquet").limit(0).write.parquet(f"{tmp_path}/events.parquet")
    assert QUERIES["q_stream_dedup"](spark, str(tmp_path)).count() == 0


def test_rows_behind_the_watermark_are_dropped(spark):
    path, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    # Day 4 moves the watermark, which lateness follows one batch later; then one row just inside and
    # one far behind it.
    day4 = 3 * 1440
    _write(
        spark,
        path,
        [_row(1, 0)],
        [_row(2, day4)],
        [_row(6, day4 + 5)],
        [_row(3, day4 - 30), _row(4, 10)],
        [_row(5, 9 * 1440)],
    )
    log = metric_log.read_log(spark, path, max_files_per_trigger=1)
    summary = metric_log.windowed_summary(log, ["key"])
    metric_log.append_to(summary, f"{out}/rows", f"{out}/progress").awaitTermination()
    got = {r["window_start"].day: r["n"] for r in spark.read.parquet(f"{out}/rows").collect()}
    assert got == {1: 1, 3: 1, 4: 2}


@pytest.mark.parametrize("files", [1, 4])
def test_leaderboard_equals_batch_and_survives_a_restart(spark, files):
    path, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    batches = [
        [_row(4 * b + i, b, value=float((7 * b + 3 * i) % 11), model=f"m{i % 3}") for i in range(4)] for b in range(files)
    ]
    _write(spark, path, *batches)

    def follow():
        log = metric_log.read_log(spark, path, max_files_per_trigger=1)
        metric_log.follow_best(log, ["model_id"], f"{out}/board", f"{out}/progress").awaitTermination()

    def board():
        return metric_log.board(spark.read.parquet(f"{out}/board"), ["model_id"]).collect()

    def batch():
        return set(metric_log.best_so_far(spark.read.parquet(path), ["model_id"]).collect())

    follow()
    assert set(board()) == batch()
    _write(spark, path, [_row(100, 60, value=50.0, model="m1"), _row(101, 60, value=float("nan"), model="m9")])
    follow()
    assert set(board()) == batch()
    assert {r["model_id"]: r["best_value"] for r in board()}["m1"] == 50.0


def test_late_rows_are_dropped_after_a_restart(spark):
    path, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    for arrival in ([_row(1, 0), _row(2, 3 * 1440)], [_row(3, 10), _row(4, 3 * 1440 + 5), _row(5, 9 * 1440)]):
        _write(spark, path, arrival)
        summary = metric_log.windowed_summary(metric_log.read_log(spark, path, max_files_per_trigger=None), ["key"])
        metric_log.append_to(summary, f"{out}/rows", f"{out}/progress").awaitTermination()
    got = {r["window_start"].day: r["n"] for r in spark.read.parquet(f"{out}/rows").collect()}
    assert got == {1: 1, 4: 2}


def test_delta_stream_equals_batch_flatten(spark, base):
    events = standins.update_events(spark, base).where(F.map_values("event")[0]["messages"].isNotNull())
    path, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    events.repartition(3).write.parquet(path)
    stream = deltas.delta_stream(metric_log.read_log(spark, path, max_files_per_trigger=1))
    metric_log.append_to(stream, f"{out}/rows", f"{out}/progress").awaitTermination()
    order = ["conv_id", "event_seq", "node_pos", "msg_pos"]
    got = spark.read.parquet(f"{out}/rows").orderBy(*order).collect()
    wanted = flatten_updates(events).withColumnRenamed("message", "delta").orderBy(*order).collect()
    assert got == wanted and got


def test_delta_stream_fails_on_absent_messages(spark, base):
    path, out = scratch_path(spark, "in"), scratch_path(spark, "out")
    standins.update_events(spark, base).write.parquet(path)
    stream = deltas.delta_stream(metric_log.read_log(spark, path))
    with pytest.raises(Exception, match="no messages from node"):
        metric_log.append_to(stream, f"{out}/rows", f"{out}/progress").awaitTermination()


def test_instants_do_not_depend_on_the_session_zone(spark):
    local = spark.createDataFrame([("2024-03-01 12:00:00",)], "t string").select(F.col("t").cast("timestamp_ntz").alias("ts"))
    before = spark.conf.get("spark.sql.session.timeZone")
    try:
        spark.conf.set("spark.sql.session.timeZone", "Asia/Tokyo")
        assert local.select(F.unix_micros(metric_log.as_instant("ts"))).first()[0] == 1709294400000000
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
