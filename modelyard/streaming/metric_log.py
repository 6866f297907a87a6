"""The metric log as a stream: deduplication within a delay, tumbling windows, running best.

File streams in and out, both append-only: the parquet sink and the `foreachBatch` writer keep their
progress in the checkpoint location, so a restarted query neither loses nor repeats rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from modelyard.operators.tracking import MISSING

_EPOCH_INSTANT = "timestamp'1970-01-01 00:00:00Z'"
_EPOCH_LOCAL = "timestamp_ntz'1970-01-01 00:00:00'"


def as_instant(column: str) -> Column:
    """Zone-less time read as UTC: watermarks need an instant, whatever the session's zone."""
    return F.expr(f"{_EPOCH_INSTANT} + (`{column}` - {_EPOCH_LOCAL})")


FILES_PER_TRIGGER = 64


def read_log(spark: SparkSession, table: str, max_files_per_trigger: int | None = FILES_PER_TRIGGER) -> DataFrame:
    """File stream over a parquet table, be it one file or a folder of files; its schema is the table's.

    A micro-batch takes a bounded number of files, so that state can be freed between batches.  None
    takes all files at once.  Before a watermark, files whose times overlap by more than its delay lose
    rows if they come in several batches; `arrivals.first_arrivals` has no watermark.
    """
    schema = spark.read.parquet(table).schema
    # A stream takes a single file only through a pattern; this one matches the table and nothing else.
    table = table.rstrip("/")
    only = f"{table[:-1]}[{table[-1]}]"
    stream = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        stream = stream.option("maxFilesPerTrigger", max_files_per_trigger)
    return stream.parquet(only)


def deduplicated(log: DataFrame, keys: list[str], ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    """First arrival per key; repeats within the watermark delay are dropped and state is freed after it."""
    return log.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def windowed_summary(log: DataFrame, by: list[str], ts: str = "ts", width: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """Count, sum and extremes per tumbling window.

    Appended as a stream, a window is final and leaves the state once the watermark has passed its
    end; rows that come later are dropped.
    """
    return (
        log.withWatermark(ts, delay)
        .groupBy(F.window(ts, width), *by)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.sum("value").alias("total"),
            F.min("value").alias("lowest"),
            F.max("value").alias("highest"),
        )
        .select(F.col("window.start").alias("window_start"), *by, "n", "total", "lowest", "highest")
    )


def best_so_far(log: DataFrame, group: list[str]) -> DataFrame:
    """Best (value, then earliest log position) per group; NaN counts as missing."""
    usable = F.coalesce(F.when(~F.isnan("value"), F.col("value")), F.lit(MISSING))
    place = F.struct(usable.alias("s"), (-F.col("log_seq")).alias("o"))
    return log.groupBy(*group).agg(F.max(place).alias("_place")).select(
        *group, F.col("_place.s").alias("best_value"), (-F.col("_place.o")).alias("best_seq")
    )


def append_to(stream: DataFrame, path: str, checkpoint: str) -> StreamingQuery:
    """Process everything available, appending parquet files."""
    return (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def follow_best(log: DataFrame, group: list[str], path: str, checkpoint: str) -> StreamingQuery:
    """Leaderboard: each batch appends the groups it changed, one folder per batch number.

    A repeated batch overwrites its own folder only; `board` reduces what was appended.
    """

    def append(changes: DataFrame, batch_id: int) -> None:
        changes.write.mode("overwrite").parquet(f"{path}/batch={batch_id}")

    return (
        best_so_far(log, group)
        .writeStream.outputMode("update")
        .foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def board(changes: DataFrame, group: list[str]) -> DataFrame:
    """Newest state of the groups: a best only rises, so the largest of the appended ones is it."""
    place = F.struct(F.col("best_value").alias("s"), (-F.col("best_seq")).alias("o"))
    return (
        changes.groupBy(*group)
        .agg(F.max(place).alias("_p"))
        .select(*group, F.col("_p.s").alias("best_value"), (-F.col("_p.o")).alias("best_seq"))
    )
