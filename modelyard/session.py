"""SparkSession defaults.  Cluster sizing stays with spark-submit; nothing here overrides what it sets."""

from __future__ import annotations

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.ui.showConsoleProgress": "false",
}


def build_session(
    app_name: str = "modelyard", master: str | None = None, extra: dict[str, str] | None = None
) -> SparkSession:
    """Session with the defaults above; `master` is for local work and tests only."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for name, value in {**DEFAULTS, **(extra or {})}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()
