"""Append-only tracking tables below one folder: runs, models, metrics, datasets, versions.

Every call writes one batch of rows; metrics are partitioned by key and by a bucket of the run, so that a
ranking by one key, or within some runs, reads only those.  Log positions are claimed in blocks, so
any number of writers never share one; small files are put together by `compact`.  Versions are written
by one writer at a time.
"""

from __future__ import annotations

import random
import uuid
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from modelyard import schemas
from modelyard.functions.scalars import URI_PREFIX
from modelyard.operators.registry import register_versions
from modelyard.sources.shared import scratch_path

_TABLES = {
    "runs": schemas.RUNS,
    "models": schemas.LOGGED_MODELS,
    "metrics": schemas.METRICS,
    "datasets": schemas.DATASETS,
    "coefficients": schemas.COEFFICIENTS,
    "versions": schemas.MODEL_VERSIONS,
    "states": schemas.TRAINING_STATES,
}
_PARTITIONED_BY = {"metrics": ["key", "run_bucket"]}
RUN_BUCKETS = 64
BLOCK_BITS = 20  # positions in a claimed block


def run_bucket(run_id: Column) -> Column:
    """Partition of a run; rows without a run share one."""
    return F.pmod(F.xxhash64(F.coalesce(run_id, F.lit(""))), F.lit(RUN_BUCKETS)).cast("int")


@dataclass(frozen=True)
class LoggedModel:
    model_id: str
    model_uri: str


class TrackingStore:
    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")

    def _path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def _exists(self, table: str) -> bool:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(self._path(table))
        return path.getFileSystem(self.spark._jsc.hadoopConfiguration()).exists(path)

    def append(self, table: str, rows: DataFrame) -> None:
        """Columns are matched by name; missing nullable ones become NULL, unknown ones are an error."""
        schema = _TABLES[table]
        unknown = set(rows.columns) - set(schema.names)
        if unknown:
            raise ValueError(f"no such columns in {table}: {sorted(unknown)}")
        lacking = [f.name for f in schema.fields if not f.nullable and f.name not in rows.columns]
        if lacking:
            raise ValueError(f"columns missing for {table}: {lacking}")
        selected = rows.select(
            *[
                (F.col(f.name) if f.name in rows.columns else F.lit(None)).cast(f.dataType).alias(f.name)
                for f in schema.fields
            ]
        )
        if table == "metrics":
            selected = selected.withColumn("run_bucket", run_bucket(F.col("run_id")))
        columns = _PARTITIONED_BY.get(table)
        if columns is None:
            selected.write.mode("append").parquet(self._path(table))
        else:
            # Rebalanced, so that every key is written as few files and a hot key by many tasks.
            balanced = selected.hint("rebalance", *columns)
            balanced.write.mode("append").partitionBy(*columns).parquet(self._path(table))

    def read(self, table: str) -> DataFrame:
        schema = _TABLES[table]
        if not self._exists(table):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self._path(table)).select(*schema.names)

    def read_metrics(self, key: str | None = None, runs: Sequence[str] | DataFrame | None = None) -> DataFrame:
        """Metric rows of one key, of some runs, or both; other partitions are not read.

        Runs given by name prune when the query is planned; a table of runs (`run_id`) prunes while it runs,
        if it is small enough to be sent along.
        """
        if not self._exists("metrics"):
            return self.spark.createDataFrame([], schemas.METRICS)
        whole = T.StructType([*schemas.METRICS.fields, T.StructField("run_bucket", T.IntegerType())])
        rows = self.spark.read.schema(whole).parquet(self._path("metrics"))
        if key is not None:
            rows = rows.where(F.col("key") == key)
        if isinstance(runs, DataFrame):
            asked = runs.select("run_id").distinct().withColumn("run_bucket", run_bucket(F.col("run_id")))
            rows = rows.join(asked, ["run_bucket", "run_id"], "left_semi")
        elif runs is not None:
            names = self.spark.createDataFrame([(r,) for r in runs], "run_id string")
            buckets = [r[0] for r in names.select(run_bucket(F.col("run_id"))).distinct().collect()]
            rows = rows.where(F.col("run_bucket").isin(buckets) & F.col("run_id").isin(list(runs)))
        return rows.select(*schemas.METRICS.names)

    def _rows(self, table: str, rows: list[dict]) -> DataFrame:
        """Rows made on the driver.  Meant for handfuls; bulk rows come as a DataFrame."""
        schema = _TABLES[table]
        nullable = T.StructType([T.StructField(f.name, f.dataType, True) for f in schema.fields])
        return self.spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], nullable)

    def run(self, run_name: str | None = None) -> "Run":
        return Run(self, run_name)

    def next_log_seq(self, n: int = 1) -> int:
        """First of `n` log positions that no other writer gets.

        Positions come in blocks, claimed by files named after them.  A writer that sees a claim overlapping
        its own after it has made it withdraws and tries further up.  Of two such writers, at most
        one can have looked before the other's claim was there, so no two keep the same block; all this
        needs is that a file, once made, is listed.  Withdrawn blocks stay unused.
        """
        blocks, claim = -(-max(n, 1) >> BLOCK_BITS), uuid.uuid4().hex
        folder = self.spark._jvm.org.apache.hadoop.fs.Path(self._path("positions"))
        system = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        system.mkdirs(folder)

        def claims() -> list[tuple[int, int, str]]:
            names = [s.getPath().getName().split("-") for s in system.listStatus(folder)]
            return [(int(first), int(size), who) for first, size, who in names]

        for attempt in range(1000):
            first = max((f + size for f, size, _ in claims()), default=0) + (random.randrange(4) if attempt else 0)
            own = f"{first}-{blocks}-{claim}{attempt:03x}"
            system.create(self.spark._jvm.org.apache.hadoop.fs.Path(folder, own)).close()
            if not any(f < first + blocks and first < f + size for f, size, who in claims() if who != own.split("-")[2]):
                return first << BLOCK_BITS
        raise RuntimeError("no log positions could be claimed")

    def n_files(self, table: str) -> int:
        """Files a reader of the table opens."""
        return self.spark.read.parquet(self._path(table)).select(F.input_file_name()).distinct().count() if self._exists(table) else 0

    def compact(self, table: str = "metrics", least_files: int = 2) -> int:
        """Rewrite the partitions that consist of at least `least_files` files as few files; how many.

        The rows are first written aside to the shared folder, then replace their partitions and no others,
        so a failed job can be repeated.  Nobody may append to the table meanwhile.
        """
        columns = _PARTITIONED_BY[table]
        if not self._exists(table):
            return 0
        schema = T.StructType([*_TABLES[table].fields, T.StructField("run_bucket", T.IntegerType())])
        rows = self.spark.read.schema(schema).parquet(self._path(table))
        files = rows.select(*columns, F.input_file_name().alias("_file")).distinct()
        many = files.groupBy(*columns).count().where(F.col("count") >= least_files).select(*columns)
        n = many.count()
        if n:
            aside = scratch_path(self.spark, "compact")
            rows.join(F.broadcast(many), columns, "left_semi").write.parquet(aside)
            merged = self.spark.read.schema(schema).parquet(aside).hint("rebalance", *columns)
            merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*columns).parquet(self._path(table))
        return n

    def log_models(self, models: list[dict]) -> list[LoggedModel]:
        """One write for any number of models; ids are assigned, parameters become text."""
        order = self.next_log_seq(len(models))
        logged, rows = [], []
        for i, model in enumerate(models):
            model_id = f"m-{uuid.uuid4().hex}"
            logged.append(LoggedModel(model_id, URI_PREFIX + model_id))
            rows.append(
                {
                    **model,
                    "model_id": model_id,
                    "model_uri": URI_PREFIX + model_id,
                    "params": {k: str(v) for k, v in (model.get("params") or {}).items()},
                    "search_order": order + i,
                }
            )
        self.append("models", self._rows("models", rows))
        return logged

    def log_metrics(
        self,
        metrics: Mapping[str, float],
        model_id: str,
        dataset: str | None = None,
        run_id: str | None = None,
        step: int | None = None,
    ) -> None:
        """All metrics of one evaluation in one write."""
        order = self.next_log_seq(len(metrics))
        rows = [
            {
                "run_id": run_id,
                "model_id": model_id,
                "dataset": dataset,
                "key": key,
                "value": float(value),
                "step": step,
                "log_seq": order + i,
            }
            for i, (key, value) in enumerate(metrics.items())
        ]
        self.append("metrics", self._rows("metrics", rows))

    def register(self, model_id: str, name: str, tags: Mapping[str, str] | None = None) -> int:
        """Next version of a name."""
        arrival = self.spark.createDataFrame([(name, 0)], "name string, arrival bigint")
        existing = self.read("versions").where(F.col("name") == name)
        version = register_versions(arrival, existing).first()["version"]
        row = {"name": name, "version": version, "model_id": model_id, "tags": dict(tags or {})}
        self.append("versions", self._rows("versions", [row]))
        return version


class Run:
    """Context manager: one row in `runs` when it closes, with its status."""

    def __init__(self, store: TrackingStore, run_name: str | None) -> None:
        self.store, self.run_name, self.run_id = store, run_name, uuid.uuid4().hex

    def __enter__(self) -> "Run":
        self._start = datetime.now(timezone.utc)
        return self

    def __exit__(self, kind, error, trace) -> bool:
        row = {
            "run_id": self.run_id,
            "run_name": self.run_name,
            "start_ts": self._start,
            "end_ts": datetime.now(timezone.utc),
            "status": "FAILED" if kind else "FINISHED",
        }
        self.store.append("runs", self.store._rows("runs", [row]))
        return False
