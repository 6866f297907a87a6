"""Helpers shared by the operators of this package."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.pandas.types import to_arrow_schema

from modelyard.sources.shared import scratch_path


def documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) of every row; a null text counts as empty, other columns do not matter."""
    return docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )


def read_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """`df` written once to the cluster's shared folder and read back: later readers do not repeat the
    work, and a lost executor costs no more than a second read."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_fold(doc_id: Column, folds: int) -> Column:
    """crc32 of the id as text, modulo `folds`; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds


def derive(
    df: DataFrame,
    start: Callable[[], Callable[[list], dict[str, list]]],
    schema: str,
    text_col: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Columns computed in Python from one text column, next to columns that travel unchanged as Arrow.

    `start` runs once in a task and gives the function from the texts of a batch to its new columns.
    """
    new = T.StructType.fromDDL(schema)
    whole = T.StructType([df.schema[name] for name in keep] + new.fields)
    arrow = to_arrow_schema(new)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = start()
        for batch in batches:
            made = work(batch.column(text_col).to_pylist())
            columns = [batch.column(name) for name in keep] + [pa.array(made[f.name], f.type) for f in arrow]
            yield pa.RecordBatch.from_arrays(columns, [*keep, *arrow.names])

    return df.select(*dict.fromkeys([*keep, text_col])).mapInArrow(rows, whole)
