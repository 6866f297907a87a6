"""Reading tables and binding named datasets."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from modelyard.functions.hashing import hash60


def read_table(spark: SparkSession, base: str, name: str) -> DataFrame:
    """Lazy parquet scan; column pruning and filters reach the file reader."""
    return spark.read.parquet(f"{base.rstrip('/')}/{name}.parquet")


def table_from_rows(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Literal table with a declared schema; for hand-written evaluation sets, not for data."""
    return spark.createDataFrame(rows, schema)


@dataclass(frozen=True)
class NamedDataset:
    """A frame with the name that metrics are linked to."""

    df: DataFrame
    name: str

    def profile(self) -> DataFrame:
        return dataset_profile(self.df, self.name)


def _canonical_text(field: T.StructField) -> Column:
    col = F.col(f"`{field.name}`")
    if isinstance(field.dataType, T.TimestampNTZType):
        text = F.expr(f"cast(timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', `{field.name}`) as string)")
    elif isinstance(field.dataType, T.TimestampType):
        text = F.unix_micros(col).cast("string")
    elif isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType)):
        text = F.to_json(F.struct(col))
    else:
        text = col.cast("string")
    return F.coalesce(text, F.lit("\u0000"))


def row_digest(df: DataFrame) -> Column:
    """60-bit digest of a whole row; field order matters, row order does not."""
    return hash60(F.concat_ws("\u0001", *[_canonical_text(f) for f in df.schema.fields]))


def dataset_profile(df: DataFrame, name: str) -> DataFrame:
    """Row count, NULL count over all cells, schema and an order-insensitive digest in one scan.

    The digest adds 60-bit row digests as DECIMAL(38,0): 2^60 fits about 10^20 rows.
    """
    nulls = sum((F.col(f"`{c}`").isNull().cast("long") for c in df.columns), F.lit(0).cast("long"))
    return df.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.coalesce(F.sum(nulls), F.lit(0)).alias("n_null_cells"),
        F.coalesce(F.sum(row_digest(df).cast("decimal(38,0)")).cast("string"), F.lit("0")).alias("digest"),
    ).select(
        F.lit(name).alias("name"),
        F.lit(df.schema.json()).alias("schema_json"),
        "n_rows",
        "n_null_cells",
        "digest",
    )
