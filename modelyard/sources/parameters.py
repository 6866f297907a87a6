"""Job parameters: text in, empty text means "not given"."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Parameter names and the default tag name.
JOB_PARAMETERS = ("model_name", "model_version", "approval_tag_name")
DEFAULT_APPROVAL_TAG = "Approval_Check"


def require(**params: str | None) -> dict[str, str]:
    """All parameters must be given; an empty one is an error, never a match-all."""
    missing = sorted(name for name, value in params.items() if value is None or str(value).strip() == "")
    if missing:
        raise ValueError(f"parameters not given: {', '.join(missing)}")
    return {name: str(value) for name, value in params.items()}


def query_with(spark: SparkSession, text: str, **params: str | None) -> DataFrame:
    """SQL with named parameters (`:model_name`), bound by Spark, never spliced into the text."""
    return spark.sql(text, args=require(**params))


def parse_version(version: str | int) -> int:
    """Versions arrive as text and are stored as integers."""
    text = require(model_version=str(version))["model_version"]
    if not text.isdigit() or int(text) < 1:
        raise ValueError(f"not a version: {version!r}")
    return int(text)
