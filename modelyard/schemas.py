"""Declared schemas of the tables the engine keeps.  Nothing is inferred from samples."""

from __future__ import annotations

from pyspark.sql import types as T

TOOL_CALL = T.StructType(
    [
        T.StructField("id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("arguments", T.StringType()),
    ]
)

MESSAGE = T.StructType(
    [
        T.StructField("role", T.StringType()),
        T.StructField("content", T.StringType()),
        T.StructField("tool_calls", T.ArrayType(TOOL_CALL)),
    ]
)

UPDATE_EVENT = T.MapType(T.StringType(), T.StructType([T.StructField("messages", T.ArrayType(MESSAGE))]))

RUNS = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("run_name", T.StringType()),
        T.StructField("start_ts", T.TimestampType()),
        T.StructField("end_ts", T.TimestampType()),
        T.StructField("status", T.StringType()),
    ]
)

LOGGED_MODELS = T.StructType(
    [
        T.StructField("model_id", T.StringType(), False),
        T.StructField("run_id", T.StringType()),
        T.StructField("name", T.StringType()),
        T.StructField("params", T.MapType(T.StringType(), T.StringType())),
        T.StructField("step", T.LongType()),
        T.StructField("model_type", T.StringType()),
        T.StructField("model_uri", T.StringType()),
        T.StructField("signature_json", T.StringType()),
        T.StructField("search_order", T.LongType()),
    ]
)

METRICS = T.StructType(
    [
        T.StructField("run_id", T.StringType()),
        T.StructField("model_id", T.StringType(), False),
        T.StructField("dataset", T.StringType()),
        T.StructField("key", T.StringType(), False),
        T.StructField("value", T.DoubleType()),
        T.StructField("step", T.LongType()),
        T.StructField("log_seq", T.LongType(), False),
    ]
)

DATASETS = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("schema_json", T.StringType()),
        T.StructField("n_rows", T.LongType()),
        T.StructField("digest", T.StringType()),
    ]
)

COEFFICIENTS = T.StructType(
    [
        T.StructField("model_id", T.StringType(), False),
        T.StructField("idx", T.IntegerType(), False),
        T.StructField("value", T.DoubleType(), False),
    ]
)

TRAINING_STATES = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("step", T.LongType(), False),
        T.StructField("pos", T.IntegerType(), False),
        T.StructField("weight", T.DoubleType(), False),
        T.StructField("first", T.DoubleType(), False),
        T.StructField("second", T.DoubleType(), False),
    ]
)

MODEL_VERSIONS = T.StructType(
    [
        T.StructField("name", T.StringType(), False),
        T.StructField("version", T.LongType(), False),
        T.StructField("model_id", T.StringType()),
        T.StructField("tags", T.MapType(T.StringType(), T.StringType())),
    ]
)

ENDPOINTS = T.StructType(
    [
        T.StructField("endpoint_name", T.StringType(), False),
        T.StructField("entity_name", T.StringType()),
        T.StructField("entity_version", T.LongType()),
        T.StructField("workload_size", T.StringType()),
        T.StructField("scale_to_zero", T.BooleanType()),
    ]
)

EVAL_SET = T.StructType(
    [
        T.StructField("request_id", T.LongType(), False),
        T.StructField("request", T.StringType()),
        T.StructField("expected_response", T.StringType()),
    ]
)
