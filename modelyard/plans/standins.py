"""The given tables read as lifecycle tables.

customer -> models, events -> metric log, orders -> registrations, versions, endpoints,
lineitem x part -> scored regression, embeddings -> features and labels,
conversations -> messages, documents x benchmark -> responses with expected texts, part -> tools.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from modelyard.functions.scalars import binary_label
from modelyard.operators.splits import hash_split
from modelyard.sources.tables import read_table

MEDIAN_DATE = "timestamp_ntz'1998-04-25 00:00:00'"
N_STEPS = 101
TAG = "Approval_Check"


def model_key(column: str) -> Column:
    return F.concat(F.lit("m-"), F.col(column).cast("string"))


def models(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "customer").select(
        model_key("c_custkey").alias("model_id"),
        F.col("c_mktsegment").alias("name"),
        F.col("c_custkey").alias("search_order"),
    )


def metric_log(spark: SparkSession, base: str) -> DataFrame:
    events = read_table(spark, base, "events")
    return hash_split(events, "event_id").select(
        F.concat(F.lit("r-"), F.date_format("ts", "yyyy-MM-dd")).alias("run_id"),
        model_key("user_id").alias("model_id"),
        "dataset",
        F.col("event_type").alias("key"),
        "value",
        (F.col("event_id") % N_STEPS).alias("step"),
        F.col("event_id").alias("log_seq"),
        "ts",
    )


def registrations(spark: SparkSession, base: str) -> DataFrame:
    return read_table(spark, base, "orders").select(
        F.concat(F.lit("main.default.m"), F.col("o_custkey").cast("string")).alias("name"),
        F.col("o_orderkey").alias("arrival"),
        model_key("o_custkey").alias("model_id"),
        (F.col("o_orderdate") < F.expr(MEDIAN_DATE)).alias("is_earlier"),
    )


def version_tags() -> Column:
    """The four cases of the gate, by arrival number."""
    case = F.col("arrival") % 4
    empty = F.from_json(F.lit("{}"), "map<string,string>")
    return (
        F.when(case == 0, empty)
        .when(case == 1, F.create_map(F.lit(TAG), F.lit("Approved")))
        .when(case == 2, F.create_map(F.lit(TAG), F.lit("Rejected")))
        .otherwise(F.create_map(F.lit(TAG.upper()), F.lit("Approved")))
    )


GATE_TIMES = ("timestamp_ntz'1996-06-30 00:00:00'", "timestamp_ntz'1999-12-31 00:00:00'")


def tag_history(spark: SparkSession, base: str) -> DataFrame:
    """Orders as tag changes: three versions a customer, set, changed, removed, with the key in two cases."""
    status = F.col("o_orderstatus")
    return read_table(spark, base, "orders").select(
        F.concat(F.lit("main.default.m"), F.col("o_custkey").cast("string")).alias("name"),
        (F.col("o_orderkey") % 3 + 1).alias("version"),
        F.when(F.col("o_orderkey") % 5 == 0, "owner").when(F.col("o_orderkey") % 5 == 1, TAG.upper()).otherwise(TAG).alias("key"),
        F.when(status == "O", "approved").when(status == "F", "Rejected").alias("value"),
        F.col("o_orderdate").cast("timestamp_ntz").alias("set_at"),
        F.col("o_orderkey").alias("seq"),
    )


def regression(spark: SparkSession, base: str) -> DataFrame:
    lineitem = read_table(spark, base, "lineitem")
    part = read_table(spark, base, "part").select("p_partkey", "p_retailprice")
    scored = lineitem.join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        "l_orderkey",
        "l_suppkey",
        F.col("l_extendedprice").alias("y"),
        (F.col("l_quantity") * F.col("p_retailprice")).alias("p"),
    )
    return hash_split(scored, "l_orderkey").withColumn("model_id", model_key("l_suppkey"))


def features(spark: SparkSession, base: str) -> DataFrame:
    embeddings = read_table(spark, base, "embeddings")
    return hash_split(embeddings, "vec_id").select(
        "vec_id",
        F.col("embedding").alias("features"),
        "label",
        binary_label(F.col("label"), 2).alias("quality"),
        "dataset",
    )


def turns(spark: SparkSession, base: str) -> DataFrame:
    """Conversations; an assistant turn calls a tool when its length is a multiple of three."""
    calls = (F.col("role") == "assistant") & (F.length("text") % 3 == 0)
    call = F.struct(
        F.concat_ws("-", F.lit("call"), F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
        F.lit("measure").alias("name"),
        F.lit("{}").alias("arguments"),
    )
    return read_table(spark, base, "conversations").withColumn("tool_calls", F.when(calls, F.array(call)))


def update_events(spark: SparkSession, base: str) -> DataFrame:
    """One update event per turn; system turns come from a node without messages."""
    message = F.struct("role", F.col("text").alias("content"), "tool_calls")
    messages = F.when(F.col("role") != "system", F.array(message))
    node = F.when(F.col("role") == "assistant", F.lit("agent")).otherwise(F.lit("tools"))
    return turns(spark, base).select(
        "conv_id", F.col("turn").alias("event_seq"), F.create_map(node, F.struct(messages.alias("messages"))).alias("event")
    )


def responses(spark: SparkSession, base: str) -> DataFrame:
    """Every document as a response, with a benchmark text as what was expected."""
    benchmark = read_table(spark, base, "benchmark").select("item_id", F.col("text").alias("expected"))
    n_items = benchmark.agg(F.count(F.lit(1))).scalar()
    documents = read_table(spark, base, "documents").select(
        F.col("doc_id").alias("request_id"),
        "lang",
        F.col("text").alias("response"),
        (F.col("doc_id") % n_items).alias("item_id"),
    )
    return documents.join(benchmark, "item_id").drop("item_id")


def tools(spark: SparkSession, base: str) -> DataFrame:
    kind = F.col("p_size") % 3
    return read_table(spark, base, "part").select(
        F.concat(F.lit("tool-"), F.col("p_partkey").cast("string")).alias("tool_name"),
        F.when(kind == 0, "index").when(kind == 1, "function").otherwise("local").alias("kind"),
        F.array("p_brand", "p_type").alias("resources"),
    )
