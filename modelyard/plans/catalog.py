"""One callable per registered query: (spark, table folder) -> DataFrame."""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from modelyard.functions import scalars
from modelyard.operators import (
    agents,
    aggregates,
    evaluation,
    gram,
    inverted,
    linear,
    messages,
    metrics,
    models,
    network,
    projections,
    registry,
    rowwise,
    scoring,
    signatures,
    splits,
    tags,
    tracking,
    vectors,
)
from modelyard.plans import standins
from modelyard.sources.shared import cut_lineage, scratch_path
from modelyard.sources.tables import dataset_profile, read_table
from modelyard.sources.tracking_store import TrackingStore
from modelyard.streaming import arrivals, deltas, metric_log

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

WIDTH = 64
CLASSES = 10
LATE = 97
EVALUATED_AT_LEAST = 150.0
PROMPT = "Answer briefly."


def query(function: Query) -> Query:
    QUERIES["q_" + function.__name__.rstrip("_")] = function
    return function


def _long(*names: str) -> list:
    return [F.col(n).cast("bigint").alias(n) for n in names]


# --- sources and datasets ---------------------------------------------------------------------


@query
def source_scan(spark, base):
    return read_table(spark, base, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@query
def dataset_profile_(spark, base):
    events = read_table(spark, base, "events")
    return dataset_profile(events, "events").drop("schema_json")


@query
def schema_conformance(spark, base):
    signature = T.StructType(
        [
            T.StructField("event_id", T.LongType()),
            T.StructField("event_type", T.StringType()),
            T.StructField("value", T.FloatType()),
            T.StructField("step", T.LongType()),
        ]
    )
    events = read_table(spark, base, "events").select("event_id", "event_type", "value", "props")
    return evaluation.schema_conformance(events, signature)


@query
def signature_check(spark, base):
    """Events with values taken away against a signature of wider types: what is wrong with which row."""
    events = read_table(spark, base, "events")
    damaged = events.select(
        "event_id",
        F.when(F.col("event_id") % 7 != 0, F.col("user_id").cast("int")).alias("user_id"),
        F.when(F.col("event_id") % 5 != 0, F.col("value")).alias("value"),
        F.slice(F.array("value", "value", "value"), 1, (F.col("event_id") % 3 + 1).cast("int")).alias("history"),
    )
    signature = T.StructType(
        [
            T.StructField("event_id", T.LongType(), False),
            T.StructField("user_id", T.LongType(), False),
            T.StructField("value", T.DoubleType(), False),
            T.StructField("history", T.ArrayType(T.DoubleType(), False)),
        ]
    )
    good, aside = signatures.conform(damaged, signature, {"history": 2})
    rows = good.withColumn("violations", F.array().cast("array<string>")).unionByName(aside)
    return rows.select("event_id", "user_id", F.array_join("violations", ", ").alias("violations"))


# --- projections ------------------------------------------------------------------------------


@query
def feature_projection(spark, base):
    table = standins.features(spark, base).drop("dataset", "label")
    return projections.features_of(projections.unpack_features(table, "features", WIDTH), "quality")


@query
def label_projection(spark, base):
    table = standins.features(spark, base)
    return projections.label_of(table, "quality").groupBy("quality").agg(F.count(F.lit(1)).alias("n"))


@query
def positional_split(spark, base):
    table = standins.features(spark, base).select("features", "label")
    wide = projections.unpack_features(table, "features", WIDTH)
    return projections.positional_split(wide).select(
        F.size("features").cast("bigint").alias("n_features"),
        F.get("features", F.lit(0)).cast("double").alias("first_feature"),
        F.get("features", F.lit(WIDTH - 1)).cast("double").alias("last_feature"),
        "target",
    )


@query
def binary_label(spark, base):
    table = read_table(spark, base, "embeddings").select("vec_id", "label")
    return projections.with_binary_label(table, "label", 2)


@query
def argmax(spark, base):
    return read_table(spark, base, "embeddings").select(
        "vec_id", scalars.argmax_index(F.col("embedding")).alias("predicted")
    )


@query
def shape(spark, base):
    return projections.shape_summary(read_table(spark, base, "embeddings"), F.col("embedding"), F.col("label"))


@query
def endpoint_name(spark, base):
    name = F.concat(F.lit("main.default."), F.col("c_name"))
    return read_table(spark, base, "customer").select("c_custkey", scalars.endpoint_name(name).alias("endpoint_name"))


@query
def model_uri(spark, base):
    uri = F.when(F.col("arrival") % 2 == 0, scalars.model_uri(F.col("model_id"))).otherwise(
        scalars.version_uri(F.col("name"), F.col("arrival"))
    )
    return (
        standins.registrations(spark, base)
        .withColumn("uri", uri)
        .select(
            "arrival",
            "uri",
            scalars.uri_subject(F.col("uri")).alias("subject"),
            scalars.uri_version(F.col("uri")).alias("version"),
        )
    )


@query
def qualified_name(spark, base):
    catalog = F.when(F.col("p_size") > 3, F.col("p_brand"))
    full = scalars.qualified_name(catalog, F.col("p_type"), F.col("p_name"))
    return (
        read_table(spark, base, "part")
        .withColumn("full_name", full)
        .select(
            "p_partkey",
            "full_name",
            scalars.is_complete_name(F.col("full_name")).alias("is_complete"),
            F.element_at(F.split("full_name", r"\."), -1).alias("model_part"),
        )
    )


@query
def params_map(spark, base):
    params = F.from_json("props", "map<string,string>")
    logged = scalars.stringify_values(F.create_map(F.lit("value"), F.col("value")))
    return read_table(spark, base, "events").select(
        "event_id",
        F.element_at(params, "k").alias("k"),
        scalars.parameter_number(params, "k").alias("k_number"),
        scalars.parameter_number(params, "absent").alias("absent_number"),
        F.element_at(logged, "value").alias("value_text"),
    )


@query
def metric_map_rows(spark, base):
    summary = (
        standins.metric_log(spark, base)
        .groupBy("model_id", "dataset")
        .agg(
            F.create_map(
                F.lit("mean"), F.avg("value"), F.lit("highest"), F.max("value"), F.lit("count"), F.count("value").cast("double")
            ).alias("metrics")
        )
    )
    return metrics.map_rows(summary, "metrics", ["model_id", "dataset"]).withColumn("value", F.round("value", 6))


@query
def checkpoint_steps(spark, base):
    log = standins.metric_log(spark, base)
    return projections.every_nth_step(log, "step", 10).groupBy("step").agg(F.count(F.lit(1)).alias("n"))


# --- splits -----------------------------------------------------------------------------------


@query
def split_hash(spark, base):
    return splits.hash_split(read_table(spark, base, "orders").select("o_orderkey"), "o_orderkey")


@query
def split_exact(spark, base):
    return splits.exact_split(read_table(spark, base, "orders").select("o_orderkey"), "o_orderkey")


# --- metrics ----------------------------------------------------------------------------------


def _rounded(df: DataFrame, digits: int, *names: str) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if c in names else F.col(c) for c in df.columns])


# Prices are squared here, so two digits leave room for the order of summation; R2 keeps six.
_PRICE_METRICS = ("mse", "rmse", "mae", "max_error", "target_sum", "target_mean")


@query
def regression_metrics(spark, base):
    y, p = F.col("y"), F.col("p")
    wide = standins.regression(spark, base).agg(
        metrics.mse(y, p).alias("mse"),
        *[c.alias(f"compat_{k}") for k, c in metrics.compat_metrics(y, p).items()],
        metrics.rmse(y, p).alias("rmse"),
    )
    return _rounded(_rounded(wide, 2, "mse", "compat_rmse", "compat_mae", "rmse"), 6, "compat_r2")


@query
def evaluate_regressor(spark, base):
    result = metrics.evaluate(standins.regression(spark, base), "y", "p")
    return _rounded(_rounded(result, 2, *_PRICE_METRICS), 6, "r2")


@query
def metrics_by_model_dataset(spark, base):
    result = metrics.evaluate(standins.regression(spark, base), "y", "p", by=["model_id", "dataset"])
    return _rounded(_rounded(result, 2, *_PRICE_METRICS), 6, "r2")


@query
def train_test_gap(spark, base):
    wide = metrics.evaluate(standins.regression(spark, base), "y", "p", by=["model_id", "dataset"])
    rows = metrics.metric_rows(wide, ["mae", "r2"], ["model_id", "dataset"])
    return _rounded(metrics.train_test_gap(rows), 4, "train", "test", "gap")


@query
def accuracy(spark, base):
    labels = read_table(spark, base, "labels")
    documents = read_table(spark, base, "documents").select("doc_id", "source")
    joined = labels.join(documents, "doc_id")
    return _rounded(
        metrics.evaluate(joined, "quality", "toxic", "classifier", by=["source"]), 6, "accuracy"
    )


@query
def custom_metric(spark, base):
    extra = {
        "bias": lambda y, p: F.avg(y - p),
        "within_tenth": lambda y, p: F.count_if(F.abs(y - p) <= F.abs(y) * 0.1),
    }
    result = metrics.evaluate(standins.regression(spark, base), "y", "p", by=["dataset"], extra=extra)
    return _rounded(result.select("dataset", "n", "bias", "within_tenth"), 4, "bias")


@query
def custom_aggregates(spark, base):
    """Area under the curve and calibration from mergeable states, by language of the labelled documents."""
    documents = read_table(spark, base, "documents").select("doc_id", "lang", "n_chars")
    labelled = read_table(spark, base, "labels").join(documents, "doc_id")
    scored = labelled.withColumn("score", F.least(F.col("n_chars") % 997 / 1000 + F.col("toxic") / 5, F.lit(1.0)))
    asked = ["toxic", "score"]
    chosen = {"auc": (aggregates.area_under_curve(), asked), "calibration": (aggregates.calibration_error(), asked)}
    return _rounded(aggregates.aggregate(scored, ["lang"], chosen), 6, "auc", "calibration")


@query
def cross_entropy(spark, base):
    return _rounded(metrics.cross_entropy(read_table(spark, base, "embeddings"), "embedding", "label"), 6, "loss")


# --- tracking log -----------------------------------------------------------------------------


@query
def lineage(spark, base):
    log = standins.metric_log(spark, base)
    datasets = log.groupBy("dataset").agg(F.count(F.lit(1)).alias("dataset_rows")).withColumnRenamed("dataset", "name")
    runs = log.groupBy("run_id").agg(F.min("log_seq").alias("first_seq"), F.max("log_seq").alias("last_seq"))
    return tracking.lineage(standins.models(spark, base).drop("search_order"), log, datasets, runs)


@query
def model_lookup(spark, base):
    orders = read_table(spark, base, "orders").where(F.col("o_orderstatus") == "P")
    wanted = orders.select(standins.model_key("o_custkey").alias("model_id"))
    found = tracking.lookup_models(standins.models(spark, base), wanted)
    first = tracking.first_metric(standins.metric_log(spark, base)).withColumnRenamed("model_id", "_m")
    return found.join(first, F.col("model_id") == F.col("_m"), "left").drop("_m")


@query
def model_document(spark, base):
    documents = tracking.model_documents(
        standins.models(spark, base).drop("search_order"), standins.metric_log(spark, base).drop("run_id", "ts")
    )
    shape = (
        "struct<model_id:string,name:string,"
        "metrics:array<struct<log_seq:bigint,key:string,value:double,step:bigint,dataset:string>>>"
    )
    read_back = documents.select("part", F.from_json("document", shape).alias("d"))
    return read_back.select("part", "d.model_id", "d.name", F.inline_outer("d.metrics"))


@query
def first_metric(spark, base):
    log = standins.metric_log(spark, base)
    of_key = tracking.first_metric(log, "purchase").select("model_id", F.col("value").alias("first_purchase"))
    of_any = tracking.first_metric(log).withColumnRenamed("value", "first_value").withColumnRenamed("key", "first_key")
    return of_any.join(of_key, "model_id", "left")


@query
def first_metric_of_dataset(spark, base):
    return tracking.first_metric(standins.metric_log(spark, base), "purchase", "test")


@query
def rank_checkpoints(spark, base):
    ranked = tracking.rank_models(standins.models(spark, base), standins.metric_log(spark, base), "purchase")
    return tracking.with_rank(ranked)


@query
def rank_of_run(spark, base):
    """Models of the last run by one key: of the stored log only the partitions of run and key are read."""
    log = standins.metric_log(spark, base)
    store = TrackingStore(spark, scratch_path(spark, "store"))
    store.append("metrics", log.drop("ts"))
    run = log.agg(F.max("run_id")).first()[0]
    found = store.read_metrics("purchase", [run] if run else [])
    measured = standins.models(spark, base).join(found.select("model_id").distinct(), "model_id", "left_semi")
    return tracking.with_rank(tracking.rank_models(measured, found, "purchase"))


@query
def best_worst(spark, base):
    scored = tracking.score_models(standins.models(spark, base), standins.metric_log(spark, base), "purchase")
    return tracking.best_and_worst(scored)


@query
def best_per_group(spark, base):
    scored = tracking.score_models(standins.models(spark, base), standins.metric_log(spark, base), "purchase")
    return tracking.best_per_group(scored, ["name"])


@query
def metric_curve(spark, base):
    return _rounded(tracking.metric_curve(standins.metric_log(spark, base)), 6, "change")


@query
def latest_metric(spark, base):
    return tracking.latest_metric(standins.metric_log(spark, base))


@query
def metric_windows(spark, base):
    summary = metric_log.windowed_summary(
        standins.metric_log(spark, base).withColumn("ts", metric_log.as_instant("ts")), ["key"]
    )
    return _window_rows(summary)


def _window_rows(summary: DataFrame) -> DataFrame:
    days = F.expr("timestampdiff(DAY, timestamp'1970-01-01 00:00:00Z', window_start)")
    return summary.select(
        days.cast("bigint").alias("day"),
        "key",
        "n",
        F.round("total", 4).alias("total"),
        "lowest",
        "highest",
    )


# --- fitting and scoring ----------------------------------------------------------------------


@query
def elastic_net(spark, base):
    model = linear.fit_elastic_net(standins.features(spark, base), "features", "quality")
    return model.to_table(spark, "elasticnet").select("idx", F.round("value", 8).alias("value"))


@query
def elastic_net_sparse(spark, base):
    """Weaker penalty, so that some weights are not zero; checked by its optimality conditions."""
    table = standins.features(spark, base)
    model = linear.fit_elastic_net(table, "features", "quality", alpha=0.002)
    return model.to_table(spark, "elasticnet").select("idx", F.round("value", 6).alias("value"))


PATH = (0.05, 0.004, 0.002, 0.001)


@query
def elastic_net_path(spark, base):
    """Weights for several penalties from one pass over the rows."""
    models = gram.fit_path(standins.features(spark, base), "features", "quality", PATH)
    return _rounded(gram.path_table(spark, PATH, models), 6, "value")


@query
def train_evaluate(spark, base):
    """Fit on the train part, one scoring pass over both parts, metrics per part."""
    table = standins.features(spark, base)
    model = linear.fit_elastic_net(table.where(F.col("dataset") == "train"), "features", "quality")
    scored = linear.score(table, "features", model)
    result = metrics.evaluate(scored, "quality", "prediction", by=["dataset"])
    return _rounded(result, 6, *[c for c in result.columns if c not in ("dataset", "n")])


def _mean_vectors(table: DataFrame, by: list[str]) -> DataFrame:
    """Mean of every feature per group as coefficient rows."""
    return (
        table.select(*by, F.posexplode("features").alias("idx", "x"))
        .groupBy(*by, "idx")
        .agg(F.avg(F.col("x").cast("double")).alias("value"))
    )


@query
def linear_score(spark, base):
    """Coefficients kept as a table, read back by id, scored in generated code."""
    table = standins.features(spark, base)
    rows = _mean_vectors(table.where(F.col("quality") == 1), []).select(F.lit("mean").alias("model_id"), "idx", "value")
    offset = table.agg(F.avg("quality").alias("value")).select(
        F.lit("mean").alias("model_id"), F.lit(linear.INTERCEPT).alias("idx"), "value"
    )
    model = linear.load_model(rows.unionByName(offset), "mean")
    return linear.score(table, "features", model).select("vec_id", F.round("prediction", 6).alias("prediction"))


@query
def score_many_models(spark, base):
    """A model per class (its mean vector), each scored on both datasets; metrics per model and dataset."""
    table = standins.features(spark, base)
    coefficients = _mean_vectors(table, ["label"]).select(
        F.concat(F.lit("m-"), F.col("label").cast("string")).alias("model_id"), "idx", "value"
    )
    models = linear.packed_models(coefficients)
    classes = models.withColumn("class", F.substring_index("model_id", "-", -1))
    assignments = models.select("model_id", F.explode(F.array(F.lit("train"), F.lit("test"))).alias("dataset"))
    result = scoring.evaluate_models(table, assignments, classes, "label", one_of="class")
    return _rounded(result, 6, "mse", "rmse", "mae", "r2", "max_error", "target_sum", "target_mean")


def formula_weights(shape: network.Shape) -> np.ndarray:
    """Fixed weights from a rule: multiples of 1/64 between -1/2 and 1/2."""
    return ((np.arange(shape.size) * 37 + 11) % 65 - 32) / 64.0


@query
def mlp_score(spark, base):
    """Forward pass and argmax with weights given by a rule, so that SQL can check them."""
    layers = network.Shape(WIDTH, network.HIDDEN, CLASSES)
    table = standins.features(spark, base)
    scored = network.predict(table, "features", layers, formula_weights(layers))
    return scored.select(
        "vec_id",
        scalars.argmax_index(F.col("scores")).alias("predicted"),
        F.round(F.array_max("scores"), 6).alias("top_score"),
    )


def _stored_models(spark: SparkSession) -> tuple[DataFrame, DataFrame, DataFrame]:
    """A linear model and a network with weights given by a rule, as logged models, coefficients and versions."""
    layers = network.Shape(WIDTH, network.HIDDEN, CLASSES)
    widths = f"{layers.inputs}-{layers.hidden}-{layers.classes}"
    logged = spark.createDataFrame(
        [("m-line", models.LINEAR, None), ("m-net", models.NETWORK, {models.WIDTHS: widths})],
        "model_id string, model_type string, params map<string,string>",
    )
    values = formula_weights(layers).tolist()
    rows = [("m-net", i, w) for i, w in enumerate(values)]
    rows += [("m-line", i, w) for i, w in enumerate(values[:WIDTH])] + [("m-line", linear.INTERCEPT, 0.25)]
    versions = spark.createDataFrame([("main.default.net", 2, "m-net")], "name string, version bigint, model_id string")
    return logged, spark.createDataFrame(rows, "model_id string, idx int, value double"), versions


@query
def score_by_address(spark, base):
    """Every row scored by the model at its address: by id, by version, an absent version, no address."""
    logged, coefficients, versions = _stored_models(spark)
    case = F.col("vec_id") % 4
    uri = (
        F.when(case == 0, "models:/m-line")
        .when(case == 1, "models:/main.default.net/2")
        .when(case == 2, "models:/main.default.net/9")
        .otherwise("runs:/m-line")
    )
    requests = standins.features(spark, base).select("vec_id", "features", uri.alias("uri"))
    resolved = registry.resolve_uris(requests, logged, versions)
    scored = models.score_requests(resolved, models.typed_models(logged, coefficients))
    return scored.select(
        "vec_id", "model_id", "status", F.round("prediction", 6).alias("prediction"), F.round(F.array_max("scores"), 6).alias("top_score")
    )


@query
def mlp_updates(spark, base):
    """Weights after each of the first three updates of a training from weights given by a rule."""
    layers = network.Shape(WIDTH, network.HIDDEN, CLASSES)
    table = standins.features(spark, base)
    training = network.train(table, "features", "label", layers, epochs=3, every=1, start=formula_weights(layers))
    rows = network.checkpoint_table(spark, training, "net")
    return rows.select("step", F.posexplode("weights").alias("pos", "v")).withColumn("v", F.round("v", 6))


@query
def mlp_gradient(spark, base):
    """One full-batch gradient at the same weights: a sum per weight, then loss and rows."""
    layers = network.Shape(WIDTH, network.HIDDEN, CLASSES)
    table = standins.features(spark, base)
    sums = network.gradient_table(table, "features", "label", layers, formula_weights(layers))
    return _rounded(sums, 6, "v")


def _network_shape(table: DataFrame) -> network.Shape:
    facts = projections.shape_summary(table, F.col("features"), F.col("label")).first()
    return network.Shape(facts["max_features"], network.HIDDEN, facts["n_classes"])


@query
def mlp_train(spark, base):
    """Loss before every update of full-batch training."""
    table = standins.features(spark, base).where(F.col("dataset") == "train")
    training = network.train(table, "features", "label", _network_shape(table), seed=7)
    rows = [(epoch, float(loss)) for epoch, loss in enumerate(training.losses)]
    return spark.createDataFrame(rows, "epoch bigint, loss double").withColumn("loss", F.round("loss", 4))


@query
def checkpoint_accuracy(spark, base):
    """Checkpoints of one training run, all scored in one pass."""
    table = standins.features(spark, base).where(F.col("dataset") == "train")
    training = network.train(table, "features", "label", _network_shape(table), seed=7)
    name = F.concat(F.lit("net-"), F.col("step").cast("string"))
    return network.checkpoint_accuracy(table, "features", "label", training).select(
        name.alias("name"), "step", "n", "accuracy"
    )


def _class_means(table: DataFrame) -> DataFrame:
    """Mean vector of every class as a query: one row per class, features gathered in order."""
    return (
        _mean_vectors(table, ["label"])
        .groupBy("label")
        .agg(F.array_sort(F.collect_list(F.struct("idx", "value"))).alias("pairs"))
        .select(
            F.col("label").cast("bigint").alias("query_id"),
            F.transform("pairs", lambda p: p["value"]).alias("embedding"),
        )
    )


@query
def vector_means(spark, base):
    """Ten nearest vectors to the mean vector of every class."""
    means = _class_means(standins.features(spark, base))
    return _rounded(vectors.nearest(read_table(spark, base, "embeddings"), means, 10), 6, "similarity")


def _asked(table: DataFrame) -> DataFrame:
    """Every vector whose id is a multiple of 20 as a query."""
    return table.where(F.col("vec_id") % 20 == 0).select(F.col("vec_id").alias("query_id"), "embedding")


@query
def vector_topk(spark, base):
    """Ten nearest of all vectors to every vector whose id is a multiple of 20."""
    table = read_table(spark, base, "embeddings")
    return _rounded(vectors.nearest(table, _asked(table), 10), 6, "similarity")


@query
def vector_lsh(spark, base):
    """The same by hash buckets with exact re-ranking; which vectors are found is approximate."""
    table = read_table(spark, base, "embeddings")
    return _rounded(vectors.nearest_in_buckets(table, _asked(table), 10), 6, "similarity")


@query
def vector_index(spark, base):
    """The same through an index of inverted files; which vectors are found is approximate."""
    table = read_table(spark, base, "embeddings")
    index = inverted.build(table, scratch_path(spark, "index"))
    return _rounded(inverted.search(index, _asked(table), 10), 6, "similarity")


@query
def vector_index_recall(spark, base):
    """The index against the exact search: neighbours wanted, and whether it finds 90 % of them
    while it compares less than 20 % of the pairs."""
    table = read_table(spark, base, "embeddings")
    index = inverted.build(table, scratch_path(spark, "index"))
    asked = _asked(table)
    found = inverted.recall(inverted.search(index, asked, 10), vectors.nearest(table, asked, 10))
    met = inverted.pairs_compared(index, asked).first()
    return found.select(
        "wanted",
        F.lit(met["pairs"]).cast("bigint").alias("pairs"),
        (F.col("recall") >= 0.9).alias("recall_reached"),
        F.lit(met["compared"] < 0.2 * met["pairs"]).alias("few_compared"),
    )


@query
def vector_filtered(spark, base):
    """An index whose lists are all looked into, with a condition on a kept column: exact again."""
    table = read_table(spark, base, "embeddings")
    index = inverted.build(table, scratch_path(spark, "index"), ["label"], files=1)
    return _rounded(inverted.search(index, _asked(table), 5, "label = 3", share=1.0), 6, "similarity")


# --- messages and agents ----------------------------------------------------------------------


@query
def prepend_system(spark, base):
    conversations = read_table(spark, base, "conversations").select("conv_id", "turn", "role", "text")
    return messages.with_system_turn(conversations, PROMPT)


@query
def last_message(spark, base):
    return messages.last_messages(standins.turns(spark, base))


@query
def route(spark, base):
    return messages.route_conversations(standins.turns(spark, base))


def _message_rows(flat: DataFrame, column: str) -> DataFrame:
    return flat.select(
        "conv_id",
        "event_seq",
        *_long("node_pos", "msg_pos"),
        "node",
        F.col(f"{column}.role").alias("role"),
        F.col(f"{column}.content").alias("content"),
        scalars.is_truthy_list(F.col(f"{column}.tool_calls")).alias("calls_tools"),
    )


@query
def flatten_updates(spark, base):
    return _message_rows(messages.flatten_updates(standins.update_events(spark, base)), "message")


@query
def message_validate(spark, base):
    """Turns with a role taken away from every fourth and the text from every seventh conversation."""
    role = F.when(F.col("conv_id") % 4 != 0, F.col("role"))
    text = F.when(F.col("conv_id") % 7 != 0, F.col("text"))
    damaged = read_table(spark, base, "conversations").select("conv_id", "turn", role.alias("role"), text.alias("text"))
    valid, quarantined = messages.split_valid(damaged)
    return valid.withColumn("status", F.lit("ok")).unionByName(quarantined).select("conv_id", "turn", "status")


@query
def pair_turns(spark, base):
    return messages.pair_turns(read_table(spark, base, "conversations"))


@query
def trace_summary(spark, base):
    return messages.trace_summary(read_table(spark, base, "conversations"))


def _scripted_responder(batch: pd.DataFrame) -> pd.DataFrame:
    """Offline stand-in for a chat model: one tool call per round, as many rounds as n_turns % 3."""
    replies = []
    for text, n_turns, new in zip(batch["last_text"], batch["n_turns"], batch["new_messages"]):
        done = len(new) // 2
        if done < n_turns % 3:
            call = {"id": f"call-{done}", "name": "measure" if done == 0 else "absent", "arguments": text}
            replies.append({"role": "assistant", "content": f"round {done}", "tool_calls": [call]})
        else:
            last = new[-1]["content"] if len(new) else "no tools"
            replies.append({"role": "assistant", "content": f"done: {last}", "tool_calls": None})
    return pd.DataFrame(replies, columns=["role", "content", "tool_calls"])


@query
def agent_batch(spark, base):
    tools = agents.Tools({"measure": F.length})
    answered = agents.run_agent(read_table(spark, base, "conversations"), _scripted_responder, tools, PROMPT)
    return answered.select(
        "conv_id",
        "seq",
        "role",
        "content",
        scalars.is_truthy_list(F.col("tool_calls")).alias("calls_tools"),
        "finished",
    )


class _Digest:
    """A memory that depends on every turn and on their order."""

    def start(self):
        return hashlib.md5()

    def read(self, memory, roles, texts):
        for role, text in zip(roles, texts):
            memory.update(f"{role or ''}:{text or ''}\n".encode())
        return memory

    def finish(self, memory):
        return memory.hexdigest()


def _digest_responder(batch: pd.DataFrame) -> pd.DataFrame:
    """Asks a tool about half of the memories, then names what it remembers."""
    replies = []
    for memory, new in zip(batch["memory"], batch["new_messages"]):
        if memory[0] < "8" and not len(new):
            call = {"id": "call", "name": "upper", "arguments": memory}
            replies.append({"role": "assistant", "content": "asks", "tool_calls": [call]})
        else:
            replies.append({"role": "assistant", "content": f"read: {memory}", "tool_calls": None})
    return pd.DataFrame(replies, columns=["role", "content", "tool_calls"])


class Excerpts:
    """For the n-th user turn, n mod 3 rows with the characters read so far; at the end one row of totals."""

    def __init__(self, least: int) -> None:
        self.least, self.users, self.chars, self.conversation = least, 0, 0, None

    def row(self, row):
        self.conversation = row["conv_id"]
        self.chars += len(row["text"] or "")
        if row["role"] == "user":
            self.users += 1
            for part in range(self.users % 3):
                yield row["conv_id"], row["turn"], part, self.chars

    def end(self):
        if self.users >= self.least:
            yield self.conversation, -1, self.users, self.chars


@query
def respond_rows(spark, base):
    """A responder that gives no, one or two rows for a turn and sees the turns of a conversation in order."""
    turns = read_table(spark, base, "conversations").select("conv_id", "turn", "role", "text")
    schema = "conv_id bigint, turn bigint, part bigint, chars bigint"
    return rowwise.respond_rows(turns, Excerpts, schema, ["conv_id"], ["turn"], least=2)


@query
def agent_history(spark, base):
    """An agent whose answer depends on every turn of its conversation."""
    tools = agents.Tools()
    tools.add_builtin("upper")
    answered = agents.run_agent(
        read_table(spark, base, "conversations"), _digest_responder, tools, PROMPT, history=_Digest()
    )
    return answered.select(
        "conv_id", "seq", "role", "content", scalars.is_truthy_list(F.col("tool_calls")).alias("calls_tools"), "finished"
    )


@query
def predict_batch(spark, base):
    requests = read_table(spark, base, "conversations").where(F.col("role") == "user").select("conv_id", "turn", "text")
    answered = agents.predict_once(requests, lambda text: "chars: " + text.str.len().astype(str), "text")
    return answered.select("conv_id", "turn", "response")


# --- evaluation of responses ------------------------------------------------------------------


@query
def token_f1(spark, base):
    scored = evaluation.token_overlap(standins.responses(spark, base), "response", "expected")
    return _rounded(scored.drop("lang", "response", "expected"), 6, "precision", "recall", "f1")


@query
def eval_rows(spark, base):
    """Result table of an evaluation: request, response, expected and the scores of each row."""
    request_id = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    paired = messages.pair_turns(read_table(spark, base, "conversations"))
    items = read_table(spark, base, "benchmark").select("item_id", F.col("text").alias("expected"))
    n_items = items.agg(F.count(F.lit(1))).scalar()
    rows = (
        paired.withColumn("item_id", F.col("conv_id") % n_items)
        .join(items, "item_id")
        .select(request_id.alias("request_id"), "request", "response", "expected")
    )
    return _rounded(evaluation.token_overlap(rows, "response", "expected"), 6, "precision", "recall", "f1")


@query
def eval_summary(spark, base):
    scored = evaluation.token_overlap(standins.responses(spark, base), "response", "expected")
    summary = evaluation.summarise(scored, ["lang"])
    return _rounded(summary, 6, "exact_match", "precision", "recall", "f1")


@query
def rouge_l(spark, base):
    scored = evaluation.rouge_l(standins.responses(spark, base), "response", "expected")
    return _rounded(
        scored.select("request_id", "lcs", "lcs_precision", "lcs_recall", "lcs_f1"), 6, "lcs_precision", "lcs_recall", "lcs_f1"
    )


@query
def toolcall_pr(spark, base):
    """Event types per user and day: those of train rows as predicted calls, of test rows as expected."""
    kind = F.col("key")
    # The sets hold distinct tool names, so they are bounded by the number of tools.
    calls = (
        standins.metric_log(spark, base)
        .groupBy("model_id", "run_id")
        .agg(
            F.collect_set(F.when(F.col("dataset") == "train", kind)).alias("predicted"),
            F.collect_set(F.when(F.col("dataset") == "test", kind)).alias("expected"),
        )
    )
    scored = evaluation.tool_call_scores(calls, "predicted", "expected").drop("predicted", "expected")
    return _rounded(scored, 6, "tool_precision", "tool_recall")


# --- registry ---------------------------------------------------------------------------------


def _registered(spark: SparkSession, base: str, written: bool = False) -> tuple[DataFrame, DataFrame]:
    """(existing, fresh) versions: the later registrations come on top of the earlier ones.

    `written` numbers the existing ones once, for plans that read them more than once.
    """
    registered = standins.registrations(spark, base)
    existing = registry.register_versions(registered.where("is_earlier"))
    if written:
        existing = cut_lineage(existing)
    return existing, registry.register_versions(registered.where("not is_earlier"), existing)


@query
def register_versions(spark, base):
    return _registered(spark, base)[1].select("arrival", "name", "version")


@query
def resolve_uri(spark, base):
    existing, fresh = _registered(spark, base, written=True)
    versions = existing.unionByName(fresh)
    case = F.col("arrival") % 3
    uri = (
        F.when(case == 0, scalars.model_uri(F.col("model_id")))
        .when(case == 1, scalars.version_uri(F.col("name"), F.col("arrival") % 20 + 1))
        .otherwise(F.concat(F.lit("runs:/"), F.col("name")))
    )
    requests = standins.registrations(spark, base).select("arrival", uri.alias("uri"))
    return registry.resolve_uris(requests, standins.models(spark, base), versions)


def _tagged(spark: SparkSession, base: str) -> DataFrame:
    return standins.registrations(spark, base).select(
        "name", F.col("arrival").alias("version"), "model_id", standins.version_tags().alias("tags")
    )


@query
def approval_gate(spark, base):
    return registry.approval_gate(_tagged(spark, base)).select("version", "approved", "reason")


@query
def gate_at_two_times(spark, base):
    """The gate for every version at two times, by the tags that held then."""
    history = standins.tag_history(spark, base)
    times = F.explode(F.array(*[F.expr(t) for t in standins.GATE_TIMES])).alias("asked_at")
    requests = history.select("name", "version").distinct().select("name", "version", times)
    day = F.date_format("asked_at", "yyyy-MM-dd").alias("asked_on")
    return tags.gate_as_of(requests, history).select("name", "version", day, F.size("tags").cast("bigint").alias("n_tags"), "reason", "approved")


@query
def deployable_versions(spark, base):
    log = standins.metric_log(spark, base)
    return registry.deployable_versions(_tagged(spark, base), log).select("name", "version", "model_id")


@query
def deployable_evaluated(spark, base):
    """Approved versions whose model reached a value in an evaluation run; the runs of even days are such."""
    log = standins.metric_log(spark, base)
    even = F.day(F.to_date(F.substring("run_id", 3, 10))) % 2 == 0
    runs = log.select("run_id").distinct().withColumn("run_name", F.when(even, registry.EVALUATION).otherwise("training"))
    evaluated = registry.evaluations(log, runs)
    gate = registry.deployable_versions(_tagged(spark, base), evaluated, required=("purchase", EVALUATED_AT_LEAST))
    return gate.select("name", "version", "model_id")


@query
def deployable_with_threshold(spark, base):
    latest = tracking.latest_metric(standins.metric_log(spark, base), ["model_id", "key"])
    gate = registry.deployable_versions(_tagged(spark, base), latest, required=("purchase", 10.0))
    return gate.select("name", "version", "model_id")


@query
def endpoint_upsert(spark, base):
    registered = standins.registrations(spark, base).withColumn("version", F.col("arrival"))
    existing = registry.desired_endpoints(registered.where("is_earlier"))
    incoming = registry.desired_endpoints(registered.where("not is_earlier"))
    return registry.upsert_endpoints(existing, incoming)


@query
def resource_manifest(spark, base):
    suppliers = read_table(spark, base, "supplier").select(
        F.lit("endpoint").alias("resource_kind"), F.col("s_name").alias("resource_name")
    )
    return registry.resource_manifest(standins.tools(spark, base), suppliers)


# --- streams ----------------------------------------------------------------------------------


def _streamed_log(stream: DataFrame) -> DataFrame:
    return stream.select(
        standins.model_key("user_id").alias("model_id"),
        F.col("event_type").alias("key"),
        "value",
        F.col("event_id").alias("log_seq"),
        metric_log.as_instant("ts").alias("ts"),
    )


def _events_stream(spark: SparkSession, base: str) -> DataFrame:
    return _streamed_log(metric_log.read_log(spark, f"{base}/events.parquet"))


@query
def stream_deltas(spark, base):
    path = scratch_path(spark, "deltas")
    calls = (F.col("role") == "assistant") & (F.length("text") % 3 == 0)
    call = F.struct(F.lit("c").alias("id"), F.lit("measure").alias("name"), F.lit("{}").alias("arguments"))
    message = F.struct("role", F.col("text").alias("content"), F.when(calls, F.array(call)).alias("tool_calls"))
    events = metric_log.read_log(spark, f"{base}/conversations.parquet").select(
        "conv_id",
        F.col("turn").alias("event_seq"),
        F.create_map(F.lit("agent"), F.struct(F.array(message).alias("messages"))).alias("event"),
    )
    stream = deltas.delta_stream(events)
    metric_log.append_to(stream, f"{path}/rows", f"{path}/progress").awaitTermination()
    return _message_rows(spark.read.schema(stream.schema).parquet(f"{path}/rows"), "delta")


@query
def stream_dedup(spark, base):
    """Every log row arrives twice; one of the two is kept, in whatever order the files come."""
    path, log = scratch_path(spark, "dedup"), _events_stream(spark, base)
    kept = arrivals.first_arrivals(log.unionByName(log))
    metric_log.append_to(kept, f"{path}/rows", f"{path}/progress").awaitTermination()
    return spark.read.schema(kept.schema).parquet(f"{path}/rows").select("model_id", "key", "value", "log_seq")


@query
def stream_best(spark, base):
    path, group = scratch_path(spark, "best"), ["model_id", "key"]
    metric_log.follow_best(_events_stream(spark, base), group, f"{path}/board", f"{path}/progress").awaitTermination()
    return metric_log.board(spark.read.parquet(f"{path}/board"), group)


@query
def stream_windows(spark, base):
    """Two arrivals, the second after the first has moved the watermark: late rows and open windows stay out."""
    path = scratch_path(spark, "windows")
    events = read_table(spark, base, "events").select("event_id", "user_id", "event_type", "value", "ts")
    late = F.col("event_id") % LATE == 0
    for arrival in (events.where(~late), events.where(late)):
        arrival.write.mode("append").parquet(f"{path}/in")
        log = _streamed_log(metric_log.read_log(spark, f"{path}/in", max_files_per_trigger=None))
        summary = metric_log.windowed_summary(log, ["key"])
        metric_log.append_to(summary, f"{path}/rows", f"{path}/progress").awaitTermination()
    return _window_rows(spark.read.schema(summary.schema).parquet(f"{path}/rows"))
