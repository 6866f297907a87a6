"""Versions, approval, promotion and desired endpoint state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from modelyard.functions.scalars import endpoint_name, has_key_ignoring_case, uri_subject, uri_version
from modelyard.operators.blocks import numbered
from modelyard.sources.parameters import DEFAULT_APPROVAL_TAG

# The name of evaluation runs, the accepted tag value and the settings of a served entity.
EVALUATION = "evaluation"
APPROVED_VALUE = "approved"
WORKLOAD_SIZE = "Small"
SCALE_TO_ZERO = True

# Arrival numbers are shared by all names, so a name has few of them per block.
_ARRIVAL_BITS = 20


def register_versions(arrivals: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Versions for registrations (name, arrival, ...): dense per name, after the existing ones.

    `arrival` is a unique integer.  Run by one writer at a time.
    """
    fresh = numbered(arrivals, ["name"], "arrival", "version", bits=_ARRIVAL_BITS)
    if existing is None:
        return fresh
    taken = existing.groupBy("name").agg(F.max("version").alias("_taken"))
    return (
        fresh.join(taken, "name", "left")
        .withColumn("version", F.col("version") + F.coalesce("_taken", F.lit(0)))
        .drop("_taken")
    )


def resolve_uris(requests: DataFrame, models: DataFrame, versions: DataFrame, uri: str = "uri") -> DataFrame:
    """Address to model id: `models:/<id>` by id, `models:/<name>/<version>` by version; else NULL."""
    subject, version = uri_subject(F.col(uri)), uri_version(F.col(uri))
    # Neither ids nor names hold a slash, so one key serves both forms.
    key = F.when(subject != "", F.when(version == "", subject).otherwise(F.concat(subject, F.lit("/"), version)))
    parsed = requests.withColumn("_key", key)
    named = F.concat("name", F.lit("/"), F.col("version").cast("string"))
    known = models.select(F.col("model_id").alias("_known"), F.col("model_id").alias("_found")).unionByName(
        versions.select(named.alias("_known"), F.col("model_id").alias("_found"))
    )
    # Malformed addresses share one key, so they stay out of the join.
    found = parsed.where(F.col("_key").isNotNull()).join(known, F.col("_key") == F.col("_known"), "left")
    malformed = parsed.where(F.col("_key").isNull()).withColumns(
        {"_known": F.lit(None).cast("string"), "_found": F.lit(None).cast(models.schema["model_id"].dataType)}
    )
    return found.unionByName(malformed).withColumn("model_id", F.col("_found")).drop("_key", "_known", "_found")


def approval_reason(tags: Column, tag: str = DEFAULT_APPROVAL_TAG) -> Column:
    """`approved`, `rejected`, `missing` or `key_case_mismatch`.

    Presence ignores case, the lookup does not: a key in other case is found but cannot be read.
    """
    value = F.try_element_at(tags, F.lit(tag))
    return (
        F.when(~has_key_ignoring_case(tags, tag), F.lit("missing"))
        .when(F.lower(value) == APPROVED_VALUE, F.lit("approved"))
        .when(F.array_contains(F.map_keys(tags), tag), F.lit("rejected"))
        .otherwise(F.lit("key_case_mismatch"))
    )


def approval_gate(versions: DataFrame, tag: str = DEFAULT_APPROVAL_TAG) -> DataFrame:
    if not tag:
        raise ValueError("tag name not given")
    return versions.withColumn("reason", approval_reason(F.col("tags"), tag)).withColumn(
        "approved", F.col("reason") == "approved"
    )


def evaluations(metrics: DataFrame, runs: DataFrame, run_name: str = EVALUATION) -> DataFrame:
    """Metrics logged in runs of a name: those of training runs are no evaluation."""
    named = runs.where(F.col("run_name") == run_name).select("run_id").distinct()
    return metrics.join(named, "run_id", "left_semi")


def deployable_versions(
    versions: DataFrame,
    evaluations: DataFrame,
    tag: str = DEFAULT_APPROVAL_TAG,
    required: tuple[str, float] | None = None,
) -> DataFrame:
    """Versions that were evaluated and are approved; optionally with a metric of at least a value."""
    passing = evaluations
    if required is not None:
        key, least = required
        passing = passing.where((F.col("key") == key) & (F.col("value") >= least))
    evaluated = passing.select("model_id").distinct()
    return approval_gate(versions, tag).where("approved").join(evaluated, "model_id", "left_semi").drop("approved", "reason")


def desired_endpoints(versions: DataFrame) -> DataFrame:
    """One endpoint per name, serving its latest version."""
    return versions.groupBy("name").agg(F.max("version").alias("entity_version")).select(
        endpoint_name(F.col("name")).alias("endpoint_name"),
        F.col("name").alias("entity_name"),
        "entity_version",
        F.lit(WORKLOAD_SIZE).alias("workload_size"),
        F.lit(SCALE_TO_ZERO).alias("scale_to_zero"),
    )


def upsert_endpoints(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Desired state after an update: incoming rows replace existing ones as a whole, others stay."""
    key = "endpoint_name"
    rest = [c for c in existing.columns if c != key]
    latest = incoming.groupBy(key).agg(F.max_by(F.struct(*rest), "entity_version").alias("_new"))
    current = existing.select(key, F.struct(*rest).alias("_old"))
    chosen = F.coalesce("_new", "_old")
    return current.join(latest, key, "full_outer").select(
        key,
        *[chosen[c].alias(c) for c in rest],
        F.when(F.col("_new").isNull(), "keep").when(F.col("_old").isNull(), "create").otherwise("update").alias("action"),
    )


def resource_manifest(tools: DataFrame, base: DataFrame) -> DataFrame:
    """(resource_kind, resource_name) an agent depends on: the base rows, all resources of index
    tools, one function per function tool; tools of other kinds add nothing."""
    resources = F.when(
        F.col("kind") == "index",
        F.transform("resources", lambda r: F.struct(F.lit("index").alias("resource_kind"), r.alias("resource_name"))),
    ).when(
        F.col("kind") == "function",
        F.array(F.struct(F.lit("function").alias("resource_kind"), F.col("tool_name").alias("resource_name"))),
    )
    return base.select("resource_kind", "resource_name").unionByName(tools.select(F.inline(resources)))
