"""Tags of versions as a history, and the tags a version had at a time.

A history row sets a key of a version at a time, or removes it by a NULL value.  What held at a time is
the newest row per key before it: an aggregate that combines before the shuffle, so neither a version
nor a key with a long history is sorted or gathered anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from modelyard.operators import registry
from modelyard.sources.parameters import DEFAULT_APPROVAL_TAG

VERSION = ["name", "version"]


def tags_as_of(requests: DataFrame, history: DataFrame, at: str = "asked_at") -> DataFrame:
    """`requests` (name, version, `at`) with `tags`, the map that held at that time.

    `history` has (name, version, key, value, set_at, seq); of two rows of one time the larger `seq` is
    newer.  Rows set at the asked time count.  Rows without key or time, and requests without name, version
    or time, meet nothing; a version without tags has an empty map.  Equal requests each get an answer.

    Requests of one version at one time are answered once: first the (version, time) pairs are reduced,
    then the answers are joined back.
    """
    asked = requests.select(*VERSION, F.col(at).alias("_at")).distinct()
    rows = history.where(F.col("key").isNotNull() & F.col("set_at").isNotNull())
    newest = F.max_by("value", F.struct("set_at", "seq"))
    held = (
        rows.join(asked, VERSION)
        .where(F.col("set_at") <= F.col("_at"))
        .groupBy(*VERSION, "_at", "key")
        .agg(newest.alias("value"))
        .where(F.col("value").isNotNull())
        # One entry for each key that is set.
        .groupBy(*VERSION, "_at")
        .agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("tags"))
        .withColumnRenamed("_at", at)
    )
    none = F.from_json(F.lit("{}"), "map<string,string>")
    return requests.join(held, [*VERSION, at], "left").withColumn("tags", F.coalesce("tags", none))


def gate_as_of(
    requests: DataFrame, history: DataFrame, tag: str = DEFAULT_APPROVAL_TAG, at: str = "asked_at"
) -> DataFrame:
    """The approval gate with the tags of the asked time: `requests` and tags, reason, approved."""
    return registry.approval_gate(tags_as_of(requests, history, at), tag)


def current_tags(history: DataFrame) -> DataFrame:
    """(name, version, tags) of all versions with a tag, as of their newest rows."""
    newest = F.max_by("value", F.struct("set_at", "seq"))
    kept = history.where(F.col("key").isNotNull() & F.col("set_at").isNotNull()).groupBy(*VERSION, "key").agg(newest.alias("value"))
    return (
        kept.where(F.col("value").isNotNull())
        .groupBy(*VERSION)
        .agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("tags"))
    )


def with_tags(versions: DataFrame, tags: DataFrame) -> DataFrame:
    """`versions` joined with (name, version, tags); a version without tags has an empty map."""
    none = F.from_json(F.lit("{}"), "map<string,string>")
    own = tags.select(*VERSION, F.col("tags").alias("_tags"))
    return versions.join(own, VERSION, "left").withColumn("tags", F.coalesce("_tags", none)).drop("_tags")
