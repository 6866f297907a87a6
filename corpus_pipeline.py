"""A training corpus from documents: reject toxic ones, drop near-copies, cut repeats, hide secrets, pack."""

from __future__ import annotations

import functools
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from modelyard.llm import packing, secrets, simhash, suffix_dedup, toxicity
from modelyard.llm.common import materialise, read_documents
from modelyard.llm.queries import RANKS, SPECIAL

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

TOXIC_FROM = 0.5

#: No SQL can express the trees, the fingerprints or the tokenizer.
ORACLE_SQL = None


def _carrying(stage: Stage, reads: tuple[str, ...] = (), changes_text: bool = False) -> Stage:
    """The stage over doc_id, text and what else it `reads`, with all other columns carried under names that
    clash with nothing.

    They come back as they were; `n_chars` follows the text where the stage changes it.
    """

    @functools.wraps(stage)
    def over_all_columns(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        carried = {c: f"carried_{i}" for i, c in enumerate(docs.columns) if c not in ("doc_id", "text")}
        plain = docs.select("doc_id", "text", *reads, *[F.col(f"`{c}`").alias(n) for c, n in carried.items()])
        done = stage(spark, plain, sf_dir)
        if changes_text and "n_chars" in carried:
            done = done.withColumn(carried["n_chars"], F.length("text").cast(docs.schema["n_chars"].dataType))
        return done.select(*[F.col(carried.get(c, c)).alias(c) for c in docs.columns])

    return over_all_columns


def _toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, trained on the given labels, scores below the threshold.

    A null or empty text is scored as one without words; rows with equal ids or texts are scored each; an
    empty table gives none; other columns, whatever they are called, stay as they are.
    """
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.with_scores(docs, model)
    return scored.where(F.col("toxic_score") < TOXIC_FROM).drop("toxic_score")


def _simhash(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, that with the smallest id, of each group of near-duplicates.

    Texts without words, null ones among them, are one group; of repeated rows with one id, one stays; an
    empty table gives none; other columns, whatever they are called, stay as they are.
    """
    return simhash.keep_one(docs)


def _suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the passages that occur more than once.

    A null text counts as empty; of equal texts each loses all; other columns, whatever they are called, stay as
    they are, but that `n_chars` follows the text.
    """
    others = tuple(c for c in docs.columns if c != "text")
    cut = suffix_dedup.remove_repeats(docs, keep=others, as_text=True)
    return cut.withColumn("text", F.col("kept")).select(*docs.columns)


def _secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with a mark in place of each secret.

    A null text counts as empty; repeated rows are looked into each; other columns, whatever they are called, stay
    as they are, but that `n_chars` follows the text.
    """
    found = secrets.find(docs, keep=tuple(c for c in docs.columns if c != "doc_id"))
    text = F.coalesce("text", F.lit(""))
    return found.withColumn("text", secrets.redact(text, F.col("found"))).select(*docs.columns)


toxicity_stage = _carrying(_toxicity)
simhash_stage = _carrying(_simhash)
suffix_stage = _carrying(_suffix_dedup, changes_text=True)
secrets_stage = _carrying(_secrets, ("source", "lang"), changes_text=True)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents and their places in token sequences."""
    return packing.pack(docs, RANKS, public_tokenizers.PATTERN, SPECIAL)


STAGES = [
    ("toxicity", toxicity_stage),
    ("simhash", simhash_stage),
    ("suffix_dedup", suffix_stage),
    ("secrets", secrets_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`; each but the last is written to the shared folder and read back."""
    docs = read_documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
