"""Token counts of a piece model without token ids per document.

The model never joins pieces across the start of a run of blanks (no piece of it has a blank after
another character, which `check_model` verifies), so a text is the sequence of its pre-tokens: a run
of blanks with the characters up to the next run.  Pieces are counted once per distinct pre-token of
the corpus; a document's count is the sum over its pre-token frequencies.

The join has two parts.  Counts of the most frequent pre-tokens travel to every task: the number of
entries (`head_entries`) and the bytes of each (`head_bytes`) are bounded.  All other pre-tokens meet
their counts in a shuffled join.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from modelyard.llm.common import derive, documents, materialise

_FLUSH = 400_000  # distinct pre-tokens a task holds before it hands them on
_RUNS = re.compile(" +[^ ]*")
_BLANK = "▁"  # the model's own sign for a blank


def pre_tokens(text: str) -> list[str]:
    """Pre-tokens in order, each without its first blank; the model puts one before the text."""
    text = text.replace(_BLANK, " ")
    if not text:
        return []
    if "  " in text or text[0] == " ":
        return [run[1:] for run in _RUNS.findall(" " + text)]
    return text.split(" ")


def check_model(processor) -> None:
    """Raises if a piece spans the start of a run of blanks, or blanks are changed by the model."""
    for i in range(processor.vocab_size()):
        if re.search(f"[^{_BLANK}]{_BLANK}", processor.id_to_piece(i)):
            raise ValueError(f"piece {i} spans pre-tokens")
    if processor.encode("") or len(processor.encode("a  b")) == len(processor.encode("a b")):
        raise ValueError("the model drops blanks")


def _processor(model_file: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=model_file)


def _tally(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    seen: Counter[str] = Counter()

    def rows() -> pd.DataFrame:
        return pd.DataFrame({"pre_token": list(seen), "n": np.fromiter(seen.values(), np.int64, len(seen))})

    for batch in batches:
        for text in batch["text"]:
            seen.update(pre_tokens(text))
            if len(seen) > _FLUSH:
                yield rows()
                seen.clear()
    if seen:
        yield rows()


def _piece_counter(model_file: str):
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        processor = _processor(model_file)
        lone = len(processor.encode("a ")) - len(processor.encode("a"))
        for batch in batches:
            keys = list(batch["pre_token"])
            counted = [len(ids) for ids in processor.encode(keys, num_threads=1)] if keys else []
            batch["pieces"] = np.array([c if k else lone for k, c in zip(keys, counted)], np.int64)
            yield batch

    return count


def _head_floor(vocabulary: DataFrame, entries: int) -> int:
    """Smallest power of two from which on at most `entries` pre-tokens are as frequent."""
    classes = {
        r["c"]: r["k"]
        for r in vocabulary.groupBy(F.floor(F.log2("n")).cast("int").alias("c")).agg(F.count("*").alias("k")).collect()
    }
    floor, total = 63, 0
    for c in sorted(classes, reverse=True):
        total += classes[c]
        if total > entries:
            break
        floor = c
    return 1 << floor if floor < 63 else (1 << 63) - 1


def _against_head(head):
    def start():
        known = head.value

        def frequencies(texts: list[str]) -> dict[str, list]:
            made = {"head_tokens": [], "rare": [], "times": []}
            for text in texts:
                total, rare, often = 0, [], []
                for token, n in Counter(pre_tokens(text)).items():
                    pieces = known.get(token)
                    if pieces is None:
                        rare.append(token)
                        often.append(n)
                    else:
                        total += n * pieces
                made["head_tokens"].append(total)
                made["rare"].append(rare)
                made["times"].append(often)
            return made

        return frequencies

    return start


def count_tokens(
    docs: DataFrame,
    model_file: str,
    limit: int = 4096,
    head_entries: int = 1 << 18,
    head_bytes: int = 48,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit for every row of `docs`.

    A null or empty text has no bytes and no tokens; a null id stays null; repeated rows each have
    their own result row; an empty table gives no rows; further columns are ignored.
    `model_file` must be readable at the same place on every executor.
    """
    check_model(_processor(model_file))
    texts = documents(docs, id_col, text_col)
    tallied = texts.select("text").mapInPandas(_tally, "pre_token string, n bigint")
    vocabulary = materialise(
        tallied.groupBy("pre_token")
        .agg(F.sum("n").alias("n"))
        .mapInPandas(_piece_counter(model_file), "pre_token string, n bigint, pieces bigint"),
        "pre-tokens",
    )
    floor = _head_floor(vocabulary, head_entries)
    in_head = (F.col("n") >= floor) & (F.octet_length("pre_token") <= head_bytes)
    common = vocabulary.where(in_head).select("pre_token", "pieces").toPandas()
    head = docs.sparkSession.sparkContext.broadcast(dict(zip(common["pre_token"], common["pieces"].tolist())))

    numbered = texts.withColumns(
        {"row": F.monotonically_increasing_id(), "n_bytes": F.octet_length("text").cast("bigint")}
    )
    base = materialise(
        derive(
            numbered,
            _against_head(head),
            "head_tokens bigint, rare array<string>, times array<bigint>",
            keep=("row", "doc_id", "n_bytes"),
        ),
        "frequencies",
    )
    rare = (
        base.select("row", F.explode(F.arrays_zip("rare", "times")).alias("e"))
        .select("row", F.col("e.rare").alias("pre_token"), F.col("e.times").alias("times"))
        .join(vocabulary.where(~in_head).select("pre_token", "pieces"), "pre_token")
        .groupBy("row")
        .agg(F.sum(F.col("times") * F.col("pieces")).alias("rare_tokens"))
    )
    total = F.col("head_tokens") + F.coalesce("rare_tokens", F.lit(0))
    return base.select("row", "doc_id", "n_bytes", "head_tokens").join(rare, "row", "left").select(
        "doc_id", "n_bytes", total.alias("n_tokens"), (total > limit).alias("over_limit")
    )
