"""Language identification by rank-order profiles of character n-grams.

A profile is the list of a language's most frequent n-grams (one to three characters of a word, word
ends included) by rank.  A document's own list is compared with each profile by the out-of-place
distance: the sum of rank differences, the profile's length for an n-gram that is not in it.  Profile
counts cover all training documents; a profile's size is fixed, so all profiles are small.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F

from modelyard.llm.common import derive

PROFILE = 400
_END = 1  # word boundary; letters are their code point, which is larger
_NAMES = 64  # a task hands its counts on when it holds more languages than this


def _letters() -> np.ndarray:
    """Table over all code points: the code point of a letter, else the word boundary."""
    table = np.full(0x110000, _END, np.int64)
    for point in range(0x110000):
        if chr(point).isalpha():
            table[point] = point
    return table


def grams(text: str, letters: np.ndarray) -> np.ndarray:
    """Codes of all n-grams of a text, none if it has no letter."""
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    a = np.empty(len(points) + 2, np.int64)
    a[0] = a[-1] = _END
    a[1:-1] = letters[points]
    a = a[np.append(True, (a[1:] != _END) | (a[:-1] != _END))]
    if len(a) < 3:
        return np.empty(0, np.int64)
    middle = a[1:-1]
    three = ((a[:-2] << 42) | (middle << 21) | a[2:])[middle != _END]
    return np.concatenate([a[a != _END], (a[:-1] << 21) | a[1:], three])


def ranked(codes: np.ndarray, size: int) -> np.ndarray:
    """The most frequent codes, most frequent first, ties by code."""
    values, counts = np.unique(codes, return_counts=True)
    return values[np.argsort(-counts, kind="stable")[:size]]


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    codes, where = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return codes, np.bincount(where, np.concatenate([p[1] for p in parts]), len(codes)).astype(np.int64)


def _counts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    letters, held = _letters(), {}

    def add(lang: str, waiting: list[np.ndarray]) -> None:
        counted = np.unique(np.concatenate(waiting), return_counts=True)
        held[lang] = _merged([held[lang], counted] if lang in held else [counted])

    def rows() -> Iterator[pd.DataFrame]:
        for lang, (codes, counts) in held.items():
            yield pd.DataFrame({"lang": lang, "code": codes, "n": counts})

    for batch in batches:
        for lang, texts in batch.groupby("lang", sort=False)["text"]:
            waiting, size = [], 0
            for text in texts:
                waiting.append(grams(text, letters))
                size += len(waiting[-1])
                if size > 1 << 21:
                    add(lang, waiting)
                    waiting, size = [], 0
            if waiting:
                add(lang, waiting)
        if len(held) > _NAMES:
            yield from rows()
            held.clear()
    yield from rows()


def profiles(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = PROFILE) -> DataFrame:
    """lang, code, place (from 0): the `size` most frequent n-grams of each language over all rows.

    Rows without language or text teach nothing.  Every task keeps the `size` best of the n-grams it
    counted before they meet, so the window sees that many rows of a language from each of them.
    """
    rows = docs.select(
        F.col(f"`{lang_col}`").cast("string").alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text")
    ).dropna()
    counted = (
        rows.mapInPandas(_counts, "lang string, code bigint, n bigint").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    )
    order = Window.partitionBy("lang").orderBy(F.desc("n"), "code")
    return (
        counted.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= size)
        .select("lang", "code", (F.col("rank") - 1).alias("place"))
    )


def _table(rows: list) -> list[tuple[str, np.ndarray, np.ndarray]]:
    """(language, sorted codes, their places), languages in order of their names."""
    by_lang: dict[str, list] = {}
    for r in rows:
        by_lang.setdefault(r["lang"], []).append((r["code"], r["place"]))
    table = []
    for lang in sorted(by_lang):
        pairs = sorted(by_lang[lang])
        table.append((lang, np.array([c for c, _ in pairs]), np.array([p for _, p in pairs])))
    return table


def distances(own: np.ndarray, table: list, size: int) -> list[int]:
    """Out-of-place distance of a document's ranked codes to each profile."""
    here = np.arange(len(own))
    found = []
    for _, codes, places in table:
        at = np.minimum(np.searchsorted(codes, own), len(codes) - 1)
        found.append(int(np.where(codes[at] == own, np.abs(places[at] - here), size).sum()))
    return found


def identify(
    docs: DataFrame, learned: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = PROFILE
) -> DataFrame:
    """doc_id, lang_pred, score of every row's whole text.

    Score: one less the distance as a share of the largest possible.  A text that is null or has no
    letter, and any text when nothing was learned, is `und` with score 0; equal distances go to the
    language first in order of names.  Repeated rows each give a row; further columns are ignored.
    """
    table = _table(learned.collect())  # at most `size` rows for each language

    def start():
        letters = _letters()

        def work(texts: list) -> dict[str, list]:
            names, scores = [], []
            for text in texts:
                own = ranked(grams(text, letters), size) if text and table else ()
                if len(own) == 0:
                    names.append("und")
                    scores.append(0.0)
                    continue
                apart = distances(own, table, size)
                best = int(np.argmin(apart))
                names.append(table[best][0])
                scores.append(1.0 - apart[best] / (size * len(own)))
            return {"lang_pred": names, "score": scores}

        return work

    texts = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    return derive(texts, start, "lang_pred string, score double")
