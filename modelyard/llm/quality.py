"""Quality of texts by naive Bayes support vectors.

A text is the set of its n-grams: tokens, pairs of tokens and triples of token shapes, each hashed to
one of 2^BITS buckets.  A bucket's indicator is scaled by the log ratio of its shares in the two
classes, counted over all labelled rows; a linear classifier with hinge loss is fitted to the scaled
indicators by dual coordinate descent, and its margins are turned into probabilities by a logistic
curve, which is fitted to margins of rows that their own half's classifier has not seen.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from modelyard.llm.common import derive, documents, materialise, text_fold

BITS = 18
BOUND = 16_384  # rows the hinge loss is fitted to; the class counts cover all labelled rows
COST = 1.0
EPOCHS = 12
SMOOTHING = 1.0
SENT_ALONG = 1 << 20  # labels that are sent to all tasks; beyond that texts and labels meet by id

_TOKENS = re.compile(r"[^\W_]+|[^\w\s]+|_+")
_MEMO = 1 << 17
_KINDS = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9], np.uint64)
_SAME, _SAME_BUT_ONE = 64, 128  # the token is the one before, or the one before that


def shape(token: str) -> int:
    """A number below 64: how a token is written, not what it says."""
    if token[0].isalnum():
        if token.isdigit():
            return 1 + min(len(token), 4)
        if token.isalpha():
            if token.islower() or not (token.isupper() or token.istitle()):
                return 8 + min(len(token) // 4, 3)
            return 12 if token.istitle() else 13
        return 14
    return 16 + (ord(token[0]) % 16) * 3 + min(len(token), 3) - 1


class Tokens(dict):
    """Token to a hash of its lower-case form and its shape, remembered up to a bounded number."""

    def __missing__(self, token: str) -> int:
        if len(self) >= _MEMO:
            self.clear()
        code = self[token] = zlib.crc32(token.lower().encode()) << 8 | shape(token)
        return code


def grams(text: str, memo: Tokens, bits: int = BITS) -> np.ndarray:
    """Sorted buckets of all n-grams of a text; none for a text without tokens."""
    codes = np.array([memo[t] for t in _TOKENS.findall(text)], np.uint64)
    words, shapes = codes >> np.uint64(8), codes & np.uint64(255)
    shapes[1:] |= (words[1:] == words[:-1]) * np.uint64(_SAME)
    shapes[2:] |= (words[2:] == words[:-2]) * np.uint64(_SAME_BUT_ONE)
    one = words + np.uint64(1)
    two = (words[:-1] << np.uint64(32)) ^ words[1:]
    three = (shapes[:-2] << np.uint64(16)) | (shapes[1:-1] << np.uint64(8)) | shapes[2:]
    hashed = [(g ^ k) * _KINDS[0] ^ (g + k) >> np.uint64(29) for g, k in zip((one, two, three), _KINDS)]
    mixed = np.concatenate(hashed) * _KINDS[1]
    return np.unique(mixed >> np.uint64(64 - bits)).astype(np.int32)


def log_ratios(positive: np.ndarray, negative: np.ndarray, smoothing: float = SMOOTHING) -> np.ndarray:
    """Log ratio of a bucket's shares in the two classes, 0 for a bucket seen in neither."""
    p, q = positive + smoothing, negative + smoothing
    ratio = np.log(p / p.sum()) - np.log(q / q.sum())
    return np.where(positive + negative > 0, ratio, 0.0)


def scaled(buckets: np.ndarray, ratios: np.ndarray) -> np.ndarray:
    """Scaled indicators of one text, of length 1 together, so that long texts weigh no more."""
    x = ratios[buckets]
    size = np.sqrt(x @ x)
    return x / size if size > 0 else x


def fit_hinge(
    rows: list[np.ndarray], values: list[np.ndarray], y: np.ndarray, width: int, cost: float = COST, epochs: int = EPOCHS
) -> tuple[np.ndarray, float]:
    """(weights, bias) that minimise |w|^2 / 2 + the classes' weighted hinge losses.

    Dual coordinate descent: one row's multiplier at a time, in an order shuffled for each epoch; the
    bias is the weight of a further component that is 1.  A class counts as much as the other one,
    however many rows it has.
    """
    w, bias, alpha = np.zeros(width), 0.0, np.zeros(len(y))
    most = cost * len(y) / (2.0 * np.where(y > 0, max((y > 0).sum(), 1), max((y < 0).sum(), 1)))
    diagonal = np.array([v @ v + 1.0 for v in values])
    draw = np.random.default_rng(12)
    for _ in range(epochs):
        largest = 0.0
        for i in draw.permutation(len(y)):
            at, v = rows[i], values[i]
            gradient = y[i] * (w[at] @ v + bias) - 1.0
            new = min(max(alpha[i] - gradient / diagonal[i], 0.0), most[i])
            step = (new - alpha[i]) * y[i]
            if step:
                alpha[i] = new
                w[at] += step * v
                bias += step
                largest = max(largest, abs(step))
        if largest < 1e-3 * cost:
            break
    return w, bias


def fit_logistic(margin: np.ndarray, label: np.ndarray) -> tuple[float, float]:
    """(slope, shift) of the probability of label 1 given a margin; targets are kept off 0 and 1."""
    ones, zeros = label.sum(), len(label) - label.sum()
    target = np.where(label > 0, (ones + 1.0) / (ones + 2.0), 1.0 / (zeros + 2.0))
    slope, shift = 1.0, float(np.log((ones + 1.0) / (zeros + 1.0)))

    def loss(a: float, b: float) -> float:
        z = a * margin + b
        return float((np.logaddexp(0.0, z) - target * z).sum())

    now = loss(slope, shift)
    for _ in range(100):
        p = 1.0 / (1.0 + np.exp(-np.clip(slope * margin + shift, -500, 500)))
        d, h = p - target, p * (1 - p) + 1e-12
        g = np.array([d @ margin, d.sum()])
        curve = np.array([[(h * margin) @ margin + 1e-9, h @ margin], [h @ margin, h.sum() + 1e-9]])
        step, size = np.linalg.solve(curve, g), 1.0
        while size > 1e-8 and loss(slope - size * step[0], shift - size * step[1]) > now - 1e-4 * size * (g @ step):
            size /= 2
        if size <= 1e-8:
            break
        slope, shift = slope - size * step[0], shift - size * step[1]
        before, now = now, loss(slope, shift)
        if before - now < 1e-9 * (1 + abs(now)):
            break
    return float(slope), float(shift)


@dataclass
class Model:
    """`weights` already hold the ratios; `ratios` are needed for the length of a text only."""

    ratios: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    shift: float

    @staticmethod
    def constant(share: float) -> Model:
        """Without labels of both kinds every text scores the share of label 1."""
        share = min(max(share, 1e-9), 1 - 1e-9)
        nothing = np.zeros(1 << BITS, np.float32)
        return Model(nothing, nothing, 0.0, 0.0, float(np.log(share / (1 - share))))

    def score(self, buckets: np.ndarray) -> float:
        ratios = self.ratios[buckets]
        size = float(np.sqrt(ratios @ ratios))
        margin = self.bias + (float(self.weights[buckets].sum()) / size if size > 0 else 0.0)
        return float(1.0 / (1.0 + np.exp(-np.clip(self.slope * margin + self.shift, -500, 500))))


def _with_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    memo = Tokens()
    for batch in batches:
        made = [grams(t, memo) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), batch.column("label"), batch.column("half"), pa.array(made, pa.list_(pa.int32()))],
            ["doc_id", "label", "half", "grams"],
        )


def _class_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows with a bucket by half and label, summed within the task."""
    counts = np.zeros((4, 1 << BITS), np.int64)
    for batch in batches:
        lists = batch.column("grams")
        lengths = np.diff(lists.offsets.to_numpy())
        cell = 2 * batch.column("half").to_numpy() + batch.column("label").to_numpy()
        where = np.repeat(cell, lengths)
        buckets = lists.flatten().to_numpy()
        for c in range(4):
            counts[c] += np.bincount(buckets[where == c], minlength=1 << BITS)
    used = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(c) for c in (used, *counts[:, used])], ["bucket", "a0", "a1", "b0", "b1"])


def labelled_grams(docs: DataFrame, labels: DataFrame, label_col: str, folds: int, out: int) -> DataFrame:
    """(doc_id, label, half, grams) of the rows to learn from, written once."""
    known = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"))
        .where(text_fold(F.col("doc_id"), folds) != out)
    )
    half = F.pmod(F.xxhash64("doc_id", F.lit(12)), F.lit(2)).cast("int")
    if known.count() <= SENT_ALONG:
        known = F.broadcast(known)
    texts = documents(docs).join(known, "doc_id").select("doc_id", "label", half.alias("half"), "text")
    return materialise(texts.mapInArrow(_with_grams, "doc_id bigint, label int, half int, grams array<int>"), "quality-grams")


def train(
    docs: DataFrame, labels: DataFrame, label_col: str = "quality", folds: int = 4, out: int = 2, bound: int = BOUND
) -> Model:
    """A model from the labelled rows whose crc32(doc_id as text) mod `folds` is not `out`.

    Class counts cover all of them; the hinge loss and the logistic curve are fitted to about `bound`
    rows, chosen by a hash of the id, which is what reaches the driver.  Rows without id or with a
    label other than 0 and 1 teach nothing; a text labelled twice counts as 0 if one label says so;
    without labels of both kinds the score is the share of label 1, without any it is a half.
    """
    rows = labelled_grams(docs, labels, label_col, folds, out)
    kinds = {r["label"]: r["n"] for r in rows.groupBy("label").agg(F.count("*").alias("n")).collect()}
    total = sum(kinds.values())
    if len(kinds) < 2:
        return Model.constant(kinds.get(1, 0) / total if total else 0.5)

    counted = rows.mapInArrow(_class_counts, "bucket bigint, a0 bigint, a1 bigint, b0 bigint, b1 bigint")
    summed = counted.groupBy("bucket").agg(*[F.sum(c).alias(c) for c in ("a0", "a1", "b0", "b1")]).toPandas()
    counts = np.zeros((4, 1 << BITS))
    counts[:, summed["bucket"].to_numpy()] = summed[["a0", "a1", "b0", "b1"]].to_numpy().T

    chosen = rows
    if total > bound:  # the same rows every time
        chosen = rows.where(F.pmod(F.xxhash64("doc_id", F.lit(3)), F.lit(1 << 30)) < int(bound / total * (1 << 30)))
    seen = chosen.toArrow()
    order = sorted(range(seen.num_rows), key=seen["doc_id"].to_pylist().__getitem__)
    column = seen["grams"].combine_chunks()
    flat, offsets = column.flatten().to_numpy(), column.offsets.to_numpy() - column.offsets[0].as_py()
    buckets = [flat[offsets[i] : offsets[i + 1]] for i in order]
    label, half = seen["label"].to_numpy()[order], seen["half"].to_numpy()[order]
    return _fitted(buckets, label, half, counts)


def _fitted(buckets: list[np.ndarray], label: np.ndarray, half: np.ndarray, counts: np.ndarray) -> Model:
    def fit(use: np.ndarray, positive: np.ndarray, negative: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        ratios = log_ratios(positive, negative)
        own = [buckets[i] for i in use]
        w, bias = fit_hinge(own, [scaled(b, ratios) for b in own], 2.0 * label[use] - 1.0, 1 << BITS)
        return ratios, w, bias

    margin = np.zeros(len(label))
    for side, (positive, negative) in enumerate(((counts[1], counts[0]), (counts[3], counts[2]))):
        ratios, w, bias = fit(np.flatnonzero(half == side), positive, negative)
        for i in np.flatnonzero(half != side):
            margin[i] = w[buckets[i]] @ scaled(buckets[i], ratios) + bias
    slope, shift = fit_logistic(margin, label) if len(label) else (0.0, 0.0)
    ratios, w, bias = fit(np.arange(len(label)), counts[1] + counts[3], counts[0] + counts[2])
    return Model(ratios.astype(np.float32), (ratios * w).astype(np.float32), float(bias), slope, shift)


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score (0 to 1, higher: label 1 likelier) of every row's whole text.

    Null and empty texts are scored as texts without n-grams; a null id stays null; repeated rows each
    give a row; an empty table gives none; further columns are ignored, whatever they are called.
    """

    def start():
        memo = Tokens()
        return lambda texts: {"score": [model.score(grams(t, memo)) for t in texts]}

    return derive(documents(docs, id_col, text_col), start, "score double")
