"""Toxicity: gradient-boosted trees over dense text features, calibrated by isotonic regression.

Features: densities of lexicon words, of words near a second person, of capitals and punctuation, and
rates of obfuscated spelling.  The lexicon holds words, and beginnings of words, that toxic labelled texts have much more often
than others; it is learned twice, on halves of the labelled texts, so that the trees see features of
texts that their lexicon has not seen.  Trees are fitted on one half's predictions of the other for
calibration, then on all.

At most `bound` labelled texts are used for fitting (a sample by hash beyond that); what reaches the
driver is their features, and lexicon words up to `_LEXICON`.  Every text is scored.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from modelyard.llm.common import derive, documents, materialise, text_fold

BOUND = 100_000
_LEXICON = 4000
_LEAST_TEXTS = 4
_LEAST_Z = 3.0
_FLUSH = 400_000
_NEAR = 6  # words around a lexicon word in which a second person counts
_WINDOW = 50
_STEMS = (4, 5, 6)

# Second-person words of some languages, and signs that stand for letters.
SECOND_PERSON = frozenset(
    "you your yours yourself u ur ye thou thee tu te toi ton ta tes vous votre vos du dich dir dein deine deinen "
    "deiner ihr euch euer sie ihnen usted ustedes ti vos tú su sus".split()
)
LEET = str.maketrans("013457@$!|+", "oieastasiit")

_WORDS = re.compile(r"[^\W\d_]+")

_INNER = re.compile(r"[0-9@$!|+*._\-](?=[^\W\d_])")
_MASKED = re.compile(r"(?<![^\W\d_])[^\W\d_]+(?:[0-9@$!|+*._\-]+[^\W\d_]+)+")
_APART = re.compile(r"[\W_]*[^\W\d_](?:[.\-_*]+[^\W\d_])*[\W_]*")
_LOUD = re.compile(r"[!?*$%&#@]{2,}")
_BETWEEN = re.compile(r"[^\w]+|_+|\d+")

FEATURES = (
    "log_words hits hit_density best_weight weight_density top_weights dense_window near_second_person second_person "
    "capitals loud_words exclamations punctuation runs digits masked masked_hits letters"
).split()


def _unmasked(token: str) -> Iterator[str]:
    """Plain spellings that an obfuscated word may stand for."""
    low = token.lower()
    yield _BETWEEN.sub("", low)
    yield _BETWEEN.sub("", low.translate(LEET))


def class_table() -> np.ndarray:
    """Kind of every code point: made once on the driver and sent along."""
    table = np.zeros(0x110000, np.uint8)
    for point in range(0x110000):
        c = chr(point)
        table[point] = 1 if c.isspace() else 3 if c.isupper() else 2 if c.isalpha() else 4 if c.isdigit() else 5 if c in "!?" else 6
    return table


class Classes:
    """Counts of kinds of code points by a table over all of them."""

    def __init__(self, table: np.ndarray | None = None) -> None:
        self._table = class_table() if table is None else table

    def counts(self, text: str) -> np.ndarray:
        points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
        return np.bincount(self._table[points], minlength=7)


def stems(word: str) -> list[str]:
    """Beginnings of a word, as lexicon entries of their own."""
    return [word[:n] + "*" for n in _STEMS if len(word) > n]


class Memo(dict):
    """Answers by token (what white space separates); each token is looked into once."""

    def __init__(self, answer) -> None:
        self._answer = answer

    def __missing__(self, token: str):
        if len(self) > _FLUSH:
            self.clear()
        found = self[token] = self._answer(token)
        return found


def words_of(token: str) -> list[str]:
    """Runs of letters of a token; mostly it is one itself."""
    return [token] if token.isalpha() else _WORDS.findall(token)


def apart(token: str, words: list[str]) -> str:
    """The letters of a token that has no two letters side by side, and any single character; else nothing."""
    if len(token) == 1:
        return token
    if any(len(w) > 1 for w in words):
        return ""
    return "".join(words) if _APART.fullmatch(token) else ""


def token_memo(weights: dict[str, float]) -> Memo:
    """Of a token: weight, number of words of the second person, letters that stand apart; None if it has none of these.

    The weight is that of the heaviest of its words and their stems, 0 if none is in the lexicon.  A word
    and its stems begin alike, so most words are told apart from all entries by their beginning.
    """
    beginnings = {k[: _STEMS[0]] for k in weights}

    def answer(token: str) -> tuple[float, int, str] | None:
        words = words_of(token)
        weight = max(
            (weights.get(k, 0.0) for w in words if w[: _STEMS[0]] in beginnings for k in (w, *stems(w))), default=0.0
        )
        found = (weight, sum(w in SECOND_PERSON for w in words), apart(token, words))
        return found if any(found) else None

    return Memo(answer)


def capitals_memo() -> Memo:
    """Of a token as written: words of three or more letters that are all capitals, of whatever script."""
    return Memo(lambda token: sum(len(w) > 2 and w.isupper() for w in words_of(token)))


def spaced_out(alone: list[tuple[int, str]]) -> list[str]:
    """Words whose letters stand apart: four or more letters of two or more tokens in a row, joined."""
    found, first = [], 0
    for here in range(1, len(alone) + 1):
        if here == len(alone) or alone[here][0] != alone[here - 1][0] + 1:
            word = "".join(letters for _, letters in alone[first:here])
            if here - first > 1 and len(word) > 3:
                found.append(word)
            first = here
    return found


def features(text: str, memo: Memo, capitals: Memo, classes: Classes) -> list[float]:
    words = text.lower().split()
    n = len(words)
    kinds = classes.counts(text)
    chars = max(1, len(text))
    told = [(i, k) for i, k in enumerate(map(memo.__getitem__, words)) if k]
    heavy = [(i, k[0]) for i, k in told if k[0]]
    at = [i for i, _ in heavy]
    weights = sorted((w for _, w in heavy), reverse=True)
    second = [i for i, k in told if k[1]]
    near = sum(bisect_left(second, i - _NEAR) < bisect_right(second, i + _NEAR) for i in at)
    masked = (_MASKED.findall(text) if _INNER.search(text) else []) + spaced_out([(i, k[2]) for i, k in told if k[2]])
    masked_hits = sum(any(k is not None and k[0] > 0 for k in map(memo.__getitem__, _unmasked(m))) for m in masked)
    dense, low = 0, 0
    for high, place in enumerate(at):
        while place - at[low] >= _WINDOW:
            low += 1
        dense = max(dense, high - low + 1)
    loud = sum([capitals[w] for w in text.split() if not w.islower()]) if kinds[3] else 0
    per = 1000.0 / max(1, n)
    return [
        float(np.log1p(n)),
        float(len(at)),
        len(at) * per,
        weights[0] if weights else 0.0,
        sum(weights) * per,
        sum(weights[:3]),
        float(dense),
        near * per,
        sum(k[1] for _, k in told) * per,
        kinds[3] / chars,
        loud * per,
        kinds[5] / chars,
        (kinds[5] + kinds[6]) / chars,
        len(_LOUD.findall(text)) * per,
        kinds[4] / chars,
        len(masked) * per,
        float(masked_hits),
        (kinds[2] + kinds[3]) / chars,
    ]


@dataclass
class Tree:
    """A tree in heap order: feature (-1 for a leaf), threshold and value of each place."""

    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def predict(self, x: np.ndarray) -> np.ndarray:
        at = np.zeros(len(x), np.int64)
        for _ in range(int(np.log2(len(self.feature) + 1)) - 1):
            split = self.feature[at] >= 0
            right = x[np.arange(len(x)), np.maximum(self.feature[at], 0)] > self.threshold[at]
            at = np.where(split, 2 * at + 1 + right, at)
        return self.value[at]


@dataclass
class Boosted:
    base: float
    rate: float
    trees: list[Tree]

    def margin(self, x: np.ndarray) -> np.ndarray:
        return self.base + self.rate * sum((t.predict(x) for t in self.trees), np.zeros(len(x)))


def fit_boosted(
    x: np.ndarray, y: np.ndarray, rounds: int = 80, depth: int = 3, rate: float = 0.15, ridge: float = 1.0, bins: int = 64
) -> Boosted:
    """Logistic gradient boosting on histograms of quantile bins."""
    share = np.clip(y.mean() if len(y) else 0.0, 1e-6, 1 - 1e-6)
    model = Boosted(float(np.log(share / (1 - share))), rate, [])
    if not len(y) or y.min() == y.max():
        return model
    edges = [np.unique(np.quantile(x[:, f], np.linspace(0, 1, bins + 1)[1:-1])) for f in range(x.shape[1])]
    binned = np.stack([np.searchsorted(e, x[:, f]) for f, e in enumerate(edges)], axis=1)
    margin = np.full(len(y), model.base)
    size = (1 << (depth + 1)) - 1
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-margin))
        gradient, curve = y - p, p * (1 - p)
        tree = Tree(np.full(size, -1), np.zeros(size), np.zeros(size))
        at = np.zeros(len(y), np.int64)
        for level in range(depth + 1):
            first, nodes = (1 << level) - 1, 1 << level
            inside = (at >= first).nonzero()[0]
            local = at[inside] - first
            g_all = np.bincount(local, gradient[inside], nodes)
            h_all = np.bincount(local, curve[inside], nodes)
            tree.value[first : first + nodes] = g_all / (h_all + ridge)
            if level == depth:
                break
            best = np.full(nodes, 1e-6)
            for f, e in enumerate(edges):
                if not len(e):
                    continue
                cells = local * bins + binned[inside, f]
                g = np.bincount(cells, gradient[inside], nodes * bins).reshape(nodes, bins).cumsum(axis=1)
                h = np.bincount(cells, curve[inside], nodes * bins).reshape(nodes, bins).cumsum(axis=1)
                gl, hl = g[:, : len(e)], h[:, : len(e)]
                gr, hr = g_all[:, None] - gl, h_all[:, None] - hl
                gain = gl**2 / (hl + ridge) + gr**2 / (hr + ridge) - (g_all**2 / (h_all + ridge))[:, None]
                gain[(hl < 1.0) | (hr < 1.0)] = 0
                top = gain.argmax(axis=1)
                better = gain[np.arange(nodes), top] > best
                best = np.where(better, gain[np.arange(nodes), top], best)
                spots = first + np.flatnonzero(better)
                tree.feature[spots] = f
                tree.threshold[spots] = e[top[better]]
            spot = at[inside]
            split = tree.feature[spot] >= 0
            right = x[inside, np.maximum(tree.feature[spot], 0)] > tree.threshold[spot]
            at[inside] = np.where(split, 2 * spot + 1 + right, spot)
        margin += rate * tree.predict(x)
        model.trees.append(tree)
    return model


def fit_isotonic(margin: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rising steps (margin, share of label 1) by pooling adjacent violators."""
    order = np.argsort(margin, kind="stable")
    blocks: list[list[float]] = []  # sum of labels, count, sum of margins
    for m, label in zip(margin[order], y[order]):
        blocks.append([float(label), 1.0, float(m)])
        while len(blocks) > 1 and blocks[-2][0] * blocks[-1][1] >= blocks[-1][0] * blocks[-2][1]:
            last = blocks.pop()
            blocks[-1] = [a + b for a, b in zip(blocks[-1], last)]
    # Shares are drawn in a little, so that a short block at an end is no certainty.
    return (
        np.array([b[2] / b[1] for b in blocks]),
        np.array([(b[0] + 0.05) / (b[1] + 0.1) for b in blocks]),
    )


@dataclass
class Model:
    lexicon: dict[str, float]
    trees: Boosted
    steps: tuple[np.ndarray, np.ndarray]

    def score(self, x: np.ndarray) -> np.ndarray:
        margin = self.trees.margin(x)
        places, shares = self.steps
        if not len(places):
            return 1 / (1 + np.exp(-margin))
        return np.clip(np.interp(margin, places, np.maximum.accumulate(shares)), 0.0, 1.0)


def _texts_by_word(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """word, and in how many toxic and other texts of either half it occurs."""
    seen: dict[str, list[int]] = {}
    entries = Memo(lambda token: [k for w in _WORDS.findall(token) for k in (w, *stems(w))])

    def rows() -> pa.RecordBatch:
        counts = np.array(list(seen.values()), np.int64).reshape(-1, 4)
        return pa.RecordBatch.from_arrays(
            [pa.array(list(seen), pa.string()), *[pa.array(counts[:, i]) for i in range(4)]], ["word", "a0", "a1", "b0", "b1"]
        )

    for batch in batches:
        for text, label, half in zip(*(batch.column(c).to_pylist() for c in ("text", "label", "half"))):
            for word in set().union(*map(entries.__getitem__, set(text.lower().split()))):
                counts = seen.get(word)
                if counts is None:
                    counts = seen[word] = [0, 0, 0, 0]
                counts[2 * half + label] += 1
            if len(seen) > _FLUSH:
                yield rows()
                seen.clear()
    if seen:
        yield rows()


def _weighted(counted: DataFrame, clean: Column, toxic: Column, totals: tuple[int, int]) -> DataFrame:
    """word, weight (log odds) of the words most clearly more frequent in toxic texts."""
    n_clean, n_toxic = totals
    weight = F.log((toxic + 0.5) / (n_toxic + 1.0)) - F.log((clean + 0.5) / (n_clean + 1.0))
    error = F.sqrt(1 / (toxic + 0.5) + 1 / (clean + 0.5))
    return (
        counted.where(toxic >= _LEAST_TEXTS)
        .select("word", weight.alias("weight"), (weight / error).alias("z"))
        .where(F.col("z") >= _LEAST_Z)
        .orderBy(F.desc("z"), "word")
        .limit(_LEXICON)
    )


def _lexicons(labelled: DataFrame) -> list[dict[str, float]]:
    """Lexicon of the first half, of the second, of both."""
    totals = {(r["half"], r["label"]): r["n"] for r in labelled.groupBy("half", "label").agg(F.count("*").alias("n")).collect()}
    total = lambda label, *halves: sum(totals.get((h, label), 0) for h in halves)
    counted = materialise(
        labelled.select("text", "label", "half")
        .mapInArrow(_texts_by_word, "word string, a0 bigint, a1 bigint, b0 bigint, b1 bigint")
        .groupBy("word")
        .agg(*[F.sum(c).alias(c) for c in ("a0", "a1", "b0", "b1")])
        .where(F.col("a1") + F.col("b1") >= _LEAST_TEXTS),
        "toxic-words",
    )
    sides = (
        (F.col("a0"), F.col("a1"), (0,)),
        (F.col("b0"), F.col("b1"), (1,)),
        (F.col("a0") + F.col("b0"), F.col("a1") + F.col("b1"), (0, 1)),
    )
    return [
        {r["word"]: r["weight"] for r in _weighted(counted, c, t, (total(0, *h), total(1, *h))).collect()} for c, t, h in sides
    ]


def labelled_texts(docs: DataFrame, labels: DataFrame, label_col: str, folds: int, bound: int) -> DataFrame:
    """(text, label, half) of the rows to learn from; the held-out fold is not among them."""
    known = (
        labels.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("label"))
        .where(F.col("label").isin(0, 1) & F.col("doc_id").isNotNull())
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
        .where(text_fold(F.col("doc_id"), folds) != 0)
    )
    count = known.count()
    if count > bound:
        limit = int(bound / count * (1 << 30))
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < limit)
    # `bound` limits the rows sent along.
    half = F.pmod(F.xxhash64("doc_id", F.lit(7)), F.lit(2)).cast("int")
    return documents(docs).join(F.broadcast(known), "doc_id").select("text", "label", half.alias("half"))


def train(
    docs: DataFrame, labels: DataFrame, label_col: str = "toxic", folds: int = 5, bound: int = BOUND
) -> Model:
    """A model from the labelled rows whose crc32(doc_id as text) mod `folds` is not 0.

    Rows without id or with a label other than 0 and 1 teach nothing; a text labelled twice counts as
    toxic if one label says so.  Without labels of both kinds the score is the share of label 1.
    """
    labelled = labelled_texts(docs, labels, label_col, folds, bound)
    first, second, both = _lexicons(labelled)
    sides = [second, first]  # each half by the other's lexicon
    table = docs.sparkSession.sparkContext.broadcast(class_table())

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes, memos, capitals = Classes(table.value), [token_memo(side) for side in sides], capitals_memo()
        for batch in batches:
            halves = batch.column("half").to_pylist()
            made = [features(t, memos[h], capitals, classes) for t, h in zip(batch.column("text").to_pylist(), halves)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("label"), batch.column("half"), pa.array(made, pa.list_(pa.float64()))], ["label", "half", "x"]
            )

    seen: pd.DataFrame = labelled.mapInArrow(rows, "label int, half int, x array<double>").toPandas()
    x = np.array(seen["x"].tolist(), np.float64).reshape(-1, len(FEATURES))
    order = np.lexsort(x.T)  # the fit does not depend on the order of arrival
    x, y, half = x[order], seen["label"].to_numpy(np.float64)[order], seen["half"].to_numpy()[order]
    margin = np.zeros(len(y))
    for side in (0, 1):
        margin[half == side] = fit_boosted(x[half != side], y[half != side]).margin(x[half == side])
    steps = fit_isotonic(margin, y) if len(set(y)) == 2 else (np.empty(0), np.empty(0))
    return Model(both, fit_boosted(x, y), steps)


def _scorer(spark: SparkSession, model: Model, out: str):
    """The model, whose size is bounded, travels with the function."""
    table = spark.sparkContext.broadcast(class_table())

    def start():
        classes, memo, capitals = Classes(table.value), token_memo(model.lexicon), capitals_memo()

        def work(texts: list[str]) -> dict[str, list]:
            x = np.array([features(t, memo, capitals, classes) for t in texts]).reshape(-1, len(FEATURES))
            return {out: model.score(x)}

        return work

    return start


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and score of every row's whole text; null and empty texts are scored as texts without words."""
    return derive(documents(docs, id_col, text_col), _scorer(docs.sparkSession, model, "score"), "score double")


def with_scores(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns of `docs` and toxic_score, for filters."""
    # The text is looked at under a name of its own, so that a null text may stay null in the result.
    looked = docs.withColumn("_looked_at", F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))

    return derive(looked, _scorer(docs.sparkSession, model, "toxic_score"), "toxic_score double", text_col="_looked_at", keep=tuple(docs.columns))
