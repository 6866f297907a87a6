"""The quality classifier: its parts against plain computations, the query against held-out labels."""

from __future__ import annotations

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from modelyard.llm import quality
from modelyard.llm.queries import QUERIES


def test_grams_are_the_set_of_hashed_neighbours():
    memo = quality.Tokens()
    text = "The the cat, sat!! and THE cat sat"
    found = quality.grams(text, memo)
    assert (np.diff(found) > 0).all() and found.min() >= 0 and found.max() < 1 << quality.BITS
    assert (found == quality.grams(text, quality.Tokens())).all()
    assert len(quality.grams("", memo)) == 0 and len(quality.grams(" \n", memo)) == 0
    assert len(quality.grams("word", memo)) == 1 and len(quality.grams("two words", memo)) == 3
    # A word repeated is written another way than words that differ.
    assert set(quality.grams("so so so", memo)) != set(quality.grams("so la ti", memo))


def test_memo_is_bounded(monkeypatch):
    text = " ".join(f"w{i}" for i in range(50))
    whole = quality.grams(text, quality.Tokens())
    monkeypatch.setattr(quality, "_MEMO", 8)
    memo = quality.Tokens()
    assert (quality.grams(text, memo) == whole).all() and len(memo) <= 8


def test_log_ratios():
    found = quality.log_ratios(np.array([3.0, 0.0, 0.0]), np.array([0.0, 1.0, 0.0]))
    assert found[0] == pytest.approx(np.log((4 / 6) / (1 / 4)))
    assert found[1] == pytest.approx(np.log((1 / 6) / (2 / 4)))
    assert found[2] == 0


def test_dual_coordinate_descent_reaches_the_optimum():
    """The duality gap of the weighted hinge loss closes."""
    draw = np.random.default_rng(4)
    x = draw.normal(size=(120, 6))
    y = np.where(x[:, 0] + 0.5 * draw.normal(size=120) > 0.4, 1.0, -1.0)
    rows = [np.arange(6)] * len(y)
    w, bias = quality.fit_hinge(rows, list(x), y, 6, cost=0.5, epochs=4000)
    weight = 0.5 * len(y) / (2 * np.where(y > 0, (y > 0).sum(), (y < 0).sum()))
    loss = lambda w, b: (w @ w + b * b) / 2 + (weight * np.maximum(0, 1 - y * (x @ w + b))).sum()
    best = loss(w, bias)
    for _ in range(300):
        assert loss(w + draw.normal(size=6) * 0.01, bias + draw.normal() * 0.01) >= best - 1e-6


def test_logistic_curve_has_no_slope_left():
    draw = np.random.default_rng(3)
    margin = draw.normal(size=500)
    label = (draw.random(500) < 1 / (1 + np.exp(-(2 * margin + 1)))).astype(float)
    slope, shift = quality.fit_logistic(margin, label)
    ones = label.sum()
    target = np.where(label > 0, (ones + 1) / (ones + 2), 1 / (500 - ones + 2))
    apart = 1 / (1 + np.exp(-(slope * margin + shift))) - target
    assert abs(apart.sum()) < 1e-3 and abs(apart @ margin) < 1e-3


def test_held_out_labels(spark):
    base = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{base}/labels.parquet").select("doc_id", "quality")
    rows = QUERIES["op12_quality"](spark, base).join(labels, "doc_id", "left").collect()
    assert len(rows) == spark.read.parquet(f"{base}/documents.parquet").count()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in rows)
    assert all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.7) for r in rows)
    held = [r for r in rows if r["held_out"] and r["quality"] is not None]
    good = [r["predicted"] for r in held if r["quality"] == 1]
    poor = [r["predicted"] for r in held if r["quality"] == 0]
    assert np.mean(good) > 0.95 and np.mean(poor) < 0.1


def test_held_out_labels_are_not_learned(spark, base):
    docs, labels = (spark.read.parquet(f"{base}/{n}.parquet") for n in ("documents", "labels"))
    out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    turned = labels.withColumn("quality", F.when(out, 1 - F.col("quality")).otherwise(F.col("quality")))
    first, second = quality.train(docs, labels), quality.train(docs, turned)
    assert (first.weights == second.weights).all() and (first.slope, first.shift) == (second.slope, second.shift)


def test_counts_cover_rows_beyond_the_bound(spark, base):
    docs, labels = (spark.read.parquet(f"{base}/{n}.parquet") for n in ("documents", "labels"))
    whole, part = quality.train(docs, labels), quality.train(docs, labels, bound=30)
    assert (whole.ratios == part.ratios).all() and (whole.weights != part.weights).any()


def test_labels_too_many_to_send_along(spark, base, monkeypatch):
    docs, labels = (spark.read.parquet(f"{base}/{n}.parquet") for n in ("documents", "labels"))
    sent = quality.train(docs, labels)
    monkeypatch.setattr(quality, "SENT_ALONG", 10)
    met = quality.train(docs, labels)
    assert (sent.weights == met.weights).all() and (sent.slope, sent.shift) == (met.slope, met.shift)


LAYOUT = "text string, doc_id bigint, label string, half int, grams string, score string"


def test_odd_rows(spark):
    words = " ".join(f"w{i % 700}" for i in range(60_000))
    rows = [(t, i, "x", 1, "g", "s") for i, t in enumerate([None, "", " ", "plain words here", words, "é\U0001f600 __ ..."])]
    rows += [rows[3], rows[3], ("plain words here", None, "x", 1, "g", "s")]
    docs = spark.createDataFrame(rows, LAYOUT)
    labels = spark.createDataFrame(
        [(3, 1, 5), (3, 0, 5), (4, 1, 5), (5, 0, 5), (None, 1, 5), (0, None, 5), (1, 7, 5), (99, 1, 5)],
        "doc_id bigint, quality int, score int",
    )
    model = quality.train(docs, labels, out=99)
    got = quality.score(docs, model).collect()
    assert len(got) == len(rows) and all(0 <= r["score"] <= 1 for r in got)
    same = {r["score"] for r in got if r["doc_id"] in (3, None)}
    assert len(same) == 1 and len({r["score"] for r in got if r["doc_id"] in (0, 1, 2)}) == 1
    assert quality.score(docs.limit(0), model).collect() == []


def test_labels_of_one_kind_and_none(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    ones = spark.createDataFrame([(1, 1)], "doc_id bigint, quality int")
    assert all(r["score"] > 0.999 for r in quality.score(docs, quality.train(docs, ones)).collect())
    assert all(r["score"] == 0.5 for r in quality.score(docs, quality.train(docs, ones.limit(0))).collect())
    assert all(r["score"] == 0.5 for r in quality.score(docs, quality.train(docs.limit(0), ones)).collect())
