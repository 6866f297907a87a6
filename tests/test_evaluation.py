from __future__ import annotations

import random
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import types as T

from modelyard.functions.text import lcs_length, lcs_lengths, shared_counts
from modelyard.operators import evaluation


def _lcs_table(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        before = 0
        for j, y in enumerate(b, 1):
            before, row[j] = row[j], before + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


words = st.lists(st.sampled_from("abcd"), max_size=90)


@settings(max_examples=200, deadline=None)
@given(words, words)
def test_lcs_equals_table(a, b):
    assert lcs_length(a, b) == _lcs_table(a, b) == lcs_length(b, a)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(words, st.lists(st.sampled_from("cdefg"), max_size=20)), max_size=8), st.booleans())
def test_rows_of_a_batch_are_scored_like_single_ones(pairs, turn):
    if turn:
        pairs = [(b, a) for a, b in pairs]
    a, b = (pa.array([p[i] for p in pairs], pa.list_(pa.string())) for i in (0, 1))
    assert lcs_lengths(a, b).tolist() == [_lcs_table(x, y) for x, y in pairs]
    assert shared_counts(a, b).tolist() == [sum((Counter(x) & Counter(y)).values()) for x, y in pairs]
    if len(pairs) > 1:  # a part of a larger batch
        assert lcs_lengths(a[1:], b[1:]).tolist() == lcs_lengths(a, b).tolist()[1:]


def _plain_tokens(text):
    lowered = "".join(c for c in (text or "").lower() if c.isalnum() or c in " \t\n\r\f")
    return [w for w in lowered.split() if w not in ("a", "an", "the")]


@pytest.fixture(scope="module")
def pairs(spark):
    draw = random.Random(3)
    vocabulary = ["The", "a", "an", "Fox", "fox,", "dog.", "Über", "runs!", "x1", "--", "naïve", "(of)"]

    def text():
        return " ".join(draw.choice(vocabulary) for _ in range(draw.randrange(0, 30)))

    rows = [(i, text(), text(), f"g{i % 3}") for i in range(60)]
    rows += [(100, "the a", "", "g0"), (101, None, None, "g0"), (102, "fox", None, "g1"), (103, "Fox dog", "fox, dog.", "g2")]
    return spark.createDataFrame(rows, "i bigint, r string, e string, g string").cache()


def test_token_overlap_equals_counters(pairs):
    wanted = {}
    for row in pairs.collect():
        r, e = _plain_tokens(row["r"]), _plain_tokens(row["e"])
        common = sum((Counter(r) & Counter(e)).values())
        precision, recall = common / len(r) if r else 0.0, common / len(e) if e else 0.0
        f1 = 2 * precision * recall / (precision + recall) if precision + recall else 0.0
        wanted[row["i"]] = (common, len(r), len(e), int(r == e), pytest.approx(f1), row["g"])
    got = {
        r["i"]: (r["n_common"], r["n_response"], r["n_expected"], r["exact_match"], r["f1"], r["g"])
        for r in evaluation.token_overlap(pairs, "r", "e").collect()
    }
    assert got == wanted


def test_rouge_equals_table(pairs):
    for row in evaluation.rouge_l(pairs, "r", "e").collect():
        r, e = _plain_tokens(row["r"]), _plain_tokens(row["e"])
        assert row["lcs"] == _lcs_table(r, e)
        assert 0 <= row["lcs_precision"] <= 1 and 0 <= row["lcs_f1"] <= 1
        if r:
            assert row["lcs_precision"] == pytest.approx(row["lcs"] / len(r))


def test_token_overlap_does_not_shuffle(pairs):
    assert "Exchange" not in evaluation.token_overlap(pairs, "r", "e")._jdf.queryExecution().executedPlan().toString()


def test_long_texts_are_scored_whole():
    a = [str(i % 997) for i in range(20000)]
    assert lcs_length(a, a) == 20000
    assert lcs_length(a, a[10000:]) == 10000


def test_tool_calls_as_sets(spark):
    rows = [(["a", "a", "b"], ["b", "c"]), ([], ["a"]), (None, None), (["a"], ["a"])]
    df = spark.createDataFrame(rows, "p array<string>, e array<string>")
    got = [
        (r["n_common"], r["n_missed"], r["n_extra"], r["tool_precision"], r["tool_recall"])
        for r in evaluation.tool_call_scores(df, "p", "e").collect()
    ]
    assert got == [(1, 1, 1, 0.5, 0.5), (0, 1, 0, 0.0, 0.0), (0, 0, 0, 0.0, 0.0), (1, 0, 0, 1.0, 1.0)]


def test_summary(pairs):
    scored = evaluation.token_overlap(pairs, "r", "e")
    got = {r["g"]: r["n_rows"] for r in evaluation.summarise(scored, ["g"]).collect()}
    assert sum(got.values()) == 64 and set(got) == {"g0", "g1", "g2"}


def test_conformance(spark):
    df = spark.createDataFrame([(1, None, "x"), (2, 2.0, None)], "id bigint, value double, extra string")
    signature = T.StructType(
        [T.StructField("id", T.LongType()), T.StructField("value", T.FloatType()), T.StructField("gone", T.LongType())]
    )
    rows = evaluation.schema_conformance(df, signature).collect()
    assert {r["column"]: (r["lowest"], r["highest"]) for r in rows} == {
        "id": (1.0, 2.0),
        "value": (2.0, 2.0),
        "extra": (None, None),
        "gone": (None, None),
    }
    got = {r["column"]: (r["status"], r["n_null"], r["n_rows"]) for r in rows}
    assert got == {
        "id": ("ok", 0, 2),
        "value": ("type_mismatch", 1, 2),
        "extra": ("unexpected", 1, 2),
        "gone": ("missing", None, 2),
    }
