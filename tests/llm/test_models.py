"""Search, toxicity, secrets and the pipeline."""

from __future__ import annotations

import re

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from check_oracle import compare, connect
from modelyard.llm import cover_tree, secrets, toxicity
from modelyard.llm.common import text_fold
from modelyard.llm.queries import ORACLE, QUERIES

ASSIGN = re.compile(secrets.ASSIGN.removeprefix("(?i)"), re.I | re.A)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, base, name):
    assert compare(spark, connect(base), QUERIES[name], ORACLE[name], base) is None


def _best(ids, vectors, k, step):
    out = set()
    for row in np.flatnonzero(ids % step == 0):
        other = ids != ids[row]
        scores = vectors[other] @ vectors[row]
        for rank, j in enumerate(np.lexsort((ids[other], -scores))[:k]):
            out.add((int(ids[row]), rank + 1, int(ids[other][j]), int(scores[j])))
    return out


@pytest.mark.parametrize("chunk", [1 << 13, 3])
@pytest.mark.parametrize("k", [1, 10, 700])
def test_top_k_equals_brute_force(spark, k, chunk):
    draw = np.random.default_rng(8)
    points = draw.normal(size=(600, 6))
    points[100:300] = points[100]  # ties
    points[300:400] = points[300] + 0.01 * draw.normal(size=(100, 6))
    df = spark.createDataFrame(
        [(i, [float(x) for x in p], "clash") for i, p in enumerate(points)], "vec_id bigint, embedding array<double>, score string"
    ).repartition(5)
    vectors = np.floor(1024 * points).astype(np.int64)
    got = {tuple(r) for r in cover_tree.top_k(df, k, query_step=50, chunk=chunk).collect()}
    assert got == _best(np.arange(600), vectors, k, 50)


def test_clusters_are_pruned():
    draw = np.random.default_rng(1)
    centres = draw.integers(-1000, 1000, (40, 8))
    data = (centres[:, None, :] + draw.integers(-5, 6, (40, 100, 8))).reshape(-1, 8)
    ids = np.arange(len(data))
    search = cover_tree.Search(ids[::10], data[::10], 10, np.full(400, cover_tree._LOWEST))
    search.add(ids, data)
    assert search.pairs < 0.5 * 400 * len(data)


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [3.0, None]), (2, None), (3, [nan, 1.0]), (4, [inf, 0.0]), (5, [0.5, 0.25]), (6, [1.0]),
            (None, [1.0, 1.0]), (100, [1.0, 2.0]), (200, [7.0]), (300, []), (7, [])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = {tuple(r) for r in cover_tree.top_k(df).collect()}
    one = 1024 * 1024
    assert got == {
        (0, 1, 100, 5 * one), (0, 2, 5, one), (100, 1, 0, 5 * one), (100, 2, 5, one), (200, 1, 6, 7 * one),
        (300, 1, 7, 0),
    }
    assert cover_tree.top_k(df.limit(0)).count() == 0


def test_large_components_stay_exact(spark):
    big = float(1 << 40)
    df = spark.createDataFrame([(0, [1.0 + 2**-10, 1.0]), (1, [big, 1.0]), (2, [big, 2.0])], "vec_id bigint, embedding array<double>")
    rows = {r["vec_id"]: r["score"] for r in cover_tree.top_k(df).collect()}
    assert rows[1] == 1025 * (1 << 50) + (1 << 20) and rows[2] == 1025 * (1 << 50) + (1 << 21)


def test_components_and_scores_beyond_a_long_are_the_nearest_long(spark):
    rows = [(0, [1.0, 1e300]), (1, [1.0, 1e300]), (2, [1.0, -1e300]), (3, [0.0, 0.0]), (4, [1.0, 1e18])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    long = (1 << 63) - 1
    got = [tuple(r) for r in cover_tree.top_k(df).orderBy("rank").collect()]
    assert got == [(0, 1, 1, long), (0, 2, 4, long), (0, 3, 3, 0), (0, 4, 2, -long)]


@pytest.mark.parametrize("block,chunk", [(1 << 19, 1 << 13), (400, 5)])
def test_repeated_ids_and_vectors_in_any_number_of_blocks(spark, monkeypatch, block, chunk):
    monkeypatch.setattr(cover_tree, "_BLOCK", block)
    draw = np.random.default_rng(3)
    points = draw.integers(-20, 21, (500, 4))
    points[:170] = points[0]
    ids = np.where(np.arange(500) < 400, np.arange(500), 100 * (np.arange(500) % 3))  # 0, 100, 200 occur often
    df = spark.createDataFrame([(int(i), [p / 1024 for p in map(float, v)]) for i, v in zip(ids, points)], "vec_id bigint, embedding array<double>")
    wanted = []
    for query in np.unique(ids[ids % 100 == 0]):
        hits = sorted((-int(points[j] @ points[i]), int(ids[j])) for i in np.flatnonzero(ids == query) for j in np.flatnonzero(ids != query))
        wanted += [(int(query), n + 1, j, -s) for n, (s, j) in enumerate(hits[:10])]
    assert sorted(tuple(r) for r in cover_tree.top_k(df).collect()) == sorted(wanted)
    assert sorted(tuple(r) for r in cover_tree.top_k(df, chunk=chunk).collect()) == sorted(wanted)


def test_bounds_hold_for_large_vectors_that_cancel():
    draw = np.random.default_rng(5)
    data = draw.integers(-(1 << 30), 1 << 30, (3000, 6))
    data[:, 0] += 1 << 45
    queries = data[::50].copy()
    queries[:, 0] = draw.integers(-9, 9, len(queries))
    search = cover_tree.Search(np.arange(len(queries)) + 10_000, queries, 7, np.full(len(queries), cover_tree._LOWEST))
    for part in np.array_split(np.arange(3000), 4):
        search.add(part, data[part])
    scores = (queries.astype(object) @ data.astype(object).T).astype(np.int64)
    for place, query in enumerate(search.ids - 10_000):
        best = np.lexsort((np.arange(3000), -scores[query]))[:7]
        assert search.found[search.place == place].tolist() == best.tolist()


def test_toxicity_on_held_out_documents(spark):
    base = "/root/testdata/sf0.1"
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    model = toxicity.train(docs, labels)
    scored = toxicity.score(docs, model).join(labels, "doc_id").where(text_fold(F.col("doc_id"), 5) == 0).collect()
    toxic = [r["score"] for r in scored if r["toxic"] == 1]
    clean = [r["score"] for r in scored if r["toxic"] == 0]
    assert np.mean([s >= 0.5 for s in toxic]) > 0.9
    assert np.mean([s >= 0.5 for s in clean]) < 0.02


def test_held_out_labels_teach_nothing(spark, base):
    docs, labels = (spark.read.parquet(f"{base}/{t}.parquet") for t in ("documents", "labels"))
    held = text_fold(F.col("doc_id"), 5) == 0
    turned = labels.withColumn("toxic", F.when(held, 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = ({tuple(r) for r in toxicity.score(docs, toxicity.train(docs, t)).collect()} for t in (labels, turned))
    assert a == b


def test_toxicity_of_awkward_rows(spark):
    docs = spark.createDataFrame(
        [(1, None, "x"), (2, "", "x"), (None, "you idiot " * 3000, "x"), (3, "fine words", "x"), (3, "fine words", "x")],
        "doc_id bigint, text string, score string",
    )
    labels = spark.createDataFrame([(1, 0), (2, None), (3, 1), (3, 0), (None, 1), (9, 7)], "doc_id bigint, toxic int")
    for model in (toxicity.train(docs, labels), toxicity.train(docs, labels.limit(0)), toxicity.train(docs.limit(0), labels)):
        rows = toxicity.score(docs, model).collect()
        assert len(rows) == 5 and all(0 <= r["score"] <= 1 for r in rows)
        assert toxicity.score(docs.limit(0), model).count() == 0
        kept = toxicity.with_scores(docs, model)
        assert kept.columns == [*docs.columns, "toxic_score"] and kept.count() == 5


def _toxic_features(text):
    made = toxicity.features(text, toxicity.token_memo({"idiot": 2.0}), toxicity.capitals_memo(), toxicity.Classes())
    return dict(zip(toxicity.FEATURES, made))


@pytest.mark.parametrize("token", ["you", "you,", "you!", "you.", '"you', "you're", "(tu)"])
def test_second_person_is_found_in_the_letters_of_a_token(token):
    made = _toxic_features(f"{token} idiot")
    assert made["second_person"] == 500 and made["near_second_person"] == 500


@pytest.mark.parametrize(
    "text, words", [("IDIOT now", 1), ("ΗΛΙΘΙΕ now", 1), ("ԱՊՈՒՇ now", 1), ("ŁŻŹ ЇЖАК", 2), ("XMLParser aBCD 你好吗", 0), ("AB", 0)]
)
def test_words_of_capitals_of_all_scripts(text, words):
    assert _toxic_features(text)["loud_words"] == pytest.approx(words * 1000 / len(text.split()))


@pytest.mark.parametrize("text", ["i d i o t", "i d i o t!", "(i d i o t)", "i, d, i, o, t.", "i d-i o.t", "1 d 1 0 t"])
def test_letters_set_apart_are_joined(text):
    assert _toxic_features(f"such an {text}")["masked_hits"] >= 1
    assert _toxic_features("such a b3 c4 d5 e6 row")["masked_hits"] == 0


def test_isotonic_steps_rise():
    draw = np.random.default_rng(0)
    margin = draw.normal(size=500)
    places, shares = toxicity.fit_isotonic(margin, (margin + draw.normal(size=500) > 0).astype(float))
    assert (np.diff(places) > 0).all() and (np.diff(shares) >= 0).all()


def test_trees_learn_a_step():
    x = np.random.default_rng(0).uniform(size=(2000, 3))
    y = ((x[:, 1] > 0.5) ^ (x[:, 2] > 0.3)).astype(float)
    assert ((toxicity.fit_boosted(x, y).margin(x) > 0) == (y == 1)).mean() > 0.98


KEY = "AKIA" + "Q" * 16
TEXTS = [
    (1, f"password = 'hunter2hunter2' and {KEY}", "a"), (2, f"x {KEY} y", "b"), (3, "TOKEN:short token=abcdefgh", "a"),
    (4, "secret=token: abcdefgh", "a"), (5, None, "a"), (6, "", None), (7, "é" * 10 + "0123456789abcdef" * 2, None),
    (8, "live Zx9Zx9Zx9Zx9Zx9Zx9Zx9 here", "a"), (9, "copied Qw8Qw8Qw8Qw8Qw8Qw8Qw8 here", "a"),
    (10, "copied Qw8Qw8Qw8Qw8Qw8Qw8Qw8 here", "b"), (11, "api_key='" + "k1" * 5000 + "'", "c"), (11, "api-key: abcdefghij", "c"),
    (None, "passwd: 12345678 passwd: 12345678", "c"),
]


def _base(text):
    text = text or ""
    found = [(m.start(), 0, f"assign:{m.start()}:{m.end()}") for m in ASSIGN.finditer(text) if len(m.group(2)) >= 8]
    for place, kind, pattern, least in ((1, "access", secrets.ACCESS, 16), (2, "hex", secrets.HEX, 32)):
        found += [
            (m.start(), place, f"{kind}:{m.start()}:{m.end()}") for m in re.finditer(pattern, text) if len(m.group()) >= least
        ]
    return ",".join(s for *_, s in sorted(found))


def test_secrets_equal_brute_force(spark, base):
    docs = spark.createDataFrame([(*t, "en", "clash") for t in TEXTS], "doc_id bigint, text string, source string, lang string, row string")
    rows = secrets.find(docs, keep=("text",)).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert r["base"] == _base(r["text"])
        assert r["n_assign"] == r["base"].count("assign")
    spans = {r["doc_id"]: r["spans"] for r in rows}
    assert spans[8] == "owned:5:26" and spans[9] == spans[10] == ""
    counts = {r["doc_id"]: (r["n_live"], r["n_example"]) for r in rows}
    assert counts[1] == (1, 1) and counts[2] == (0, 1)
    assert secrets.find(docs.limit(0)).count() == 0
    given = spark.read.parquet(f"{base}/documents.parquet")
    assert all(r["base"] == _base(r["text"]) for r in secrets.find(given, keep=("text",)).collect())


def test_redaction(spark):
    docs = spark.createDataFrame([(*t, "en") for t in TEXTS], "doc_id bigint, text string, source string, lang string")
    rows = secrets.find(docs, keep=("text",)).select("doc_id", secrets.redact(F.col("text"), F.col("found")).alias("t")).collect()
    made = {r["doc_id"]: r["t"] for r in rows}
    assert made[1] == "[secret]' and [secret]" and made[7] == "é" * 10 + "[secret]" and made[9] == TEXTS[8][1]
    assert made[8] == "live [secret] here" and made[None] == "[secret] [secret]"


def test_pipeline_stages(spark, base):
    docs = spark.read.parquet(f"{base}/documents.parquet")
    labels = spark.read.parquet(f"{base}/labels.parquet")
    columns, seen = docs.columns, docs
    counts = []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        seen = stage(spark, seen, base).cache()
        assert seen.columns == columns, name
        counts.append(seen.count())
    assert docs.count() >= counts[0] >= counts[1] == counts[2] == counts[3] > 0.5 * docs.count()
    clean = labels.where("toxic = 0").join(docs, "doc_id", "left_semi")
    first = corpus_pipeline.toxicity_stage(spark, docs, base)
    assert clean.join(first, "doc_id", "left_anti").count() <= 0.03 * clean.count()
    assert all(_base(r["text"]) == "" for r in seen.select("text").collect())
    packed = corpus_pipeline.packing_stage(spark, seen, base)
    assert packed.select("doc_id").distinct().count() == counts[3]


def test_pipeline_of_awkward_rows(spark, base, tmp_path):
    schema = "doc_id bigint, text string, lang string, source string, n_chars bigint"
    rows = [(1, None, None, None, None), (2, "", "en", "a", 0), (3, "some words " * 400, "en", "a", 1), (3, "some words " * 400, "en", "a", 1),
            (None, "other words", None, "b", 1)]
    folder = str(tmp_path / "tables")
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    spark.read.parquet(f"{base}/labels.parquet").write.parquet(f"{folder}/labels.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 3
    empty = str(tmp_path / "empty")
    spark.createDataFrame([], schema).write.parquet(f"{empty}/documents.parquet")
    spark.read.parquet(f"{base}/labels.parquet").limit(0).write.parquet(f"{empty}/labels.parquet")
    assert corpus_pipeline.run(spark, empty).count() == 0


def test_stages_carry_columns_whatever_they_are_called(spark, base):
    clashing = (
        "toxic_score score kept n_bytes n_removed n_spans spans found base n_assign n_access n_hex n_live n_example row owner "
        "repo _place _check _again _looked_at key check label half carried_0 first"
    ).split()
    docs = spark.read.parquet(f"{base}/documents.parquet").where("doc_id < 60")
    odd = docs.withColumns({c: F.concat(F.lit(f"{c} "), F.col("doc_id").cast("string")) for c in clashing}).cache()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        plain = {r["doc_id"]: r for r in stage(spark, docs, base).collect()}
        seen = stage(spark, odd, base)
        assert seen.columns == odd.columns, name
        rows = seen.collect()
        assert {r["doc_id"] for r in rows} == plain.keys() and len(rows) == len(plain), name
        for r in rows:
            assert all(r[c] == plain[r["doc_id"]][c] for c in docs.columns), name
            assert all(r[c] == f"{c} {r['doc_id']}" for c in clashing), name
    assert corpus_pipeline.packing_stage(spark, odd, base).count() > 0
