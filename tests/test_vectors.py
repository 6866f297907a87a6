from __future__ import annotations

import numpy as np
import pytest

from modelyard.operators import vectors


@pytest.fixture(scope="module")
def tables(spark):
    draw = np.random.default_rng(4)
    v = draw.normal(size=(500, 8))
    v[100:300] = v[100]  # copies: ties must go to the smaller id
    v[499] = 0.0
    q = np.vstack([draw.normal(size=(20, 8)), v[100]])
    make = lambda m, name: spark.createDataFrame(
        [(i, [float(x) for x in r]) for i, r in enumerate(m)], f"{name} bigint, embedding array<double>"
    ).repartition(5)
    return make(v, "vec_id").cache(), make(q, "query_id").cache(), v, q


def _brute(v, q, k):
    unit = v / np.where(np.linalg.norm(v, axis=1, keepdims=True) > 0, np.linalg.norm(v, axis=1, keepdims=True), 1)
    scores = np.round((q / np.linalg.norm(q, axis=1, keepdims=True)) @ unit.T, 9)
    return {i: [int(j) for j in np.lexsort((np.arange(len(v)), -row))[:k]] for i, row in enumerate(scores)}


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
@pytest.mark.parametrize("k", [1, 10, 600])
def test_nearest_is_exact(tables, broadcast_bytes, k, monkeypatch):
    monkeypatch.setattr(vectors, "_BLOCK_ROWS", 64)
    df, queries, v, q = tables
    got = {}
    for r in sorted(vectors.nearest(df, queries, k, broadcast_bytes).collect(), key=lambda r: (r["query_id"], r["rank"])):
        got.setdefault(r["query_id"], []).append((r["vec_id"], r["similarity"]))
    wanted = _brute(v, q, k)
    for i, hits in got.items():
        assert len(hits) == min(k, 500)
        assert [s for _, s in hits] == sorted((s for _, s in hits), reverse=True)
        if i != 20:
            distinct = [h for h, _ in hits if not 100 <= h < 300]
            assert distinct == [w for w in wanted[i] if not 100 <= w < 300]
    assert set(got) == set(wanted)


def test_no_queries_no_hits(tables):
    df, queries, _, _ = tables
    assert vectors.nearest(df, queries.where("query_id < 0"), 3).count() == 0


def test_filter_reaches_the_scan(spark, base):
    from modelyard.sources.tables import read_table

    df = read_table(spark, base, "embeddings").where("label = 2")
    queries = df.where("vec_id < 40").selectExpr("vec_id AS query_id", "embedding")
    found = vectors.nearest(df, queries, 3)
    assert "EqualTo(label,2)" in found._jdf.queryExecution().toString()
    best = {r["query_id"]: r["vec_id"] for r in found.where("rank = 1").collect()}
    assert best and all(k == v for k, v in best.items())


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_buckets_find_most_and_score_exactly(spark, base, broadcast_bytes):
    from modelyard.sources.tables import read_table

    df = read_table(spark, base, "embeddings")
    queries = df.where("vec_id % 20 = 0").selectExpr("vec_id AS query_id", "embedding")
    k = 10
    exact = {(r["query_id"], r["vec_id"]): r["similarity"] for r in vectors.nearest(df, queries, k).collect()}
    found = vectors.nearest_in_buckets(df, queries, k, broadcast_bytes=broadcast_bytes).collect()
    assert len(found) == len(exact)  # k for every query
    pairs = {(r["query_id"], r["vec_id"]): r["similarity"] for r in found}
    assert len(pairs) == len(found)
    shared = pairs.keys() & exact.keys()
    assert all(pairs[p] == pytest.approx(exact[p], abs=1e-9) for p in shared)
    assert len(shared) / len(exact) >= 0.9


def test_thin_buckets_fall_back_to_exact_search(tables):
    df, queries, _, _ = tables
    thin = vectors.nearest_in_buckets(df, queries, 7, bucket_length=1e-6, tables=1)
    exact = vectors.nearest(df, queries, 7)
    key = lambda r: (r["query_id"], r["rank"])
    got, wanted = sorted(thin.collect(), key=key), sorted(exact.collect(), key=key)
    assert [key(r) for r in got] == [key(r) for r in wanted]
    assert [r["similarity"] for r in got] == pytest.approx([r["similarity"] for r in wanted], abs=1e-9)


@pytest.fixture(scope="module")
def odd(spark):
    """Vectors and queries with repeated and missing ids, copies, near copies and vectors of length zero."""
    draw = np.random.default_rng(8)
    v = draw.normal(size=(400, 6)).astype(np.float32)
    v[50:150] = v[50]
    v[150:200] = v[50] + draw.normal(scale=1e-7, size=(50, 6)).astype(np.float32)
    v[200:230] = 0.0
    ids = [None if i % 50 == 7 else i // 2 if i > 350 else i for i in draw.permutation(400).tolist()]
    q = np.vstack([draw.normal(size=(30, 6)), np.zeros((5, 6)), np.tile(v[50], (3, 1)), v[60:62]]).astype(np.float32)
    asked = [i // 2 if i < 10 else i for i in range(len(q))]
    make = lambda m, i, name: spark.createDataFrame(
        [(a, [float(x) for x in r]) for a, r in zip(i, m)], f"{name} bigint, embedding array<float>"
    ).repartition(3)
    return make(v, ids, "vec_id").cache(), make(q, asked, "query_id").cache()


def _pair_by_pair(df, queries, k, length, tables):
    """Sequential products of all pairs that share a bucket, the k best by similarity and id."""
    v, lsh = vectors._bucketed(df, "vec_id", bucketLength=length, numHashTables=tables, seed=1)
    v, q = v.collect(), vectors._bucketed(queries, "query_id", lsh)[0].collect()
    hits = {}
    for a in q:
        for b in v:
            if any(x == y for x, y in zip(a["buckets"], b["buckets"])):
                similarity = 0.0
                for x, y in zip(b["unit"], a["unit"]):
                    similarity += x * y
                hits.setdefault(a["query_id"], []).append((-similarity, b["vec_id"] is not None, b["vec_id"] or 0))
    best = {i: sorted(h)[:k] for i, h in hits.items() if len(h) >= k}
    return [(i, r, v if there else None, -s) for i in sorted(best) for r, (s, there, v) in enumerate(best[i], 1)]


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
@pytest.mark.parametrize("length, tables, k", [(0.5, 6, 7), (0.05, 3, 2), (0.5, 1, 60)])
def test_buckets_score_the_very_pairs_that_share_one(odd, broadcast_bytes, length, tables, k, monkeypatch):
    monkeypatch.setattr(vectors, "_SLICE_ROWS", 32)
    monkeypatch.setattr(vectors, "_SCORE_CELLS", 256)
    df, queries = odd
    nothing = lambda v, q, *_: vectors._ranked(v.sparkSession.createDataFrame([], vectors._HITS), k)
    monkeypatch.setattr(vectors, "nearest", nothing)  # the exact search of queries with thin buckets
    found = vectors.nearest_in_buckets(df, queries, k, length, tables, broadcast_bytes=broadcast_bytes)
    got = sorted((tuple(r) for r in found.collect()), key=lambda r: r[:2])
    wanted = _pair_by_pair(df, queries, k, length, tables)
    assert wanted and got == wanted


@pytest.mark.parametrize("broadcast_bytes", [1 << 20, 0])
def test_pairs_of_buckets_do_not_become_rows(spark, broadcast_bytes, monkeypatch):
    draw = np.random.default_rng(3)
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(draw.normal(size=(3000, 16)))]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").coalesce(2)
    queries = df.where("vec_id % 20 = 0").selectExpr("vec_id AS query_id", "embedding")
    seen, ranked = [], vectors._ranked

    def counted(hits, k):
        seen.append(hits.count())
        return ranked(hits, k)

    monkeypatch.setattr(vectors, "_ranked", counted)
    assert vectors.nearest_in_buckets(df, queries, 5, broadcast_bytes=broadcast_bytes).count() == 150 * 5
    places = 2 if broadcast_bytes else 6 * 8  # tasks; buckets of all tables
    assert seen[0] <= places * 150 * 5  # nearly all of the 450,000 pairs share a bucket


def test_norm_is_summed_once_for_a_vector(spark, base):
    from modelyard.sources.tables import read_table

    df = read_table(spark, base, "embeddings")
    v, _ = vectors._bucketed(df, "vec_id", bucketLength=0.5, numHashTables=2, seed=1)
    plan = v._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("SQRT(aggregate(") == 1 and "/ SQRT(" not in plan
