"""Clustering by the threshold algorithm, against plain rounds over all centroids."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest

from check_oracle import compare, connect
from modelyard.llm import centroids
from modelyard.llm.queries import ORACLE, QUERIES


def test_query_equals_sql(spark):
    base = "/root/testdata/sf0.01"
    assert compare(spark, connect(base), QUERIES["op13_centroids"], ORACLE["op13_centroids"], base) is None


def _plain(rows, k, rounds, scale, seed=1):
    """(id, cluster, distance) of every row and the centroids, in Python integers."""
    points = [(i, [int(np.floor(scale * x)) if abs(x) < 2**40 else scale * int(x) for x in v]) for i, v in rows]
    key = lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1])
    centres = [v for _, v in sorted(points, key=key)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        held = [[] for _ in centres]
        for _, v in points:
            held[nearest(v)[1]].append(v)
        centres = [[sum(x) // len(h) for x in zip(*h)] if h else c for h, c in zip(held, centres)]
    return [(i, nearest(v)[1], nearest(v)[0]) for i, v in points], centres


@pytest.mark.parametrize("k", [1, 7, 60])
def test_clusters_equal_plain_rounds(spark, k):
    draw = np.random.default_rng(5)
    points = draw.normal(size=(400, 5))
    points[50:150] = points[50]  # ties and empty centroids
    points[150:200] = np.round(points[150:200])
    rows = [(int(i), [float(x) for x in v]) for i, v in enumerate(points)]
    df = spark.createDataFrame([(*r, "clash", 1) for r in rows], "vec_id bigint, embedding array<double>, v string, cluster int").repartition(5)
    got = centroids.clusters(df, k=k, rounds=3, width=5).collect()
    wanted, centres = _plain(rows, k, 3, 64)
    assert sorted((r["vec_id"], r["cluster"], r["distance"]) for r in got) == sorted(wanted)
    total = sum(d for _, _, d in wanted)
    for r in got:
        assert r["inertia"] == total
        assert r["cluster_inertia"] == sum(d for _, c, d in wanted if c == r["cluster"])
        assert r["centroid_sha256"] == hashlib.sha256(",".join(map(str, centres[r["cluster"]])).encode()).hexdigest()


def test_walks_stop_early_where_centroids_lie_apart():
    draw = np.random.default_rng(2)
    points = draw.integers(-10**6, 10**6, (50, 2))
    vectors = points[draw.integers(0, 50, 3000)] + draw.integers(-50, 51, (3000, 2))
    number, distance, computed = centroids.Lists(points.tolist(), 2).nearest(vectors)
    exact = ((vectors[:, None, :] - points[None]) ** 2).sum(axis=2)
    assert (number == exact.argmin(axis=1)).all() and (distance == exact.min(axis=1)).all()
    assert computed < 0.2 * exact.size


def test_ties_go_to_the_smaller_number():
    lists = centroids.Lists([[2, 0], [-2, 0], [0, 2], [-2, 0], [0, -2]], 2)
    number, distance, _ = lists.nearest(np.array([[0, 0], [-1, 0], [0, -1], [1, 1], [-5, 0]]))
    assert number.tolist() == [0, 1, 4, 0, 1] and distance.tolist() == [4, 1, 1, 2, 9]


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 2.0]), (1, [3.0, None]), (2, None), (3, [nan, 1.0]), (4, [inf, 0.0]), (5, [-1e-20, 0.25]), (6, [1.0]),
            (7, []), (None, [1.0, 1.0]), (5, [-1e-20, 0.25]), (8, [1e308, 0.0])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    got = sorted(((r["vec_id"], r["cluster"], r["distance"]) for r in centroids.clusters(df, k=2, width=2).collect()), key=repr)
    kept = [(i, v) for i, v in rows if i in (0, 5, None)]
    assert got == sorted(_plain(kept, 2, 3, 64)[0], key=repr)
    assert centroids.clusters(df.limit(0), width=2).collect() == []


def test_components_of_any_size_stay_exact(spark):
    rows = [(0, [1e30, 2.0]), (1, [1e30, 3.0]), (2, [-3e9, 0.5]), (3, [0.25, -0.5]), (4, [0.0, -1e12]), (5, [1.5, 2.5])]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    for k in (1, 3, 6):
        got = centroids.clusters(df, k=k, width=2).collect()
        wanted, _ = _plain(rows, k, 3, 64)
        long = lambda d: d if d < 1 << 63 else None
        assert sorted((r["vec_id"], r["cluster"], r["distance"]) for r in got) == [(i, c, long(d)) for i, c, d in wanted]
        assert {r["inertia"] for r in got} == {long(sum(d for _, _, d in wanted))}
