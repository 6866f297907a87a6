"""Clustering of vectors around centroids, nearest centroids found by the threshold algorithm.

Vectors are integers (scaled components, rounded down), so that distances, sums and means are exact
and do not depend on how rows are dealt to tasks.  Every dimension has its list of centroids in order
of their value there.  A vector walks each list outward from its own value, one centroid a list and
step; a centroid met for the first time has its exact distance computed.  The distances in the single
dimensions at which the walk stands add up to a bound below any centroid not yet met, so a vector stops
as soon as that sum strictly exceeds its best exact distance: an equally near centroid of a smaller
number cannot be missed.  Only centroids and their sums, whose number is fixed, pass the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from modelyard.llm.common import materialise

_CHUNK = 2048  # vectors that walk together
_SMALL = 1 << 26  # components beyond this are computed as Python integers, which have no bound
_LIMB = 30
_LONG = (1 << 63) - 1


def quantised(df: DataFrame, id_col: str, vector_col: str, width: int, scale: int) -> DataFrame:
    """(vec_id, v): floor(scale * component) of the vectors with `width` components, none null or
    non-finite; as doubles, which hold these integers exactly."""
    v = F.transform(F.col(f"`{vector_col}`").cast("array<double>"), lambda x: x * scale)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = df.where(F.coalesce((F.size(v) == width) & finite, F.lit(False)))
    # From 2^53 on a double is a whole number, and floor() would force it into a bigint.
    down = F.transform(v, lambda x: F.when(F.abs(x) < float(1 << 53), F.floor(x).cast("double")).otherwise(x))
    return kept.select(F.col(f"`{id_col}`").cast("bigint").alias("vec_id"), down.alias("v"))


def integers(rows: np.ndarray) -> np.ndarray:
    """Whole doubles as 64-bit integers, as Python integers where squares of those could overflow."""
    if not rows.size or np.abs(rows).max() < _SMALL:
        return rows.astype(np.int64)
    return np.array([[int(x) for x in r] for r in rows], object).reshape(rows.shape)


def _vectors(batch: pa.RecordBatch, width: int) -> np.ndarray:
    return integers(batch.column("v").flatten().to_numpy(zero_copy_only=False).reshape(-1, width))


class Lists:
    """The centroids, and in each dimension their numbers in order of their value."""

    def __init__(self, centroids: list[list[int]], width: int):
        small = all(abs(x) < _SMALL for c in centroids for x in c)
        self.points = np.array(centroids, np.int64 if small else object).reshape(len(centroids), width)
        self.order = np.argsort(self.points, axis=0, kind="stable").T
        self.values = np.take_along_axis(self.points.T, self.order, axis=1)

    def nearest(self, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
        """(number, squared distance, exact distances computed); ties go to the smaller number."""
        points, values = self.points, self.values
        if vectors.dtype != points.dtype:
            vectors, points, values = (a.astype(object) for a in (vectors, points, values))
        n, (k, width) = len(vectors), points.shape
        right = np.stack([np.searchsorted(values[d], vectors[:, d]) for d in range(width)], 1)
        left = right - 1
        dims = np.arange(width)
        best = np.full(n, k, np.int64)
        distance = np.zeros(n, vectors.dtype)
        met = np.zeros((n, k), bool)
        walking, computed = np.arange(n), 0
        for _ in range(k):
            own, l, r = vectors[walking], left[walking], right[walking]
            below = own - values[dims, np.maximum(l, 0)]
            above = values[dims, np.minimum(r, k - 1)] - own
            go_left = (l >= 0) & ((r >= k) | (below <= above))
            at = self.order[dims, np.where(go_left, l, np.minimum(r, k - 1))]
            step = np.where(go_left, below, above)
            left[walking], right[walking] = l - go_left, r + ~go_left
            now = np.zeros((len(walking), k), bool)
            np.put_along_axis(now, at, True, axis=1)
            which, centroid = np.nonzero(now & ~met[walking])
            met[walking] |= now
            apart = own[which] - points[centroid]
            exact = (apart * apart).sum(axis=1)
            computed += len(which)
            rows = walking[which]
            for c in range(k):  # in order of number, so that an equal distance changes nothing
                some = centroid == c
                at_c, exact_c = rows[some], exact[some]
                nearer = (best[at_c] == k) | (exact_c < distance[at_c]) | ((exact_c == distance[at_c]) & (c < best[at_c]))
                best[at_c[nearer]], distance[at_c[nearer]] = c, exact_c[nearer]
            going = ((step * step).sum(axis=1) <= distance[walking]) & ~met[walking].all(axis=1)
            walking = walking[going.astype(bool)]
            if not len(walking):
                break
        return best, distance, computed


def _limbs(total: int) -> list[int]:
    """Signed digits of 30 bits, least first: sums of them stay bigints whatever the integers are."""
    sign, rest, out = (-1 if total < 0 else 1), abs(total), []
    while rest or not out:
        out.append(sign * (rest & ((1 << _LIMB) - 1)))
        rest >>= _LIMB
    return out


def _sums(lists: Lists, width: int):
    """Vectors of each centroid counted and added up within the task."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(lists.points)
        counts, totals = [0] * k, [[0] * width for _ in range(k)]
        for batch in batches:
            vectors = _vectors(batch, width)
            for at in range(0, len(vectors), _CHUNK):
                part = vectors[at : at + _CHUNK]
                number, _, _ = lists.nearest(part)
                for c in np.unique(number).tolist():
                    some = part[number == c]
                    counts[c] += len(some)
                    totals[c] = [a + int(b) for a, b in zip(totals[c], some.sum(axis=0))]
        out = [
            (c, d, limb, digit, counts[c])
            for c in range(k)
            if counts[c]
            for d in range(width)
            for limb, digit in enumerate(_limbs(totals[c][d]))
        ]
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[i] for r in out], pa.int64()) for i in range(5)], ["cluster", "d", "limb", "digit", "n"]
        )

    return rows


def moved(vectors: DataFrame, centroids: list[list[int]], width: int) -> list[list[int]]:
    """One round: centroids replaced by the means, rounded down, of the vectors nearest to them."""
    sums = vectors.select("v").mapInArrow(
        _sums(Lists(centroids, width), width), "cluster bigint, d bigint, limb bigint, digit bigint, n bigint"
    )
    # At most as many rows as centroids have components, times the limbs of the largest sum.
    found = sums.groupBy("cluster", "d", "limb").agg(F.sum("digit").alias("digit"), F.sum("n").alias("n")).collect()
    totals, counts = {}, {}
    for r in found:
        totals[r["cluster"], r["d"]] = totals.get((r["cluster"], r["d"]), 0) + (r["digit"] << (_LIMB * r["limb"]))
        if r["limb"] == 0:
            counts[r["cluster"]] = r["n"]
    return [
        [totals[c, d] // counts[c] for d in range(width)] if c in counts else old for c, old in enumerate(centroids)
    ]


def seeds(vectors: DataFrame, k: int, seed: int) -> list[list[int]]:
    """The k vectors with the smallest sha256 of `<seed>:<vec_id>`; of equal ids, the smaller vector."""
    label = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return [[int(x) for x in r["v"]] for r in vectors.orderBy(label, "v").limit(k).select("v").collect()]


@dataclass
class Clusters:
    """`vectors` (vec_id, v) with their nearest of the final `centroids`."""

    vectors: DataFrame
    centroids: list[list[int]]
    width: int

    def members(self) -> DataFrame:
        """vec_id, cluster, distance (squared, exact; null where a long cannot hold it)."""
        lists, width = Lists(self.centroids, self.width), self.width

        def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                vectors = _vectors(batch, width)
                number, apart = [], []
                for at in range(0, len(vectors), _CHUNK):
                    best, distance, _ = lists.nearest(vectors[at : at + _CHUNK])
                    number += best.tolist()
                    apart += [x if x <= _LONG else None for x in distance.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("vec_id"), pa.array(number, pa.int32()), pa.array(apart, pa.int64())],
                    ["vec_id", "cluster", "distance"],
                )

        return self.vectors.mapInArrow(rows, "vec_id bigint, cluster int, distance bigint")


def fit(
    df: DataFrame,
    k: int = 16,
    rounds: int = 3,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    width: int = 64,
    scale: int = 64,
    seed: int = 1,
) -> Clusters:
    """`rounds` rounds of assigning every vector and moving every centroid, from `seeds`.

    Vectors that are null, of another width or hold a component that is null or not finite when scaled
    take no part.  A
    null id is one without digits; repeated rows each count; fewer than k vectors are that many
    centroids, and none are none; a centroid that no vector is nearest to stays; further columns are
    ignored, whatever they are called.
    """
    vectors = materialise(quantised(df, id_col, vector_col, width, scale), "vectors")
    centroids = seeds(vectors, k, seed)
    for _ in range(rounds if centroids else 0):
        centroids = moved(vectors, centroids, width)
    return Clusters(vectors, centroids, width)


def clusters(df: DataFrame, **options) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia (sums of distance), centroid_sha256.

    A sum that a long cannot hold is null, as is one with such a distance in it.  Otherwise as `fit`.
    """
    found = fit(df, **options)
    spark = df.sparkSession
    members = materialise(found.members(), "members")
    whole = F.sum(F.col("distance").cast("decimal(19,0)"))
    sums = members.groupBy("cluster").agg(whole.alias("s"), F.count_if(F.col("distance").isNull()).alias("m"))
    per = {r["cluster"]: (r["s"], r["m"]) for r in sums.collect()}  # one row for each centroid
    total = sum(int(s or 0) for s, _ in per.values()), sum(m for _, m in per.values())
    as_long = lambda s, m: int(s) if m == 0 and s is not None and s <= _LONG else None
    rows = [
        (c, as_long(*per[c]), as_long(*total), ",".join(str(x) for x in found.centroids[c])) for c in sorted(per)
    ]
    known = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, components string")
    return members.join(F.broadcast(known), "cluster").select(
        "vec_id",
        "cluster",
        "distance",
        "cluster_inertia",
        "inertia",
        F.sha2(F.col("components").cast("binary"), 256).alias("centroid_sha256"),
    )
