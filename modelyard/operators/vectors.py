"""Nearest vectors by cosine similarity: exact, or among the vectors of matching hash buckets.

A block of vectors is compared with a block of queries as one matrix product and only the best k per
query leave the task.  Few queries travel to every task (after their size was checked); many queries
are cut into blocks that meet blocks of vectors by key, so neither side is ever whole in one place.

Among hash buckets the vectors of a batch that have the same buckets are multiplied at once with the
queries that share one of them, so a pair is scored once in however many buckets it meets.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml.feature import BucketedRandomProjectionLSH, BucketedRandomProjectionLSHModel
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, functions as F, types as T

from modelyard.operators.blocks import top_k
from modelyard.sources.shared import cut_lineage

# Queries up to this many bytes of DOUBLEs are sent to every task.
BROADCAST_BYTES = 32 << 20
_BLOCK_ROWS = 4096
_SCORE_CELLS = 4 << 20
# Rows of one side of a bucket that meet in one task; multiplications that make a task of their own worth while, and
# that one task shall not exceed.  Every task returns k hits for each query, so there should not be too many.
_SLICE_ROWS = 1 << 16
_TASK_PRODUCTS = 1 << 30, 1 << 36
_NO_ID = np.iinfo(np.int64).min  # orders a missing id before the others, as Spark does

_HITS = T.StructType(
    [
        T.StructField("query_id", T.LongType()),
        T.StructField("vec_id", T.LongType()),
        T.StructField("similarity", T.DoubleType()),
    ]
)
_NO_HITS = pa.RecordBatch.from_arrays(
    [pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], _HITS.names
)


def _unit_rows(vectors: pd.Series) -> np.ndarray:
    matrix = np.vstack([np.asarray(v, dtype=np.float64) for v in vectors])
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return np.divide(matrix, norms, out=np.zeros_like(matrix), where=norms > 0)


def _best(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> pd.DataFrame:
    """k best vectors per query, smaller id first on ties; scores are held for a slice of queries at a time."""
    k = min(k, len(ids))
    at_once = max(1, _SCORE_CELLS // len(ids))
    found = []
    for start in range(0, len(query_ids), at_once):
        scores = queries[start : start + at_once] @ vectors.T
        border = np.partition(scores, len(ids) - k, axis=1)[:, len(ids) - k, None]
        rows, columns = np.nonzero(scores >= border)
        hits = pd.DataFrame(
            {"query_id": query_ids[start + rows], "vec_id": ids[columns], "similarity": scores[rows, columns]}
        )
        found.append(_keep_best(hits, k))
    return pd.concat(found, ignore_index=True)


def _keep_best(hits: pd.DataFrame, k: int) -> pd.DataFrame:
    ordered = hits.sort_values(["query_id", "similarity", "vec_id"], ascending=[True, False, True], kind="stable")
    return ordered.groupby("query_id", sort=False).head(k)


def _scan(vectors: DataFrame, queries: DataFrame, k: int) -> DataFrame:
    """Queries in every task, vectors scanned in place: no shuffle of vectors."""
    local = queries.toPandas()
    shared = vectors.sparkSession.sparkContext.broadcast(
        (local["query_id"].to_numpy(np.int64), _unit_rows(local["embedding"]))
    )

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        query_ids, matrix = shared.value
        held: pd.DataFrame | None = None
        for batch in batches:
            if batch.empty:
                continue
            found = _best(query_ids, matrix, batch["vec_id"].to_numpy(np.int64), _unit_rows(batch["embedding"]), k)
            held = found if held is None else _keep_best(pd.concat([held, found]), k)
        if held is not None:
            yield held

    return vectors.select("vec_id", "embedding").mapInPandas(search, _HITS)


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("bigint"), F.lit(n - 1).cast("bigint"))


def _blocks(vectors: DataFrame, queries: DataFrame, n_vectors: int, n_queries: int, k: int) -> DataFrame:
    """Every block of queries meets every block of vectors once."""
    v_blocks = max(1, -(-n_vectors // _BLOCK_ROWS))
    q_blocks = max(1, -(-n_queries // _BLOCK_ROWS))
    v_side = (
        vectors.select("vec_id", "embedding")
        .withColumn("_v", F.pmod(F.xxhash64("vec_id"), F.lit(v_blocks)))
        .withColumn("_q", F.explode(_numbers(q_blocks)))
    )
    q_side = (
        queries.select("query_id", F.col("embedding").alias("q_embedding"))
        .withColumn("_q", F.pmod(F.xxhash64("query_id"), F.lit(q_blocks)))
        .withColumn("_v", F.explode(_numbers(v_blocks)))
    )

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if left.empty or right.empty:
            return pd.DataFrame({"query_id": [], "vec_id": [], "similarity": []}).astype(
                {"query_id": "int64", "vec_id": "int64", "similarity": "float64"}
            )
        return _best(
            right["query_id"].to_numpy(np.int64),
            _unit_rows(right["q_embedding"]),
            left["vec_id"].to_numpy(np.int64),
            _unit_rows(left["embedding"]),
            k,
        )

    return v_side.groupBy("_v", "_q").cogroup(q_side.groupBy("_v", "_q")).applyInPandas(meet, _HITS)


def nearest(
    vectors: DataFrame, queries: DataFrame, k: int, broadcast_bytes: int = BROADCAST_BYTES
) -> DataFrame:
    """Exact k nearest vectors for every query: (query_id, rank, vec_id, similarity).

    `vectors` has (vec_id, embedding), `queries` (query_id, embedding).  Filters on the vectors are
    applied by the caller before, and reach the scan.
    """
    if k < 1:
        raise ValueError("k must be positive")
    size = queries.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("embedding")), F.lit(0)).alias("d")).first()
    if size["n"] * size["d"] * 8 <= broadcast_bytes:
        if size["n"] == 0:
            hits = vectors.sparkSession.createDataFrame([], _HITS)
        else:
            hits = _scan(vectors, queries, k)
    else:
        hits = _blocks(vectors, queries, vectors.count(), size["n"], k)
    return _ranked(hits, k)


def _bucketed(df: DataFrame, id_column: str, lsh: BucketedRandomProjectionLSHModel | None = None, **options):
    """(id, unit, buckets): unit vector and its bucket in every hash table; with the fitted hashes.

    On unit vectors the order by distance, which the hashes follow, is the order by cosine.
    """
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")))
    # The norm is bound by a lambda of its own: as a column it would be put in, and summed, for every component.
    divided = lambda n: F.transform("embedding", lambda x: F.coalesce(F.try_divide(x.cast("double"), n), F.lit(0.0)))
    units = df.select(id_column, F.get(F.transform(F.array(norm), divided), F.lit(0)).alias("unit"))
    units = units.withColumn("_x", array_to_vector("unit"))
    if lsh is None:
        lsh = BucketedRandomProjectionLSH(inputCol="_x", outputCol="_h", **options).fit(units)
    buckets = F.transform("_h", lambda h: F.get(vector_to_array(h), F.lit(0)).cast("bigint"))
    return lsh.transform(units).select(id_column, "unit", buckets.alias("buckets")), lsh


def _rows(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def _by_value(rows: np.ndarray) -> list[np.ndarray]:
    """Positions of equal rows, together."""
    order = np.lexsort(rows.T)
    changes = np.flatnonzero((rows[order[1:]] != rows[order[:-1]]).any(axis=1)) + 1
    return np.split(order, changes)


def _copies(units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Position of one row of each value, and for all rows the number of their value."""
    units = np.ascontiguousarray(units)
    _, first, number = np.unique(
        units.view(f"V{units.itemsize * units.shape[1]}").ravel(), return_index=True, return_inverse=True
    )
    return first, number


def _few_copies(ids: np.ndarray, units: np.ndarray, k: int) -> np.ndarray:
    """Positions without those copies of a vector that k copies of smaller id leave no place among the best."""
    _, copy_of = _copies(units)
    order = np.lexsort((ids, copy_of))
    ordered = copy_of[order]
    return np.sort(order[np.arange(len(order)) - np.searchsorted(ordered, ordered) < k])


class _Asked:
    """Queries of a task, with the k best hits that each has so far; equal queries are searched for once.

    Pairs are chosen by products of single precision with a margin for their rounding; what is kept is
    scored in double precision, component by component, so equal vectors get equal similarities.
    """

    def __init__(self, ids: pa.Array, units: np.ndarray, buckets: np.ndarray, k: int):
        first, self.copy_of = _copies(units)
        units, buckets = units[first], buckets[first]
        self.ids, self.buckets, self.k = ids, buckets, k
        self.by_component, self.short = np.ascontiguousarray(units.T), units.astype(np.float32)
        self.longest, self.any_nan = self._length(units), bool(np.isnan(units).any())
        self.top = np.full((len(units), k), -np.inf, np.float32)
        self.order = np.argsort(buckets, axis=0, kind="stable")
        self.ordered = np.take_along_axis(buckets, self.order, axis=0)
        self.held = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)

    @staticmethod
    def _length(units: np.ndarray) -> float:
        return float(np.fmax.reduce(np.linalg.norm(units, axis=1), initial=0.0))

    def _sharing(self, own: np.ndarray, table: int | None) -> np.ndarray:
        """Queries that share a bucket; or, in a meeting of one table's bucket, that share none of an earlier table."""
        if table is not None:
            return np.flatnonzero(~(self.buckets[:, :table] == own[:table]).any(axis=1))
        shares = np.zeros(len(self.buckets), bool)
        for t, bucket in enumerate(own):
            low, high = np.searchsorted(self.ordered[:, t], [bucket, bucket + 1])
            shares[self.order[low:high, t]] = True
        return np.flatnonzero(shares)

    def _near(self, asked: np.ndarray, vectors: np.ndarray, margin: float) -> tuple[np.ndarray, ...]:
        """(row of `asked`, row of `vectors`, score) of the pairs that may be among the best."""
        scores = self.short[asked] @ vectors.T
        if self.any_nan:
            scores[np.isnan(scores)] = np.inf  # NaN is the largest number in Spark's order
        least = self.top[asked].min(axis=1) - margin
        near = scores >= least[:, None]
        if len(vectors) > self.k and np.count_nonzero(near) > 2 * self.k * len(asked):
            at = len(vectors) - self.k
            least = np.maximum(least, np.partition(scores, at, axis=1)[:, at] - margin)
            near = scores >= least[:, None]
        row, column = np.divmod(np.flatnonzero(near), len(vectors))
        score = scores[row, column]
        counts = np.bincount(row, minlength=len(asked))
        touched = np.flatnonzero(counts)
        if len(touched):
            place = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
            wide = np.full((len(touched), self.k + counts.max()), -np.inf, np.float32)
            wide[:, : self.k] = self.top[asked[touched]]
            wide[np.repeat(np.arange(len(touched)), counts[touched]), self.k + place] = score
            self.top[asked[touched]] = np.partition(wide, counts.max(), axis=1)[:, counts.max() :]
        return row, column, score

    def meet(self, ids: pa.Array, units: np.ndarray, buckets: np.ndarray, table: int | None = None) -> None:
        """Vectors that may meet the queries: in any bucket, or all in one of `table`."""
        ids = ids.fill_null(_NO_ID).to_numpy(zero_copy_only=False)
        kept = _few_copies(ids, units, self.k)
        ids, units, buckets = ids[kept], units[kept], buckets[kept]
        short = units.astype(np.float32)
        self.any_nan |= bool(np.isnan(short).any())
        # Twice what a product of n components of single precision can be off on either side.
        margin = 4 * (units.shape[1] + 2) * 2.0**-24 * self.longest * self._length(units)
        by_component, found, waiting = np.ascontiguousarray(units.T), [], 0
        for same in _by_value(buckets):
            asked = self._sharing(buckets[same[0]], table)
            step = max(1, _SCORE_CELLS // len(same))
            for start in range(0, len(asked), step):
                some = asked[start : start + step]
                row, column, score = self._near(some, short[same], margin)
                found.append((some[row], same[column], score))
                waiting += len(row)
                if waiting > _SCORE_CELLS // 4:
                    self._score(found, ids, by_component, margin)
                    found, waiting = [], 0
        if found:
            self._score(found, ids, by_component, margin)

    def _score(self, found: list[tuple], ids: np.ndarray, by_component: np.ndarray, margin: float) -> None:
        asked, met, score = (np.concatenate(c) for c in zip(*found))
        still = score >= self.top.min(axis=1)[asked] - margin
        asked, met = asked[still], met[still]
        similarity = np.zeros(len(asked))
        for x, y in zip(by_component, self.by_component):
            similarity += x[met] * y[asked]
        self._hold(asked, ids[met], similarity)

    def _hold(self, asked: np.ndarray, ids: np.ndarray, similarity: np.ndarray) -> None:
        asked, ids, similarity = (np.concatenate(c) for c in zip(self.held, (asked, ids, similarity)))
        order = np.lexsort((ids, -np.where(np.isnan(similarity), np.inf, similarity), asked))
        ordered = asked[order]
        best = order[np.arange(len(order)) - np.searchsorted(ordered, ordered) < self.k]
        self.held = asked[best], ids[best], similarity[best]

    def hits(self) -> pa.RecordBatch:
        asked, ids, similarity = self.held
        starts = np.searchsorted(asked, self.copy_of)
        counts = np.searchsorted(asked, self.copy_of, side="right") - starts
        row = np.repeat(np.arange(len(self.copy_of)), counts)
        hit = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts) + starts[row]
        ids, similarity = ids[hit], similarity[hit]
        return pa.RecordBatch.from_arrays(
            [self.ids.take(pa.array(row)), pa.array(ids, mask=ids == _NO_ID), pa.array(similarity)],
            ["query_id", "vec_id", "similarity"],
        )


def _scan_buckets(v: DataFrame, q: DataFrame, k: int) -> DataFrame:
    """Queries and their buckets in every task, vectors scanned in place."""
    local = q.select(F.col("query_id").cast("bigint"), "unit", "buckets").toArrow().combine_chunks()
    if local.num_rows == 0:
        return v.sparkSession.createDataFrame([], _HITS)
    ids, units, buckets = (c.combine_chunks() for c in local.columns)
    shared = v.sparkSession.sparkContext.broadcast((ids, _rows(units), _rows(buckets)))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = _Asked(*shared.value, k)
        for batch in batches:
            if batch.num_rows:
                ids, units, buckets = batch.columns
                asked.meet(ids, _rows(units), _rows(buckets))
        yield asked.hits()

    return v.select(F.col("vec_id").cast("bigint"), "unit", "buckets").mapInArrow(search, _HITS)


def _meet_by_bucket(v: DataFrame, q: DataFrame, n_queries: int, k: int) -> DataFrame:
    """Vectors and queries go to their bucket of every table; large buckets are cut into slices of either side.

    Where the buckets are so large that by those of the queries a pair would meet more than once on average, all
    slices meet once instead, which moves fewer rows; the pairs that are scored are the same.
    """
    met = F.sum(F.col("count").cast("double") * F.col("count"))
    coarse = q.select(F.posexplode("buckets")).groupBy("pos", "col").count().agg(met).first()[0] >= n_queries**2

    def placed(df: DataFrame, id_column: str) -> DataFrame:
        place = [F.lit(-1).alias("_t"), F.lit(0).cast("bigint").alias("_b")]
        if not coarse:
            place = [F.posexplode("buckets").alias("_t", "_b")]
        return df.select(F.col(id_column).cast("bigint").alias("id"), "unit", "buckets", *place)

    def slices(df: DataFrame, name: str) -> DataFrame:
        # At most a row for each _SLICE_ROWS rows.
        cut = F.ceil(F.count(F.lit(1)) / _SLICE_ROWS)
        return F.broadcast(df.groupBy("_t", "_b").agg(cut.alias(name)).where(F.col(name) > 1))

    v, q = placed(v, "vec_id"), placed(q, "query_id")
    v_slices, q_slices = slices(v, "_vs"), slices(q, "_qs")

    def dealt(df: DataFrame, own: str, other: str) -> DataFrame:
        cut = df.join(v_slices, ["_t", "_b"], "left").join(q_slices, ["_t", "_b"], "left")
        mine = F.pmod(F.xxhash64("id", "unit"), F.coalesce(own, F.lit(1)))
        each = F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce(other, F.lit(1)) - 1))
        return cut.select("_t", "_b", mine.alias(own), each.alias(other), "id", "unit", "buckets")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_batches([_NO_HITS])
        parts = [[side[c].combine_chunks() for c in ("id", "unit", "buckets")] for side in (left, right)]
        (ids, units, buckets), (asked_ids, asked_units, asked_buckets) = parts
        asked = _Asked(asked_ids, _rows(asked_units), _rows(asked_buckets), k)
        asked.meet(ids, _rows(units), _rows(buckets), None if coarse else left["_t"][0].as_py())
        return pa.Table.from_batches([asked.hits()])

    key = ["_t", "_b", "_vs", "_qs"]
    v_side, q_side = dealt(v, "_vs", "_qs").groupBy(*key), dealt(q, "_qs", "_vs").groupBy(*key)
    return v_side.cogroup(q_side).applyInArrow(meet, _HITS)


def nearest_in_buckets(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    bucket_length: float = 0.5,
    tables: int = 6,
    seed: int = 1,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """k nearest among the vectors that share a hash bucket with the query, re-ranked exactly.

    Approximate in which vectors are found, exact in their similarity.  Queries whose buckets hold
    fewer than k vectors are answered by the exact search.
    """
    size = queries.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.size("embedding")), F.lit(0)).alias("d")).first()
    v, lsh = _bucketed(vectors, "vec_id", bucketLength=bucket_length, numHashTables=tables, seed=seed)
    q, _ = _bucketed(queries, "query_id", lsh)
    if size["n"] * (size["d"] + tables) * 8 <= broadcast_bytes:
        products = vectors.count() * size["n"] * size["d"]
        most, least = (-(-products // x) for x in _TASK_PRODUCTS)
        tasks = min(most, max(least, vectors.sparkSession.sparkContext.defaultParallelism))
        if tasks > 1:  # else a table of one file is one task, however many queries meet it
            dealt = vectors.repartition(tasks)
            v, _ = _bucketed(dealt, "vec_id", lsh)
        hits = _scan_buckets(v, q, k)
    else:
        hits = _meet_by_bucket(v, q, size["n"], k)
    found = cut_lineage(_ranked(hits, k))
    answered = found.where(F.col("rank") == k).select("query_id")
    short = queries.join(answered, "query_id", "left_anti")
    exact = nearest(vectors, short, k, broadcast_bytes)
    return found.join(answered, "query_id", "left_semi").unionByName(exact)


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    order = [F.desc("similarity"), F.asc("vec_id")]
    return top_k(hits, ["query_id"], order, k, spread=F.col("vec_id")).select("query_id", "rank", "vec_id", "similarity")
