"""Exact top-k search by inner product with two cover trees, one over queries and one over data.

A node of a tree has a centre, which is one of its points, and a covering radius over everything below
it.  Children are chosen farthest first, so that centres of a level lie apart by no less than they
cover.  The search takes a query node together with the data nodes it still has to look at: a data node
is given up if its largest possible score is below the worst k-th score of the queries in the node.
The bounds of all data nodes at hand are one array expression, rows of a leaf lie side by side, and the
rows of the leaves that survive are multiplied with the query leaf in one product, best leaves first.

Queries and rows are dealt to blocks of bounded size, and a task searches one block of rows for one
block of queries; it hands on at most k rows for each query.  Neither passes through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

_FANOUT = 16
_LEAF = 64
_QUERY_LEAF = 16  # small, so that the queries of a node are alike
_SHRINK = 1.3
_BLOCK = 1 << 19  # components of the rows in a block
_SEEDS = 1 << 17  # components of the rows whose scores give the first lower bounds
_EXACT = float(1 << 53)
_LOWEST = np.iinfo(np.int64).min
_LONG = np.iinfo(np.int64).max
_SLACK = 1e-9  # of the largest values in a bound; far above the rounding of a product


class Tree:
    """Cover tree in arrays: node i covers the rows order[lo[i]:hi[i]] within radii[i] of centres[i]."""

    def __init__(self, points: np.ndarray, leaf: int):
        squares = np.einsum("ij,ij->i", points, points)
        rounding = 1e-12 * float(squares.max(initial=0.0))  # of a squared distance, as computed below
        order = np.arange(len(points))
        chosen, radii, lo, hi, kids = [], [], [], [], []
        waiting = [(0, len(points), 0, -1)]
        while waiting:
            start, stop, centre, parent = waiting.pop()
            rows = order[start:stop]
            here, own = points[rows], squares[rows]

            def apart(row: int) -> np.ndarray:
                return np.maximum(own - 2 * (here @ points[row]) + squares[row], 0.0)

            nearest = apart(centre)
            reach = float(nearest.max())
            if parent >= 0:
                kids[parent].append(len(chosen))
            node = len(chosen)
            chosen.append(centre)
            radii.append(np.sqrt(reach + rounding))
            lo.append(start)
            hi.append(stop)
            kids.append([])
            if stop - start <= leaf or reach <= rounding:
                continue
            centres, owner = [centre], np.zeros(len(rows), np.int64)
            while len(centres) < _FANOUT and (far := int(np.argmax(nearest))) >= 0 and nearest[far] > reach / _SHRINK**2:
                to_new = apart(int(rows[far]))
                closer = to_new < nearest
                closer[far] = True
                owner[closer] = len(centres)
                nearest[closer] = to_new[closer]
                centres.append(int(rows[far]))
            dealt = np.argsort(owner, kind="stable")
            order[start:stop] = rows[dealt]
            ends = start + np.cumsum(np.bincount(owner, minlength=len(centres)))
            for i, (first, end) in enumerate(zip([start, *ends[:-1]], ends)):
                if end > first:
                    waiting.append((int(first), int(end), centres[i], node))
        self.order, self.centres = order, points[chosen]
        self.radii, self.lo, self.hi = np.array(radii), np.array(lo), np.array(hi)
        self.norms = np.sqrt(squares[chosen])
        self.kids = [np.array(k, np.int64) for k in kids]
        self.inner = np.array([len(k) > 0 for k in kids])


class Search:
    """Best k candidates of each query so far: `place` (row of the query), `scores` and `found` (id)."""

    def __init__(self, ids: np.ndarray, queries: np.ndarray, k: int, floor: np.ndarray):
        self.tree = Tree(queries.astype(np.float64), _QUERY_LEAF)
        order = self.tree.order
        self.ids, self.queries, self.k = ids[order], queries[order], k
        self.points = self.queries.astype(np.float64)
        self.kth = floor[order].astype(np.int64)  # a candidate below this is not among the best k
        self.kth_id = np.full(len(ids), _LONG)  # nor is one with this score and a larger id
        self.place = self.scores = self.found = np.empty(0, np.int64)
        self.largest = float(np.abs(self.points).max(initial=0.0))
        self.pairs = 0

    def add(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        points = vectors.astype(np.float64)
        exact = self.largest * float(np.abs(points).max(initial=0.0)) * max(1, vectors.shape[1]) < _EXACT
        data = Tree(points, _LEAF)
        ids, vectors = ids[data.order], points[data.order] if exact else vectors[data.order]
        tables = [(self.place, self.scores, self.found)]
        waiting = [(0, np.zeros(1, np.int64))]
        while waiting:
            node, others = waiting.pop()
            others = self._hopeful(node, data, others)
            children = self.tree.kids[node]
            while True:
                open_ = data.inner[others] & ((len(children) == 0) | (data.radii[others] >= self.tree.radii[node]))
                if not open_.any():
                    break
                below = np.concatenate([data.kids[other] for other in others[open_]])
                others = np.concatenate([others[~open_], self._hopeful(node, data, below)])
            if len(others) == 0:
                continue
            if len(children):
                waiting.extend((child, others) for child in children)
            else:
                tables.append(self._leaf(node, data, others, ids, vectors, exact))
        self.place, self.scores, self.found = (np.concatenate(part) for part in zip(*tables))
        self._keep_best()

    def _bounds(self, node: int, data: Tree, others: np.ndarray) -> np.ndarray:
        """No score of a query in the node with a row in one of the others is above this."""
        norm, radius = self.tree.norms[node], self.tree.radii[node]
        norms, radii = data.norms[others], data.radii[others]
        middle = data.centres[others] @ self.tree.centres[node]
        return middle + norm * radii + norms * radius + radius * radii + _SLACK * (norm + radius) * (norms + radii)

    def _worst(self, node: int) -> float:
        worst = float(self.kth[self.tree.lo[node] : self.tree.hi[node]].min())
        return worst - _SLACK * abs(worst)

    def _hopeful(self, node: int, data: Tree, others: np.ndarray) -> np.ndarray:
        return others[self._bounds(node, data, others) >= self._worst(node)]

    def _leaf(
        self, node: int, data: Tree, others: np.ndarray, ids: np.ndarray, vectors: np.ndarray, exact: bool
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Best candidates of the node's queries in the leaves `others`, the most promising leaves first."""
        start, stop = self.tree.lo[node], self.tree.hi[node]
        bounds = self._bounds(node, data, others)
        order = np.argsort(-bounds, kind="stable")
        others, bounds = others[order], bounds[order]
        queries = self.points[start:stop] if exact else self.queries[start:stop].astype(object)
        place = scores = found = np.empty(0, np.int64)
        at, step = 0, 1
        while at < len(others) and bounds[at] >= self._worst(node):
            rows = np.concatenate([np.arange(data.lo[o], data.hi[o]) for o in others[at : at + step]])
            at, step = at + step, 2 * step
            self.pairs += (stop - start) * len(rows)
            if exact:
                made = (queries @ vectors[rows].T).astype(np.int64)
            else:
                made = np.clip(queries @ vectors[rows].astype(object).T, _LOWEST + 1, _LONG).astype(np.int64)
            own, kth = ids[rows][None, :], self.kth[start:stop, None]
            better = (made > kth) | ((made == kth) & (own <= self.kth_id[start:stop, None]))
            q, r = np.nonzero(better & (own != self.ids[start:stop, None]))
            place = np.concatenate([place, q + start])
            scores = np.concatenate([scores, made[q, r]])
            found = np.concatenate([found, ids[rows][r]])
            place, scores, found = self._best(place, scores, found)
        return place, scores, found

    def _best(
        self, place: np.ndarray, scores: np.ndarray, found: np.ndarray
    ) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The k best candidates of each query; where there are k, the last of them is the query's new bound."""
        order = np.lexsort((found, ~scores, place))  # ~ turns the order and, unlike -, cannot overflow
        place, scores, found = place[order], scores[order], found[order]
        rank = np.arange(len(place)) - np.searchsorted(place, place)
        keep = rank < self.k
        place, scores, found, rank = place[keep], scores[keep], found[keep], rank[keep]
        last = rank == self.k - 1
        last[last] = scores[last] >= self.kth[place[last]]
        self.kth[place[last]], self.kth_id[place[last]] = scores[last], found[last]
        return place, scores, found

    def _keep_best(self) -> None:
        self.place, self.scores, self.found = self._best(self.place, self.scores, self.found)


def _by_length(table: pa.Table, *more: str) -> Iterator[tuple[int, tuple[np.ndarray, ...]]]:
    """(length, (ids, vectors, further columns)); vectors of different lengths have no score together."""
    if table.num_rows == 0:
        return
    columns = [table.column(name).to_numpy() for name in ("vec_id", *more)]
    lists = pa.concat_arrays(table.column("v").chunks)
    lengths = pa.compute.list_value_length(lists).to_numpy()
    flat = lists.flatten().to_numpy()
    ends = np.cumsum(lengths)
    for length in np.unique(lengths):
        here = np.flatnonzero(lengths == length)
        places = (ends[here] - length)[:, None] + np.arange(length)
        yield int(length), (columns[0][here], flat[places], *(c[here] for c in columns[1:]))


def _search_cell(k: int):
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def search(queries: pa.Table, rows: pa.Table) -> pa.Table:
        data, made = dict(_by_length(rows)), []
        for length, (ids, vectors, floor) in _by_length(queries, "floor"):
            if length in data:
                found = Search(ids, vectors, k, floor)
                found.add(*data[length])
                made.append(pa.table([found.ids[found.place], found.found, found.scores], schema=schema))
        return pa.concat_tables(made) if made else schema.empty_table()

    return search


def _seeds(rows: DataFrame, total: int, width: int) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Some rows, chosen by a hash of their id, by length: `_SEEDS` components at most."""
    wanted = max(1, _SEEDS // max(1, width))
    share = min(1.0, 0.5 * wanted / max(1, total))
    some = rows.where(F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(1 << 30)) < F.lit(int(share * (1 << 30))))
    return dict(_by_length(some.select("vec_id", "v").limit(wanted).toArrow()))


def _with_floor(shared, k: int):
    """For each query a score that its k-th best cannot be below: the k-th among some of the rows."""

    def floors(ids: np.ndarray, vectors: np.ndarray) -> np.ndarray:
        floor, length = np.full(len(ids), _LOWEST), vectors.shape[1]
        if length in shared.value and len(shared.value[length][0]) > k:
            other, data = (part.astype(np.float64) if part.ndim == 2 else part for part in shared.value[length])
            points = vectors.astype(np.float64)
            largest = float(np.abs(points).max(initial=0.0)) * float(np.abs(data).max(initial=0.0))
            if largest * max(1, length) < _EXACT:
                scores = (points @ data.T).astype(np.int64)
                scores[ids[:, None] == other[None, :]] = _LOWEST
                floor = np.partition(scores, len(other) - k, axis=1)[:, len(other) - k]
        return floor

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            floor = np.full(len(batch), _LOWEST)
            lengths = pa.compute.list_value_length(batch.column("v")).to_numpy()
            for length, (ids, vectors) in _by_length(table):
                floor[lengths == length] = floors(ids, vectors)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(floor)], [*batch.schema.names, "floor"])

    return rows


def integer_vectors(table: DataFrame, id_col: str, vector_col: str, scale: int) -> DataFrame:
    """(vec_id, v): floor(scale * x) of each component; rows without id, vector or finite components go."""
    vector = F.col(f"`{vector_col}`")
    odd = F.exists(
        vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == F.lit(float("inf")))
    )
    return (
        table.where(F.col(f"`{id_col}`").isNotNull() & vector.isNotNull() & ~odd)
        .select(
            F.col(f"`{id_col}`").cast("bigint").alias("vec_id"),
            F.transform(vector, lambda x: F.floor(F.lit(scale) * x.cast("double"))).alias("v"),
        )
    )


def top_k(
    table: DataFrame,
    k: int = 10,
    query_step: int = 100,
    scale: int = 1024,
    chunk: int = 1 << 13,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best rows for each row whose id is divisible by `query_step`.

    Candidates are the rows with another id and a vector of the same length; equal scores go to the
    smaller id.  Vectors that are null or hold null or non-finite components and rows without an id take
    no part; empty vectors score 0 with each other; an id that occurs twice is two candidates and, as a
    query, one whose rows compete for the same ranks; an empty table gives no rows; other columns are
    ignored.  Scaled components and scores beyond a long are set to the nearest long.

    A block holds about `chunk` queries or `_BLOCK` components of rows, dealt by place in the scan, so
    that no id or vector, however frequent, makes a block large.
    """
    rows = integer_vectors(table, id_col, vector_col, scale)
    queries = rows.where(F.col("vec_id") % query_step == 0)
    sizes = rows.agg(
        F.count_if(F.col("vec_id") % query_step == 0).alias("asked"),
        F.count("*").alias("total"),
        F.coalesce(F.max(F.size("v")), F.lit(0)).alias("width"),
    ).first()
    shared = table.sparkSession.sparkContext.broadcast(_seeds(rows, sizes["total"], sizes["width"]))
    query_blocks = max(1, -(-sizes["asked"] // chunk))
    row_blocks = max(1, -(-sizes["total"] * max(1, sizes["width"]) // _BLOCK))
    tasks = min(2 * query_blocks * row_blocks, 1 << 15)
    place = F.monotonically_increasing_id()
    asked = (
        queries.mapInArrow(_with_floor(shared, k), "vec_id bigint, v array<bigint>, floor bigint")
        .withColumn("block", F.pmod(place, F.lit(query_blocks)))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(row_blocks - 1))))
        .select((F.col("other") * query_blocks + F.col("block")).cast("bigint").alias("cell"), "vec_id", "v", "floor")
    )
    dealt = (
        rows.withColumn("block", F.pmod(place, F.lit(row_blocks)))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.lit(query_blocks - 1))))
        .select((F.col("block") * query_blocks + F.col("other")).cast("bigint").alias("cell"), "vec_id", "v")
    )
    found = (
        asked.repartition(tasks, "cell").groupBy("cell")
        .cogroup(dealt.repartition(tasks, "cell").groupBy("cell"))
        .applyInArrow(_search_cell(k), "query_id bigint, vec_id bigint, score bigint")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select(
        "query_id", "rank", "vec_id", "score"
    )
