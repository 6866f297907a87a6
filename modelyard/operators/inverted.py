"""Vector search through inverted files: an index kept as tables, approximate in which vectors are met.

An index holds several independent inverted files.  Each has its own coarse centres, fitted on a
bounded sample, and stores every vector in the list of its nearest centre; a query looks into the few
lists whose centres are nearest, in every file.  Many thinly probed files find more of the true
neighbours than one file probed as often, because a neighbour on the far side of one border is rarely
on the far side of all of them.  Found vectors are scored exactly.

Lists are laid out in cells of bounded size: a long list is cut into several, short ones share one.
Few queries travel to the vectors and only their lists are read; many queries meet the vectors cell by
cell, so that no list and no set of queries is ever whole in one task.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from modelyard.operators.blocks import top_k
from modelyard.sources.shared import scratch_path

FILES = 11
SHARE = 0.016
SAMPLE = 1 << 15
MAX_LISTS = 4096
CELL_ROWS = 4096
BROADCAST_BYTES = 32 << 20
_ROUNDS = 3
_FILTER_LISTS = 1024  # a longer IN list would read nearly everything anyway
_CELLS_AT_ONCE = 1 << 22
_DIGITS = 12  # equal vectors get equal similarities whatever rows they are multiplied with

_HITS = "query_id bigint, vec_id bigint, similarity double"


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return _unit(flat.reshape(-1, width).astype(np.float64))


def _nearest_lists(units: np.ndarray, centres: np.ndarray, probes: int) -> np.ndarray:
    """(rows, files * probes): numbers of the nearest lists of every file, nearest first."""
    files, lists, _ = centres.shape
    out = np.empty((len(units), files, probes), np.int32)
    step = max(1, _CELLS_AT_ONCE // lists)
    for at in range(0, len(units), step):
        for f in range(files):
            scores = np.round(units[at : at + step] @ centres[f].T, _DIGITS)
            if probes == 1:
                best = scores.argmax(axis=1)[:, None]
            else:
                best = np.argsort(-scores, axis=1, kind="stable")[:, :probes]
            out[at : at + step, f] = best + f * lists
    return out.reshape(len(units), files * probes)


def fitted_centres(sample: np.ndarray, lists: int, seed: int) -> np.ndarray:
    """Unit centres: sample rows moved by a few rounds to the mean direction of the rows nearest to them."""
    draw = np.random.default_rng(seed)
    centres = sample[np.sort(draw.choice(len(sample), lists, replace=False))]
    for _ in range(_ROUNDS):
        own = _nearest_lists(sample, centres[None], 1)[:, 0]
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        moved = _unit(sums)
        centres = np.where(np.linalg.norm(moved, axis=1, keepdims=True) > 0, moved, centres)
    return centres


def usable(df: DataFrame, vector: str, width: int) -> DataFrame:
    """Rows whose vector has `width` components, all of them finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return df.where(F.coalesce((F.size(vector) == width) & finite, F.lit(False)))


@dataclass(frozen=True)
class InvertedIndex:
    """An index at `path`: `vectors` (list, cell, vec_id, embedding, kept columns), `lists` (list, first_cell,
    n_cells, n) and `centres` (file, place, centre)."""

    spark: SparkSession
    path: str
    centres: np.ndarray

    @property
    def vectors(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/vectors")

    @property
    def lists(self) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/lists")

    @property
    def width(self) -> int:
        return self.centres.shape[2]

    def probes(self, share: float) -> int:
        return max(1, min(self.centres.shape[1], round(self.centres.shape[1] * share)))


def _fit(vectors: DataFrame, n: int, files: int, lists: int, sample: int, width: int, seed: int) -> np.ndarray:
    """Centres of every file, each fitted in a task of its own on the same bounded sample."""
    chosen = vectors.select("vec_id", "embedding")
    if n > sample:
        chosen = chosen.where(F.pmod(F.xxhash64("vec_id", F.lit(seed)), F.lit(1 << 30)) < int(sample / n * (1 << 30)))
    seen = chosen.orderBy("vec_id").toArrow()
    rows = _matrix(seen["embedding"].combine_chunks(), width)
    lists = min(lists, len(rows))
    shared = vectors.sparkSession.sparkContext.broadcast(rows)

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for f in batch.column("id").to_pylist():
                found = fitted_centres(shared.value, lists, seed + f)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(lists, f)), pa.array(np.arange(lists)), pa.array(list(found), pa.list_(pa.float64()))],
                    ["file", "place", "centre"],
                )

    numbers = vectors.sparkSession.range(0, files, 1, files)
    fitted = numbers.mapInArrow(fit, "file bigint, place bigint, centre array<double>").orderBy("file", "place").toArrow()
    return _matrix(fitted["centre"].combine_chunks(), width).reshape(files, lists, width)


def laid_out(counts: Sequence[tuple[int, int]], cell_rows: int) -> list[tuple[int, int, int, int]]:
    """(list, first_cell, n_cells, n): long lists get cells of their own, short neighbours share one."""
    out, cell, room = [], -1, 0
    for number, n in counts:
        if n > cell_rows:
            own = -(-n // cell_rows)
            out.append((number, cell + 1, own, n))
            cell, room = cell + own, 0
            continue
        if n > room:
            cell, room = cell + 1, cell_rows
        room -= n
        out.append((number, cell, 1, n))
    return out


def build(
    vectors: DataFrame,
    path: str,
    keep: Sequence[str] = (),
    files: int = FILES,
    lists: int | None = None,
    sample: int = SAMPLE,
    cell_rows: int = CELL_ROWS,
    seed: int = 1,
) -> InvertedIndex:
    """Write an index of all rows of `vectors` (vec_id, embedding, `keep`) to a new folder at `path`.

    Centres are fitted on about `sample` rows, chosen by a hash of the id; every row with a usable
    vector of the most frequent width is stored.  `lists` of a file defaults to six times the root of
    the number of rows, at most a quarter of the sample and `MAX_LISTS`.  `keep` columns can be
    filtered on.  Every row is written once for each file.
    """
    spark = vectors.sparkSession
    table = vectors.select("vec_id", "embedding", *keep)
    width = table.agg(F.mode(F.size("embedding")).alias("w")).first()["w"]
    if not width or width < 1:
        raise ValueError("no vectors to index")
    table = usable(table, "embedding", width)
    n = table.count()
    if n == 0:
        raise ValueError("no vectors to index")
    if lists is None:
        lists = int(6 * n**0.5)
    lists = max(1, min(lists, MAX_LISTS, -(-min(n, sample) // 4)))
    centres = _fit(table, n, files, lists, sample, width, seed)
    spark.createDataFrame(
        [(f, p, c) for f, rows in enumerate(centres.tolist()) for p, c in enumerate(rows)],
        "file int, place int, centre array<double>",
    ).write.parquet(f"{path}/centres")

    shared, names = spark.sparkContext.broadcast(centres), table.columns
    schema = table.schema.simpleString().removeprefix("struct<").removesuffix(">") + ",lists:array<int>"

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = _nearest_lists(_matrix(batch.column("embedding"), width), shared.value, 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(list(own), pa.list_(pa.int32()))], [*names, "lists"]
            )

    assigned_path = scratch_path(spark, "assigned")
    table.mapInArrow(assign, f"struct<{schema}>").write.parquet(assigned_path)
    assigned = spark.read.parquet(assigned_path)
    placed = assigned.withColumn("list", F.explode("lists")).drop("lists")
    # At most files * MAX_LISTS rows.
    counts = [tuple(r) for r in assigned.select(F.explode("lists").alias("list")).groupBy("list").count().orderBy("list").collect()]
    cells = spark.createDataFrame(laid_out(counts, cell_rows), "list int, first_cell int, n_cells int, n bigint")
    cells.coalesce(1).write.parquet(f"{path}/lists")
    cell = F.col("first_cell") + F.pmod(F.xxhash64("vec_id"), F.col("n_cells"))
    (
        placed.join(F.broadcast(cells.drop("n")), "list")
        .select("list", cell.cast("int").alias("cell"), *names)
        .repartitionByRange("cell")
        .sortWithinPartitions("cell", "list")
        .write.parquet(f"{path}/vectors")
    )
    return InvertedIndex(spark, path, centres)


def load(spark: SparkSession, path: str) -> InvertedIndex:
    """The index another job has built."""
    stored = spark.read.parquet(f"{path}/centres").orderBy("file", "place").toArrow()
    width = len(stored["centre"][0])
    centres = _matrix(stored["centre"].combine_chunks(), width)
    files = stored["file"][-1].as_py() + 1
    return InvertedIndex(spark, path, centres.reshape(files, -1, width))


def probed(index: InvertedIndex, queries: DataFrame, share: float = SHARE) -> DataFrame:
    """(query_id, embedding, lists): the lists every query with a usable vector looks into."""
    probes, width = index.probes(share), index.width
    shared = index.spark.sparkContext.broadcast(index.centres)

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = _matrix(batch.column("embedding"), width)
            chosen = _nearest_lists(units, shared.value, probes)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("query_id"),
                    pa.array(list(units), pa.list_(pa.float64())),
                    pa.array(list(chosen), pa.list_(pa.int32())),
                ],
                ["query_id", "embedding", "lists"],
            )

    rows = usable(queries.select(F.col("query_id").cast("bigint"), F.col("embedding").cast("array<double>")), "embedding", width)
    return rows.mapInArrow(look, "query_id bigint, embedding array<double>, lists array<int>")


def pairs_compared(index: InvertedIndex, queries: DataFrame, share: float = SHARE) -> DataFrame:
    """One row (compared, pairs): query and vector pairs scored, a pair met in two files twice, and all pairs."""
    asked = probed(index, queries, share).select(F.explode("lists").alias("list"))
    met = asked.join(F.broadcast(index.lists), "list").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("compared"))
    stored = index.lists.agg((F.sum("n") / index.centres.shape[0]).cast("bigint")).scalar()
    return met.select("compared", (queries.agg(F.count(F.lit(1))).scalar() * stored).alias("pairs"))


def _kept(query: np.ndarray, vec: np.ndarray, score: np.ndarray, k: int) -> tuple[np.ndarray, ...]:
    """The k best hits of every query, each pair once."""
    order = np.lexsort((vec, -score, query))
    query, vec, score = query[order], vec[order], score[order]
    fresh = np.append(True, (query[1:] != query[:-1]) | (vec[1:] != vec[:-1]))[: len(query)]
    query, vec, score = query[fresh], vec[fresh], score[fresh]
    first = np.searchsorted(query, query)
    best = np.arange(len(query)) - first < k
    return query[best], vec[best], score[best]


def _meet(
    q_list: np.ndarray, q_id: np.ndarray, q: np.ndarray, v_list: np.ndarray, v_id: np.ndarray, v: np.ndarray, k: int
) -> tuple[np.ndarray, ...]:
    """Best hits among the pairs of one list; the query side is in order of lists."""
    found = [(np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0))]
    order = np.argsort(v_list, kind="stable")
    v_list, v_id, v = v_list[order], v_id[order], v[order]
    numbers, starts = np.unique(v_list, return_index=True)
    ends = np.append(starts[1:], len(v_list))
    q_from, q_to = np.searchsorted(q_list, numbers), np.searchsorted(q_list, numbers, side="right")
    for s, e, a, b in zip(starts.tolist(), ends.tolist(), q_from.tolist(), q_to.tolist()):
        step = max(1, _CELLS_AT_ONCE // (e - s))
        for low in range(a, b, step):
            high = min(low + step, b)
            scores = np.round(q[low:high] @ v[s:e].T, _DIGITS)
            hits = np.repeat(q_id[low:high], e - s), np.tile(v_id[s:e], high - low), scores.ravel()
            if e - s > 4 * k:
                hits = _kept(*hits, k)
            found.append(hits)
    return _kept(*(np.concatenate(c) for c in zip(*found)), k)


def _batch(hits: tuple[np.ndarray, ...]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c) for c in hits], ["query_id", "vec_id", "similarity"])


def _by_list(lists: pa.ListArray, *of_row: np.ndarray) -> tuple[np.ndarray, ...]:
    """List numbers of all rows in order, and the given values of the row each of them comes from."""
    flat, row = lists.flatten().to_numpy(), np.repeat(np.arange(len(lists)), np.diff(lists.offsets.to_numpy()))
    order = np.argsort(flat, kind="stable")
    return (flat[order], *(values[row[order]] for values in of_row))


def _send_queries(vectors: DataFrame, asked: DataFrame, k: int, width: int) -> DataFrame:
    """Few queries: they travel to all tasks, and only their lists are read."""
    local = asked.toArrow().combine_chunks()
    rows = np.arange(local.num_rows)
    q_list, row = _by_list(local["lists"].combine_chunks(), rows) if len(rows) else (rows, rows)
    shared = vectors.sparkSession.sparkContext.broadcast(
        (q_list, row, local["query_id"].to_numpy(), _matrix(local["embedding"].combine_chunks(), width))
    )
    wanted = np.unique(q_list).tolist()
    if len(wanted) <= _FILTER_LISTS:
        vectors = vectors.where(F.col("list").isin(wanted))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q_list, row, q_id, q = shared.value
        held = None
        for batch in batches:
            lists = batch.column("list").to_numpy()
            use = np.isin(q_list, lists)
            hits = _meet(
                q_list[use], q_id[row[use]], q[row[use]], lists, batch.column("vec_id").to_numpy(),
                _matrix(batch.column("embedding"), width), k,
            )
            held = hits if held is None else _kept(*(np.concatenate(c) for c in zip(held, hits)), k)
        if held is not None:
            yield _batch(held)

    return vectors.select("list", "vec_id", "embedding").mapInArrow(search, _HITS)


def _cells_of(index: InvertedIndex, asked: DataFrame) -> DataFrame:
    """(cell, query_id, embedding, lists): a query once for each cell that holds one of its lists."""
    layout = index.lists.orderBy("list").toPandas()  # at most files * MAX_LISTS rows
    most = int(layout["list"].max()) + 1
    first, n_cells = np.zeros(most, np.int64), np.zeros(most, np.int64)  # a list nobody is in has no cell
    first[layout["list"]], n_cells[layout["list"]] = layout["first_cell"], layout["n_cells"]
    shared = index.spark.sparkContext.broadcast((first, n_cells))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first, n_cells = shared.value
        for batch in batches:
            column = batch.column("lists")
            lists = column.flatten().to_numpy()
            row = np.repeat(np.arange(batch.num_rows), np.diff(column.offsets.to_numpy()))
            held = lists < len(first)
            lists, row = lists[held], row[held]
            times = n_cells[lists]
            ahead = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            cell, row, lists = np.repeat(first[lists], times) + ahead, np.repeat(row, times), np.repeat(lists, times)
            order = np.lexsort((cell, row))
            cell, row, lists = cell[order], row[order], lists[order]
            starts = np.flatnonzero(np.append(True, (cell[1:] != cell[:-1]) | (row[1:] != row[:-1]))[: len(cell)])
            taken = pa.array(row[starts])
            grouped = pa.ListArray.from_arrays(pa.array(np.append(starts, len(cell)), pa.int32()), pa.array(lists, pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell[starts], pa.int32()), batch.column("query_id").take(taken), batch.column("embedding").take(taken), grouped],
                ["cell", "query_id", "embedding", "lists"],
            )

    return asked.mapInArrow(spread, "cell int, query_id bigint, embedding array<double>, lists array<int>")


def _by_cell(index: InvertedIndex, vectors: DataFrame, asked: DataFrame, k: int, slice_rows: int) -> DataFrame:
    """Many queries: every cell meets the queries of its lists, a bounded slice of them at a time."""
    width, spread = index.width, _cells_of(index, asked)
    # One row for each cell: the number of cells follows the number of vectors, so it is not sent along.
    slices = spread.groupBy("cell").agg(F.ceil(F.count(F.lit(1)) / slice_rows).cast("int").alias("slices"))
    q_side = spread.join(slices, "cell").select(
        "cell", F.pmod(F.xxhash64("query_id"), F.col("slices")).cast("int").alias("slice"), "query_id", "embedding", "lists"
    )
    copies = F.explode(F.sequence(F.lit(0), F.col("slices") - 1))
    v_side = vectors.join(slices, "cell").select("cell", copies.alias("slice"), "list", "vec_id", "embedding")

    def meet(left: pa.Table, right: pa.Table) -> pa.Table:
        if not left.num_rows or not right.num_rows:
            return pa.Table.from_batches([_batch((np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0)))])
        q = _matrix(right["embedding"].combine_chunks(), width)
        v = _matrix(left["embedding"].combine_chunks(), width)
        q_list, q_id, row = _by_list(right["lists"].combine_chunks(), right["query_id"].to_numpy(), np.arange(len(q)))
        hits = _meet(q_list, q_id, q[row], left["list"].to_numpy(), left["vec_id"].to_numpy(), v, k)
        return pa.Table.from_batches([_batch(hits)])

    return v_side.groupBy("cell", "slice").cogroup(q_side.groupBy("cell", "slice")).applyInArrow(meet, _HITS)


def search(
    index: InvertedIndex,
    queries: DataFrame,
    k: int,
    where: Column | str | None = None,
    share: float = SHARE,
    broadcast_bytes: int = BROADCAST_BYTES,
    slice_rows: int = CELL_ROWS,
) -> DataFrame:
    """k nearest of the vectors met, by exact cosine similarity: (query_id, rank, vec_id, similarity).

    `queries` has (query_id, embedding), query ids differ.  `where` is a condition on the kept columns; it
    and, for few queries, the lists reach the scan.  `share` is the part of every file's lists that a
    query looks into: 1 meets everything.  Queries without a usable vector get no hits.
    """
    if k < 1:
        raise ValueError("k must be positive")
    vectors = index.vectors
    if where is not None:
        vectors = vectors.where(where)
    asked = probed(index, queries, share)
    n = queries.count()
    if n * (index.width + index.centres.shape[0] * index.probes(share)) * 8 <= broadcast_bytes:
        hits = _send_queries(vectors, asked, k, index.width)
    else:
        hits = _by_cell(index, vectors, asked, k, slice_rows)
    # A pair met in several files counts once.
    pairs = hits.groupBy("query_id", "vec_id").agg(F.max("similarity").alias("similarity"))
    best = top_k(pairs, ["query_id"], [F.desc("similarity"), F.asc("vec_id")], k, spread=F.col("vec_id"))
    return best.select("query_id", "rank", "vec_id", "similarity")


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row (wanted, hits, recall): how many of the exact neighbours were found."""
    hit = F.col("_hit").isNotNull()
    met = found.select("query_id", "vec_id", F.lit(1).alias("_hit"))
    return (
        exact.join(met, ["query_id", "vec_id"], "left")
        .agg(F.count(F.lit(1)).alias("wanted"), F.count_if(hit).alias("hits"))
        .withColumn("recall", F.try_divide("hits", "wanted"))
    )


def retrieve(
    index: InvertedIndex,
    calls: DataFrame,
    k: int,
    where: Column | str | None = None,
    columns: Sequence[str] = ("vec_id",),
    **options,
) -> DataFrame:
    """Answers of a retrieval tool for a table of calls (query_id, embedding): (query_id, result).

    `result` is a JSON array of the hits in order, with rank, similarity and `columns`, which are the id or
    kept columns; a call without hits gets an empty array.
    """
    found = search(index, calls, k, where, **options)
    extra = [c for c in columns if c != "vec_id"]
    if extra:
        per_file = index.centres.shape[1]
        stored = index.vectors.where(F.col("list") < per_file).select("vec_id", *extra)  # each vector once
        found = found.join(stored, "vec_id")
    hit = F.struct("rank", "similarity", *columns)
    answers = found.groupBy("query_id").agg(F.to_json(F.array_sort(F.collect_list(hit))).alias("result"))
    asked = calls.select(F.col("query_id").cast("bigint"))
    return asked.join(answers, "query_id", "left").withColumn("result", F.coalesce("result", F.lit("[]")))
