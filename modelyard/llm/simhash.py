"""Near-duplicates by SimHash fingerprints, compared bit-sliced.

Fingerprints that differ in at most r of 64 bits agree on at least m - r of m blocks of bits.  For each
choice of m - r blocks, fingerprints meet those with the same bits there; the buckets are compared with
bit planes held vertically: one word holds one bit of 64 fingerprints, the number of differing bits of
64 pairs is counted at once with carry-save adders, and columns of a block are given up once all its
counts exceed r.  A bucket hands on a spanning forest of its links, not its pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import accumulate, combinations, groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from modelyard.llm.common import derive, documents, materialise
from modelyard.llm.components import components

SEED = 42
_TILE = 4096  # distinct fingerprints of a bucket that one task compares with each other
_ROWS = 512  # fingerprints whose distances to a tile are counted at once
_ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def shingle_hashes(text: str, words: int) -> list[int]:
    """XXH64 of each shingle; A-Z lower-cased, words split at ASCII white space, joined by one blank."""
    import xxhash

    found = text.encode().lower().split()
    if not found:
        return []
    joined, size = b" ".join(found), min(words, len(found))
    ends = list(accumulate(len(w) + 1 for w in found))
    starts = [0, *ends[: len(ends) - size]]
    digest = xxhash.xxh64_intdigest
    return [digest(joined[s : e - 1], SEED) for s, e in zip(starts, ends[size - 1 :])]


def fingerprint(hashes: list[int]) -> int:
    """Bits set in more than half of the hashes; zero if there are none."""
    if not hashes:
        return 0
    as_bytes = np.array(hashes, np.uint64).view(np.uint8).reshape(-1, 8)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(as_bytes), 1 << 16):
        ones += np.unpackbits(as_bytes[at : at + (1 << 16)], axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def _fingerprints(texts: DataFrame, words: int, keep: tuple[str, ...]) -> DataFrame:
    def start():
        return lambda batch: {
            "fp": np.array([fingerprint(shingle_hashes(t, words)) for t in batch], np.uint64).view(np.int64)
        }

    return derive(texts, start, "fp bigint", keep=keep)


def fingerprints(
    docs: DataFrame, words: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and fp (64 bits as a signed long) of every row; null, empty and blank texts have fp 0."""
    return _fingerprints(documents(docs, id_col, text_col), words, ("doc_id",))


def _planes(values: np.ndarray) -> np.ndarray:
    """Bit planes: row b holds bit b of all values, 64 of them to a word."""
    bits = np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    padded = np.zeros((64, -(-len(values) // 64) * 64), np.uint8)
    padded[:, : len(values)] = bits.T
    return np.packbits(padded, axis=1, bitorder="little").view(np.uint64)


def links(values: np.ndarray, planes: np.ndarray, radius: int, first: int = 0) -> np.ndarray:
    """Bit matrix: for each of `values`, which others of those in `planes` are within the radius (< 8).

    `values` are those in `planes` from position `first` on; none is compared with itself.  Three counter planes and one for overflow hold the distances; three bit planes enter at a time.
    """
    columns = np.arange(planes.shape[1])
    order = range(64)
    ones, twos, fours, over = (np.zeros((len(values), len(columns)), np.uint64) for _ in range(4))
    own = np.arange(first, first + len(values))
    over[np.arange(len(values)), own >> 6] = np.uint64(1) << (own & 63).astype(np.uint64)
    held = planes
    picked = [np.where((values >> np.uint64(b)) & np.uint64(1), _ALL, np.uint64(0))[:, None] for b in order]
    limit = radius + 1

    def exceeded() -> np.ndarray:
        reached = np.zeros_like(over)  # counts of at least `limit`, from the highest counter down
        equal = np.full_like(over, _ALL)
        for weight, plane in ((4, fours), (2, twos), (1, ones)):
            if limit & weight:
                equal &= plane
            else:
                reached |= equal & plane
        return over | reached | equal if limit < 8 else over

    for at in range(0, len(order), 3):
        three = [held[b] ^ q for b, q in zip(order[at : at + 3], picked[at : at + 3])]
        while len(three) < 3:
            three.append(np.zeros_like(over))
        x, y, z = three
        half = x ^ y
        low, high = half ^ z, (x & y) | (half & z)
        carry = ones & low
        ones = ones ^ low
        # two carries of weight two meet the counter of twos in a full adder
        half = carry ^ high
        carry, twos = (carry & high) | (half & twos), half ^ twos
        over |= fours & carry
        fours = fours ^ carry
        if at % 9 == 6:
            alive = (exceeded() != _ALL).any(axis=0)
            if not alive.any():
                return np.zeros((len(values), planes.shape[1]), np.uint64)
            if not alive.all():
                columns, held = columns[alive], held[:, alive]
                ones, twos, fours, over = (c[:, alive] for c in (ones, twos, fours, over))
    found = np.zeros((len(values), planes.shape[1]), np.uint64)
    found[:, columns] = ~exceeded()
    return found


def forest(values: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Edges of a spanning forest of the links between fingerprints, as positions."""
    n, planes = len(values), _planes(values)
    rows = [links(values[at : at + _ROWS], planes, radius, at) for at in range(0, n, _ROWS)]
    near = np.concatenate(rows)
    near[:, -1] &= _ALL >> np.uint64(-n % 64)
    lonely = ~near.any(axis=1)
    edges: list[tuple[int, int]] = []
    waiting = np.full(planes.shape[1], _ALL)
    for seed in np.flatnonzero(~lonely):
        if not (int(waiting[seed >> 6]) >> int(seed & 63)) & 1:
            continue
        stack = [int(seed)]
        waiting[seed >> 6] &= ~(np.uint64(1) << np.uint64(seed & 63))
        while stack:
            node = stack.pop()
            fresh = near[node] & waiting
            words = np.flatnonzero(fresh)
            if len(words) == 0:
                continue
            waiting &= ~fresh
            bits = np.unpackbits(fresh[words].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
            for w, b in zip(*np.nonzero(bits)):
                other = int(words[w]) * 64 + int(b)
                edges.append((node, other))
                stack.append(other)
    return edges


def _masks(radius: int, blocks: int) -> list[int]:
    """For each choice of blocks - radius blocks, the bits they cover."""
    edges = [round(i * 64 / blocks) for i in range(blocks + 1)]
    bits = [((1 << edges[i + 1]) - 1) ^ ((1 << edges[i]) - 1) for i in range(blocks)]
    return [sum(choice) for choice in combinations(bits, blocks - radius)]


def _bucket_forests(radius: int):
    """Forests of runs of rows with the same bucket.  Small buckets share one comparison: a link between
    members of two of them is a link all the same."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def members() -> Iterator[tuple]:
            for batch in batches:
                yield from zip(*(batch.column(c).to_pylist() for c in ("table", "key", "i", "j", "fp")))

        def linked(fps: list[int]) -> pa.RecordBatch:
            values = np.unique(np.array(fps, np.int64))
            pairs = np.array(forest(values.view(np.uint64), radius), np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_pydict({"a": values[pairs[:, 0]], "b": values[pairs[:, 1]]})

        waiting: list[int] = []
        for _, run in groupby(members(), key=itemgetter(0, 1, 2, 3)):
            waiting.extend(r[4] for r in run)
            if len(waiting) >= _ROWS:
                yield linked(waiting)
                waiting = []
        if waiting:
            yield linked(waiting)

    return rows


def near_links(distinct: DataFrame, radius: int = 4, blocks: int = 5, tile: int = _TILE) -> DataFrame:
    """(a, b): links between the distinct fingerprints in column fp, enough to connect whatever is linked.

    A bucket of more than `tile` fingerprints is dealt into parts; each pair of parts is a task's work.
    More `blocks` give smaller buckets and more copies of each fingerprint; 5 suits up to about 10^8.
    """
    if not radius < min(blocks, 8):
        raise ValueError("radius must be below 8 and below the number of blocks")
    masks = _masks(radius, blocks)
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    choices = F.array(
        *[F.struct(F.lit(i).alias("table"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed)]
    )
    keyed = distinct.select("fp", F.inline(choices))
    sizes = keyed.groupBy("table", "key").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / tile).cast("int")
    dealt = (
        keyed.join(sizes, ["table", "key"])
        .withColumn("parts", parts)
        .withColumn("part", F.pmod(F.xxhash64("fp"), F.col("parts")).cast("int"))
        .withColumn(
            "other",
            F.explode(
                F.when(F.col("parts") == 1, F.array(F.lit(0))).otherwise(
                    F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda j: j != F.col("part"))
                )
            ),
        )
        .select("table", "key", F.least("part", "other").alias("i"), F.greatest("part", "other").alias("j"), "fp")
    )
    bucket = ["table", "key", "i", "j"]
    return (
        dealt.repartition(*bucket)
        .sortWithinPartitions(*bucket)
        .mapInArrow(_bucket_forests(radius), "a bigint, b bigint")
        .distinct()
    )


def _rows(docs: DataFrame, words: int, id_col: str, text_col: str) -> DataFrame:
    """doc_id, a hash of the text and the fingerprint of every row."""
    texts = documents(docs, id_col, text_col).withColumn("check", F.xxhash64("text"))
    return materialise(_fingerprints(texts, words, ("doc_id", "check")), "fingerprints")


def _classes(rows: DataFrame, radius: int, blocks: int) -> DataFrame:
    """(fp, first): the smallest (no_id, doc_id, check) of all rows reachable from a fingerprint."""
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "check")
    firsts = materialise(rows.groupBy("fp").agg(F.min(order).alias("first")), "distinct-fingerprints")
    roots = components(near_links(firsts.select("fp"), radius, blocks))
    of_root = firsts.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn(
        "root", F.coalesce("root", "fp")
    )
    smallest = of_root.groupBy("root").agg(F.min("first").alias("smallest"))
    return of_root.select("fp", "root").join(smallest, "root").select("fp", F.col("smallest").alias("first"))


def near_duplicates(
    docs: DataFrame,
    words: int = 4,
    radius: int = 4,
    blocks: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id reachable over links).

    Every row has a result, repeated rows too; null, empty and blank texts share fingerprint zero.  A
    null id stays null and does not count for the smallest; an empty table gives no rows; further
    columns are ignored.
    """
    rows = _rows(docs, words, id_col, text_col)
    return rows.join(_classes(rows, radius, blocks), "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), F.col("first.doc_id").alias("component_id")
    )


def keep_one(
    docs: DataFrame,
    words: int = 4,
    radius: int = 4,
    blocks: int = 5,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The rows of `docs`, all columns, less those whose group already has a row with a smaller id.

    Of rows with equal ids the one with the smaller text hash stays, of repeated rows one; a row without
    id stays only if its whole group has none.
    """
    rows = _rows(docs, words, id_col, text_col)
    place = lambda c: F.coalesce(c, F.lit((1 << 63) - 1))
    firsts = _classes(rows, radius, blocks).select(
        place(F.col("first.doc_id")).alias("_place"), F.col("first.check").alias("_check")
    )
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    keyed = docs.withColumns({"_place": place(F.col(f"`{id_col}`").cast("bigint")), "_check": F.xxhash64(text)})
    again = Window.partitionBy("_place", "_check").orderBy(F.col(f"`{text_col}`").isNull())
    return (
        keyed.join(firsts.distinct(), ["_place", "_check"], "left_semi")
        .withColumn("_again", F.row_number().over(again))
        .where("_again = 1")
        .select(*[F.col(f"`{c}`") for c in docs.columns])
    )
