"""Packing of documents into token sequences: shortest pack first over the length histogram.

A document's ids are cut into full sequences and one rest.  The histogram of the piece lengths, which
has one entry for each length up to the sequence length, is packed on the driver: lengths longest
first, each into the packs that are shortest so far, whole groups of equal packs at once.  The result
is a list of patterns with counts.  A piece then finds its place by its rank among the pieces of its
length; ranks come from blocks of pieces and the sums of the blocks before.

Ids are made once; the number and the checksum of each piece's ids leave the task, the ids do not.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from modelyard.llm.byte_bpe import encoding, parts
from modelyard.llm.common import derive, documents, materialise

Pattern = tuple[int, tuple[int, ...]]  # how many packs, the lengths in each
_BLOCK_ROWS = 1 << 14


def pack_lengths(histogram: dict[int, int], capacity: int) -> list[Pattern]:
    """Patterns that hold every counted length once.

    `room` keeps the open patterns by the space left in them.  A length goes to the pattern with the
    most space, that is, the shortest pack; if none has enough, it opens packs of its own.
    """
    room: dict[int, list[list]] = defaultdict(list)
    spaces: list[int] = []  # keys of `room` in rising order
    done: list[Pattern] = []

    def put(count: int, lengths: tuple[int, ...], space: int) -> None:
        if space == 0:
            done.append((count, lengths))
            return
        if not room[space]:
            at = int(np.searchsorted(spaces, space))
            spaces.insert(at, space)
        room[space].append([count, lengths])

    for length in sorted(histogram, reverse=True):
        left = histogram[length]
        while left:
            if not spaces or spaces[-1] < length:
                put(left, (length,), capacity - length)
                break
            space = spaces[-1]
            pattern = room[space][-1]
            taken = min(left, pattern[0])
            pattern[0] -= taken
            if not pattern[0]:
                room[space].pop()
                if not room[space]:
                    spaces.pop()
            put(taken, (*pattern[1], length), space - length)
            left -= taken
    return done + [(count, lengths) for groups in room.values() for count, lengths in groups]


def slots(patterns: list[Pattern]) -> dict[int, tuple[np.ndarray, ...]]:
    """By length: first rank of each slot (rising), its pattern's first sequence id, its offset, ids in the pack.

    A slot is one place in a pattern; it takes as many pieces of its length as the pattern has packs.
    """
    taken: dict[int, int] = defaultdict(int)
    rows: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    first_sequence = 0
    for count, lengths in patterns:
        offset = 0
        for length in lengths:
            rows[length].append((taken[length], first_sequence, offset, sum(lengths)))
            taken[length] += count
            offset += length
        first_sequence += count
    return {k: tuple(np.array(c, np.int64) for c in zip(*v)) for k, v in rows.items()}


def _piece_maker(rank_file: str, pattern: str, special: dict[str, int], end_id: int, capacity: int):
    def start():
        bpe = encoding(rank_file, pattern, special)

        def work(texts: list[str]) -> dict[str, list]:
            made = {"pieces": []}
            for text in texts:
                made_ids = [
                    bpe._encode_single_piece(part) if whole else bpe.encode_to_numpy(part, allowed_special="all")
                    for part, whole in parts(text, special)
                ]
                ids = np.concatenate([*made_ids, np.array([end_id])]).astype("<u4")
                made["pieces"].append(
                    [
                        {
                            "start": at,
                            "length": len(ids[at : at + capacity]),
                            "ids_crc32": zlib.crc32(ids[at : at + capacity].tobytes()),
                            "doc_tokens": len(ids),
                        }
                        for at in range(0, len(ids), capacity)
                    ]
                )
            return made

        return work

    return start


def padded(length: int, capacity: int) -> int:
    """A sequence's length after padding: one whose length is a power of two stays as it is."""
    return capacity if length & (length - 1) else length


def _place(places, capacity: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = places.value
        for batch in batches:
            lengths = batch.column("length").to_numpy()
            ranks = batch.column("rank").to_numpy()
            sequence, offset, filled = (np.zeros(len(ranks), np.int64) for _ in range(3))
            for length in np.unique(lengths):
                here = lengths == length
                first, sequences, offsets, totals = table[int(length)]
                slot = np.searchsorted(first, ranks[here], side="right") - 1
                sequence[here] = sequences[slot] + ranks[here] - first[slot]
                offset[here] = offsets[slot]
                filled[here] = totals[slot]
            ends = np.array([padded(int(n), capacity) for n in filled], np.int64)
            kept = batch.drop_columns(["rank"])
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array(sequence), pa.array(offset), pa.array(ends)],
                [*kept.schema.names, "sequence_id", "offset", "padded_length"],
            )

    return rows


def pack(
    docs: DataFrame,
    rank_file: str,
    pattern: str,
    special: dict[str, int] | None = None,
    end_id: int = 1,
    capacity: int = 2048,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, padded_length.

    A document is its text's ids and `end_id`; a null or empty text is that one id.  Strings of
    `special` in a text become their ids.  Texts of any length are cut after tokenisation; repeated
    rows are documents of their own; an empty table has no pieces; further columns are ignored.
    `padded_length` is `capacity`, or the sequence's own length where that is a power of two.
    """
    spark = docs.sparkSession
    texts = documents(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())
    piece = "struct<start:bigint,length:bigint,ids_crc32:bigint,doc_tokens:bigint>"
    made = derive(
        texts,
        _piece_maker(rank_file, pattern, special or {}, end_id, capacity),
        f"pieces array<{piece}>",
        keep=("row", "doc_id"),
    )
    pieces = materialise(made.select("row", "doc_id", F.inline("pieces")), "pieces")

    counted = pieces.groupBy("length").agg(F.count("*").alias("n"))
    histogram = {r["length"]: r["n"] for r in counted.collect()}
    # No length is longer than the sequence, so the histogram, the patterns and their slots follow the
    # sequence length, not the documents.
    place = _place(spark.sparkContext.broadcast(slots(pack_lengths(histogram, capacity))), capacity)
    blocks = spark.createDataFrame(
        [(length, max(1, n // _BLOCK_ROWS)) for length, n in histogram.items()], "length bigint, blocks bigint"
    )
    salt = F.pmod(F.xxhash64("row", "start"), F.col("blocks"))
    cut = pieces.join(F.broadcast(blocks), "length").withColumn("block", F.struct("length", salt.alias("salt")))
    before = (
        cut.groupBy("block")
        .agg(F.count("*").alias("n"))
        .select(
            "block",
            (
                F.sum("n").over(Window.partitionBy("block.length").orderBy("block.salt")) - F.col("n")
            ).alias("before"),
        )
    )
    in_block = F.row_number().over(Window.partitionBy("block").orderBy("row", "start"))
    placed = (
        cut.withColumn("in_block", in_block)
        .join(before, "block")
        .select(
            "doc_id", "start", "length", "ids_crc32", "doc_tokens", (F.col("before") + F.col("in_block") - 1).alias("rank")
        )
    )
    longs = "doc_id start length ids_crc32 doc_tokens sequence_id offset padded_length".split()
    return placed.mapInArrow(place, ", ".join(f"{name} bigint" for name in longs))
