"""First arrivals of a log by keyed state, whatever the order and the overlap of its files.

Log positions are cut into blocks; the state of a block is a bit per position, and a count alone once
all have arrived.  So nothing depends on time or on a watermark, a block's state is bounded, and it
shrinks as the log becomes complete, where a state per row would grow with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

BLOCK_BITS = 12
_STATE = "n int, seen binary, latest bigint"
_SLICES = 1024


def _as_text(name: str, kind: T.DataType) -> Column:
    """A column as text that gives the very value back: NaN is not NULL, and no integer passes through a float."""
    column = F.col(f"`{name}`")
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(column)
    if not isinstance(kind, T.AtomicType):
        raise TypeError(f"{name}: {kind.simpleString()} columns have to be written as text first")
    return column.cast("string")


def _from_text(column: Column, kind: T.DataType) -> Column:
    if isinstance(kind, T.TimestampType):
        return F.timestamp_micros(column.cast("bigint"))
    if isinstance(kind, T.BinaryType):
        return F.unhex(column)
    return column.cast(kind)


def _one_per_batch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Leaves out repeats of a position within an Arrow batch, so that a hot position is combined before the shuffle."""
    for batch in batches:
        position = batch.column("_position")
        known = pc.is_valid(position).to_numpy(zero_copy_only=False)
        rows = np.flatnonzero(known)
        _, first = np.unique(position.take(pa.array(rows)).to_numpy(zero_copy_only=False), return_index=True)
        keep = ~known
        keep[rows[first]] = True
        yield batch.filter(pa.array(keep))


def first_arrivals(
    log: DataFrame, position: str = "log_seq", bits: int = BLOCK_BITS, ts: str | None = None, expiry: str | None = None
) -> DataFrame:
    """One row for every position of an integer column, the first to arrive; further ones are dropped.

    Of rows of one position in the same micro-batch any one is kept: a position names a row, so they
    are copies.  Rows without a position cannot be told apart and are all kept.

    Without `expiry` the state of every block stays.  With it (an interval such as "30 days", and `ts`, an
    instant) a block's state leaves by a timer once the watermark has passed its latest row; rows that come
    later than that delay are dropped, so no copy passes a second time.  Rows without an instant are kept.

    A block holds 2^bits positions, so no state and no group outgrows that, but for repeats that come
    in different Arrow batches.
    """
    if not 3 <= bits <= 20:
        raise ValueError("blocks of 2^3 to 2^20 positions")
    fields = log.schema.fields
    where = F.col(f"`{position}`").cast("bigint")
    if (ts is None) != (expiry is None):
        raise ValueError("an expiry needs a column of instants, and the other way round")
    instant = F.lit(None).cast("timestamp") if ts is None else F.col(f"`{ts}`")
    carried = log.select(
        where.alias("_position"), instant.alias("_ts"), *[_as_text(f.name, f.dataType).alias(f"_c{i}") for i, f in enumerate(fields)]
    )
    texts = [f"_c{i}" for i in range(len(fields))]
    # Rows without a position share no state, so they are dealt to slices.
    block = F.coalesce(F.shiftright("_position", bits), F.pmod(F.xxhash64(*texts), F.lit(_SLICES)))
    combined = carried.mapInArrow(_one_per_batch, carried.schema)
    if expiry is not None:
        combined = combined.withWatermark("_ts", expiry)
    combined = combined.withColumns({"_has": F.col("_position").isNotNull(), "_block": block, "_at": F.unix_millis("_ts")})
    if expiry is None:
        combined = combined.drop("_ts")
    size, expires = 1 << bits, expiry is not None

    def fresh(key: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        if state.hasTimedOut:
            state.remove()
            return
        if not key[0]:
            for frame in frames:
                yield frame[texts]
            return
        old = state.get if state.exists else (0, bytes(size // 8), None)
        n, packed, latest = old
        # A complete block has no bits left.
        seen = None if n == size else np.unpackbits(np.frombuffer(packed, np.uint8))
        for frame in frames:
            at = frame["_at"].max()
            if expires and not pd.isna(at):
                latest = int(at) if latest is None else max(latest, int(at))
            if seen is None:
                continue
            places = frame["_position"].to_numpy(np.int64) & (size - 1)
            places, first = np.unique(places, return_index=True)
            new = seen[places] == 0
            seen[places] = 1
            n += int(new.sum())
            if new.any():
                yield frame.iloc[np.sort(first[new])][texts]
        if (n, latest) != (old[0], old[2]):
            packed = b"" if n == size else np.packbits(seen).tobytes()
            state.update((n, packed, latest))
        if latest is not None:
            # A timer has to lie behind the watermark.
            state.setTimeoutTimestamp(max(latest, state.getCurrentWatermarkMs()) + 1)

    timeout = GroupStateTimeout.EventTimeTimeout if expires else GroupStateTimeout.NoTimeout
    kept = combined.groupBy("_has", "_block").applyInPandasWithState(
        fresh, ", ".join(f"{c} string" for c in texts), _STATE, "append", timeout
    )
    return kept.select(*[_from_text(F.col(c), f.dataType).alias(f.name) for c, f in zip(texts, fields)])
