"""Removal of long byte strings that occur more than once, by a logarithmic family of suffix arrays.

Suffix arrays are sparse.  In every window of `length` bytes the smallest hash of its `head` bytes long
substrings is chosen, so equal windows choose equal heads wherever they stand; only suffixes that begin
with a chosen head are kept, sorted by (the hash of) that head.  The corpus arrives in batches.  A new
batch's array is merge-scanned against each existing level: heads on both sides, or twice on one, mark
long matches.  Then it becomes a level itself; two levels of equal size merge into one of double size.

An exact check follows: all windows that chose a repeated head are compared.  They travel as segments,
runs of window starts with the same choice.  Equal segments are counted first (map-side, so thousands
of copies leave one row); only one of each kind is fetched, and only where its head has several kinds.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from modelyard.llm.common import materialise

LENGTH = 200
HEAD = 64
_CHUNK = 1 << 20  # bytes worked on at once
_RUN = 256  # window starts of a segment
_KINDS = 1 << 13  # kinds of segments of one head that one task compares; beyond, windows are counted
_BASES = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93))
_KEYS = ["head", "segment"]


def _powers(base: np.uint64, size: int) -> np.ndarray:
    out = np.full(size, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


class Hasher:
    """Hashes of substrings of a byte array, all of one length or each of its own."""

    def __init__(self, size: int):
        self._tables = [(_powers(b, size + 1), _powers(np.uint64(pow(int(b), -1, 1 << 64)), size + 1)) for b in _BASES]

    def sums(self, data: np.ndarray, which: int) -> np.ndarray:
        powers, _ = self._tables[which]
        out = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers[: len(data)], out=out[1:])
        return out

    def of(self, sums: np.ndarray, which: int, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return _mixed((sums[ends] - sums[starts]) * self._tables[which][1][starts])

    def windows(self, sums: np.ndarray, which: int, size: int) -> np.ndarray:
        n = len(sums) - size
        return _mixed((sums[size:] - sums[:-size]) * self._tables[which][1][:n])


def _sliding(values: np.ndarray, width: int, pick) -> np.ndarray:
    """pick (minimum or maximum) over each `width` neighbours."""
    out, done = values, 1
    while 2 * done <= width:
        out = pick(out[:-done], out[done:])
        done *= 2
    return pick(out[: len(values) - width + 1], out[width - done :]) if done < width else out


def segments(hasher: Hasher, data: np.ndarray, starts: np.ndarray, sizes: np.ndarray, length: int, head: int):
    """Segments of adjoining texts: text number, first window start in it, window starts, head, segment
    hash, and whether a window may occur twice inside."""
    width = length - head + 1
    heads = hasher.windows(hasher.sums(data, 0), 0, head)
    chosen = _sliding(heads, width, np.minimum)
    counts = sizes - length + 1
    text = np.repeat(np.arange(len(starts)), counts)
    at = np.repeat(starts - np.cumsum(counts) + counts, counts) + np.arange(counts.sum())
    value = chosen[at]
    first = np.flatnonzero(np.append(True, (value[1:] != value[:-1]) | (text[1:] != text[:-1])))
    runs = np.diff(np.append(first, len(value)))
    parts = -(-runs // _RUN)  # long runs, of periodic texts, in parts
    step = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
    first = np.repeat(first, parts) + step * _RUN
    runs = np.diff(np.append(first, len(value)))
    begin, of_text, of_head = at[first], text[first], value[first]

    # The same head twice within a segment: neighbouring chosen places with equal heads.
    places = np.flatnonzero(
        heads == _sliding(np.concatenate([np.zeros(width - 1, np.uint64), chosen, np.zeros(width - 1, np.uint64)]), width, np.maximum)
    )
    twice = np.flatnonzero((heads[places[1:]] == heads[places[:-1]]) & (np.diff(places) <= width))
    inner = np.zeros(len(first), bool)
    if len(twice):
        p, q = places[twice], places[twice + 1]
        low = np.searchsorted(begin, np.minimum(q - width + 1, p), side="right") - 1
        high = np.searchsorted(begin, p, side="right")
        low = np.maximum(low, 0)
        many = np.maximum(high - low, 0)
        touched = np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        same = of_head[touched] == np.repeat(heads[p], many)
        inner[touched[same]] = True
    inner |= runs >= _RUN

    sums = hasher.sums(data, 1)
    whole = hasher.of(sums, 1, begin, begin + runs + length - 1)
    return of_text, begin - starts[of_text], runs, of_head, whole, inner


def _pieces(texts: list[bytes], length: int) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of (text number, place in it, bytes); long texts in overlapping parts that share no window."""
    group, size = [], 0
    for number, text in enumerate(texts):
        for place in range(0, len(text) - length + 1, _CHUNK):
            part = text[place : place + _CHUNK + length - 1]
            if group and size + len(part) > _CHUNK + length:
                yield group
                group, size = [], 0
            group.append((number, place, part))
            size += len(part)
    if group:
        yield group


def _signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def _find_segments(length: int, head: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = Hasher(_CHUNK + 2 * length)
        for batch in batches:
            key, check = (batch.column(c).to_numpy() for c in ("key", "check"))
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            for group in _pieces(texts, length):
                number, place = (np.array([g[i] for g in group], np.int64) for i in (0, 1))
                sizes = np.array([len(g[2]) for g in group], np.int64)
                data = np.frombuffer(b"".join(g[2] for g in group), np.uint8)
                of_text, begin, runs, of_head, whole, inner = segments(
                    hasher, data, np.cumsum(sizes) - sizes, sizes, length, head
                )
                yield pa.RecordBatch.from_pydict(
                    {
                        "key": key[number[of_text]],
                        "check": check[number[of_text]],
                        "start": begin + place[of_text],
                        "windows": runs.astype(np.int32),
                        "head": _signed(of_head),
                        "segment": _signed(whole),
                        "inner": inner,
                    }
                )

    return rows


class SuffixLevels:
    """The index family: levels of distinct heads with their counts, each a table sorted by head."""

    def __init__(self) -> None:
        self._levels: list[tuple[int, DataFrame]] = []

    def add(self, heads: DataFrame, last: bool = False) -> list[DataFrame]:
        """Takes the suffix array of a batch (head, n); gives the heads with long matches in it or
        between it and a level.  After the `last` batch nothing is merged any more."""
        array = materialise(heads.sortWithinPartitions("head"), "suffixes")
        found = [array.where("n > 1").select("head")]
        found += [array.join(level, "head").select("head") for _, level in self._levels]
        if not last:
            rank = 0
            while self._levels and self._levels[-1][0] == rank:
                _, level = self._levels.pop()
                both = array.union(level).groupBy("head").agg(F.sum("n").alias("n"))
                array, rank = materialise(both.sortWithinPartitions("head"), "suffixes"), rank + 1
            self._levels.append((rank, array))
        return found


def _repeated_windows(length: int):
    """Of segments sorted by head: the ranges of windows that occur twice among those of a head."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        size = 0
        for batch in batches:
            for row in batch.to_pylist():
                if size > _CHUNK and row["head"] != held[-1]["head"]:
                    yield judged(held)
                    held, size = [], 0
                held.append(row)
                size += len(row["data"])
        if held:
            yield judged(held)

    def judged(held: list[dict]) -> pa.RecordBatch:
        hashes, of_row, places = window_hashes([r["data"] for r in held], length)
        _, which, seen = np.unique(hashes, return_inverse=True, return_counts=True)
        weight = np.array([r["n"] for r in held], np.int64)[of_row]
        times = np.bincount(which, weight, len(seen))[which]
        made = {"head": [], "segment": [], "ranges": []}
        hit = np.flatnonzero(times > 1)
        if len(hit):
            breaks = np.flatnonzero((np.diff(places[hit]) != 1) | (np.diff(of_row[hit]) != 0)) + 1
            lows = np.append(0, breaks)
            highs = np.append(breaks, len(hit)) - 1
            ranges: dict[int, list] = {}
            for low, high in zip(hit[lows], hit[highs]):
                ranges.setdefault(int(of_row[low]), []).append({"low": int(places[low]), "high": int(places[high])})
            for number, own in ranges.items():
                made["head"].append(held[number]["head"])
                made["segment"].append(held[number]["segment"])
                made["ranges"].append(own)
        kind = pa.list_(pa.struct([("low", pa.int64()), ("high", pa.int64())]))
        return pa.RecordBatch.from_arrays(
            [pa.array(made["head"], pa.int64()), pa.array(made["segment"], pa.int64()), pa.array(made["ranges"], kind)],
            ["head", "segment", "ranges"],
        )

    return rows


def window_hashes(texts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, text number and place of every window of `length` bytes."""
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    counts = np.maximum(sizes - length + 1, 0)
    of_row = np.repeat(np.arange(len(texts)), counts)
    places = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = np.repeat(np.cumsum(sizes) - sizes, counts) + places
    if not len(at):
        return np.empty(0, np.uint64), of_row, places
    hasher = Hasher(len(data))
    one, two = (hasher.windows(hasher.sums(data, i), i, length)[at] for i in (0, 1))
    return one ^ (two << np.uint64(1)), of_row, places


def _single_windows(length: int):
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, of_row, places = window_hashes(batch.column("data").to_pylist(), length)
            picked = batch.select(["head", "segment", "n"]).take(pa.array(of_row))
            yield pa.RecordBatch.from_arrays(
                [*picked.columns, _signed(hashes), pa.array(places)], ["head", "segment", "n", "window", "place"]
            )

    return rows


def _cut(length: int, as_text: bool):
    """What is kept of each row, and counts, from its text and the ranges of repeated windows."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, removed, spans, total = [], [], [], []
            for text, ranges in zip(batch.column("text").to_pylist(), batch.column("ranges").to_pylist()):
                data = text.encode()
                total.append(len(data))
                out, done, cut, number = [], 0, 0, 0
                for r in sorted(ranges or (), key=lambda r: r["low"]):
                    end = r["high"] + length
                    if r["low"] > done or not number:
                        out.append(data[done : r["low"]])
                        number += 1
                        cut += end - r["low"]
                        done = end
                    elif end > done:
                        cut += end - done
                        done = end
                out.append(data[done:])
                rest = b"".join(out)
                kept.append(rest.decode("utf-8", "ignore") if as_text else rest)
                removed.append(cut)
                spans.append(number)
            others = batch.drop_columns(["text", "ranges"])
            new = {
                "n_bytes": pa.array(total, pa.int64()),
                "n_removed": pa.array(removed, pa.int64()),
                "n_spans": pa.array(spans, pa.int64()),
                "kept": pa.array(kept, pa.string() if as_text else pa.binary()),
            }
            yield pa.RecordBatch.from_arrays([*others.columns, *new.values()], [*others.schema.names, *new])

    return rows


def repeated_ranges(
    keyed: DataFrame, length: int = LENGTH, head: int = HEAD, batches: int = 4, kinds: int = _KINDS
) -> DataFrame:
    """(key, check, ranges): window starts (low to high) of each text whose `length` bytes start elsewhere too.

    `keyed` has (key, check, text), texts not null; equal keys mean equal texts.
    """
    found = keyed.mapInArrow(
        _find_segments(length, head),
        "key bigint, check bigint, start bigint, windows int, head bigint, segment bigint, inner boolean",
    )
    every = materialise(found.withColumn("batch", F.pmod("key", F.lit(batches)).cast("int")), "segments")
    levels, matches = SuffixLevels(), [every.where("inner").select("head")]
    for number in range(batches):
        array = every.where(F.col("batch") == number).groupBy("head").agg(F.count("*").alias("n"))
        matches += levels.add(array, last=number == batches - 1)
    repeated = matches[0]
    for more in matches[1:]:
        repeated = repeated.union(more)
    candidates = materialise(every.drop("batch").join(repeated.distinct(), "head", "left_semi"), "candidates")

    sorts = candidates.groupBy(*_KEYS).agg(
        F.count("*").alias("n"),
        F.min(F.struct("key", "check", "start", "windows")).alias("one"),
        F.max("inner").alias("inner"),
    )
    sorts = materialise(sorts, "kinds")
    several = sorts.groupBy("head").agg(F.count("*").alias("m"), F.max("inner").alias("any_inner"))
    several = several.where((F.col("m") > 1) | F.col("any_inner")).select("head", "m")
    asked = (
        sorts.join(several, "head")
        .select("one.key", "one.check", F.struct("head", "segment", "n", "m", "one.start", "one.windows").alias("ask"))
        .groupBy("key", "check")
        .agg(F.collect_list("ask").alias("asks"))
    )
    fetched = materialise(
        keyed.join(asked, ["key", "check"]).mapInArrow(
            _fetch(length), "head bigint, segment bigint, n bigint, m bigint, data binary"
        ),
        "fetched",
    )
    small = (
        fetched.where(F.col("m") <= kinds)
        .repartition("head")
        .sortWithinPartitions("head")
        .mapInArrow(
            _repeated_windows(length), "head bigint, segment bigint, ranges array<struct<low:bigint,high:bigint>>"
        )
    )
    single = fetched.where(F.col("m") > kinds).mapInArrow(
        _single_windows(length), "head bigint, segment bigint, n bigint, window bigint, place bigint"
    )
    often = single.groupBy("window").agg(F.sum("n").alias("times")).where("times > 1").select("window")
    large = (
        single.join(often, "window", "left_semi")
        .groupBy(*_KEYS)
        .agg(F.collect_set(F.struct(F.col("place").alias("low"), F.col("place").alias("high"))).alias("ranges"))
    )
    copies = sorts.where("n > 1").select(
        *_KEYS,
        F.array(F.struct(F.lit(0).cast("bigint").alias("low"), (F.col("one.windows") - 1).cast("bigint").alias("high"))).alias(
            "ranges"
        ),
    )
    marked = copies.union(small.union(large).join(copies.select(*_KEYS), _KEYS, "left_anti"))
    shifted = F.transform(
        "ranges", lambda r: F.struct((r["low"] + F.col("start")).alias("low"), (r["high"] + F.col("start")).alias("high"))
    )
    # Copies of a text leave one row for each of its segments.
    return (
        candidates.select("key", "check", "start", *_KEYS)
        .distinct()
        .join(marked, _KEYS)
        .select("key", "check", shifted.alias("ranges"))
        .groupBy("key", "check")
        .agg(F.flatten(F.collect_list("ranges")).alias("ranges"))
    )


def _fetch(length: int):
    """Bytes of the asked segments; of the copies of a text that a task sees, only the first is cut up."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = set()
        for batch in batches:
            made: dict[str, list] = {"head": [], "segment": [], "n": [], "m": [], "data": []}
            for key, text, asks in zip(*(batch.column(c) for c in ("key", "text", "asks"))):
                if (key := key.as_py()) in seen:
                    continue
                seen.add(key)
                data = text.as_py().encode()
                for ask in asks.as_py():
                    for name in ("head", "segment", "n", "m"):
                        made[name].append(ask[name])
                    made["data"].append(data[ask["start"] : ask["start"] + ask["windows"] + length - 1])
            longs = [pa.array(made[name], pa.int64()) for name in ("head", "segment", "n", "m")]
            yield pa.RecordBatch.from_arrays([*longs, pa.array(made["data"], pa.binary())], list(made))

    return rows


def _key(text: Column) -> dict[str, Column]:
    """Two independent 64-bit hashes of a text; they stand for it in joins."""
    return {"key": F.xxhash64(text, F.lit(1)), "check": F.xxhash64(text)}


def remove_repeats(
    docs: DataFrame,
    length: int = LENGTH,
    text_col: str = "text",
    keep: tuple[str, ...] = ("doc_id",),
    batches: int = 4,
    head: int = HEAD,
    kinds: int = _KINDS,
    as_text: bool = False,
) -> DataFrame:
    """The columns `keep` of every row with kept, n_bytes, n_removed, n_spans.

    `kept` is binary; with `as_text` it is a string without the bytes of characters that were cut apart.

    Each byte covered by a `length` bytes long string that also starts anywhere else in any row is
    removed; repeated rows repeat all their strings.  Null texts are empty; texts shorter than `length`
    stay whole; ids may be null or repeated, no id is used; an empty table gives no rows; columns other
    than `keep` and the text are ignored.  `keep` must not name the new columns.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    named = docs.select(*[F.col(f"`{c}`").alias(f"_{c}") for c in keep], text.alias("text"))
    named = named.withColumns(_key(F.col("text")))
    # Equal texts have the same key, so each text is looked at as often as it occurs.
    ranges = repeated_ranges(named.select("key", "check", "text"), length, head, batches, kinds)
    schema = ", ".join(f"`_{c}` {docs.schema[c].dataType.simpleString()}" for c in keep)
    schema += f", n_bytes bigint, n_removed bigint, n_spans bigint, kept {'string' if as_text else 'binary'}"
    cut = named.join(ranges, ["key", "check"], "left").drop("key", "check").mapInArrow(_cut(length, as_text), schema)
    return cut.select(*[F.col(f"`_{c}`").alias(c) for c in keep], "kept", "n_bytes", "n_removed", "n_spans")
