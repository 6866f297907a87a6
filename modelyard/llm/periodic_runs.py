"""Periodic runs of words, found through a grammar of each text.

A run is a stretch of consecutive words with smallest period q, at least `LEAST` words and two periods
long, that no neighbouring word extends with the same period.  Re-Pair replaces the most frequent pair
of symbols by a new one until no pair stands twice; what is left is split in halves.  A run lies in one
smallest node of that derivation, whose boundary it crosses, so it is enough to look for the runs that
cross the boundary of each rule, once for each rule however often it is used, and to translate them to
all positions the rule derives.  A run cut off by a node's border is part of a longer one found
further up; intervals of one period that overlap are merged.
"""

from __future__ import annotations

import heapq
import re

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from modelyard.llm.common import derive, documents

LEAST = 12
WORD = r"[^\x20\x09-\x0D]+"
RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"

_WORDS = re.compile(WORD)
_AT_ONCE = 1 << 20  # candidate periods looked at together
_HOLE = -1


def repeated_pairs(ids: np.ndarray) -> dict[tuple[int, int], list[int]]:
    """Places of each pair of neighbours that stands at least twice, in order of the text."""
    codes = ids[:-1] * (int(ids.max()) + 1) + ids[1:]
    order = np.argsort(codes, kind="stable")
    starts = np.flatnonzero(np.append(True, np.diff(codes[order]) != 0))
    ends = np.append(starts[1:], len(order))
    places = {}
    for k in np.flatnonzero(ends - starts > 1):
        spots = order[starts[k] : ends[k]].tolist()
        places[int(ids[spots[0]]), int(ids[spots[0] + 1])] = spots
    return places


def re_pair(ids: np.ndarray) -> tuple[list[int], list[int], list[tuple[int, int]]]:
    """(symbols left, their first words, rules): rule k is the pair that symbol max(ids) + 1 + k stands for.

    Pairs of equal frequency are replaced in the order in which they came up, so that rules over a
    repeated passage stay balanced.
    """
    n, first_rule = len(ids), int(ids.max()) + 1
    symbols, after, before = ids.tolist(), list(range(1, n + 1)), list(range(-1, n - 1))
    places = repeated_pairs(ids)
    waiting = [(-len(spots), k, pair) for k, (pair, spots) in enumerate(sorted(places.items(), key=lambda p: p[1][0]))]
    heapq.heapify(waiting)
    serial = len(waiting)
    rules: list[tuple[int, int]] = []
    while waiting:
        rank, _, pair = heapq.heappop(waiting)
        left, right = pair
        live, last = [], -1
        for i in places.pop(pair):
            if i != last and symbols[i] == left:
                j = after[i]
                if j < n and symbols[j] == right:
                    live.append(i)
                    last = j
        if len(live) < 2:
            continue
        if len(live) < -rank:  # others were replaced first and took some of its places
            places[pair] = live
            heapq.heappush(waiting, (-len(live), serial, pair))
            serial += 1
            continue
        new = first_rule + len(rules)
        rules.append(pair)
        fresh: dict[tuple[int, int], list[int]] = {}
        for i in live:
            j = after[i]
            k, h = after[j], before[i]
            symbols[i], symbols[j], after[i] = new, _HOLE, k
            if h >= 0:
                fresh.setdefault((symbols[h], new), []).append(h)
            if k < n:
                before[k] = i
                fresh.setdefault((new, symbols[k]), []).append(i)
        for found, spots in fresh.items():
            if len(spots) > 1:
                places[found] = spots
                heapq.heappush(waiting, (-len(spots), serial, found))
                serial += 1
    starts, i = [], 0
    while i < n:
        starts.append(i)
        i = after[i]
    return [symbols[i] for i in starts], starts, rules


def _sizes(first_rule: int, rules: list[tuple[int, int]]) -> list[int]:
    """Words derived by each rule."""
    sizes: list[int] = []
    size = lambda s: 1 if s < first_rule else sizes[s - first_rule]
    for left, right in rules:
        sizes.append(size(left) + size(right))
    return sizes


def boundaries(ids: np.ndarray, least: int = LEAST) -> tuple[np.ndarray, list[list[int]]]:
    """(nodes, positions): begin, middle and end of one derivation of each rule of at least `least` words
    and of each half-split of what Re-Pair left; and all positions each of them derives."""
    symbols, starts, rules = re_pair(ids)
    n, first_rule = len(ids), int(ids.max()) + 1
    sizes = _sizes(first_rule, rules)
    derived: dict[int, list[int]] = {}
    for symbol, start in zip(symbols, starts):
        if symbol >= first_rule and sizes[symbol - first_rule] >= least:
            derived.setdefault(symbol, []).append(start)
    nodes, positions = [], []
    for k in range(len(rules) - 1, -1, -1):  # a rule is used by later rules only
        spots = derived.get(first_rule + k)
        if not spots:
            continue
        left, right = rules[k]
        middle = 1 if left < first_rule else sizes[left - first_rule]
        nodes.append((spots[0], spots[0] + middle, spots[0] + sizes[k]))
        positions.append(spots)
        for symbol, shift in ((left, 0), (right, middle)):
            if symbol >= first_rule and sizes[symbol - first_rule] >= least:
                derived.setdefault(symbol, []).extend([p + shift for p in spots])
    edges, open_ranges = [*starts, n], [(0, len(starts))]
    while open_ranges:
        low, high = open_ranges.pop()
        if high - low < 2 or edges[high] - edges[low] < least:
            continue
        half = (low + high) // 2
        nodes.append((edges[low], edges[half], edges[high]))
        positions.append([edges[low]])
        open_ranges += [(low, half), (half, high)]
    return np.array(nodes, np.int64).reshape(-1, 3), positions


class Blocks:
    """Equality of equally long blocks of words: ranks of all blocks of 1, 2, 4 ... words, made when asked for."""

    def __init__(self, ids: np.ndarray):
        self.ranks = [ids]
        self.n = len(ids)

    def level(self, k: int) -> np.ndarray:
        while len(self.ranks) <= k:
            step, last = 1 << (len(self.ranks) - 1), self.ranks[-1]
            codes = last[: len(last) - step] * (int(last.max()) + 1) + last[step:]
            self.ranks.append(np.unique(codes, return_inverse=True)[1])
        return self.ranks[k]

    def forward(self, x: np.ndarray, y: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How many words from x on equal those from y on, where the latter stand before `end`."""
        done = np.zeros(len(x), np.int64)
        for k in range(int((end - y).max()).bit_length() - 1, -1, -1):
            step, ranks = 1 << k, self.level(k)
            top = len(ranks) - 1
            far = y + done
            same = (far + step <= end) & (ranks[np.minimum(x + done, top)] == ranks[np.minimum(far, top)])
            done += same * step
        return done

    def backward(self, x: np.ndarray, y: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """How many words before x equal those before y, where the former stand at `begin` or after."""
        done = np.zeros(len(x), np.int64)
        for k in range(int((x - begin).max()).bit_length() - 1, -1, -1):
            step, ranks = 1 << k, self.level(k)
            top = len(ranks) - 1
            near = x - done - step
            same = (near >= begin) & (
                ranks[np.clip(near, 0, top)] == ranks[np.clip(y - done - step, 0, top)]
            )
            done += same * step
        return done


def _periods(most: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(node, q) for q = 1 .. most[node]."""
    node = np.repeat(np.arange(len(most)), most)
    return node, np.arange(len(node)) - np.repeat(np.cumsum(most) - most, most) + 1


def _marks(ids: np.ndarray, least: int) -> tuple[np.ndarray, int]:
    """(marks, reach): on the equal stretches of a run each place stands in a window of reach + 1 equal
    words; a mark is the hash of the window that begins there."""
    if least < 7:  # stretches may be shorter than three places and two more on one side
        return ids, 0
    # Equal triples have equal hashes; unequal ones that share a hash only cost a comparison.
    a = ids.astype(np.uint64)
    mixed = a[:-2] * np.uint64(0x9E3779B97F4A7C15) ^ a[1:-1] * np.uint64(0xC2B2AE3D27D4EB4F)
    return np.append(mixed ^ a[2:] * np.uint64(0x165667B19E3779F9), ~np.arange(2, dtype=np.uint64)), 2


def _crossing(nodes: np.ndarray, marks: np.ndarray, reach: int, blocks: Blocks, least: int) -> np.ndarray:
    """(node, start, length, period) of the runs inside a node that cross its middle.

    Words q apart are equal on a stretch of at least max(q, least - q) places; it holds the last q
    before the middle, or the one before the middle together with the middle.
    """
    begin, middle, end = nodes.T
    half = (end - begin) // 2
    found = []
    for most, at_q in ((np.minimum(middle - begin, half), True), (np.minimum(end - middle, half), False)):
        node, q = _periods(most)
        i = middle[node] - (q if at_q else 1)
        back = np.maximum(i - reach, 0)
        likely = (marks[i] == marks[i + q]) | (marks[back] == marks[back + q])
        found.append((node[likely], q[likely], i[likely]))
    node, q, i = (np.concatenate(c) for c in zip(*found))
    if not len(node):
        return np.empty((0, 4), np.int64)
    right = blocks.forward(i, i + q, end[node])
    keep = right > 0
    node, q, i, right = node[keep], q[keep], i[keep], right[keep]
    if not len(node):
        return np.empty((0, 4), np.int64)
    start = i - blocks.backward(i, i + q, begin[node])
    length = i + right + q - start
    keep = length >= np.maximum(2 * q, least)
    rows = np.stack([node, start, length, q], 1)[keep]
    rows = rows[np.lexsort(rows.T[::-1])]
    smallest = np.append(True, np.any(rows[1:, :3] != rows[:-1, :3], axis=1))[: len(rows)]
    return rows[smallest]


def _merged(rows: np.ndarray, n: int) -> np.ndarray:
    """(start, length, period): intervals of one period that share a period's words are one run."""
    start, length, period = rows[np.lexsort((rows[:, 0], rows[:, 2]))].T
    apart = period * (2 * n + 2)
    low, high = start + apart, np.maximum.accumulate(start + length + apart)
    first = np.flatnonzero(np.append(True, low[1:] + period[1:] > high[:-1]))
    last = np.append(first[1:], len(start)) - 1
    out = np.stack([start[first], high[last] - low[first], period[first]], 1)
    return out[np.lexsort((out[:, 2], out[:, 0]))]


def runs_of(ids: np.ndarray, least: int = LEAST) -> np.ndarray:
    """All runs (start, length, period) of a sequence of numbers from 0, by start, then period."""
    n, none = len(ids), np.empty((0, 3), np.int64)
    if n < least:
        return none
    marks, reach = _marks(ids, least)
    nodes, positions = boundaries(ids, least)
    blocks, rows = Blocks(ids), []
    total = np.cumsum(nodes[:, 2] - nodes[:, 0])
    part = 0
    while part < len(nodes):
        until = max(part + 1, int(np.searchsorted(total, (total[part - 1] if part else 0) + _AT_ONCE)))
        for node, start, length, period in _crossing(nodes[part:until], marks, reach, blocks, least).tolist():
            spots = np.array(positions[part + node], np.int64)
            shifted = spots + (start - nodes[part + node, 0])
            rows.append(np.stack([shifted, np.full(len(spots), length), np.full(len(spots), period)], 1))
        part = until
    return _merged(np.concatenate(rows), n) if rows else none


def numbered(words: list[str]) -> np.ndarray:
    """The words as numbers, by first appearance."""
    numbers: dict[str, int] = {}
    return np.array([numbers.setdefault(w, len(numbers)) for w in words], np.int64)


def kept_words(words: list[str], runs: np.ndarray) -> list[str]:
    """The words that no run contains after its first period."""
    if not len(runs):
        return words
    depth = np.zeros(len(words) + 1, np.int64)
    np.add.at(depth, runs[:, 0] + runs[:, 2], 1)
    np.add.at(depth, runs[:, 0] + runs[:, 1], -1)
    return [words[i] for i in np.flatnonzero(np.cumsum(depth[:-1]) == 0)]


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST) -> DataFrame:
    """doc_id, n_words, runs (start, length, period; by start, then period), collapsed.

    Words are what lies between blanks, tabs and line ends, numbered from 0.  `collapsed` is the words
    that no run contains after its first period, joined by one space.  Every row gives a row: a null,
    empty or blank text has no words, no runs and an empty `collapsed`; a null id stays null; repeated
    rows each give their own; an empty table gives none; further columns are ignored, whatever they
    are called.  Texts are whole, and a text's memory grows with its words.
    """

    def start():
        def work(texts: list[str]) -> dict[str, list]:
            made: dict[str, list] = {"n_words": [], "runs": [], "collapsed": []}
            for text in texts:
                words = _WORDS.findall(text)
                runs = runs_of(numbered(words), least)
                made["n_words"].append(len(words))
                made["runs"].append([{"start": s, "length": n, "period": q} for s, n, q in runs.tolist()])
                made["collapsed"].append(" ".join(kept_words(words, runs)))
            return made

        return work

    return derive(documents(docs, id_col, text_col), start, f"n_words bigint, runs {RUNS}, collapsed string")


def plant(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text): in a document whose h = crc32(id as text) is a multiple of 10, the n words from
    a = g % n on repeat the first 1 + (n - a) / (3 + g % 8) of them, where g = h / 10; whole divisions.

    A null id counts as the empty text; documents without words stay as they are.
    """
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))
    words = F.when(h % 10 == 0, F.regexp_extract_all("text", F.lit(WORD), F.lit(0)))
    # The words are a column of their own, so that a lambda reads them and does not split the text again.
    split = documents(docs, id_col, text_col).withColumns({"words": words, "g": F.floor(h / 10)})
    n = F.nullif(F.size("words"), F.lit(0)).cast("bigint")
    parts = split.withColumns({"a": F.col("g") % n, "n": n}).withColumn(
        "p", 1 + F.floor((F.col("n") - F.col("a")) / (3 + F.col("g") % 8))
    )

    def repeated(w: Column, i: Column) -> Column:
        at = (F.col("a") + (i - F.col("a")) % F.col("p") + 1).cast("int")
        return F.when(i < F.col("a"), w).otherwise(F.element_at("words", at))

    planted = F.array_join(F.transform("words", repeated), " ")
    return parts.select("doc_id", F.when(F.col("n") > 0, planted).otherwise(F.col("text")).alias("text"))


def digest(found: DataFrame) -> DataFrame:
    """doc_id, n_runs, the longest run and hashes of all runs and of the words left, from rows of `find`."""
    key = lambda r: F.struct((-r["length"]).alias("length"), r["start"].alias("start"), r["period"].alias("period"))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    best = F.array_min(F.transform("runs", key))
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        F.col("best.start").alias("start"),
        (-F.col("best.length")).alias("length"),
        F.col("best.period").alias("period"),
        F.floor(-1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        F.sha2(lines.cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )
