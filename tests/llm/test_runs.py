"""Periodic runs, against trying every period."""

from __future__ import annotations

import hashlib
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st

from modelyard.llm import periodic_runs
from modelyard.llm.queries import QUERIES


def _every_period(words, least=12):
    n, found = len(words), {}
    for q in range(1, n // 2 + 1):
        i = 0
        while i + q < n:
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            if j + q - i >= max(2 * q, least):
                found.setdefault((i, j + q - i), q)  # the smallest period comes first
            i = max(j, i + 1)
    return sorted((s, length, q) for (s, length), q in found.items())


def _runs(words, least=12):
    return [tuple(r) for r in periodic_runs.runs_of(periodic_runs.numbered(words), least).tolist()]


def _fibonacci(n):
    a, b = "x", "xy"
    while len(b) < n:
        a, b = b, b + a
    return list(b[:n])


SEQUENCES = {
    "one word": ["a"] * 300,
    "two words": ["a", "b"] * 77 + ["a"],
    "no repeats": [str(i) for i in range(200)],
    "Fibonacci": _fibonacci(400),
    "Thue-Morse": [str(bin(i).count("1") % 2) for i in range(400)],
    "powers of powers": ((["a", "b"] * 3 + ["c"]) * 4 + ["d"]) * 5,
    "one change": ["a", "b", "c"] * 20 + ["x"] + ["a", "b", "c"] * 20,
    "short": ["a"] * 11,
    "exactly long enough": ["a"] * 12,
    "two periods exactly": [str(i) for i in range(30)] * 2,
    "copies apart": [str(i) for i in range(40)] + ["!"] + [str(i) for i in range(40)],
    "none": [],
}


@pytest.mark.parametrize("name", sorted(SEQUENCES))
def test_runs_equal_every_period(name):
    assert _runs(SEQUENCES[name]) == _every_period(SEQUENCES[name])


@settings(max_examples=300, deadline=None)
@given(st.lists(st.tuples(st.lists(st.integers(0, 2), min_size=1, max_size=8), st.integers(1, 6)), max_size=12), st.integers(2, 14))
def test_random_runs_equal_every_period(parts, least):
    words = [str(w) for block, times in parts for w in block * times]
    assert _runs(words, least) == _every_period(words, least)


def test_candidates_in_many_parts(monkeypatch):
    monkeypatch.setattr(periodic_runs, "_AT_ONCE", 16)
    for words in SEQUENCES.values():
        assert _runs(words) == _every_period(words)


def test_grammar_derives_the_text_and_has_no_pair_twice():
    words = _fibonacci(300) + [str(i % 9) for i in range(100)]
    ids = periodic_runs.numbered(words)
    symbols, starts, rules = periodic_runs.re_pair(ids)
    first = int(ids.max()) + 1

    def text(symbol):
        return [symbol] if symbol < first else text(rules[symbol - first][0]) + text(rules[symbol - first][1])

    derived = [text(s) for s in symbols]
    assert [w for d in derived for w in d] == ids.tolist()
    assert starts == [0, *np.cumsum([len(d) for d in derived])[:-1].tolist()]
    again = periodic_runs.repeated_pairs(np.array(symbols))
    assert all(len(p) == 2 and p[1] - p[0] == 1 for p in again.values())  # only a pair that overlaps itself


def test_a_long_passage_stays_balanced():
    words = [str(i) for i in range(4000)] * 2
    nodes, _ = periodic_runs.boundaries(periodic_runs.numbered(words))
    assert (nodes[:, 2] - nodes[:, 0]).sum() < 40 * len(words)
    assert _runs(words) == [(0, 8000, 4000)]


WORD = re.compile("[^\x20\x09-\x0d]+")


def _expected(doc_id, text):
    words = WORD.findall(text or "")
    n, h = len(words), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    g = h // 10
    if h % 10 == 0 and n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = _every_period(words)
    dropped = {i for s, length, q in runs for i in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2])) if runs else None
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    kept = " ".join(w for i, w in enumerate(words) if i not in dropped)
    return (
        doc_id, len(runs), *(best or (None,) * 3), best and 1000 * best[1] // best[2],
        hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept.encode()).hexdigest(),
    )


COLUMNS = ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_query_over_the_whole_table(spark, base):
    docs = spark.read.parquet(f"{base}/documents.parquet").collect()
    got = {tuple(r[c] for c in COLUMNS) for r in QUERIES["op11_periodic_runs"](spark, base).collect()}
    assert got == {_expected(r["doc_id"], r["text"]) for r in docs}
    assert sum(r[1] > 0 for r in got) > len(docs) / 20


def test_query_on_odd_rows(spark, tmp_path):
    planted = [i for i in range(400) if zlib.crc32(str(i).encode()) % 10 == 0]
    texts = [None, "", " \t\n", "a", "a " * 50, "é ß x " * 9, "x y " * 20, "wörter und " * 3000]
    rows = [(i, texts[k % len(texts)], 1, "r", 7) for k, i in enumerate(planted + list(range(1000, 1040)))]
    rows += [rows[3], (None, "a b " * 20, 2, "r", 7), (None, "a b " * 20, 2, "r", 7)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string, words int, runs string, n bigint")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted((tuple(r[c] for c in COLUMNS) for r in QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect()), key=repr)
    known = {}
    wanted = [known.setdefault(r[:2], _expected(*r[:2])) if len(r[1] or "") < 20_000 else None for r in rows]
    assert len(got) == len(rows)
    assert sorted((w for w in wanted if w), key=repr) == [g for g in got if g in set(wanted)]
    long = [r[0] for r in rows if len(r[1] or "") >= 20_000 and r[0] >= 1000]
    assert all(g[1:6] == (1, 0, 6000, 2, 3_000_000) for g in got if g[0] in long)


def test_empty_table(spark, tmp_path):
    spark.createDataFrame([], "doc_id bigint, text string").write.parquet(str(tmp_path / "documents.parquet"))
    assert QUERIES["op11_periodic_runs"](spark, str(tmp_path)).collect() == []
