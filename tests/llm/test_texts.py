"""Operators over texts against brute force, on given and on awkward rows."""

from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from modelyard.llm import byte_bpe, components, language, order_minhash, packing, simhash, suffix_dedup, token_counts
from modelyard.llm.queries import MULTI_RANKS, PIECES, QUERIES, RANKS, SPECIAL

LONG = "ab" * 60_000
AWKWARD = [
    (1, None), (2, ""), (3, "   "), (4, "\n"), (5, "x"), (6, "▁a  b ▁"), (7, "one two three"), (7, "one two three"),
    (None, "no id"), (8, LONG), (9, "a" * 700), (10, "é" * 450 + "z"), (11, "你好 世界\r\n<s> </s> <|endoftext|> 　x"),
    (12, "the cat sat " * 90), (13, "A cat sat. " + "the cat sat " * 60), (14, " lead and trail "), (15, "\U0001f600 \x00 \x1c y"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    schema = "doc_id bigint, text string, row int, lang string, source string, n_chars bigint, key string, fp string"
    rows = [(i, t, 0, None, None, None, "clash", "clash") for i, t in AWKWARD]
    return spark.createDataFrame(rows, schema).repartition(3)


@pytest.fixture(scope="module")
def given(spark, base):
    return spark.read.parquet(f"{base}/documents.parquet")


def _rows(df):
    return [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]


def _sorted(rows):
    return sorted(rows, key=repr)


@pytest.mark.parametrize("name", ["awkward", "given"])
@pytest.mark.parametrize("head", [0, 50, 1 << 18])
def test_token_counts_equal_the_library(request, name, head):
    import sentencepiece

    whole = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    df = request.getfixturevalue(name)
    got = [tuple(r) for r in token_counts.count_tokens(df, PIECES, limit=100, head_entries=head).collect()]
    wanted = [(i, len(t.encode()), n, n > 100) for i, t in _rows(df) for n in [len(whole.encode(t))]]
    assert _sorted(got) == _sorted(wanted)


@pytest.mark.parametrize("name", ["awkward", "given"])
def test_byte_bpe_round_trip_equals_the_library(request, name):
    bpe = byte_bpe.encoding(MULTI_RANKS, public_tokenizers.PATTERN)
    df = request.getfixturevalue(name)
    got = [tuple(r) for r in byte_bpe.round_trip(df, MULTI_RANKS, public_tokenizers.PATTERN).collect()]
    wanted = []
    for i, t in _rows(df):
        ids = bpe.encode_ordinary(t)
        joined = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        wanted.append((i, len(ids), joined, hashlib.sha256(t.encode()).hexdigest()))
    assert _sorted(got) == _sorted(wanted)
    encoded = byte_bpe.encode(df, MULTI_RANKS, public_tokenizers.PATTERN)
    back = byte_bpe.decode(encoded, MULTI_RANKS, public_tokenizers.PATTERN).collect()
    assert _sorted((r["doc_id"], bytes(r["bytes"]).decode()) for r in back) == _sorted(_rows(df))


def test_chunks_do_not_change_ids():
    bpe = byte_bpe.encoding(MULTI_RANKS, public_tokenizers.PATTERN)
    text = "it's  a \n\n b's 12 34\t x\x1c y \n  z " * 40 + "é" * 50
    for size in (1, 2, 3, 7, 50):
        parts = list(byte_bpe.chunks(text, size))
        assert "".join(parts) == text
        assert [i for p in parts for i in bpe.encode_ordinary(p)] == bpe.encode_ordinary(text)


def test_runs_of_white_space_do_not_change_ids():
    bpe = byte_bpe.encoding(RANKS, public_tokenizers.PATTERN, SPECIAL)
    runs = ["       a", "\n\n\n\n\n\nb", "  \t \u3000 \x85\x1c  ", "      <|endoftext|>", "x \r\n \n    .", "\u2003" * 9]
    text = "".join(runs) * 3 + "q" + " " * 12
    for size in (1, 2, 3, 5, 60):
        found = list(byte_bpe.parts(text, SPECIAL, size))
        assert "".join(p for p, _ in found) == text
        ids = [i for p, one in found for i in (bpe._encode_single_piece(p) if one else bpe.encode(p, allowed_special="all"))]
        assert ids == bpe.encode(text, allowed_special="all")
        assert [i for part in byte_bpe.encode_text(bpe, text, size) for i in part] == bpe.encode_ordinary(text)


def test_white_space_longer_than_the_library_can_match(spark):
    text = "a" + " " * 1_500_000 + "b"
    df = spark.createDataFrame([(1, text), (2, "\n" * 1_200_000)], "doc_id bigint, text string")
    bpe = byte_bpe.encoding(MULTI_RANKS, public_tokenizers.PATTERN)
    wanted = [*bpe.encode_ordinary("a"), *bpe._encode_single_piece(" " * 1_499_999), *bpe.encode_ordinary(" b")]
    got = {r["doc_id"]: r for r in byte_bpe.round_trip(df, MULTI_RANKS, public_tokenizers.PATTERN).collect()}
    assert got[1]["ids_sha256"] == hashlib.sha256(",".join(map(str, wanted)).encode()).hexdigest()
    assert got[1]["decoded_sha256"] == hashlib.sha256(text.encode()).hexdigest()
    packed = packing.pack(df, RANKS, public_tokenizers.PATTERN, SPECIAL).collect()
    lengths = {i: sum(r["length"] for r in packed if r["doc_id"] == i) for i in (1, 2)}
    assert lengths == {r["doc_id"]: r["doc_tokens"] for r in packed}


@pytest.mark.parametrize("name", ["awkward", "given"])
def test_packing_holds_each_id_once(request, name):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    df = request.getfixturevalue(name)
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in packing.pack(df, RANKS, public_tokenizers.PATTERN, SPECIAL).collect():
        pieces[r["doc_id"]].append((r["start"], r["length"], r["ids_crc32"], r["doc_tokens"]))
        sequences[r["sequence_id"]].append((r["offset"], r["length"], r["padded_length"]))
    wanted = defaultdict(list)
    for i, t in _rows(df):
        ids = np.array(library.encode(t, add_special_tokens=False).ids + [1]).astype("<u4")
        for at in range(0, len(ids), 2048):
            part = ids[at : at + 2048]
            wanted[i].append((at, len(part), zlib.crc32(part.tobytes()), len(ids)))
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in wanted.items()}
    for parts in sequences.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= 2048 and {p for *_, p in parts} == {packing.padded(at, 2048)}


def test_packed_histogram_is_the_given_one():
    draw = np.random.default_rng(3)
    histogram = dict(Counter(int(x) for x in draw.integers(1, 101, 5000)))
    patterns = packing.pack_lengths(histogram, 100)
    held = Counter()
    for count, lengths in patterns:
        assert sum(lengths) <= 100
        held.update({n: c * count for n, c in Counter(lengths).items()})
    assert held == Counter(histogram)
    filled = sum(c * sum(p) for c, p in patterns) / (100 * sum(c for c, _ in patterns))
    assert filled > 0.98
    assert packing.pack_lengths({}, 100) == []


def _windows(texts, length):
    seen = Counter(t[k : k + length] for t in texts for k in range(len(t) - length + 1))
    out = []
    for t in texts:
        marks = bytearray(len(t))
        for k in range(len(t) - length + 1):
            if seen[t[k : k + length]] > 1:
                marks[k : k + length] = b"\1" * length
        kept = bytes(c for c, m in zip(t, marks) if not m)
        spans = sum(1 for k, m in enumerate(marks) if m and not (k and marks[k - 1]))
        out.append((sum(marks), spans, kept))
    return out


@pytest.mark.parametrize("kinds", [1 << 13, 1])
@pytest.mark.parametrize("name", ["awkward", "given"])
def test_suffix_dedup_removes_exactly_the_repeats(request, name, kinds):
    df = request.getfixturevalue(name).where("doc_id is null or doc_id != 8")
    rows = _rows(df)
    got = [
        (r["doc_id"], r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"]))
        for r in suffix_dedup.remove_repeats(df, kinds=kinds).collect()
    ]
    texts = [t.encode() for _, t in rows]
    wanted = [(i, len(t), *w) for (i, _), t, w in zip(rows, texts, _windows(texts, 200))]
    assert _sorted(got) == _sorted(wanted)


def test_suffix_dedup_finds_short_and_random_repeats(spark):
    draw = np.random.default_rng(5)
    texts = ["".join(draw.choice(list("ab"), int(n))) for n in draw.integers(0, 400, 60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    got = {r["doc_id"]: bytes(r["kept"]) for r in suffix_dedup.remove_repeats(df, length=16, head=5, batches=3).collect()}
    assert got == {i: w[2] for i, w in enumerate(_windows([t.encode() for t in texts], 16))}


def _expected_components(prints, radius):
    parent = {i: i for i in prints}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in prints:
        for j in prints:
            if i < j and (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: find(i) for i in prints}


@pytest.mark.parametrize("radius, tile", [(4, 4096), (4, 8), (2, 4096)])
def test_simhash_components_equal_brute_force(given, radius, tile, monkeypatch):
    monkeypatch.setattr(simhash, "_TILE", tile)
    got = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash.near_duplicates(given, radius=radius).collect()}
    prints = {i: simhash.fingerprint(simhash.shingle_hashes(t, 4)) for i, t in _rows(given)}
    roots = _expected_components(prints, radius)
    assert got == {i: (f"{p:016x}", roots[i]) for i, p in prints.items()}


def test_simhash_of_awkward_rows(awkward):
    rows = simhash.near_duplicates(awkward).collect()
    assert len(rows) == len(AWKWARD)
    blank = {r["doc_id"]: r for r in rows if r["doc_id"] in (1, 2, 3, 4)}
    assert {r["fingerprint"] for r in blank.values()} == {"0" * 16} and {r["component_id"] for r in blank.values()} == {1}
    assert [r["component_id"] for r in rows if r["doc_id"] is None] == [None]
    kept = simhash.keep_one(awkward)
    assert kept.columns == awkward.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert ids.count(7) == 1 and None in ids and 2 not in ids and 1 in ids


def test_large_buckets_are_compared_in_tiles(spark):
    draw = np.random.default_rng(2)
    base = int(draw.integers(0, 2**62))
    values = {base ^ (1 << int(a)) ^ (1 << int(b)) for a, b in draw.integers(0, 20, (300, 2))}
    df = spark.createDataFrame([(v,) for v in values], "fp bigint")
    edges = simhash.near_links(df, 1, blocks=2, tile=16)
    found = components.components(edges)
    roots = defaultdict(set)
    for r in found.collect():
        roots[r["root"]].add(r["node"])
    wanted = defaultdict(set)
    for v, root in _expected_components({v: v for v in values}, 1).items():
        wanted[root].add(v)
    assert sorted(map(sorted, roots.values())) == sorted(sorted(v) for v in wanted.values() if len(v) > 1)


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(200)]
    star = [(1000, 1001 + i) for i in range(100)]
    df = spark.createDataFrame([*path, *star, (5, 5), (None, 3), (7, 8)], "a bigint, b bigint")
    got = {r["node"]: r["root"] for r in components.components(df).collect()}
    assert got == {**dict.fromkeys(range(201), 0), **dict.fromkeys(range(1000, 1101), 1000)}
    assert components.components(df.limit(0)).count() == 0


@pytest.mark.parametrize("name", ["awkward", "given"])
def test_order_minhash_edits(request, name):
    df = request.getfixturevalue(name).where("doc_id is not null").dropDuplicates(["doc_id"])
    rows = sorted(_rows(df), reverse=True)
    got = {r["doc_id"]: r for r in order_minhash.with_edits(df).collect()}
    assert len(got) == len(rows)
    for n, (i, t) in enumerate(rows):
        third = len(t) // 3
        edited = t[: len(t) - third] + rows[(n + 1) % len(rows)][1][:third]
        assert got[i]["n_chars"] == len(t)
        assert got[i]["edited_sha256"] == hashlib.sha256(edited.encode()).hexdigest()
        following = got[rows[(n + 1) % len(rows)][0]]
        same = [a == b for a, b in zip(_parts(got[i]["fingerprint"]), _parts(following["fingerprint"]))]
        assert got[i]["near_next"] == sum(same) / len(same)


def _parts(text):
    return [text[k : k + 8] for k in range(0, len(text), 8)]


def test_order_minhash_likeness(spark, awkward):
    words = [f"w{i}" for i in range(400)]
    texts = [" ".join(words), " ".join(words), " ".join(words[:-5]), " ".join(reversed(words)), "w " * 300]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    s = {r["doc_id"]: r["signature"] for r in order_minhash.fingerprints(df).collect()}
    near = lambda a, b: sum(x == y for x, y in zip(s[a], s[b])) / len(s[a])
    assert near(0, 1) == 1 and near(0, 2) > 0.7 and near(0, 3) < 0.2 and near(0, 4) == 0
    assert order_minhash.with_edits(awkward).count() == len(AWKWARD)
    one = order_minhash.with_edits(df.limit(1)).collect()
    assert len(one) == 1 and one[0]["near_next"] == 1


def test_order_minhash_of_texts_without_blanks_follows_edits(spark):
    draw = np.random.default_rng(5)
    chinese = "".join(map(chr, draw.integers(0x4E00, 0x9000, 3000)))
    encoded = "".join("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"[i] for i in draw.integers(0, 64, 4000))
    texts = [chinese, chinese[:7] + "x" + chinese[7:], encoded, encoded[:3] + encoded[4:]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    s = {r["doc_id"]: r["signature"] for r in order_minhash.fingerprints(df).collect()}
    near = lambda a, b: sum(x == y for x, y in zip(s[a], s[b])) / len(s[a])
    assert near(0, 1) > 0.8 and near(2, 3) > 0.8 and near(0, 2) == 0


def test_functions_choose_among_all_elements(spark):
    """Long texts that share half of their words: the functions hit shared and other elements independently."""
    texts = [" ".join(f"{k}{i}" for i in range(2000)) for k in "ab"]
    halves = [f"{texts[0]} {texts[1]}", texts[0], "x y z", "x y z x y"]
    df = spark.createDataFrame(list(enumerate(halves)), "doc_id bigint, text string")
    rows = order_minhash.with_signature(df, "text", "signature").collect()
    s = {r["doc_id"]: r["signature"] for r in rows}
    assert 0.05 <= sum(x == y for x, y in zip(s[0], s[1])) / 32 <= 0.5
    assert len(set(s[0])) == 32 and all(len(v) == order_minhash.FUNCTIONS for v in s.values())


def test_occurrences_are_numbered(spark):
    """A k-mer that occurs once more is a new element."""
    df = spark.createDataFrame([(n, "w " * n) for n in (2, 3, 4, 5)], "doc_id bigint, text string")
    signatures = {tuple(r["signature"]) for r in order_minhash.fingerprints(df).collect()}
    assert len(signatures) == 4


def test_language_on_held_out_documents(given):
    fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3
    learned = language.profiles(given.where(fold != 1))
    made = language.identify(given, learned).join(given.where(fold == 1).select("doc_id", "lang"), "doc_id")
    rows = made.collect()
    assert sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.97 * len(rows)
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_language_of_awkward_rows(given, awkward):
    learned = language.profiles(given)
    rows = language.identify(awkward, learned).collect()
    assert len(rows) == len(AWKWARD)
    assert {r["doc_id"] for r in rows if r["lang_pred"] == "und"} == {1, 2, 3, 4}
    assert {r["lang_pred"] for r in language.identify(awkward, language.profiles(awkward)).collect()} == {"und"}


def test_equal_distances_go_to_the_language_first_in_order_of_names(spark):
    rows = [(1, "one and two", "b"), (2, "one and two", "a"), (3, "one and two", "c"), (4, "one and two", None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string")
    learned = language.profiles(docs, size=5)
    places = learned.groupBy("lang").agg(F.sort_array(F.collect_list("place")).alias("p")).collect()
    assert sorted((r["lang"], r["p"]) for r in places) == [(n, [0, 1, 2, 3, 4]) for n in "abc"]
    assert {r["lang_pred"] for r in language.identify(docs, learned, size=5).collect()} == {"a"}


def test_out_of_place_distance_by_hand():
    letters = language._letters()
    own = language.ranked(language.grams("Aab", letters), 10)
    by_hand = Counter(["a", "a", "b", "_a", "aa", "ab", "b_", "_aa", "aab", "ab_"])
    assert len(own) == len(by_hand) and own[0] == ord("a")
    profile = sorted(zip(own[::-1].tolist(), range(len(own))))
    table = [("x", np.array([c for c, _ in profile]), np.array([p for _, p in profile]))]
    n = len(own)
    assert language.distances(own, table, 10) == [sum(abs(n - 1 - 2 * k) for k in range(n))]
    assert language.distances(own, [("y", np.array([1]), np.array([0]))], 10) == [10 * n]


@pytest.mark.parametrize(
    "operator",
    [
        lambda d: token_counts.count_tokens(d, PIECES),
        lambda d: byte_bpe.round_trip(d, MULTI_RANKS, public_tokenizers.PATTERN),
        lambda d: packing.pack(d, RANKS, public_tokenizers.PATTERN, SPECIAL),
        suffix_dedup.remove_repeats,
        simhash.near_duplicates,
        simhash.keep_one,
        order_minhash.with_edits,
        lambda d: language.identify(d, language.profiles(d)),
    ],
)
def test_empty_tables_give_no_rows(awkward, operator):
    assert operator(awkward.limit(0)).count() == 0


def test_every_query_is_there():
    assert [int(name[2:].split("_")[0]) for name in QUERIES] == list(range(1, 11))
