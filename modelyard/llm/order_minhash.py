"""Document fingerprints by Order MinHash, in DataFrame functions only.

A text is a sequence of tokens: words, and where white space is more than 16 characters away pieces that end
at characters chosen by what they are, never by their place, so that an edit changes tokens near it only.
Its k-mers are k tokens in a row.  The j-th occurrence of a k-mer is an element of its own.  Each of the
signature's functions orders all elements of the text by their hash XOR a number of its own, takes the
smallest, keeps them in text order and hashes the tuple.  Texts a few edits apart agree in many
positions of the signature; the same k-mers in another order do not.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from modelyard.llm.common import materialise

TOKENS = 2  # tokens of a k-mer
_BITS = 5
FUNCTIONS = 1 << _BITS  # positions of the signature
TUPLE = 2  # elements of a tuple
_LAST = (1 << 63) - 1
_LEAST = -(1 << 63)
# Ends of pieces: vowels, some digits, punctuation, all beyond ASCII.
_END = r"aeiouyAEIOUY0369\x21-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F\x80-\x{10FFFF}"
_TOKEN = rf"(?<!\S)\S{{1,16}}(?!\S)|[^\s{_END}]*+[{_END}]|[^\s{_END}]++"


def _kmer_hashes(tokens: Column, text: Column) -> Column:
    """Hashes of all k-mers in text order; of shorter texts, the hash of all they have."""
    n = F.size(tokens)
    hashes = F.transform(
        F.slice(tokens, F.lit(1), F.greatest(n - (TOKENS - 1), F.lit(0))),
        lambda t, i: F.xxhash64(t, *[F.get(tokens, i + d) for d in range(1, TOKENS)]),
    )
    short = F.when(n > 0, F.array(F.xxhash64(F.array_join(tokens, " ")))).otherwise(F.array(F.xxhash64(text)))
    return F.when(n >= TOKENS, hashes).otherwise(short)


def with_signature(df: DataFrame, text_col: str, out: str) -> DataFrame:
    """Adds the signature (array of 32-bit numbers) of a text column that has no nulls.

    Each step is a column of its own, so that no array is computed anew for each element.
    """
    names = {n: f"_{out}_{n}" for n in "tokens hashes sorted starts later elements dealt".split()}
    tokens, hashes, ordered, starts, later, elements, dealt = (F.col(n) for n in names.values())
    df = df.withColumn(names["tokens"], F.regexp_extract_all(F.col(text_col), F.lit(_TOKEN), F.lit(0)))
    df = df.withColumn(names["hashes"], _kmer_hashes(tokens, F.col(text_col))).drop(names["tokens"])
    df = df.withColumn(names["sorted"], F.sort_array(hashes))
    first = F.filter(
        F.sequence(F.lit(0), F.size(ordered) - 1),
        lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)),
    )
    df = df.withColumn(names["starts"], first)

    # First occurrences hash to the k-mer's hash itself.
    runs = F.transform(
        starts,
        lambda i, j: F.struct(
            F.get(ordered, i).alias("h"), (F.coalesce(F.get(starts, j + 1), F.size(ordered)) - i).alias("n")
        ),
    )
    repeats = F.flatten(
        F.transform(
            F.filter(runs, lambda r: r["n"] > 1),
            lambda r: F.transform(
                F.sequence(F.lit(1), r["n"] - 1),
                lambda o: F.struct(F.xxhash64(r["h"], o).alias("g"), r["h"].alias("h"), o.alias("o")),
            ),
        )
    )
    df = df.withColumn(names["later"], repeats)
    firsts = F.when(F.size(starts) == F.size(ordered), ordered).otherwise(
        F.transform(starts, lambda i: F.get(ordered, i))
    )
    df = df.withColumn(names["elements"], F.concat(firsts, later["g"])).drop(names["starts"], names["sorted"])

    # A function's number has its own top bits and zeros below.  The elements with these top bits come first in its
    # order, by size; they follow the number in the sorted array.  Only where they are too few all are ordered anew.
    numbers = [_LEAST + (f << (64 - _BITS)) for f in range(FUNCTIONS)]
    df = df.withColumn(names["dealt"], F.sort_array(F.concat(elements, F.array(*map(F.lit, numbers)))))

    def place(g: Column) -> Column:
        # What a lambda is given is computed once.
        of_later = F.transform(
            F.filter(later, lambda e: e["g"] == g),
            lambda e: F.get(
                F.filter(F.sequence(F.lit(0), F.size(hashes) - 1), lambda i: F.get(hashes, i) == e["h"]), e["o"]
            ),
        )
        # A condition that names the position twice would look for it twice.
        at = F.array(F.array_position(hashes, g).cast("int"))
        return F.get(F.transform(at, lambda p: F.when(p > 0, p - 1).otherwise(F.get(of_later, F.lit(0)))), F.lit(0))

    def smallest(number: Column, following: Column) -> Column:
        turned = number.bitwiseXOR(F.lit(_LEAST))
        again = F.slice(F.sort_array(F.transform(elements, lambda g: g.bitwiseXOR(turned))), 1, TUPLE)
        enough = lambda found: (F.size(found) == TUPLE) & (
            following.isNull() | (F.element_at(found, -1) < following)
        )
        next_to = F.array(F.slice(dealt, F.array_position(dealt, number).cast("int") + 1, TUPLE))
        chosen = lambda found: F.when(enough(found), found).otherwise(
            F.transform(again, lambda g: g.bitwiseXOR(turned))
        )
        return F.get(F.transform(next_to, chosen), F.lit(0))

    def position(function: Column) -> Column:
        placed = F.transform(
            smallest(function["number"], function["following"]), lambda g: F.struct(place(g).alias("p"), g.alias("g"))
        )
        return F.xxhash64(F.sort_array(placed)["g"]).bitwiseAND(F.lit(0xFFFFFFFF))

    functions = F.array(
        *[
            F.struct(F.lit(n).alias("number"), F.lit(after).cast("bigint").alias("following"))
            for n, after in zip(numbers, [*numbers[1:], None])
        ]
    )
    return df.withColumn(out, F.transform(functions, position)).drop(
        names["hashes"], names["later"], names["elements"], names["dealt"]
    )


def likeness(one: Column, other: Column) -> Column:
    """Share of equal positions of two signatures."""
    same = F.filter(F.zip_with(one, other, lambda a, b: a == b), lambda x: x)
    return F.size(same) / F.lit(float(FUNCTIONS))


def as_text(signature: Column) -> Column:
    return F.array_join(F.transform(signature, lambda x: F.lpad(F.hex(x), 8, "0")), "")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and signature of every row; a null text is empty."""
    rows = docs.select(
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"),
    )
    return with_signature(rows, "text", "signature").drop("text")


def _following(keys: DataFrame) -> DataFrame:
    """(place, check, third, next_place, next_check): the next key in order, the first after the last.

    Keys are dealt out by range; the next key is within the partition or the first of the next one.
    """
    dealt = materialise(
        keys.repartitionByRange("place", "check").withColumn("part", F.spark_partition_id()), "ordered-keys"
    )
    order = Window.partitionBy("part").orderBy("place", "check")
    pair = F.struct("place", "check")
    firsts = dealt.groupBy("part").agg(F.min(pair).alias("first"))
    # One row for each partition, not for each key.
    after = firsts.select("part", F.lead("first").over(Window.orderBy("part")).alias("after"))
    start = F.broadcast(firsts.agg(F.min("first").alias("start")))
    following = F.coalesce(F.lead(pair).over(order), F.col("after"), F.col("start"))
    return (
        dealt.join(F.broadcast(after), "part")
        .join(start)
        .withColumn("next", following)
        .select(
            "place", "check", "third", F.col("next.place").alias("next_place"), F.col("next.check").alias("next_check")
        )
    )


def with_edits(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Signatures of every row's text and of its edited text, and their likeness.

    The edited text has its last third (floor of the number of code points) replaced by the first as
    many code points of the next document in descending order of ids, of the first after the last.
    Columns: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Null texts are empty; rows without an id come last; rows with equal ids are ordered by a hash of
    their texts; rows with equal id and text share one place and all results.  A single document is its
    own next one; an empty table gives no rows; other columns are ignored.  An id of -2^63 is taken for null.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("doc_id"), text.alias("text"))
    # ~id falls as the id rises and never overflows; a null id goes to the end.
    # The id is told from the place again, so that both joins read one and the same shuffle of the texts.
    rows = rows.select(
        F.coalesce(F.bitwise_not("doc_id"), F.lit(_LAST)).alias("place"),
        F.xxhash64("text").alias("check"),
        "text",
    )
    third = F.floor(F.length("text") / 3).cast("int")
    keys = rows.groupBy("place", "check").agg(F.max(third).alias("third"))
    following = materialise(_following(keys), "next-documents")
    heads = (
        rows.join(
            following.select(
                F.col("next_place").alias("place"),
                F.col("next_check").alias("check"),
                F.struct("place", "check").alias("of"),
                "third",
            ),
            ["place", "check"],
        )
        .select("of", F.substring(F.col("text"), F.lit(1), F.col("third")).alias("head"))
        .groupBy(F.col("of.place").alias("place"), F.col("of.check").alias("check"))
        .agg(F.max("head").alias("head"))
    )
    edited = F.concat(F.substring(F.col("text"), F.lit(1), F.length("text") - third), F.col("head"))
    pairs = rows.join(heads, ["place", "check"]).withColumns({"edited": edited, "n_chars": F.length("text").cast("bigint")})
    signed = with_signature(with_signature(pairs, "text", "own"), "edited", "changed")
    kept = materialise(
        signed.select(
            F.when(F.col("place") != _LAST, F.bitwise_not("place")).alias("doc_id"), "place", "check", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "own", "changed"
        ),
        "signatures",
    )
    others = kept.groupBy(F.col("place").alias("next_place"), F.col("check").alias("next_check")).agg(
        F.min("own").alias("other")
    )
    links = following.select("place", "check", "next_place", "next_check").join(others, ["next_place", "next_check"])
    return kept.join(links.select("place", "check", "other"), ["place", "check"]).select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("changed")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("changed")).alias("near_edited"),
        likeness(F.col("own"), F.col("other")).alias("near_next"),
    )
