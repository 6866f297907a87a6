"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Base patterns give the base spans.  Long mixed strings of letters and digits that no base span touches
are candidates too.  The hashes of all candidate values are counted by the distinct owners and
repositories that hold them: a value that several owners hold is a widely copied example; one that a
single owner holds looks like a live credential.  Candidates of the second kind become further spans;
base spans stay whatever their value's count, and are only told apart by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from modelyard.llm.common import materialise

# The patterns of the base kinds, the group that is the value, the least length of the value.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = (("assign", ASSIGN, 2, 8), ("access", ACCESS, 0, 16), ("hex", HEX, 0, 32))

OWNED = "owned"
MIXED = r"[A-Za-z0-9+/_-]+"
MIXED_LEAST = 20
_NAMES = [kind for kind, *_ in KINDS] + [OWNED]


def _at_least(pattern: str, least: int) -> str:
    """A pattern of one character class, matched from the start of a run only if the run is long enough.

    Runs are matched whole, so dropping short matches and never matching them are the same.
    """
    chars = pattern[pattern.index("[") : -1]
    return f"(?<!{chars}){chars}{{{least},}}"


def _scan(text: Column, pattern: str, group: int) -> Column:
    """Array of (gap, size, value): characters since the last match, of the match, and the value's text."""
    pieces = F.arrays_zip(
        F.split(text, pattern, -1).alias("before"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match"),
        F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"),
    )
    found = F.transform(
        pieces,
        lambda p: F.struct(
            F.length(p["before"]).alias("gap"), F.length(p["match"]).alias("size"), p["value"].alias("value")
        ),
    )
    return F.filter(found, lambda m: m["size"].isNotNull())


def _scans(text: Column) -> dict[str, Column]:
    quick = {
        "assign": r"(?i)password|passwd|secret|token|api_?key",
        "access": "AKIA",
        "hex": _at_least(HEX, 32),
        OWNED: _at_least(MIXED, MIXED_LEAST),
    }
    full = {
        "assign": _scan(text, ASSIGN, 2),
        "access": _scan(text, ACCESS, 0),
        "hex": _scan(text, _at_least(HEX, 32), 0),
        OWNED: _scan(text, _at_least(MIXED, MIXED_LEAST), 0),
    }
    return {kind: F.when(text.rlike(quick[kind]), full[kind]) for kind in _NAMES}


def _spans(base: DataFrame) -> DataFrame:
    """(row, owner, repo, kind, order, start, end, value) of all candidates, code points, end exclusive."""
    kinds = None
    for place, kind in enumerate(_NAMES):
        part = base.select(
            "row", "owner", "repo", F.lit(kind).alias("kind"), F.lit(place).alias("order"), F.posexplode(kind).alias("i", "m")
        )
        kinds = part if kinds is None else kinds.union(part)
    so_far = Window.partitionBy("row", "order").orderBy("i")
    ends = F.sum(F.col("m.gap") + F.col("m.size")).over(so_far)
    found = kinds.withColumn("end", ends).select(
        "row", "owner", "repo", "kind", "order", (F.col("end") - F.col("m.size")).alias("start"), "end", F.col("m.value").alias("value")
    )
    least = {kind: n for kind, _, _, n in KINDS}
    long_enough = F.coalesce(
        *[F.when(F.col("kind") == kind, F.length("value") >= n) for kind, n in least.items()],
        F.col("value").rlike("[0-9]") & F.col("value").rlike("[A-Za-z]"),
    )
    return found.where(long_enough)


def find(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    owner_col: str = "source",
    repo_cols: tuple[str, ...] = ("source", "lang"),
    examples_from: int = 2,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Secrets of every row.

    doc_id, the columns `keep`, n_assign, n_access, n_hex, n_live, n_example (base spans whose value one
    owner holds, or at least `examples_from` owners), base (text of the base spans), spans (text of all)
    and found: array of (start, end, kind, owners, repos) in order of start, then kind.

    A null text is empty and has no spans; a null owner or repository counts as one of its own name;
    repeated rows have a result each; an empty table gives no rows; other columns are ignored.
    """
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    name = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("\0"))
    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(f"`{id_col}`").cast("bigint").alias("doc_id"),
        *[F.col(f"`{c}`").alias(f"_{c}") for c in keep],
        name(owner_col).alias("owner"),
        F.concat_ws("\1", *[name(c) for c in repo_cols]).alias("repo"),
        text.alias("text"),
    )
    base = materialise(rows.withColumns(_scans(F.col("text"))).drop("text"), "scans")

    spans = _spans(base)
    is_base = F.col("kind") != OWNED
    around = Window.partitionBy("row").orderBy("start", "order")
    before = F.max(F.when(is_base, F.col("end"))).over(around.rowsBetween(Window.unboundedPreceding, -1))
    after = F.min(F.when(is_base, F.col("start"))).over(around.rowsBetween(1, Window.unboundedFollowing))
    touched = (F.coalesce(before, F.lit(0)) > F.col("start")) | (F.coalesce(after, F.col("end")) < F.col("end"))
    candidates = materialise(
        spans.withColumn("touched", touched).where(is_base | ~F.col("touched")).select(
            "row", "owner", "repo", "kind", "order", "start", "end", F.md5(F.col("value").cast("binary")).alias("secret")
        ),
        "candidates",
    )
    # Distinct holders first, map-side, so that a value in very many rows is few rows before the count.
    held = candidates.groupBy("secret", "owner", "repo").agg(F.lit(1).alias("one"))
    owners = held.groupBy("secret", "owner").agg(F.count("*").alias("repos"))
    owners = owners.groupBy("secret").agg(F.count("*").alias("owners"), F.sum("repos").alias("repos"))
    judged = candidates.join(owners, "secret").where(is_base | (F.col("owners") < examples_from))

    label = F.concat_ws(":", "kind", F.col("start").cast("string"), F.col("end").cast("string"))
    item = F.struct("start", "order", "end", "kind", "owners", "repos", label.alias("label"))
    own = judged.groupBy("row").agg(F.sort_array(F.collect_list(item)).alias("all"))
    whole = base.select("row", "doc_id", *[f"_{c}" for c in keep]).join(own, "row", "left")
    every = F.coalesce("all", F.array().cast(own.schema["all"].dataType))
    whole = whole.withColumn("all", every)
    bases = F.filter("all", lambda s: s["kind"] != OWNED)
    count = lambda test: F.size(F.filter("all", test)).cast("bigint")
    of_kind = lambda kind: lambda s: s["kind"] == kind
    joined = lambda items: F.array_join(F.transform(items, lambda s: s["label"]), ",")
    return whole.select(
        "doc_id",
        *[F.col(f"_{c}").alias(c) for c in keep],
        *[count(of_kind(kind)).alias(f"n_{kind}") for kind, *_ in KINDS],
        count(lambda s: (s["kind"] != OWNED) & (s["owners"] < examples_from)).alias("n_live"),
        count(lambda s: (s["kind"] != OWNED) & (s["owners"] >= examples_from)).alias("n_example"),
        joined(bases).alias("base"),
        joined(F.col("all")).alias("spans"),
        F.transform(
            "all",
            lambda s: F.struct(*[s[f].alias(f) for f in ("start", "end", "kind", "owners", "repos")]),
        ).alias("found"),
    )


def redact(text: Column, found: Column, mark: str = "[secret]") -> Column:
    """The text with each run of characters that spans of `found` cover replaced by `mark`."""
    cuts = F.aggregate(
        found,
        F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at")),
        lambda a, s: F.struct(
            F.when(
                s["end"] <= a["at"], a["out"]
            ).otherwise(
                F.concat(
                    a["out"],
                    F.when(
                        (s["start"] >= a["at"]) | (a["at"] == 0),
                        F.concat(
                            F.substring(text, (a["at"] + 1).cast("int"), (s["start"] - a["at"]).cast("int")), F.lit(mark)
                        ),
                    ).otherwise(F.lit("")),
                )
            ).alias("out"),
            F.greatest(a["at"], s["end"].cast("bigint")).alias("at"),
        ),
    )
    rest = F.substring(text, (cuts["at"] + 1).cast("int"), F.length(text))
    return F.when(F.size(found) > 0, F.concat(cuts["out"], rest)).otherwise(text)
