"""Byte-level BPE by rank files with the tiktoken library: encoding, decoding, cutting of long texts."""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterable, Iterator

from pyspark.sql import DataFrame

from modelyard.llm.common import derive, documents

# A match of the pattern never holds a blank or line end after another character, and none looks
# ahead beyond the white space it stands in.
_SAFE = re.compile(r"(?<=\S)(?=[ \n])")
CHUNK = 1 << 16
# Unicode's white space, which is the pattern's.
_BLANKS = "[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]"


def encoding(rank_file: str, pattern: str, special: dict[str, int] | None = None):
    """The library's encoding of a local rank file."""
    import tiktoken

    with open(rank_file, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens=special or {})


def chunks(text: str, size: int = CHUNK) -> Iterator[str]:
    """Parts of at least `size` characters, cut only where no match of the pattern can cross."""
    start = 0
    while len(text) - start > size:
        cut = _SAFE.search(text, start + size)
        if cut is None:
            break
        yield text[start : cut.start()]
        start = cut.start()
    if start < len(text):
        yield text[start:]


def parts(text: str, special: Iterable[str] = (), size: int = CHUNK) -> Iterator[tuple[str, bool]]:
    """(part, is one match) of a text: chunks, and runs of more than `size` white space.

    The library's regex fails on a run of hundreds of thousands of blanks.  The pattern takes all of
    it, less the last character if a character follows that is neither white space nor of `special`.
    """
    start = 0
    for run in re.finditer(f"{_BLANKS}{{{size + 1},}}", text) if len(text) > size else ():
        end = run.end()
        if end < len(text) and not any(text.startswith(s, end) for s in special):
            end -= 1
        yield from ((c, False) for c in chunks(text[start : run.start()], size))
        yield text[run.start() : end], True
        start = end
    yield from ((c, False) for c in chunks(text[start:], size))


def encode_text(bpe, text: str, size: int = CHUNK) -> Iterator[list[int]]:
    """Ids of a text without special tokens, a list for each part."""
    for part, whole in parts(text, size=size):
        # A match goes to the library as bytes of one piece, past its regex.
        yield bpe._encode_single_piece(part) if whole else bpe.encode_ordinary(part)


def _digests(rank_file: str, pattern: str):
    def start():
        bpe = encoding(rank_file, pattern)
        names = [str(i) for i in range(bpe.n_vocab)]

        def work(texts: list[str]) -> dict[str, list]:
            made = {"n_tokens": [], "ids_sha256": [], "decoded_sha256": []}
            for text in texts:
                n, of_ids, of_bytes = 0, hashlib.sha256(), hashlib.sha256()
                for ids in encode_text(bpe, text):
                    if n:
                        of_ids.update(b",")
                    of_ids.update(",".join([names[i] for i in ids]).encode())
                    of_bytes.update(bpe.decode_bytes(ids))
                    n += len(ids)
                made["n_tokens"].append(n)
                made["ids_sha256"].append(of_ids.hexdigest())
                made["decoded_sha256"].append(of_bytes.hexdigest())
            return made

        return work

    return start


def encode(
    docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id and ids (array) of every row's whole text; a null text is empty, an empty one has no ids."""

    def start():
        bpe = encoding(rank_file, pattern)
        return lambda texts: {"ids": [[i for ids in encode_text(bpe, t) for i in ids] for t in texts]}

    return derive(documents(docs, id_col, text_col), start, "ids array<int>")


def decode(encoded: DataFrame, rank_file: str, pattern: str) -> DataFrame:
    """doc_id and the raw bytes of each row's `ids`; null ids give null, no ids give no bytes."""

    def start():
        bpe = encoding(rank_file, pattern)
        return lambda rows: {"bytes": [None if ids is None else bpe.decode_bytes(ids) for ids in rows]}

    return derive(encoded, start, "bytes binary", text_col="ids")


def round_trip(
    docs: DataFrame, rank_file: str, pattern: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256 of every row's whole text.

    Null and empty texts have no ids (both digests are those of no bytes); texts of any length are
    encoded in chunks that end at safe boundaries; repeated rows each give a row; an empty table gives
    none; further columns are ignored.
    """
    schema = "n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    return derive(documents(docs, id_col, text_col), _digests(rank_file, pattern), schema)
