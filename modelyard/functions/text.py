"""Text normalisation and token functions for response evaluation."""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F

# The articles that answer normalisation leaves out.
ARTICLES = ("a", "an", "the")


def tokens(text: Column) -> Column:
    """Lower-cased words without punctuation and articles (the usual answer normalisation)."""
    plain = F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N} \t\n\r\f]", "")
    words = F.split(plain, r"[ \t\n\r\f]+")
    return F.filter(words, lambda w: ~w.isin("", *ARTICLES))


def lcs_length(a: Sequence[str], b: Sequence[str]) -> int:
    """Length of the longest common subsequence of whole sequences.

    One bit per element of `a`, one integer addition per element of `b`: the row of the usual
    table is kept as a bit vector, so long texts need no cut.
    """
    positions: dict[str, int] = defaultdict(int)
    for i, item in enumerate(a):
        positions[item] |= 1 << i
    mask = (1 << len(a)) - 1
    row = mask
    for item in b:
        hits = row & positions.get(item, 0)
        if hits:
            row = ((row + hits) | (row - hits)) & mask
    return len(a) - row.bit_count()


def _keys(a: pa.Array, b: pa.Array) -> tuple[np.ndarray, np.ndarray, int]:
    """row * width + token of the elements of two columns of lists, and width; in `a` and in `b` only
    elements that the other list of the row has too, in their order."""
    a_values, b_values = a.flatten(), b.flatten()
    codes = pa.concat_arrays([a_values, b_values]).dictionary_encode()
    width = max(1, len(codes.dictionary))

    def keys(lists: pa.Array, part: pa.Array) -> pa.Array:
        lengths = pc.fill_null(pc.list_value_length(lists), 0).to_numpy(zero_copy_only=False)
        return pa.array(np.repeat(np.arange(len(a), dtype=np.int64), lengths) * width + part.to_numpy(zero_copy_only=False))

    a_keys, b_keys = keys(a, codes.indices[: len(a_values)]), keys(b, codes.indices[len(a_values) :])
    # Hashes are made of the shorter side, so that the longer one is only looked through.
    if len(a_keys) < len(b_keys):
        b_keys = b_keys.filter(pc.is_in(b_keys, value_set=a_keys))
        a_keys = a_keys.filter(pc.is_in(a_keys, value_set=b_keys))
    else:
        a_keys = a_keys.filter(pc.is_in(a_keys, value_set=b_keys))
        b_keys = b_keys.filter(pc.is_in(b_keys, value_set=a_keys))
    return a_keys.to_numpy(), b_keys.to_numpy(), width


def shared_counts(a: pa.Array, b: pa.Array) -> np.ndarray:
    """Size of the multiset intersection of two token lists, for every row of a batch at once."""
    n = len(a)
    if n == 0:
        return np.zeros(0, np.int64)
    a_keys, b_keys, width = _keys(a, b)
    shared, a_counts = np.unique(a_keys, return_counts=True)
    _, b_counts = np.unique(b_keys, return_counts=True)  # the same elements
    return np.bincount(shared // width, np.minimum(a_counts, b_counts), minlength=n).astype(np.int64)


def lcs_lengths(a: pa.Array, b: pa.Array) -> np.ndarray:
    """`lcs_length` of two token lists, for every row of a batch: tokens that only one list has are left
    out for all rows at once, which changes no subsequence common to both."""
    n = len(a)
    if n == 0:
        return np.zeros(0, np.int64)
    a_keys, b_keys, width = _keys(a, b)
    a_ends, b_ends = (np.searchsorted(keys // width, np.arange(n + 1)) for keys in (a_keys, b_keys))
    a_list, b_list = a_keys.tolist(), b_keys.tolist()
    made = np.zeros(n, np.int64)
    for row in np.flatnonzero(a_ends[1:] > a_ends[:-1]):
        made[row] = lcs_length(a_list[a_ends[row] : a_ends[row + 1]], b_list[b_ends[row] : b_ends[row + 1]])
    return made
