"""Exact token-sort similarity (Indel / LCS based).

``score = 200 * lcs(a, b) / (len(a) + len(b))`` on token-sorted strings,
which equals ``100 * (1 - indel / (len(a) + len(b)))``.  The LCS length is
computed with the bit-parallel recurrence ``V = (V + (V & M)) | (V & ~M)``
over Python integers, inside an Arrow-batched pandas UDF; it only runs on
candidate pairs that passed the built-in filters.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T


def lcs_length(a: str, b: str) -> int:
    if not a or not b:
        return 0
    if len(a) < len(b):
        a, b = b, a
    masks: dict[str, int] = {}
    for i, ch in enumerate(a):
        masks[ch] = masks.get(ch, 0) | (1 << i)
    full = (1 << len(a)) - 1
    v = full
    for ch in b:
        m = masks.get(ch)
        if m is None:
            continue
        u = v & m
        v = ((v + u) | (v - u)) & full
    return len(a) - bin(v).count("1")


def lcs_length_dp(a: str, b: str) -> int:
    """Textbook dynamic program, used as the brute-force reference in tests."""
    prev = [0] * (len(b) + 1)
    for ch in a:
        cur = [0]
        for j, bj in enumerate(b):
            cur.append(prev[j] + 1 if ch == bj else max(prev[j + 1], cur[j]))
        prev = cur
    return prev[-1]


@F.pandas_udf(T.IntegerType())
def lcs_udf(a: pd.Series, b: pd.Series) -> pd.Series:
    return pd.Series([lcs_length(x, y) for x, y in zip(a, b)], dtype="int32")


def similarity_from_lcs(lcs, la, lb):
    """Column: ``200 * lcs / (la + lb)`` rounded half-even to one decimal."""
    total = la + lb
    return F.when(total == 0, F.lit(100.0)).otherwise(
        F.bround(F.lit(200.0) * lcs / total, 1))
