"""Cross-column consistency: values of one column expected inside another."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqspark.functions import text as tx


def not_contained(df: DataFrame, key: str, a: str, b: str) -> DataFrame:
    """Distinct ``(key, a, b)`` rows where upper/stripped ``a`` is not a
    substring of upper/stripped ``b``; a null on either side is not flagged."""
    cond = ~F.upper(tx.ws_strip(b)).contains(F.upper(tx.ws_strip(a)))
    cols = list(dict.fromkeys([key, a, b]))
    return df.where(F.col(a).isNotNull() & F.col(b).isNotNull() & cond).select(*cols).distinct()
