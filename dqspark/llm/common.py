"""Helpers shared by the operators of this subpackage.

Texts reach Python as Arrow batches; their UTF-8 buffers are read as numpy
byte arrays without a copy per document.  Batches are cut into groups of
documents of about ``GROUP_BYTES`` so that the working arrays stay small
whatever the batch holds (one document is never split here, so a group holds
at least one whole text).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqspark.session import ship_package
from dqspark.session import written as materialize  # noqa: F401

GROUP_BYTES = 1 << 20
ARROW_ROWS = 1000

_BASE = 0x9E3779B97F4A7C15          # odd, so invertible modulo 2**64
_POW = np.ones(1, np.uint64)
_INV = np.ones(1, np.uint64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def prepare(spark: SparkSession) -> None:
    """Ship the package to executors and keep Arrow batches of long texts small."""
    ship_package(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fold(column: str, k: int):
    """crc32 of the id as text, modulo ``k`` (0 for a null id)."""
    return F.coalesce(F.crc32(F.col(column).cast("string").cast("binary")), F.lit(0)) % k


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Tables of at least ``n`` powers of the base and of its inverse modulo 2**64."""
    global _POW, _INV
    if len(_POW) < n:
        size = 1 << max(12, (n - 1).bit_length())
        base, inv = np.uint64(_BASE), np.uint64(pow(_BASE, -1, 1 << 64))
        for name, b in (("_POW", base), ("_INV", inv)):
            t = np.full(size, b, np.uint64)
            t[0] = 1
            np.multiply.accumulate(t, out=t)
            globals()[name] = t
    return _POW, _INV


def mix64(x: np.ndarray) -> np.ndarray:
    """A finalizer that spreads every input bit over all 64 output bits."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the n + 1 offsets of its rows (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    if column.null_count:
        column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    _, offsets, data = column.buffers()
    if offsets is None or len(column) == 0:
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[
        column.offset:column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[at[0]:at[-1]], at - at[0]


def groups(offsets: np.ndarray, limit: int = GROUP_BYTES):
    """Row ranges (i, j) whose texts together hold about ``limit`` bytes, one row at least."""
    n, i = len(offsets) - 1, 0
    while i < n:
        j = int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1
        j = min(max(j, i + 1), n)
        yield i, j
        i = j


def words(data: np.ndarray, offsets: np.ndarray):
    """Starts, ends and rows of the words of a group.

    Words are the maximal runs outside ``[\\x20\\x09-\\x0D]`` and never cross rows.
    """
    n = len(data)
    if not n:
        z = np.zeros(0, np.int64)
        return z, z, z
    inside = ~SPACE[data]
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:n]
    end = inside.copy()
    end[:-1] &= ~inside[1:] | edge[1:n]
    s, e = np.flatnonzero(start), np.flatnonzero(end) + 1
    return s, e, np.searchsorted(offsets, s, side="right") - 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans from one prefix array of a polynomial modulo 2**64."""
    pw, inv = powers(len(data) + 1)
    prefix = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * pw[:len(data)], out=prefix[1:])
    h = (prefix[ends] - prefix[starts]) * inv[starts]
    return mix64(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def possibly_in(rows: DataFrame, ids: DataFrame, column: str, bits: int) -> tuple[DataFrame, str]:
    """``rows`` with a flag, and its name: false where ``column`` is surely not in ``ids`` (a column of that name).

    Ids are hashed to a filter of ``bits`` bits, ``bits / 64`` rows of two
    numbers at most, which is broadcast; the rows aren't shuffled.  The flag
    is true for all that are in ``ids`` and for some others, more as the
    filter fills up.
    """
    flag, h, part, mask = (fresh(rows, n) for n in ("possibly", "filter_hash", "filter_part", "filter_mask"))
    number = F.pmod(F.xxhash64(column), F.lit(bits))
    parts = (ids.select(number.alias("h")).selectExpr(f"h div 64 as {part}", "shiftleft(1L, int(h % 64)) as bit")
             .groupBy(part).agg(F.bit_or("bit").alias(mask)))
    hashed = rows.withColumn(h, number).withColumn(part, F.expr(f"{h} div 64"))
    return (hashed.join(F.broadcast(parts), part, "left")
            .select(*rows.columns, F.expr(f"coalesce(shiftright({mask}, int({h} % 64)) & 1, 0) = 1").alias(flag)), flag)


def rows_in(rows: DataFrame, ids: DataFrame, column: str, bits: int) -> DataFrame:
    """The rows whose ``column`` is in ``ids``; most others are dropped before the shuffle."""
    flagged, flag = possibly_in(rows, ids, column, bits)
    return flagged.where(F.col(flag)).drop(flag).join(ids, column, "left_semi")


def rows_not_in(rows: DataFrame, ids: DataFrame, column: str, bits: int) -> DataFrame:
    """The rows whose ``column`` isn't in ``ids`` (null stays); most aren't shuffled."""
    flagged, flag = possibly_in(rows, ids, column, bits)
    return (flagged.where(~F.col(flag)).drop(flag)
            .unionByName(flagged.where(F.col(flag)).drop(flag).join(ids, column, "left_anti")))


def bitmap(rows: DataFrame, position, bits: int) -> np.ndarray:
    """``bits / 64`` words with the bit at ``position`` (0 to bits - 1, a column) of every row set.

    A filter of fixed size: ``bits / 8`` bytes reach the driver, whatever the number of rows.
    """
    parts = (rows.select(position.alias("h")).selectExpr("h div 64 as part", "shiftleft(1L, int(h % 64)) as bit")
             .groupBy("part").agg(F.bit_or("bit").alias("mask")).toArrow())
    out = np.zeros(bits // 64, np.int64)
    out[parts["part"].to_numpy()] = parts["mask"].to_numpy()
    return out.view(np.uint64)


def marked(filter_words: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Whether the bit at each of the places (unsigned) is set."""
    return (filter_words[at >> np.uint64(6)] >> (at & np.uint64(63))) & np.uint64(1) == 1
