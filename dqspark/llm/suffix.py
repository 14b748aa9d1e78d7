"""Removal of repeated byte strings with suffix arrays.

Every byte covered by a ``SPAN``-byte string that starts at another place too
(in any document, the same one included) is removed.

1. *Anchors.*  Among the 32-byte grams of each SPAN-byte window the one with
   the smallest hash (leftmost on ties) is the window's anchor.  It depends on
   the window's bytes alone, so equal windows have equal anchors, at equal
   places.  Neighbouring windows share anchors: one row stands for a run of
   about 85 windows, and only grams that are the anchor of two places or more
   can belong to repeated windows.
2. *Equal bodies.*  Runs with equal anchor and equal bytes are repeated as a
   whole.  One of each such class goes on with the runs that have an anchor in
   common but differ in bytes.
3. *Shards.*  The bytes of those runs, joined to shards of a few MB by anchor,
   get a suffix array by Larsson-Sadakane refinement (only groups of suffixes
   not yet told apart are sorted again, by the ranks of the suffixes ``h``
   further on) and common prefixes by Kasai's inequality (a suffix shares at
   most one byte less than the one before it, so lengths are compared from a
   sample of positions on).  Neighbours with SPAN bytes in common are repeated.
4. *Across shards.*  An anchor with more than ``HOT`` different runs is dealt
   to several shards.  Each of them publishes its distinct windows of that
   anchor by digest; Spark orders the digests over the cluster and equal ones
   from different shards are repeated.
5. Removed ranges are gathered per text and cut out.

Texts are identified by a digest of their bytes.  A text of SPAN bytes or more
that occurs twice is removed as a whole; it still stands as one place for all
others.

Defined results: a null text is empty; texts under SPAN bytes lose nothing;
repeated rows are copies of each other whatever their id; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqspark.llm.common import (groups, materialize, mix64, possibly_in, powers, prepare, rows_in, shuffle_partitions,
                                span_hashes, utf8)

SPAN = 200
GRAM = 32
WIDTH = SPAN - GRAM + 1     # grams in a window
HOT = 4096                  # different runs of one anchor in one shard
SHARD_ROWS = 4096           # runs in a shard, about
SAMPLE = 32                 # every so many positions start a comparison of common prefixes
FILTER_BITS = 1 << 24       # of the membership filter: 262,144 rows of two numbers at most

_LOW = np.uint64(0xFFFFFFFF)


def anchors(data: np.ndarray, offsets: np.ndarray):
    """Runs of windows with one anchor: gram hash, row, first and last window start in the row, anchor's place."""
    n = len(data)
    none = np.zeros(0, np.int64)
    if n < SPAN:
        return none.astype(np.uint64), none, none, none, none
    pw, inv = powers(n + 1)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * pw[:n], out=prefix[1:])
    m = n - GRAM + 1
    gram = mix64((prefix[GRAM:] - prefix[:m]) * inv[:m])
    packed = (gram & ~_LOW) | np.arange(m, dtype=np.uint64)
    size = -(-m // WIDTH) * WIDTH
    block = np.full(size, np.uint64(0xFFFFFFFFFFFFFFFF))
    block[:m] = packed
    block = block.reshape(-1, WIDTH)
    forward = np.minimum.accumulate(block, axis=1).reshape(-1)
    backward = np.minimum.accumulate(block[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    last = n - SPAN + 1
    best = (np.minimum(backward[:last], forward[WIDTH - 1:WIDTH - 1 + last]) & _LOW).astype(np.int64)
    valid = np.zeros(n + 1, np.int32)
    long = np.flatnonzero(np.diff(offsets) >= SPAN)
    valid[offsets[long]] += 1
    valid[offsets[long + 1] - SPAN + 1] -= 1
    valid = np.cumsum(valid)[:last] > 0
    change = np.ones(last + 1, bool)
    change[1:-1] = (best[1:] != best[:-1]) | (valid[1:] != valid[:-1])
    edge = offsets[(offsets > 0) & (offsets < last)]
    change[edge] = True
    begin = np.flatnonzero(change)
    begin, end = begin[:-1], begin[1:] - 1
    ok = valid[begin]
    begin, end = begin[ok], end[ok]
    place = best[begin]
    row = np.searchsorted(offsets, begin, side="right") - 1
    return gram[place], row, begin - offsets[row], end - offsets[row], place - offsets[row]


def _place(keys: np.ndarray, row: np.ndarray, low: np.ndarray) -> np.ndarray:
    """A 64-bit name of a place: text and start."""
    return mix64(keys[row] ^ mix64(low.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))).view(np.int64)


def _key_words(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(k[:8] for k in column.to_pylist()), np.uint64)


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = _key_words(batch.column(0))
        data, offsets = utf8(batch.column(1))
        for i, j in groups(offsets):
            gram, row, low, _, _ = anchors(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
            yield pa.RecordBatch.from_arrays([pa.array(gram.view(np.int64)), pa.array(_place(keys[i:j], row, low))],
                                             names=["anchor", "place"])


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = _key_words(batch.column(0))
        data, offsets = utf8(batch.column(1))
        for i, j in groups(offsets):
            piece, at = data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]
            gram, row, low, high, _ = anchors(piece, at)
            body = span_hashes(piece, at[row] + low, at[row] + high + SPAN) if len(row) else gram
            yield pa.RecordBatch.from_arrays(
                [pa.array(gram.view(np.int64)), pa.array(body.view(np.int64)), batch.column(0).take(pa.array(row + i)),
                 pa.array(low.astype(np.int32)), pa.array(high.astype(np.int32)),
                 pa.array(_place(keys[i:j], row, low))],
                names=["anchor", "body", "key", "low", "high", "place"])


def _words(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each position on as a big-endian number (zeros after the end)."""
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    return np.lib.stride_tricks.as_strided(padded.view(np.uint8), (len(data), 8), (1, 1)).copy().view(">u8")[:, 0] \
        .astype(np.uint64)


def suffix_array(data: np.ndarray) -> np.ndarray:
    """Positions in the order of the suffixes that begin there."""
    n = len(data)
    first = _words(data)
    order = np.argsort(first, kind="stable")
    lead = np.ones(n, bool)
    lead[1:] = first[order][1:] != first[order][:-1]
    leader = np.maximum.accumulate(np.where(lead, np.arange(n), 0))
    rank = np.zeros(n + 1, np.int64)
    rank[order] = leader + 1                    # 0 is left for what lies after the end
    h = 8
    while True:
        at = rank[order]
        tied = np.zeros(n, bool)
        tied[1:] = at[1:] == at[:-1]
        tied[:-1] |= tied[1:]
        slots = np.flatnonzero(tied)
        if not len(slots):
            break
        items = order[slots]
        key = (at[slots] << 32) | rank[np.minimum(items + h, n)]
        by = np.argsort(key, kind="stable")
        items, key = items[by], key[by]
        lead = np.ones(len(slots), bool)
        lead[1:] = key[1:] != key[:-1]
        order[slots] = items
        rank[items] = np.maximum.accumulate(np.where(lead, slots, 0)) + 1
        h *= 2
    return order


def common_prefixes(data: np.ndarray, order: np.ndarray, limit: int = SPAN) -> np.ndarray:
    """Lengths shared with the predecessor in ``order``, as far as ``limit`` (below it rounded down to 8).

    Positions ``SAMPLE`` apart are compared as far as ``limit + SAMPLE``; by
    Kasai's inequality each position after them shares at least one byte less
    than the one before, and only those for which that doesn't reach ``limit``
    are compared themselves.
    """
    n = len(data)
    first = _words(data)
    before = np.full(n, -1)
    before[order[1:]] = order[:-1]

    def compare(at: np.ndarray, upto: int) -> np.ndarray:
        length, live = np.zeros(len(at), np.int64), np.flatnonzero(before[at] >= 0)
        other = before[at]
        for k in range(0, upto, 8):
            i, j = at[live] + k, other[live] + k
            same = (np.maximum(i, j) + 8 <= n)
            live, i, j = live[same], i[same], j[same]
            live = live[first[i] == first[j]]
            if not len(live):
                break
            length[live] = k + 8
        return length

    shared = np.zeros(n, np.int64)
    sampled = np.arange(0, n, SAMPLE)
    shared[sampled] = compare(sampled, limit + SAMPLE)
    at = np.arange(n)
    shared = np.maximum(shared, np.maximum.accumulate(shared + at) - at)
    rest = np.flatnonzero(shared < limit)
    shared[rest] = np.maximum(shared[rest], compare(rest, limit))
    out = shared[order]
    out[0] = 0
    return np.minimum(out, limit)


def repeated_windows(pieces: list[bytes]) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For the SPAN-byte windows of each piece: occurs twice among all pieces; is the first of its kind."""
    data = np.frombuffer(b"".join(pieces), np.uint8)
    cut = np.cumsum([0, *map(len, pieces)])
    starts = np.concatenate([np.arange(a, b - SPAN + 1) for a, b in zip(cut[:-1], cut[1:], strict=True)])
    is_start = np.zeros(len(data), bool)
    is_start[starts] = True
    order = suffix_array(data)
    shared = common_prefixes(data, order)
    slots = np.flatnonzero(is_start[order])
    position = order[slots]
    # what two window starts share is the least of what lies between them in the order
    least = np.minimum.reduceat(shared[:slots[-1] + 1], np.append(0, slots[:-1] + 1)) if len(slots) else np.zeros(0, np.int64)
    follows = least >= SPAN
    follows[:1] = False
    twice, leads = np.zeros(len(data), bool), np.zeros(len(data), bool)
    same = follows.copy()
    same[:-1] |= follows[1:]
    twice[position[same]] = True
    leads[position[~follows]] = True
    ranges = [slice(a, max(a, b - SPAN + 1)) for a, b in zip(cut[:-1], cut[1:], strict=True)]
    return [twice[r] for r in ranges], [leads[r] for r in ranges]


RANGE = "key binary, low int, high int, digest binary"
_RANGE = pa.schema([("key", pa.binary()), ("low", pa.int32()), ("high", pa.int32()), ("digest", pa.binary())])


def _sharded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ranges of repeated window starts per run; for dealt-out anchors also digests of distinct windows."""
    held: list[tuple] = []

    def finish() -> pa.RecordBatch:
        out = []
        twice, leads = repeated_windows([r[4] for r in held])
        for (_, key, low, split, body, whole), t, lead in zip(held, twice, leads, strict=True):
            if not whole and t.any():
                step = np.diff(np.concatenate([[0], t.view(np.int8), [0]]))
                for a, b in zip(np.flatnonzero(step == 1), np.flatnonzero(step == -1), strict=True):
                    out.append((key, low + int(a), low + int(b) - 1, None))
            if split:
                for k in np.flatnonzero(lead):
                    digest = hashlib.blake2b(body[k:k + SPAN], digest_size=16).digest()
                    # a window already known to be repeated only speaks for its kind: no range of its own
                    known = whole or bool(t[k])
                    out.append((None if known else key, low + int(k), low + int(k), digest))
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), _RANGE, strict=True)]
                                          if out else [pa.array([], f.type) for f in _RANGE], schema=_RANGE)

    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and row[0] != held[0][0]:
                yield finish()
                held = []
            held.append(row)
    if held:
        yield finish()


def _bodies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the runs asked for, cut from their texts."""
    for batch in batches:
        out = []
        for key, text, wanted in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            raw = text.encode()
            for w in wanted:
                out.append((w["anchor"], key, w["low"], w["whole"], raw[w["low"]:w["high"] + SPAN]))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [()] * 5,
                                            (pa.int64(), pa.binary(), pa.int32(), pa.bool_(), pa.binary()), strict=True)],
            names=["anchor", "key", "low", "whole", "body"])


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Removed bytes, spans and digest of the rest of each text with repeated window starts."""
    for batch in batches:
        out = []
        for key, text, ranges in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            raw = text.encode()
            spans: list[list[int]] = []
            for r in sorted((r["low"], r["high"] + SPAN) for r in ranges):
                if spans and r[0] <= spans[-1][1]:
                    spans[-1][1] = max(spans[-1][1], r[1])
                else:
                    spans.append(list(r))
            rest, at = hashlib.sha256(), 0
            for a, b in spans:
                rest.update(raw[at:a])
                at = b
            rest.update(raw[at:])
            out.append((key, sum(b - a for a, b in spans), len(spans), rest.hexdigest()))
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out, strict=True) if out else [()] * 4,
                                            (pa.binary(), pa.int64(), pa.int64(), pa.string()), strict=True)],
            names=["key", "removed", "spans", "rest"])


def _texts(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """key and text of the texts in ``keys``, once each."""
    may, flag = possibly_in(rows, keys, "key", FILTER_BITS)
    return may.where(flag).groupBy("key").agg(F.first("text").alias("text")).join(keys, "key", "left_semi")


def repeated_ranges(rows: DataFrame) -> DataFrame:
    """key, low, high: ranges of window starts (of texts ``key, text``) whose window is repeated."""
    spark = rows.sparkSession
    n = shuffle_partitions(spark)
    shared = materialize(rows.mapInArrow(_places, "anchor long, place long").groupBy("anchor")
                         .agg(F.min("place").alias("a"), F.max("place").alias("b")).where("a <> b").select("anchor"),
                         "suffix-anchors")
    runs = rows.mapInArrow(_runs, "anchor long, body long, key binary, low int, high int, place long")
    runs = materialize(rows_in(runs, shared, "anchor", FILTER_BITS), "suffix-runs")
    classes = materialize(runs.groupBy("anchor", "body").agg(
        (F.min("place") != F.max("place")).alias("whole"), F.min("place").alias("rep")), "suffix-classes")
    several = materialize(classes.groupBy("anchor").agg(F.count("*").alias("kinds")).where("kinds > 1"),
                          "suffix-several")
    tagged = runs.join(classes, ["anchor", "body"])
    ranges = tagged.where("whole").select("key", "low", "high")
    # copies of one text name the same places: one row of each is enough
    wanted = (tagged.where("place = rep").dropDuplicates(["anchor", "body"])
              .join(several, "anchor").select("anchor", "kinds", "key", "low", "high", "whole"))
    wanted = materialize(wanted, "suffix-wanted")
    total = wanted.count()
    shards = max(1, total // SHARD_ROWS)
    per_text = wanted.groupBy("key").agg(F.collect_list(F.struct("anchor", "low", "high", "whole")).alias("wanted"))
    bodies = (_texts(rows, wanted.select("key").distinct()).join(per_text, "key").select("key", "text", "wanted")
              .mapInArrow(_bodies, "anchor long, key binary, low int, whole boolean, body binary"))
    hot = several.where(F.col("kinds") > HOT).select("anchor", "kinds")
    part = F.pmod(F.xxhash64("key", "low"), F.ceil(F.col("kinds") / HOT))
    dealt = (bodies.join(hot, "anchor", "left")
             .withColumn("shard", F.when(F.col("kinds").isNull(), F.pmod(F.xxhash64("anchor"), F.lit(shards)))
                         .otherwise(F.xxhash64("anchor", part)))
             .select("shard", "key", "low", F.col("kinds").isNotNull().alias("split"), "body", "whole"))
    found = materialize(dealt.repartition(n, "shard").sortWithinPartitions("shard").mapInArrow(_sharded, RANGE),
                        "suffix-found")
    published = found.where("digest is not null")
    again = published.groupBy("digest").count().where("count > 1").select("digest")
    across = published.where("key is not null").join(again, "digest", "left_semi")
    names = ["key", "low", "high"]
    return (ranges.unionByName(found.where("digest is null").select(*names))
            .unionByName(across.select(*names)))


def remove_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every document."""
    prepare(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    sha = F.sha2(text.cast("binary"), 256)
    rows = docs.select("doc_id", text.alias("text"), sha.alias("sha")) \
        .withColumn("key", F.unhex(F.substring("sha", 1, 32)))
    slim = materialize(rows.select("doc_id", "key", "sha", F.octet_length("text").cast("long").alias("n_bytes")),
                       "suffix-texts")
    copied = materialize(slim.where(F.col("n_bytes") >= SPAN).groupBy("key").count().where("count > 1")
                         .select("key", F.lit(True).alias("copied")), "suffix-copied")
    ranges = materialize(repeated_ranges(rows.select("key", "text")).join(copied, "key", "left_anti"), "suffix-ranges")
    per_text = ranges.groupBy("key").agg(F.collect_set(F.struct("low", "high")).alias("ranges"))
    cut = materialize(_texts(rows.select("key", "text"), ranges.select("key").distinct())
                      .join(per_text, "key").select("key", "text", "ranges")
                      .mapInArrow(_cut, "key binary, removed long, spans long, rest string"), "suffix-cut")
    return (slim.join(copied, "key", "left").join(cut, "key", "left")
            .select("doc_id", "n_bytes",
                    F.when(F.col("copied"), F.col("n_bytes")).otherwise(F.coalesce("removed", F.lit(0))).alias("n_removed"),
                    F.when(F.col("copied"), F.lit(1)).otherwise(F.coalesce("spans", F.lit(0))).cast("long").alias("n_spans"),
                    F.when(F.col("copied"), F.lit(hashlib.sha256(b"").hexdigest()))
                    .otherwise(F.coalesce("rest", "sha")).alias("kept_sha256")))


ORACLE = r"""
with d as (select row_number() over () as r, doc_id, hex(encode(coalesce(text, ''))) as h, strlen(coalesce(text, '')) as n,
                  sha256(coalesce(text, '')) as whole from documents),
piece as (select r, n, s, substr(h, 2 * s - 1, 898) as t from (select r, h, n, unnest(range(1, n - 198, 250)) as s from d where n >= 200)),
k as (select r, s + q as p, md5(substr(t, 2 * q + 1, 400)) as m
      from (select r, s, t, unnest(range(0, least(250, n - 198 - s))) as q from piece)),
rep as (select r, p from k join (select m from k group by m having count(*) > 1) using (m)),
g as (select r, p, sum(case when p <= prev + 200 then 0 else 1 end) over (partition by r order by p) as grp
      from (select r, p, lag(p) over (partition by r order by p) as prev from rep)),
spans as (select r, min(p) as a, max(p) + 200 as z from g group by r, grp),
cut as (select r, a, z, coalesce(lag(z) over (partition by r order by a), 1) as b from spans),
kept as (select r, count(*) as n_spans, sum(z - a)::bigint as n_removed,
                string_agg(substr(h, 2 * b - 1, 2 * (a - b)), '' order by a) || substr(any_value(h), 2 * max(z) - 1) as rest
         from cut join d using (r) group by r)
select doc_id, n as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
       case when rest is null then whole else sha256(unhex(rest)) end as kept_sha256
from d left join kept using (r)
"""
