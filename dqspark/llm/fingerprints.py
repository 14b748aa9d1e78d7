"""Document fingerprints from prefix polynomial hashes.

For the code points ``c`` of a text, the prefix array ``H[i] = sum c[j] * b**j
(j < i)`` modulo ``2**31 - 1`` is kept for two bases.  The hash of any span is
``(H[j] - H[i]) * b**-i``, so equality of two spans of any texts takes constant
time and the longest common extension of two positions a binary search.  An
edit that keeps a prefix keeps its part of the array.

A fingerprint is ``length-hash-sketch``: the code point count, the hash of the
whole text and the ``SKETCH`` smallest distinct values among the mixed hashes
of all ``WINDOW`` code point spans (one span for shorter texts).  The likeness
of two fingerprints is the share of common values among the smallest of their
union, an estimate of the Jaccard index of the two texts' spans (exact when
both have at most ``SKETCH``).

``edited_pairs`` walks the documents by falling id.  They are range
partitioned by id, so each partition is a run of that order; only its last
document needs the first one of the next run.

Defined results: a null text is empty; two empty texts have likeness 1, an
empty and another 0; documents without an id come last; equal ids go by a hash
of the text; one document alone is its own next; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dqspark.llm.common import materialize, mix64, prepare, shuffle_partitions

P = np.uint64((1 << 31) - 1)
BASES = (1_000_003, 1_618_033_988)
WINDOW = 32
SKETCH = 64
BLOCK = 1 << 18             # spans hashed at once

_INVERSE = {b: pow(b, -1, int(P)) for b in BASES}
_TABLES: dict[int, np.ndarray] = {b: np.ones(1, np.uint64) for b in (*BASES, *_INVERSE.values())}
_S31 = np.uint64(31)


def _reduce(x: np.ndarray) -> np.ndarray:
    """Modulo 2**31 - 1, for values below 2**64."""
    x = (x & P) + (x >> _S31)
    x = (x & P) + (x >> _S31)
    x -= P * (x >= P)
    return x


def _powers(base: int, n: int) -> np.ndarray:
    t = _TABLES[base]
    while len(t) < n:
        step = np.uint64(pow(base, len(t), int(P)))
        t = _TABLES[base] = np.concatenate([t, _reduce(t * step)])
    return t


def code_points(text: str | None) -> np.ndarray:
    return np.frombuffer((text or "").encode("utf-32-le", "surrogatepass"), np.uint32)


class PrefixHash:
    """Prefix arrays of one text."""

    def __init__(self, codes: np.ndarray, head: PrefixHash | None = None, cut: int = 0):
        """With ``head``: the arrays of its first ``cut`` code points followed by ``codes``."""
        self.n = cut + len(codes)
        self.h = []
        for k, base in enumerate(BASES):
            part = np.empty(self.n + 1, np.uint64)
            part[:cut + 1] = head.h[k][:cut + 1] if head else 0
            if len(codes):
                terms = _reduce((codes.astype(np.uint64) + np.uint64(1)) * _powers(base, self.n)[cut:self.n])
                part[cut + 1:] = _reduce(np.cumsum(terms) + part[cut])
            self.h.append(part)

    def spans(self, i, j) -> np.ndarray:
        """62-bit hashes of the spans [i, j), equal for equal spans of any texts."""
        out = []
        for base, h in zip(BASES, self.h, strict=True):
            inverse = _powers(_INVERSE[base], self.n + 1)
            out.append(_reduce(_reduce(h[j] + P - h[i]) * inverse[i]))
        return (out[0] << _S31) | out[1]

    def span(self, i: int, j: int) -> int:
        """The hash of one span, as by ``spans``."""
        p, out = int(P), 0
        for base, h in zip(BASES, self.h, strict=True):
            out = out << 31 | (int(h[j]) - int(h[i])) * int(_powers(_INVERSE[base], self.n + 1)[i]) % p
        return out


def common_extension(a: PrefixHash, i: int, b: PrefixHash, j: int) -> int:
    """Length of the longest common extension of position i of a and j of b."""
    low, high = 0, min(a.n - i, b.n - j)
    while low < high:
        mid = (low + high + 1) // 2
        if a.span(i, i + mid) == b.span(j, j + mid):
            low = mid
        else:
            high = mid - 1
    return low


def window_values(p: PrefixHash, first: int = 0) -> np.ndarray:
    """Mixed 32-bit values of the windows that start at ``first`` or later."""
    if p.n == 0:
        return np.zeros(0, np.uint32)
    if p.n < WINDOW:
        return (mix64(p.spans(np.array([0]), np.array([p.n]))) >> np.uint64(32)).astype(np.uint32)
    last = p.n - WINDOW + 1
    out = np.empty(max(0, last - first), np.uint32)
    for s in range(first, last, BLOCK):
        at = np.arange(s, min(s + BLOCK, last))
        out[s - first:s - first + len(at)] = mix64(p.spans(at, at + WINDOW)) >> np.uint64(32)
    return out


def _distinct(values: np.ndarray) -> np.ndarray:
    values = np.sort(values)
    return values[np.append(True, values[1:] != values[:-1])] if len(values) else values


def smallest(values: np.ndarray, k: int = SKETCH) -> np.ndarray:
    """The k smallest distinct values, sorted."""
    if len(values) > 4 * k:
        low = _distinct(np.partition(values, 4 * k)[:4 * k])
        if len(low) >= k:
            return low[:k]
    return _distinct(values)[:k]


def pack(sketch: np.ndarray) -> str:
    """Differences of the sorted values in as few bytes each as the largest needs, after that number."""
    steps = np.diff(sketch.astype("<u4"), prepend=np.uint32(0)).astype("<u4")
    width = (int(steps.max(initial=1)).bit_length() + 7) // 8
    return f"{width}{base64.b64encode(steps.view(np.uint8).reshape(-1, 4)[:, :width].tobytes()).decode()}"


def unpack(packed: str) -> np.ndarray:
    raw = np.frombuffer(base64.b64decode(packed[1:]), np.uint8).reshape(-1, int(packed[0]))
    steps = np.zeros((len(raw), 4), np.uint8)
    steps[:, :raw.shape[1]] = raw
    return np.cumsum(steps.view("<u4")[:, 0], dtype=np.uint32)


def render(p: PrefixHash, sketch: np.ndarray) -> str:
    return f"{p.n}-{p.span(0, p.n):016x}-{pack(sketch)}"


def fingerprint(text: str | None) -> str:
    p = PrefixHash(code_points(text))
    return render(p, smallest(window_values(p)))


def _likeness(a: np.ndarray, b: np.ndarray) -> float:
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate([a, b]))
    union = _distinct(both)[:SKETCH]
    common = both[1:][both[1:] == both[:-1]]
    return float((common <= union[-1]).sum() / len(union))


def likeness(a: str, b: str) -> float:
    """Likeness of two fingerprints, 0 to 1."""
    return _likeness(*(unpack(x.split("-")[2]) for x in (a, b)))


class _Doc:
    def __init__(self, doc_id, text):
        self.id, self.text = doc_id, text or ""
        self.codes = code_points(text)
        self.prefix = PrefixHash(self.codes)
        self.values = window_values(self.prefix)
        self.sketch = smallest(self.values)

    def row(self, following: _Doc) -> tuple:
        """The result of this document, given the next one."""
        n = len(self.codes)
        third = n // 3
        cut = n - third
        text = self.text[:cut] + following.text[:third]
        edited = PrefixHash(following.codes[:third], self.prefix, cut)
        if edited.n < WINDOW or n < WINDOW:
            values = window_values(edited)
        else:
            kept = max(0, cut - WINDOW + 1)
            values = np.concatenate([self.values[:kept], window_values(edited, kept)])
        sketch = smallest(values)
        return (self.id, n, hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest(),
                render(self.prefix, self.sketch), render(edited, sketch),
                _likeness(self.sketch, sketch), _likeness(self.sketch, following.sketch),
                common_extension(self.prefix, 0, edited, 0))


RESULT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
          "near_edited double, near_next double, common_prefix long")
_FIELDS = [pa.field("doc_id", pa.int64()), pa.field("n_chars", pa.int64()), pa.field("edited_sha256", pa.string()),
           pa.field("fingerprint", pa.string()), pa.field("edited_fingerprint", pa.string()),
           pa.field("near_edited", pa.float64()), pa.field("near_next", pa.float64()),
           pa.field("common_prefix", pa.int64())]
_ARROW = pa.schema(_FIELDS)
_ENDS = pa.schema([*_FIELDS, pa.field("kind", pa.string()), pa.field("run", pa.int32()), pa.field("text", pa.string())])
EMPTY = (None,) * len(_FIELDS)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def _walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of all but the last document of a run; its two ends with their texts."""
    run, previous = TaskContext.get().partitionId(), None
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            doc = _Doc(doc_id, text)
            if previous is None:
                rows.append((doc_id, *EMPTY[1:], "first", run, doc.text))
            else:
                rows.append((*previous.row(doc), "whole", run, None))
            previous = doc
        if rows:
            yield _batch(rows, _ENDS)
    if previous is not None:
        yield _batch([(previous.id, *EMPTY[1:], "last", run, previous.text)], _ENDS)


def _close(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Results of the last documents of the runs."""
    for batch in batches:
        rows = [_Doc(i, t).row(_Doc(None, u)) for i, t, u in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
        if rows:
            yield _batch(rows, _ARROW)


def edited_pairs(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and of its edited text (see ``op5``)."""
    spark = docs.sparkSession
    prepare(spark)
    order = [F.desc_nulls_last("doc_id"), F.asc("tie")]
    dealt = (docs.select("doc_id", "text", F.xxhash64("text").alias("tie"))
             .repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order))
    walked = materialize(dealt.select("doc_id", "text").mapInArrow(
        _walk, RESULT + ", kind string, run int, text string"), "fingerprints")
    first = walked.where("kind = 'first'").select("run", F.col("text").alias("next_text"))
    # one row per run: as many as there are partitions
    follows = first.select("run", F.coalesce(F.lead("run").over(Window.orderBy("run")),
                                             F.min("run").over(Window.partitionBy(F.lit(0)))).alias("next_run"))
    last = walked.where("kind = 'last'").select("doc_id", "text", "run")
    pairs = (last.join(follows, "run").join(first.withColumnRenamed("run", "next_run"), "next_run")
             .select("doc_id", "text", "next_text"))
    names = [f.name for f in _FIELDS]
    return walked.where("kind = 'whole'").select(*names).unionByName(pairs.mapInArrow(_close, RESULT))
