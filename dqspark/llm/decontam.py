"""Benchmark passages in documents, found up to edits.

Texts are compared as bytes with A-Z in lower case and every run of other
ASCII characters than letters and digits as one space.  A passage counts as
leaked where a document holds its bytes with at most one edit for each full
``RATE`` bytes (insertion, deletion, replacement), whatever its size.

The CGK walk maps a string to a longer one: at step ``t`` it emits the byte
under its pointer and moves on if a random bit of (t, byte) is 1.  Two strings
a few edits apart soon walk in step again, so their images differ in few
places and edit distance becomes Hamming distance: at one edit in ten bytes
images of 400 bytes still agree in 0.4 of their places, unrelated ones in 0.11.
``WALKS`` independent walks are sampled in keys of ``KEYS`` places; an
item-sized window is a candidate for an item if any of its keys equals the
item's.  Keys are longer for short items, whose images agree in more places.
Candidates are verified by the exact edit distance.

Not every window need be walked: k edits hit at most k of an item's p disjoint
pieces (8 bytes; fewer where an item would have no more pieces than edits), so
a match holds p - k of them, each at most k bytes off its place; only windows
with so many pieces are walked.  That rules out no match.  Of items over
``WALKED`` bytes the walk compares that many from the first piece on that
stands exactly in its place.

The benchmark is shipped to the tasks in blocks of ``BLOCK_BYTES`` at most (one
pass over the documents per block); an index holds the texts and their pieces,
a few times their bytes.

Defined results: null or empty texts hold nothing; items without a letter, a digit
or a byte beyond ASCII (or null) are never found; items under 10 normalised bytes
are found where they stand exactly, also within longer words; a document without
an id is checked like any other; equal items are each reported; an empty benchmark
finds nothing; other columns are kept by ``clean`` and ignored by ``leaks``.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqspark.llm.common import groups, prepare, utf8

RATE = 10                   # bytes of an item per edit
PIECE = 8
WALKED = 512                # bytes of a window that are walked
WALKS = 8
KEYS = ((60, 12, 250), (150, 10, 1000), (WALKED + 1, 8, 1000))     # sizes below: places of a key, keys of a walk
BLOCK_BYTES = 8 << 20
SCAN_BYTES = 4 << 20
WALK_ROWS = 256             # windows walked at once

_MUL = np.uint64(0x9E3779B97F4A7C15)

_PLAIN = np.full(256, 0x20, np.uint8)
_PLAIN[128:] = np.arange(128, 256)
for _a, _b in ((48, 58), (97, 123)):
    _PLAIN[_a:_b] = np.arange(_a, _b)
_PLAIN[65:91] = np.arange(97, 123)


def normalise(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Compared bytes of the rows, their offsets, and the place of each byte in ``data``."""
    c = _PLAIN[data]
    blank = c == 0x20
    before = np.ones(len(c), bool)
    before[1:] = blank[:-1]
    before[offsets[:-1][offsets[:-1] < len(c)]] = True
    keep = np.flatnonzero(~blank | ~before)
    return c[keep], np.searchsorted(keep, offsets), keep


def normalised(text: str | None) -> bytes:
    raw = np.frombuffer((text or "").encode(), np.uint8)
    return normalise(raw, np.array([0, len(raw)]))[0].tobytes().rstrip(b" ")


def edit_distance_within(pattern: bytes, text: bytes, most: int) -> int | None:
    """Smallest edit distance of ``pattern`` to any part of ``text``, if ``most`` or less (bit-parallel)."""
    m = len(pattern)
    mask, top = (1 << m) - 1, 1 << (m - 1)
    where: dict[int, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        where[c] |= 1 << i
    up, down, score, best = mask, 0, m, m
    for c in text:
        eq = where.get(c, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        plus, minus = down | (~(diagonal | up) & mask), up & diagonal
        if plus & top:
            score += 1
        elif minus & top:
            score -= 1
        best = min(best, score)
        plus, minus = (plus << 1) & mask, (minus << 1) & mask
        up, down = minus | (~(diagonal | plus) & mask), plus & diagonal
    return best if best <= most else None


@cache
def _moves(seed: int = 11) -> np.ndarray:
    """Whether a walk moves on at a step (step, walk, byte)."""
    return np.random.default_rng(seed).integers(0, 2, (2 * WALKED, WALKS, 256), np.int8)


@cache
def _places(bits: int, keys: int, seed: int = 12) -> np.ndarray:
    """Sampled places of the images, in shares of their length (walk, key, place)."""
    return np.random.default_rng(seed).random((WALKS, keys, bits)) * 0.95


def walks(texts: list[bytes]) -> np.ndarray:
    """CGK images (text, walk, step) of texts of at most WALKED bytes, 0 after their end."""
    size = max(map(len, texts), default=0)
    padded = np.zeros((len(texts), size + 1), np.uint8)
    for i, t in enumerate(texts):
        padded[i, :len(t)] = np.frombuffer(t, np.uint8)
    at = np.zeros((len(texts), WALKS), np.int64)
    out = np.zeros((2 * size, len(texts), WALKS), np.uint8)
    row, walk = np.arange(len(texts))[:, None], np.arange(WALKS)
    for t in range(2 * size):
        out[t] = c = padded[row, at]
        at = np.minimum(at + _moves()[t][walk, c], size)
    return out.transpose(1, 2, 0)


def alike(items: list[bytes], windows: list[bytes]) -> np.ndarray:
    """Whether a key of each window's image equals that of its item (of at most WALKED bytes)."""
    out = np.zeros(len(items), bool)
    size = np.array([len(t) for t in items], np.int64)
    low = 0
    for below, bits, keys in KEYS:
        part = np.flatnonzero((size >= low) & (size < below))
        low = below
        for k in range(0, len(part), WALK_ROWS):
            left = part[k:k + WALK_ROWS]
            image, other = walks([items[i] for i in left]), walks([windows[i] for i in left])
            steps = min(image.shape[2], other.shape[2])
            same = np.zeros(image.shape, bool)
            # places after an item's end say nothing
            same[:, :, :steps] = (image[:, :, :steps] == other[:, :, :steps]) & (image[:, :, :steps] != 0)
            for w in range(WALKS):
                todo = np.flatnonzero(~out[left])
                places = (_places(bits, keys)[w].reshape(1, -1) * 2 * size[left[todo], None]).astype(np.int64)
                got = np.take_along_axis(same[todo, w], places, 1)
                out[left[todo]] = got.reshape(len(todo), keys, bits).all(2).any(1)
    return out


@dataclass
class _Pieces:
    """Pieces of one length, sorted: their bytes as numbers, items and places."""
    length: int
    value: np.ndarray
    item: np.ndarray
    offset: np.ndarray

    def __post_init__(self) -> None:
        self.mask = np.uint64((1 << 8 * self.length) - 1)
        order = np.argsort(self.value, kind="stable")
        self.value, self.item, self.offset = self.value[order], self.item[order], self.offset[order]
        bits = max(10, len(order).bit_length() + 3)
        self.shift = np.uint64(64 - bits)
        self.table = np.zeros(1 << bits, bool)
        self.table[(self.value * _MUL) >> self.shift] = True

    def hits(self, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places and pieces (by number) where the 8 bytes from a place begin with a piece."""
        value = value & self.mask
        hit = np.flatnonzero(self.table[(value * _MUL) >> self.shift])
        low = np.searchsorted(self.value, value[hit], "left")
        many = np.searchsorted(self.value, value[hit], "right") - low
        return np.repeat(hit, many), np.repeat(low, many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)


def _firsts(row: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Where each (row, item) stands first."""
    by = np.lexsort((item, row))            # stable
    new = np.ones(len(by), bool)
    new[1:] = (row[by][1:] != row[by][:-1]) | (item[by][1:] != item[by][:-1])
    return by[new]


@dataclass
class Index:
    """Items of one block and their pieces."""
    ids: list[int | None] = field(default_factory=list)
    texts: list[bytes] = field(default_factory=list)

    def build(self) -> Index:
        self.size = np.array([len(t) for t in self.texts], np.int64)
        self.most = self.size // RATE
        length = np.minimum(PIECE, self.size // (self.most + 1))
        self.need = self.size // np.maximum(length, 1) - self.most
        self.pieces = []
        for n in np.unique(length).tolist():
            found = [(t[a:a + n].ljust(PIECE, b"\0"), k, a) for k, t in enumerate(self.texts) if length[k] == n
                     for a in range(0, len(t) - n + 1, n)]
            self.pieces.append(_Pieces(n, np.frombuffer(b"".join(x[0] for x in found), "<u8"),
                                       np.array([x[1] for x in found], np.int32), np.array([x[2] for x in found], np.int32)))
        return self

    def windows(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """(row, item, start, place in the item of a piece that stands exactly there) of the windows
        that hold enough pieces of the item near their places."""
        padded = np.append(data, np.zeros(PIECE - 1, np.uint8))
        value = np.lib.stride_tricks.as_strided(padded, (len(data), PIECE), (1, 1)).copy().view("<u8")[:, 0] if len(data) \
            else np.zeros(0, np.uint64)
        out = [np.zeros((4, 0), np.int64)]
        for pieces in self.pieces:
            at, which = pieces.hits(value)
            row = np.searchsorted(offsets, at, side="right") - 1
            inside = at + pieces.length <= offsets[row + 1]
            at, which, row = at[inside], which[inside], row[inside]
            item, offset = pieces.item[which].astype(np.int64), pieces.offset[which].astype(np.int64)
            whole = self.size[item] == pieces.length        # the piece is the item: its first place says all
            first = np.flatnonzero(whole)[_firsts(row[whole], item[whole])]
            out.append(np.stack([row[first], item[first], at[first], offset[first]]))
            part = ~whole
            out.append(self._counted(row[part], item[part], at[part] - offset[part], offset[part]))
        return tuple(np.unique(np.concatenate(out, 1), axis=1))

    def _counted(self, row: np.ndarray, item: np.ndarray, start: np.ndarray, offset: np.ndarray) -> np.ndarray:
        # starts at most 2 * most apart share one of two bins twice as wide
        bins = start // (2 * self.most[item] + 1)
        row, item, offset, start = (np.concatenate([x, x]) for x in (row, item, offset, start))
        bins = np.concatenate([bins, bins - 1])
        by = np.lexsort((start, offset, bins, item, row))
        row, item, bins, offset, start = row[by], item[by], bins[by], offset[by], start[by]
        group = np.ones(len(row), bool)
        group[1:] = (row[1:] != row[:-1]) | (item[1:] != item[:-1]) | (bins[1:] != bins[:-1])
        piece = group.copy()
        piece[1:] |= offset[1:] != offset[:-1]
        number = np.cumsum(group) - 1
        first = np.flatnonzero(group)
        enough = np.bincount(number[piece], minlength=len(first)) >= self.need[item[first]]
        # the start that most pieces of a window speak for, the smaller on ties
        kept = enough[number]
        number, start, offset = number[kept], start[kept], offset[kept]
        by = np.lexsort((offset, start, number))
        number, start, offset = number[by], start[by], offset[by]
        run = np.ones(len(number), bool)
        run[1:] = (number[1:] != number[:-1]) | (start[1:] != start[:-1])
        at = np.flatnonzero(run)
        votes = np.diff(np.append(at, len(number)))
        number, start, offset = number[at], start[at], offset[at]
        by = np.lexsort((start, -votes, number))
        number, start, offset = number[by], start[by], offset[by]
        lead = np.ones(len(number), bool)
        lead[1:] = number[1:] != number[:-1]
        number, start, offset = number[lead], start[lead], offset[lead]
        return np.stack([row[first[number]], item[first[number]], start, offset])

    def find(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
        """row, item, distance and start of the leaks in normalised rows."""
        found = np.stack(self.windows(data, offsets))
        for k in range(0, found.shape[1], 16 * WALK_ROWS):
            part = found[:, k:k + 16 * WALK_ROWS].T.tolist()
            items, windows = [], []
            for row, item, start, offset in part:
                # of a long item the walk begins where the two agree
                text = self.texts[item]
                begin = min(offset, len(text) - WALKED) if len(text) > WALKED else 0
                size = min(len(text), WALKED)
                a, b = max(start + begin, int(offsets[row])), min(start + begin + size, int(offsets[row + 1]))
                items.append(text[begin:begin + size])
                windows.append(data[a:max(a, b)].tobytes())
            near = alike(items, windows)
            for (row, item, start, _), passed in zip(part, near.tolist(), strict=True):
                if not passed:
                    continue
                text, most = self.texts[item], int(self.most[item])
                a, b = int(offsets[row]), int(offsets[row + 1])
                if start >= a and data[start:min(start + len(text), b)].tobytes() == text:
                    yield row, item, 0, start
                    continue
                region = data[max(a, start - 2 * most):min(b, start + len(text) + 3 * most)].tobytes()
                distance = edit_distance_within(text, region, most)
                if distance is not None:
                    yield row, item, distance, max(a, start)


def index_of(items: list[tuple[int | None, str | None]]) -> Index:
    plain = [(item_id, normalised(text)) for item_id, text in items]
    plain = [(item_id, t) for item_id, t in plain if t]
    return Index([item_id for item_id, _ in plain], [t for _, t in plain]).build()


def _blocks(benchmark: DataFrame) -> Iterator[Index]:
    """Indexes of the benchmark's blocks, each of about BLOCK_BYTES of text at most."""
    items = benchmark.where("text is not null").select("item_id", "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-int(total) // BLOCK_BYTES)
    for b in range(blocks):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        yield index_of(sorted(((r["item_id"], r["text"]) for r in rows), key=lambda r: (r[0] is None, r)))


def _scan(index: Index, column: pa.Array) -> Iterator[tuple[int, int, int, int]]:
    """row, item, distance and byte place in the text of every leak of a batch."""
    data, offsets = utf8(column)
    for i, j in groups(offsets, SCAN_BYTES):
        base = offsets[i]
        plain, at, place = normalise(data[base:offsets[j]], offsets[i:j + 1] - base)
        for row, item, distance, start in index.find(plain, at):
            yield i + row, item, distance, int(place[start] + base - offsets[i + row])


LEAK = "doc_id long, item_id long, distance int, at long"


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, smallest distance and first byte place of every leaked item."""
    spark = docs.sparkSession
    prepare(spark)
    found = spark.createDataFrame([], LEAK)
    for index in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                best: dict[tuple, tuple[int, int]] = {}
                for row, item, distance, at in _scan(shared.value, batch.column(1)):
                    k = (row, shared.value.ids[item])
                    old = best.get(k, (distance, at))
                    best[k] = (min(old[0], distance), min(old[1], at))
                ids = batch.column(0).to_pylist()
                rows = [(ids[r], i, d, a) for (r, i), (d, a) in best.items()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [()] * 4,
                                                    (pa.int64(), pa.int64(), pa.int32(), pa.int64()), strict=True)],
                    names=["doc_id", "item_id", "distance", "at"])
        found = found.unionByName(docs.select("doc_id", "text").mapInArrow(run, LEAK))
    return found


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents without a leaked item, with their columns."""
    spark = docs.sparkSession
    prepare(spark)
    for index in _blocks(benchmark):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for row, _, _, _ in _scan(shared.value, batch.column("text")):
                    keep[row] = False
                yield batch.filter(pa.array(keep))
        docs = docs.mapInArrow(run, docs.schema)
    return docs
