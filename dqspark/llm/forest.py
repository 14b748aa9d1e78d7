"""Near-duplicate groups by an LSH forest of MinHash signatures.

A document is the set of its distinct word shingles (A-Z in lower case; words
are runs outside ``[\\x20\\x09-\\x0D]``; a text of fewer words is one shingle).
Documents with equal sets are one class from the start, so exact copies cost
one row.  Each class gets a signature of ``COORDS`` minima; each of ``TREES``
trees sorts the classes by its own sequence of ``DEPTH`` coordinates.  The
sorted order is range partitioned over the cluster; the candidates of a class
are its ``NEAR`` following neighbours that share a prefix of ``MIN_DEPTH``
coordinates or more.  Partitions hand the rows at their ends to one more pass,
so no neighbours are lost there.

A pair is a candidate if set sizes allow the similarity and a 4-bit sketch of
the signature doesn't speak clearly against it; candidates are confirmed on
the full sets, rebuilt from the texts.  The orders are walked twice: first
the next neighbours in ``CHAINS`` trees are confirmed, then, with the
components so far attached to the rows, all neighbours of different components, so a large group of near
copies is chained rather than paired.  Components come from ``components``.

The window counts rows, whatever their size or component, so a prefix that
more classes share isn't covered by it.  Where such a prefix still holds
several components, ``finished`` compares its classes on the full sets, with no
window and no sketch.  That work grows with the square of the classes of a
prefix outside its largest component (dealt to tasks by pairs of blocks).

A link at the threshold 0.8 shares a prefix of 3 in one tree with probability
0.51 and in none of the 16 with 1e-5.  Where a prefix is shared by few, the
sketch also rejects such a link with 1.3e-5.

Defined results: an empty text (or null) has an empty set, is linked with
nothing and is its own component; a row without an id is left alone
(component null, kept); rows with the same id are one document, linked with
whatever any of its texts is linked with; an empty table gives an empty result;
other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqspark.llm.common import (LOWER, groups, materialize, mix64, possibly_in, prepare, rows_in, rows_not_in,
                                shuffle_partitions, span_hashes, utf8, words)
from dqspark.llm.components import components

COORDS = 64
TREES = 16
DEPTH = 8
MIN_DEPTH = 3
NEAR = 16
CHAINS = 4                  # trees whose next neighbours are confirmed first
AGREE = 38                  # sketch positions of 64 that a candidate pair shares: 4.5 deviations below 0.8
FILTER_BITS = 1 << 22       # of the membership filter: 65,536 rows of two numbers at most
BLOCK_ROWS = 2048           # classes, and shingles, of a block of a crowded prefix
BLOCK_SHINGLES = 1 << 21
TOKENS = 1024               # columns of the matrices multiplied at once
SPREAD = 1 << 22            # pairs of rows counted at once

_rng = np.random.default_rng(20240607)
_MUL = _rng.integers(0, 1 << 63, COORDS, np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _rng.integers(0, 1 << 63, COORDS, np.uint64)
_ORDERS = []
for _t in range(TREES):
    _lead = np.arange(MIN_DEPTH * _t, MIN_DEPTH * _t + MIN_DEPTH)
    _ORDERS.append(np.concatenate([_lead, _rng.permutation(np.setdiff1d(np.arange(COORDS), _lead))[:DEPTH - MIN_DEPTH]]))


def _fold(h: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    x = np.full(len(at), 0x51ED270B + n, np.uint64)
    for k in range(n):
        x = mix64(x * np.uint64(0x9E3779B97F4A7C15) + h[at + k])
    return x


def shingle_sets(data: np.ndarray, offsets: np.ndarray, size: int) -> list[np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each row."""
    lower = LOWER[data]
    s, e, row = words(lower, offsets)
    h = span_hashes(lower, s, e)
    n = len(offsets) - 1
    count = np.bincount(row, minlength=n)
    first = np.searchsorted(row, np.arange(n))
    at = np.flatnonzero(row[:max(0, len(row) - size + 1)] == row[size - 1:]) if len(row) >= size else np.zeros(0, int)
    full = _fold(h, at, size)
    cut = np.searchsorted(row[at], np.arange(n + 1))
    out = [np.unique(full[cut[i]:cut[i + 1]]) for i in range(n)]
    for c in range(1, size):
        short = np.flatnonzero(count == c)
        for i, x in zip(short, _fold(h, first[short], c), strict=True):
            out[i] = np.array([x], np.uint64)
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    low = np.full(COORDS, 0xFFFFFFFF, np.uint64)
    for k in range(0, len(shingles), 2048):
        part = (shingles[k:k + 2048, None] * _MUL + _ADD) >> np.uint64(32)
        np.minimum(low, part.min(0), out=low)
    return low.astype(np.uint32)


def _set_key(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def _signed(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            counts, keys, sigs = [], [], []
            for i, j in groups(offsets):
                for x in shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], size):
                    counts.append(len(x))
                    keys.append(_set_key(x))
                    sigs.append(signature(x).tobytes() if len(x) else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64()), pa.array(keys, pa.binary()),
                                              pa.array(sigs, pa.binary())],
                                             names=["doc_id", "n_shingles", "set_key", "sig"])
    return run


ROW = ["tree", "key", "class", "n", "component", "sketch"]
ROW_TYPE = "tree int, key binary, class long, n long, component long, sketch binary"


def _grown(trees: int):
    """A row per class and tree: its key in the tree's order, its sketch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).reshape(-1, COORDS)
            nibble = (sig & np.uint32(15)).astype(np.uint8)
            sketch = [x.tobytes() for x in nibble[:, ::2] | (nibble[:, 1::2] << 4)]
            for tree, order in enumerate(_ORDERS[:trees]):
                keys = [x.tobytes() for x in sig[:, order].astype(">u4")]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(sig), tree, np.int32)),
                                                  pa.array(keys, pa.binary()), batch.column("class"),
                                                  batch.column("n_shingles"), batch.column("component"),
                                                  pa.array(sketch, pa.binary())], names=ROW)
    return run


_NIBBLES = np.uint64(0x1111111111111111)


def _agreeing(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    x = a ^ b
    x = x | (x >> np.uint64(1)) | (x >> np.uint64(2)) | (x >> np.uint64(3))
    return COORDS - np.bitwise_count(x & _NIBBLES).sum(1).astype(int)


def _pairs_of(tree, key, rep, n, component, sketch, percent: int, near: int, begin: int):
    """Candidate pairs (i, i + o) of sorted rows, o <= near, i + o >= begin."""
    left, right = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for o in range(1, near + 1):
        j = np.arange(max(o, begin), len(rep))
        j = j[(tree[j] == tree[j - o]) & (key[j] == key[j - o]).all(1)]
        if not len(j):
            break
        i = j - o
        fits = (100 * np.minimum(n[i], n[j]) >= percent * np.maximum(n[i], n[j])) & (component[i] != component[j])
        i, j = i[fits], j[fits]
        agree = _agreeing(sketch[i], sketch[j]) >= AGREE
        i, j = rep[i[agree]], rep[j[agree]]
        left.append(np.minimum(i, j))
        right.append(np.maximum(i, j))
    return np.concatenate(left), np.concatenate(right)


def _prefix(tree: str, key: str):
    """A tree and the first MIN_DEPTH coordinates of a key in its order, as bytes."""
    return F.concat(F.unhex(F.lpad(F.hex(tree), 8, "0")), F.substring(key, 1, 4 * MIN_DEPTH)).alias("prefix")


CANDIDATE = f"a long, b long, {ROW_TYPE}"
_CANDIDATE = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("tree", pa.int32()), ("key", pa.binary()),
                        ("class", pa.int64()), ("n", pa.int64()), ("component", pa.int64()), ("sketch", pa.binary())])


def _neighbours(percent: int, near: int, with_ends: bool):
    """Candidate pairs of a sorted run; with_ends: also its first and last rows (a and b are null).

    With near = NEAR also a row (a is null, b is 0) of each prefix that more than NEAR rows share.
    """
    def ends(table: pa.Table) -> Iterator[pa.RecordBatch]:
        none = [pa.nulls(len(table), pa.int64())] * 2
        yield from pa.Table.from_arrays([*none, *table.columns], schema=_CANDIDATE).to_batches()

    def crowded(rows: pa.Table, key: np.ndarray) -> Iterator[pa.RecordBatch]:
        tree = rows["tree"].to_numpy()
        full = (tree[NEAR:] == tree[:-NEAR]) & (key[NEAR:] == key[:-NEAR]).all(1)
        full[1:] &= ~full[:-1] | (tree[NEAR + 1:] != tree[NEAR:-1]) | (key[NEAR + 1:] != key[NEAR:-1]).any(1)
        at = np.flatnonzero(full) + NEAR
        if len(at):
            marks = pa.Table.from_arrays([pa.nulls(len(at), pa.int64()), pa.array(np.zeros(len(at), np.int64)),
                                          *rows.take(pa.array(at)).columns], schema=_CANDIDATE)
            yield from marks.to_batches()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, head = None, 0
        for batch in batches:
            fresh = pa.Table.from_batches([batch])
            if not len(fresh):
                continue
            if with_ends and head < near:
                yield from ends(fresh.slice(0, near - head))
                head += min(near - head, len(fresh))
            begin = len(held) if held is not None else 0
            rows = pa.concat_tables([held, fresh]) if held is not None else fresh
            key = np.frombuffer(b"".join(rows["key"].to_pylist()), np.uint32).reshape(-1, DEPTH)[:, :MIN_DEPTH]
            sketch = np.frombuffer(b"".join(rows["sketch"].to_pylist()), np.uint64).reshape(len(rows), -1)
            a, b = _pairs_of(rows["tree"].to_numpy(), key, rows["class"].to_numpy(), rows["n"].to_numpy(),
                             rows["component"].to_numpy(), sketch, percent, near, begin)
            if len(a):
                rest = [pa.nulls(len(a), f.type) for f in list(_CANDIDATE)[2:]]
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b), *rest], schema=_CANDIDATE)
            if near == NEAR:
                yield from crowded(rows, key)
            held = rows.slice(max(0, len(rows) - near))
        if with_ends and held is not None:
            yield from ends(held)
    return run


def candidates(classes: DataFrame, percent: int, near: int, trees: int) -> tuple[DataFrame, DataFrame]:
    """``a, b``: neighbours in some of the first ``trees`` (classes: class, n_shingles, sig, component) of different components.

    And ``prefix``: the prefixes that more than ``near`` rows share, some repeatedly, if near is NEAR.
    """
    spark = classes.sparkSession
    order = ["tree", "key", "class"]
    grown = classes.select("class", "n_shingles", "sig", "component").mapInArrow(_grown(trees), ROW_TYPE)
    found = materialize(grown.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
                        .mapInArrow(_neighbours(percent, near, True), CANDIDATE), "forest-found")
    # the two ends of each partition: a bounded table
    ends = found.where("a is null and b is null").select(*ROW).repartition(1).sortWithinPartitions(*order)
    across = materialize(ends.mapInArrow(_neighbours(percent, near, False), CANDIDATE), "forest-across")
    both = found.unionByName(across)
    pairs = materialize(both.where("a is not null").select("a", "b").distinct(), "forest-pairs")
    return pairs, both.where("a is null and b is not null").select(_prefix("tree", "key"))


def _rebuilt(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column(1))
            for i, j in groups(offsets):
                sets = shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], size)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, j - i), pa.array([_set_key(x) for x in sets], pa.binary()),
                     pa.array([x.tobytes() for x in sets], pa.binary())], names=["rep", "set_key", "shingles"])
    return run


def _sets(ids: DataFrame, classes: DataFrame, docs: DataFrame, size: int) -> DataFrame:
    """``class, rep, shingles`` of the classes in ``ids`` (column class), rebuilt from the texts."""
    wanted = materialize(classes.select("class", "rep", "set_key").join(ids, "class", "left_semi"), "forest-ids")
    texts = rows_in(docs.select(F.col("doc_id").alias("rep"), "text"), wanted.select("rep").distinct(), "rep", FILTER_BITS)
    rebuilt = texts.mapInArrow(_rebuilt(size), "rep long, set_key binary, shingles binary")
    # rows that repeat an id and a set: one stands for them
    return wanted.join(rebuilt.dropDuplicates(["rep", "set_key"]), ["rep", "set_key"]).select("class", "rep", "shingles")


def _read(column: pa.Array) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint64) for x in column.to_pylist()]


def _confirmed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(_read(batch.column("x")), _read(batch.column("y")), strict=True):
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(linked, pa.bool_())],
                                             names=["a", "b", "u", "v", "linked"])
    return run


def _confirm(pairs: DataFrame, classes: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``a, b, u, v, linked``: candidate pairs of classes, their representatives, judged on the full sets."""
    ids = pairs.select(F.col("a").alias("class")).union(pairs.select(F.col("b").alias("class"))).distinct()
    sets = materialize(_sets(ids, classes, docs, size), "forest-sets-of")
    a = sets.select(F.col("class").alias("a"), F.col("rep").alias("u"), F.col("shingles").alias("x"))
    b = sets.select(F.col("class").alias("b"), F.col("rep").alias("v"), F.col("shingles").alias("y"))
    joined = pairs.join(a, "a").join(b, "b").select("a", "b", "u", "v", "x", "y")
    return materialize(joined.mapInArrow(_confirmed(percent), "a long, b long, u long, v long, linked boolean"),
                       "forest-judged")


def _prefixed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per class and tree with the prefix of its key."""
    for batch in batches:
        sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint32).reshape(-1, COORDS)
        for tree, order in enumerate(_ORDERS):
            lead = tree.to_bytes(4, "big")
            keys = [lead + x.tobytes() for x in sig[:, order[:MIN_DEPTH]].astype(">u4")]
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), *(batch.column(c) for c in (
                "class", "component", "n_shingles"))], names=["prefix", "class", "component", "n"])


def _by_token(sets: list[np.ndarray], tokens: np.ndarray):
    """Rows that hold each of the sorted ``tokens``: rows by token, first place and number per token."""
    value = np.concatenate(sets)
    row = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    at = np.minimum(np.searchsorted(tokens, value), len(tokens) - 1)
    held = tokens[at] == value
    at, row = at[held], row[held]
    order = np.argsort(at, kind="stable")
    many = np.bincount(at, minlength=len(tokens))
    return row[order], at[order], np.cumsum(many) - many, many


def overlaps(a: list[np.ndarray], b: list[np.ndarray]) -> np.ndarray:
    """Number of common elements of every set of ``a`` and every set of ``b``.

    Elements in many sets of both are counted by matrix products, the others
    pair by pair.
    """
    n, m = len(a), len(b)
    out = np.zeros((n, m), np.float32)       # exact for whole numbers up to 2**24
    tokens = np.intersect1d(np.concatenate(a), np.concatenate(b))
    if not len(tokens):
        return out.astype(np.int64)
    rows_a, token_a, first_a, many_a = _by_token(a, tokens)
    rows_b, token_b, first_b, many_b = _by_token(b, tokens)
    heavy = many_a * many_b > max(1, (n * m) >> 7)
    place = np.cumsum(heavy) - 1
    in_a, in_b = heavy[token_a], heavy[token_b]
    for k in range(0, int(heavy.sum()), TOKENS):
        sides = []
        for size, rows, at in ((n, rows_a[in_a], place[token_a[in_a]]), (m, rows_b[in_b], place[token_b[in_b]])):
            lo, hi = np.searchsorted(at, (k, k + TOKENS))
            side = np.zeros((size, TOKENS), np.float32)
            side[rows[lo:hi], at[lo:hi] - k] = 1
            sides.append(side)
        out += sides[0] @ sides[1].T
    row, token = rows_a[~in_a], token_a[~in_a]
    upto = np.cumsum(many_b[token])
    i = 0
    while i < len(row):
        done = upto[i - 1] if i else 0
        j = max(i + 1, int(np.searchsorted(upto, done + SPREAD, "right")))
        many = many_b[token[i:j]]
        left = np.repeat(row[i:j], many)
        right = rows_b[np.repeat(first_b[token[i:j]] - (upto[i:j] - many - done), many) + np.arange(many.sum())]
        out += np.bincount(left * m + right, minlength=n * m).reshape(n, m).astype(np.float32)
        i = j
    return out.astype(np.int64)


def spanning(linked: np.ndarray) -> list[tuple[int, int, bool]]:
    """(row, other, whether other is a column): edges that join what the matrix joins, one per row and column at most."""
    out = []
    rows_left, columns_left = linked.any(1), linked.any(0)
    for seed in np.flatnonzero(rows_left).tolist():
        if not rows_left[seed]:
            continue
        rows_left[seed] = False
        rows = np.array([seed])
        while len(rows):
            columns = np.flatnonzero(linked[rows].any(0) & columns_left)
            columns_left[columns] = False
            rows = np.flatnonzero(linked[:, columns].any(1) & rows_left)
            rows_left[rows] = False
            out += [(seed, c, True) for c in columns.tolist()] + [(seed, r, False) for r in rows.tolist()]
    return out


def _compared(percent: int):
    """Edges between representatives of the linked classes of each pair of blocks (prefix, i, j)."""
    def judge(rows: list[tuple]) -> list[tuple[int, int]]:
        _, i, j = rows[0][:3]
        a = [r for r in rows if r[3] == i]
        b = [r for r in rows if r[3] == j]
        if not a or not b or len({r[4] for r in rows}) == 1:
            return []
        x, y = ([np.frombuffer(r[6], np.uint64) for r in side] for side in (a, b))
        both = overlaps(x, y)
        sizes = np.array([len(s) for s in x])[:, None] + np.array([len(s) for s in y])[None]
        apart = np.array([r[4] for r in a])[:, None] != np.array([r[4] for r in b])[None]
        linked = (both > 0) & (100 * both >= percent * (sizes - both)) & apart
        if i == j:
            linked |= np.eye(len(a), dtype=bool) & linked.any(1)[:, None]
        return [(a[r][5], (b if column else a)[o][5]) for r, o, column in spanning(linked)]

    def emit(edges: list[tuple[int, int]]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([e[k] for e in edges], pa.int64()) for k in (0, 1)], names=["u", "v"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and row[:3] != held[0][:3]:
                    yield emit(judge(held))
                    held = []
                held.append(row)
        if held:
            yield emit(judge(held))
    return run


def finished(placed: DataFrame, crowded: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``u, v``: edges between representatives that join all linked classes of each crowded prefix.

    The classes of a prefix are dealt to blocks; those of its largest
    component meet only the others, the others all.  Each pair of blocks is
    compared on the full sets and gives the edges of a spanning forest.
    """
    flagged, flag = possibly_in(placed.select("class", "component", "n_shingles", "sig").mapInArrow(
        _prefixed, "prefix binary, class long, component long, n long"), crowded, "prefix", FILTER_BITS)
    rows = materialize(flagged.where(F.col(flag)).drop(flag), "forest-prefixed")
    per = rows.groupBy("prefix", "component").agg(F.count("*").alias("rows"), F.sum("n").alias("n"))
    per = per.groupBy("prefix").agg(F.sum("rows").alias("rows"), F.sum("n").alias("n"), F.count("*").alias("parts"),
                                    F.max(F.struct("rows", "n", "component")).alias("m"))
    blocks = lambda rows, n: f"int(greatest(ceil({rows} / {BLOCK_ROWS}), ceil({n} / {BLOCK_SHINGLES})))"
    full = per.where(f"rows > {NEAR} and parts > 1").select(
        "prefix", F.col("m.component").alias("main"), F.expr(blocks("rows", "n")).alias("all"),
        F.expr(blocks("m.rows", "m.n")).alias("mains"), F.expr(blocks("(rows - m.rows)", "(n - m.n)")).alias("others")
    ).selectExpr("prefix", "if(all > 1, main, null) as main", "if(all > 1, mains, 0) as mains",
                 "if(all > 1, others, 1) as others")
    dealt = rows.join(full, "prefix").selectExpr(
        "prefix", "class", "component", "others", "mains", "component <=> main as is_main").selectExpr(
        "prefix", "class", "component", "int(if(is_main, others + pmod(xxhash64(class), mains), pmod(xxhash64(class), others))) as block",
        "explode(sequence(0, if(is_main, others, others + mains) - 1)) as other")
    dealt = materialize(dealt.selectExpr("prefix", "least(block, other) as i", "greatest(block, other) as j", "block",
                                         "component", "class"), "forest-dealt")
    sets = _sets(dealt.select("class").distinct(), placed, docs, size)
    jobs = dealt.join(sets, "class").select("prefix", "i", "j", "block", "component", "rep", "shingles")
    key = ["prefix", "i", "j"]
    return materialize(jobs.repartition(shuffle_partitions(placed.sparkSession), *key).sortWithinPartitions(*key)
                       .mapInArrow(_compared(percent), "u long, v long").where("u <> v"), "forest-finished")


def links(docs: DataFrame, size: int = 2, percent: int = 80) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Documents with their classes, classes with component, confirmed links between classes.

    Documents: doc_id, n_shingles, set_key; classes: set_key, rep (smallest
    doc_id), component; links: u, v (representatives; linked or joined by links).
    """
    spark = docs.sparkSession
    prepare(spark)
    slim = materialize(docs.select("doc_id", "text").mapInArrow(
        _signed(size), "doc_id long, n_shingles long, set_key binary, sig binary"), "forest-sets")
    classes = materialize(slim.where("set_key is not null and doc_id is not null").groupBy("set_key").agg(
        F.min("doc_id").alias("rep"), F.max("n_shingles").alias("n_shingles"), F.max("sig").alias("sig"))
        .withColumn("class", F.monotonically_increasing_id()), "forest-classes")

    def placed(part: DataFrame) -> DataFrame:
        known = part.select(F.col("id").alias("rep"), "component")
        return classes.join(known, "rep", "left").withColumn("component", F.coalesce("component", "rep"))

    def joined(part: DataFrame, more: DataFrame) -> DataFrame:
        if more.isEmpty():
            return part
        return components(part.select(F.col("id").alias("u"), F.col("component").alias("v")).union(more))

    pairs, _ = candidates(classes.withColumn("component", F.col("rep")), percent, 1, CHAINS)
    first = _confirm(pairs, classes, docs, size, percent)
    linked = first.where("linked").select("u", "v")
    part = components(linked)
    pairs, crowded = candidates(placed(part), percent, NEAR, TREES)
    further = materialize(pairs.join(first.select("a", "b"), ["a", "b"], "left_anti"), "forest-further")
    more = _confirm(further, classes, docs, size, percent).where("linked").select("u", "v")
    part, linked = joined(part, more), linked.union(more)
    if not crowded.isEmpty():
        more = finished(placed(part), crowded, docs, size, percent)
        part, linked = joined(part, more), linked.union(more)
    per_class = (classes.select("set_key", "rep").join(part.withColumnRenamed("id", "rep"), "rep", "left")
                 .select("set_key", "rep", F.coalesce("component", "rep").alias("component")))
    return slim.drop("sig"), per_class, linked


def near_duplicates(docs: DataFrame, size: int = 2, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document."""
    slim, per_class, _ = links(docs, size, percent)
    component = F.coalesce("component", F.col("doc_id"))
    return (slim.join(per_class.select("set_key", "component"), "set_key", "left")
            .select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"),
                    F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept")))


def deduplicate(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each group, with the columns of ``docs``; rows without an id stay."""
    dropped = materialize(near_duplicates(docs, size, percent).where("not kept").select("doc_id").distinct(),
                          "forest-dropped")
    return rows_not_in(docs, dropped, "doc_id", FILTER_BITS)


ORACLE = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as ws
  from documents),
sh as (
  select distinct doc_id, unnest(case when len(ws) < 2 then ws
    else list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1]) end) as s from w),
n as (select doc_id, count(*) as n from sh group by doc_id),
c as (select a.doc_id as x, b.doc_id as y, count(*) as c from sh a join sh b on a.s = b.s and a.doc_id < b.doc_id group by all),
half as (select x, y from c join n nx on nx.doc_id = x join n ny on ny.doc_id = y where 100 * c >= 80 * (nx.n + ny.n - c)),
link as (select x, y from half union all select y, x from half),
reach(id, m) as (select doc_id, doc_id from n union select link.y, reach.m from reach join link on link.x = reach.id where link.y > reach.m),
least_of as (select id, min(m) as m from reach group by id)
select d.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(m, d.doc_id) as component_id, coalesce(m, d.doc_id) = d.doc_id as kept
from documents d left join n using (doc_id) left join least_of on id = d.doc_id
"""
