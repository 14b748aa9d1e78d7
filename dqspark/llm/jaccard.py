"""N-gram Jaccard self-join by token-combination prefixes.

A document is the set of its distinct word shingles (A-Z in lower case, words
``[^\\x20\\x09-\\x0D]+``; fewer words than a shingle: the whole sequence is
one); two documents link at ``100 * common >= percent * union``.  All
arithmetic is on whole sets, no pair is lost.

Prefixes.  A document of n tokens has at most ``e = n - ceil(percent n / 100)``
that a partner lacks.  Tokens stand in one order for all documents: rare
before frequent before unassessed, then by hash.  A prefix is taken from it,
rare tokens are signatures alone, the other tokens of a prefix in pairs of
one subclass (a token's subclass is its hash modulo a number fixed per band of
sizes).  For two linked documents the tokens they share in the shorter-reaching
prefix lie in both; to share no signature all r rare ones and all but one of
each subclass must be missing, so a prefix with ``r + sum(n_c - 1) > e`` always
leaves one (the prefix is extended by one token per subclass for it).  Bands
are powers of two of the size; a document signs for every band in which a
smaller partner may lie, so both sides use one band's subclasses.  Bands too
small for that use single tokens alone.

Frequency.  The tokens whose hash lies in the lowest part of the range
(``ASSESSED`` times the errors' share) are counted over all documents;
those in more than ``FREQUENT`` are in one filter of fixed size, those in two or
more in another: a rare assessed token outside it stands in no other document
and is no signature.  The filters' false positives cost time, never a link.

Verification, in two rounds.  First, within the ``CHAINS`` smallest signatures
of each document, sorted by the number of rare tokens, every row meets the first
and the next one: pairs are linear in the documents, and a group of near copies
hangs on its core.  A large signature's rows stand in several tasks; all of them
meet its first row, wherever that is.  Then, with the
components so far, all signatures that still hold several are completed: all pairs
of different components, the rows of its largest component only with the others,
in blocks dealt over the tasks.  Near copies share thousands of signatures, in as
many tasks as there are; a pair is given at the smallest one that both have, as far
as it is among the ``LEAST`` smallest of each.  A parity bitmap of each set (its differing bits
can't outnumber the differing tokens) drops pairs before sets are read, and then
one whose size grows with the set; of the rest every component first tries its nearest, and all pairs still apart are then
compared on the full sets, rebuilt from the texts.  Exact copies are one
document from the start.

Defined results: empty or null texts have empty sets and link with nothing;
a row without an id is left alone (component null); rows with one id are one
document, linked with whatever any of its texts is linked with; an empty table
gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqspark.llm.common import (bitmap, groups, marked, materialize, mix64, prepare, rows_in, rows_not_in,
                                shuffle_partitions, utf8)
from dqspark.llm.components import components
from dqspark.llm.forest import shingle_sets

ASSESSED = 2.5              # share of the tokens that is counted, in shares of errors
FREQUENT = 64               # documents from which a token is a signature only together with another
PER_CLASS = 4               # tokens of a subclass in the prefix of a document at its band's beginning
SINGLES = 16                # smallest size whose band has subclasses
TOKEN_BITS = 1 << 24        # of the filters of tokens: 2 MB
ID_BITS = 1 << 22
PARITY = 1024               # bits of a set's parity bitmap
CHAINS = 3                  # signatures of a document that are looked at first
HEADED = 64                 # rows from which a signature's first row is sent to all others
LEAST = 8                   # smallest signatures of a document by which a pair finds the one place where it is given
ROUNDS = 3                  # in which components try their nearest pair before all others are checked
BUCKET = 1 << 19            # tokens of a bucket in which they are counted, about
SPREAD = 1 << 17            # pairs of rows compared at once
BLOCK = 1024                # rows of a signature that are compared in one task
SEEN = 1 << 17              # pairs a task remembers, so that it gives each once however many signatures they share

_PAIR = np.uint64(0x9E3779B97F4A7C15)
_NONE = np.int64((1 << 63) - 1)


def errors(n: int, percent: int) -> int:
    """Most tokens of a set of n that a partner may lack."""
    return n - (percent * n + 99) // 100


def subclasses(band: int, percent: int) -> int:
    """Subclasses of a band's frequent tokens; 0: all tokens of the band are signatures alone."""
    low = 1 << band
    many = max(1, errors(low, percent) // PER_CLASS)
    return many if low >= SINGLES and all(n - many > errors(n, percent) for n in (low, 2 * low - 1)) else 0


def bands(n: int, percent: int) -> range:
    """Bands for which a set of n tokens signs: its own and those of smaller partners."""
    return range(((percent * n + 99) // 100).bit_length() - 1, n.bit_length())


def _signed_tokens(order: np.ndarray, rare: int, band: int, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Single tokens and pair signatures of one band; ``order``: all tokens in order, the ``rare`` first ones are rare."""
    spare = errors(len(order), percent)
    many = subclasses(band, percent)
    if not many or rare > spare:
        return order[:spare + 1], order[:0]
    rest = order[rare:]
    sub = (rest >> np.uint64(32)) % np.uint64(many)
    # the first token of a subclass costs nothing, each further one an error
    first = np.zeros(len(rest), bool)
    first[np.unique(sub, return_index=True)[1]] = True
    size = int(np.searchsorted(rare + np.cumsum(~first), spare + 1)) + 1
    rest, sub = rest[:size], sub[:size]
    by = np.argsort(sub, kind="stable")
    rest, sub = rest[by], sub[by]
    begin = np.searchsorted(sub, sub)                       # tokens of the subclass that come before
    earlier = np.arange(len(rest)) - begin
    right = np.repeat(np.arange(len(rest)), earlier)
    left = np.repeat(begin, earlier) + np.arange(len(right)) - np.repeat(np.cumsum(earlier) - earlier, earlier)
    a, b = np.minimum(rest[left], rest[right]), np.maximum(rest[left], rest[right])
    return order[:rare], mix64(a * _PAIR + b)


def signatures(tokens: np.ndarray, limit: np.uint64, several, frequent, percent: int) -> tuple[int, np.ndarray]:
    """Number of rare tokens of a set (sorted hashes), and its signatures.

    ``several`` and ``frequent`` are filters of assessed tokens (hash below
    ``limit``) of two documents or more and of more than FREQUENT.
    """
    at = tokens & np.uint64(64 * len(several) - 1)
    known = tokens < limit
    often = marked(frequent, at)
    rank = np.where(known, often, 2)
    order = tokens[np.argsort(rank, kind="stable")]
    rare = int((rank == 0).sum())
    alone = known & ~marked(several, at)
    out = []
    for band in bands(len(tokens), percent):
        single, pairs = _signed_tokens(order, rare, band, percent)
        single = single[~alone[np.searchsorted(tokens, single)]]
        salt = np.uint64((band * 0x9E3779B1 + 1) & 0xFFFFFFFF)
        out += [mix64(single + salt), mix64(pairs ^ (salt << np.uint64(20)))]
    return rare, np.unique(np.concatenate(out))


def parity(tokens: np.ndarray, bits: int = PARITY) -> np.ndarray:
    """A bit per residue: whether an odd number of tokens has it."""
    return np.packbits(np.bincount(((tokens >> np.uint64(20)) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1 == 1)


def fine_parity(tokens: np.ndarray) -> np.ndarray:
    """A parity bitmap that a set of any size leaves sparse: two bits a token or more."""
    return parity(tokens, max(PARITY, 1 << (2 * len(tokens)).bit_length()))


def apart(x: np.ndarray, y: np.ndarray) -> int:
    """Differing bits of two parity bitmaps; the larger one is folded to the size of the other."""
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        x = x[:len(x) // 2] ^ x[len(x) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


def _key(tokens: np.ndarray) -> bytes | None:
    return hashlib.blake2b(tokens.tobytes(), digest_size=16).digest() if len(tokens) else None


def _sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    data, offsets = utf8(batch.column(1))
    for i, j in groups(offsets):
        yield i, shingle_sets(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], size)


def _sized(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [x for _, part in _sets(batch, size) for x in part]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([len(x) for x in sets], pa.int64()),
                                              pa.array([_key(x) for x in sets], pa.binary())],
                                             names=["doc_id", "n_shingles", "set_key"])
    return run


def _assessed(size: int, limit: np.uint64, bits: int):
    """Tokens below the limit and their documents per batch, packed by the first ``bits`` bits of the token."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            low = [x[:np.searchsorted(x, limit)] for _, part in _sets(batch, size) for x in part]
            token, n = np.unique(np.concatenate([*low, np.zeros(0, np.uint64)]), return_counts=True)
            bucket = (token >> np.uint64(64 - bits)).astype(np.int64)
            begin = np.flatnonzero(np.diff(bucket, prepend=-1))
            spans = list(zip(begin, np.append(begin[1:], len(token))))
            yield pa.RecordBatch.from_arrays(
                [pa.array(bucket[begin]), pa.array([token[i:j].tobytes() for i, j in spans], pa.binary()),
                 pa.array([n[i:j].astype(np.uint32).tobytes() for i, j in spans], pa.binary())], names=["bucket", "tokens", "counts"])
    return run


def _summed(parts: list) -> list:
    """The parts (tokens, counts) as one, each token once."""
    token, n = (np.concatenate(c) for c in zip(*parts))
    by = np.argsort(token)
    token, n = token[by], n[by]
    begin = np.flatnonzero(np.append(True, token[1:] != token[:-1]))
    return [(token[begin], np.add.reduceat(n, begin))]


def _repeated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Tokens that stand in several documents, with their number; rows come sorted by bucket."""
    def done(parts: list) -> pa.RecordBatch:
        token, n = _summed(parts)[0]
        return pa.RecordBatch.from_arrays([pa.array(token[n > 1].view(np.int64)), pa.array(n[n > 1])], names=["token", "n"])

    last, parts, waiting = None, [], 0
    for batch in batches:
        for bucket, tokens, counts in zip(*(c.to_pylist() for c in batch.columns)):
            if bucket != last and parts:
                yield done(parts)
                parts, waiting = [], 0
            last = bucket
            parts.append((np.frombuffer(tokens, np.uint64), np.frombuffer(counts, np.uint32).astype(np.int64)))
            waiting += len(parts[-1][0])
            if waiting > 4 * BUCKET:        # a frequent token comes once with every batch
                parts, waiting = _summed(parts), 0
    if parts:
        yield done(parts)


def _signed(size: int, percent: int, limit: np.uint64, several, frequent):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, sets in _sets(batch, size):
                made = [signatures(x, limit, several.value, frequent.value, percent) if len(x) else (0, x[:0]) for x in sets]
                cuts = np.concatenate([[0], np.cumsum([len(s) for _, s in made])]).astype(np.int32)
                sigs = np.concatenate([np.sort(s.view(np.int64)) for _, s in made]) if made else np.zeros(0, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, len(sets)), pa.array([len(x) for x in sets], pa.int64()),
                     pa.array([r for r, _ in made], pa.int32()), pa.array([parity(x).tobytes() for x in sets], pa.binary()),
                     pa.ListArray.from_arrays(pa.array(cuts), pa.array(sigs))],
                    names=["doc_id", "n", "rare", "bits", "sigs"])
    return run


def _first_and_next(percent: int):
    """Pairs of each row with the first row of its signature, with the row before it and with its head (rows are sorted)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None         # first and last row of the run that goes on
        for batch in batches:
            sig, rare, doc, n, head, head_n = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
            if not len(sig):
                continue
            heads = (head, doc, head_n, n)
            if held is not None:
                sig, doc, n = (np.concatenate([h, c]) for h, c in zip(held, (sig, doc, n)))
            new = np.ones(len(sig), bool)
            new[1:] = sig[1:] != sig[:-1]
            first = np.maximum.accumulate(np.where(new, np.arange(len(sig)), 0))
            i = np.flatnonzero(~new)
            right = np.concatenate([i, i])
            left = np.concatenate([first[i], i - 1])
            a, b, x, y = (np.concatenate(c) for c in zip((doc[left], doc[right], n[left], n[right]), heads))
            fits = (100 * np.minimum(x, y) >= percent * np.maximum(x, y)) & (a != b)
            a, b = a[fits], b[fits]
            both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)]), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(both[0]), pa.array(both[1])], names=["a", "b"])
            keep = [first[-1], len(sig) - 1] if first[-1] < len(sig) - 1 else [len(sig) - 1]
            held = [c[keep] for c in (sig, doc, n)]
    return run


def _near(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Whether sizes and parity bitmaps allow the similarity (rows of x against rows of y)."""
    need = -(-percent * (n + m) // (100 + percent))         # common tokens of a link
    return (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (
        np.bitwise_count(x ^ y).sum(-1, dtype=np.int64) <= n + m - 2 * need)


def _bits(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint64).reshape(len(column), PARITY // 64)


def _padded(lists: pa.ListArray) -> np.ndarray:
    """Lists of at most LEAST signatures as rows of one array."""
    out = np.full((len(lists), LEAST), _NONE)
    out[np.arange(LEAST) < lists.value_lengths().to_numpy()[:, None]] = lists.flatten().to_numpy()
    return out


def _least_common(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The smallest signature in both rows, or a number that none exceeds.

    As the rows hold a document's smallest ones, a common one is the smallest that the documents share.
    """
    out = np.full(len(x), _NONE)
    for k in range(LEAST):
        out = np.minimum(out, np.where((y == x[:, k:k + 1]).any(1), x[:, k], _NONE))
    return out


def _alike(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = _bits(batch.column("x")), _bits(batch.column("y"))
            keep = _near(x, y, batch.column("n").to_numpy(), batch.column("m").to_numpy(), percent)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep)) for c in ("a", "b")], names=["a", "b"])
    return run


def _fine(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, sets in _sets(batch, size):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, len(sets)), pa.array([len(x) for x in sets], pa.int64()),
                                                  pa.array([fine_parity(x).tobytes() for x in sets], pa.binary())],
                                                 names=["doc_id", "n", "fine"])
    return run


def _finely_alike(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = batch.column("n").to_numpy(), batch.column("m").to_numpy()
            bits = np.array([apart(np.frombuffer(x, np.uint8), np.frombuffer(y, np.uint8))
                             for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist())], np.int32)
            keep = pa.array(bits <= n + m - 2 * -(-percent * (n + m) // (100 + percent)))
            yield pa.RecordBatch.from_arrays([c.filter(keep) for c in (batch.column("a"), batch.column("b"), pa.array(bits))],
                                             names=["a", "b", "apart"])
    return run


def likely(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``a, b, apart``: the pairs whose fine bitmaps allow a link (PARITY bits say little of sets of thousands)."""
    ids = materialize(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "join-fine-ids")
    fine = materialize(rows_in(docs, ids, "doc_id", ID_BITS).mapInArrow(_fine(size), "doc_id long, n long, fine binary"), "join-fine")
    x = fine.select(F.col("doc_id").alias("a"), "n", F.col("fine").alias("x"))
    y = fine.select(F.col("doc_id").alias("b"), F.col("n").alias("m"), F.col("fine").alias("y"))
    return materialize(pairs.select("a", "b").join(x, "a").join(y, "b").select("a", "b", "n", "m", "x", "y")
                       .mapInArrow(_finely_alike(percent), "a long, b long, apart int")
                       .groupBy("a", "b").agg(F.min("apart").alias("apart")), "join-likely")


def _rebuilt(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, sets in _sets(batch, size):
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, len(sets)),
                                                  pa.array([x.tobytes() for x in sets], pa.binary())], names=["doc_id", "shingles"])
    return run


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist()):
                x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(keep, pa.bool_())) for c in ("a", "b")],
                                             names=["u", "v"])
    return run


def verified(pairs: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """``u, v``: the pairs ``a, b`` of documents that link on their full sets."""
    ids = materialize(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "join-ids")
    sets = materialize(rows_in(docs, ids, "doc_id", ID_BITS).mapInArrow(_rebuilt(size), "doc_id long, shingles binary"), "join-sets")
    x = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    y = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    return materialize(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y").mapInArrow(_linked(percent), "u long, v long")
                       .distinct(), "join-links")


def _in_blocks(percent: int):
    """Pairs of different components of each pair of blocks (sig, i, j) that sizes and bitmaps allow, with their differing bits.

    Near copies share thousands of signatures: where the rows bring their smallest ones (``low``, ascending), a pair is
    left to the smallest common one, and a task gives a pair of rows once, as far as it remembers.
    """
    def unseen(found: pa.Table, seen: pa.Table | None) -> pa.Table:
        found = found.group_by(["a", "b", "apart"], use_threads=False).aggregate([])
        return found if seen is None else found.join(seen, ["a", "b", "apart"], join_type="left anti", use_threads=False)

    def judge(rows: pa.Table) -> Iterator[pa.Table]:
        sig, i, j, block, doc, n, part = (rows[c].to_numpy() for c in ("sig", "i", "j", "block", "doc_id", "n", "component"))
        bits = _bits(rows["bits"].combine_chunks())
        low = _padded(rows["low"].combine_chunks()) if "low" in rows.column_names else None
        new = np.ones(len(rows), bool)
        new[1:] = (sig[1:] != sig[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])
        starts = np.flatnonzero(new)
        end = np.append(starts[1:], len(rows))[np.cumsum(new) - 1]
        many = end - np.arange(len(rows)) - 1           # later rows of the same pair of blocks
        upto = np.cumsum(many)
        r = 0
        while r < len(rows):
            done = upto[r] - many[r]
            e = max(r + 1, int(np.searchsorted(upto, done + SPREAD, "right")))
            left = np.repeat(np.arange(r, e), many[r:e])
            right = left + 1 + np.arange(len(left)) - (upto[left] - many[left] - done)
            keep = (part[left] != part[right]) & ((i[left] == j[left]) | (block[left] != block[right]))
            left, right = left[keep], right[keep]
            keep = _near(bits[left], bits[right], n[left], n[right], percent)
            left, right = left[keep], right[keep]
            if low is not None:
                keep = sig[left] <= _least_common(low[left], low[right])
                left, right = left[keep], right[keep]
            x, y = doc[left], doc[right]
            yield pa.table([pa.array(np.minimum(x, y)), pa.array(np.maximum(x, y)), pa.array(
                np.bitwise_count(bits[left] ^ bits[right]).sum(-1, dtype=np.int32))], names=["a", "b", "apart"])
            r = e

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = None
        for found in compared(batches):
            if not len(found):
                continue
            fresh = unseen(found, seen)
            yield from fresh.to_batches()
            if len(fresh):
                seen = fresh if seen is None or len(seen) > SEEN else pa.concat_tables([seen, fresh]).combine_chunks()

    def compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        held = None
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if held is not None:
                rows = pa.concat_tables([held, rows])
            if not len(rows):
                continue
            key = np.stack([rows[c].to_numpy() for c in ("sig", "i", "j")])
            cut = np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1
            last = int(cut[-1]) if len(cut) else 0
            if last:
                yield from judge(rows.slice(0, last))
            held = rows.slice(last)
        if held is not None and len(held):
            yield from judge(held)
    return run


def _completed(signed: DataFrame, part: DataFrame, percent: int) -> DataFrame:
    """``a, b, apart``: pairs of different components that share a signature (ascending), as far as sizes and bitmaps allow."""
    placed = materialize(signed.join(part.withColumnRenamed("id", "doc_id"), "doc_id", "left")
                         .withColumn("component", F.coalesce("component", "doc_id")), "join-placed")
    rows = placed.select(F.explode("sigs").alias("sig"), "doc_id", "n", "component")
    per = rows.groupBy("sig").agg(F.count("*").alias("rows"), F.min("component").alias("low"), F.max("component").alias("high"),
                                  F.try_sum(F.shiftrightunsigned(F.xxhash64("doc_id", "n"), 12)).alias("held"))
    # signatures of the same rows give the same pairs: one stands for them (a sum beyond 64 bits stands alone)
    mixed = materialize(per.where("low <> high").groupBy("rows", "low", "high", "held", F.expr("if(held is null, sig, null)"))
                        .agg(F.min("sig").alias("sig")).select("sig", "rows"), "join-mixed")
    # only large signatures need to know their largest component
    large = materialize(mixed.where(F.col("rows") > BLOCK).select("sig"), "join-large")     # few, so broadcast by its size
    main = (rows.join(large, "sig", "left_semi").groupBy("sig", "component").agg(F.count("*").alias("m"))
            .groupBy("sig").agg(F.max(F.struct("m", "component")).alias("m")))
    blocks = materialize(mixed.join(main, "sig", "left").select(
        "sig", F.col("m.component").alias("main"), F.expr(f"if(m is null, 0, int(ceil(m.m / {BLOCK})))").alias("mains"),
        F.expr(f"if(m is null, 1, int(ceil((rows - m.m) / {BLOCK})))").alias("others")), "join-blocks")
    dealt = rows.join(blocks, "sig").selectExpr("sig", "doc_id", "n", "component", "others", "mains", "component <=> main as is_main")
    dealt = dealt.selectExpr("sig", "doc_id", "n", "component", "if(is_main, others + pmod(xxhash64(doc_id), mains), pmod(xxhash64(doc_id), others)) as block",
                             "explode(sequence(0, if(is_main, others, others + mains) - 1)) as other")
    dealt = dealt.selectExpr("sig", "cast(least(block, other) as long) as i", "cast(greatest(block, other) as long) as j",
                             "cast(block as long) as block", "doc_id", "n", "component")
    # the smallest signature stands for those of the same rows, so the smallest common one of a pair is always looked at
    bits = placed.select("doc_id", "n", "bits", F.slice("sigs", 1, LEAST).alias("low")).distinct()
    key = ["sig", "i", "j"]
    jobs = dealt.join(bits, ["doc_id", "n"]).select(*key, "block", "doc_id", "n", "component", "bits", "low")
    return materialize(jobs.repartition(shuffle_partitions(signed.sparkSession), *key).sortWithinPartitions(*key)
                       .mapInArrow(_in_blocks(percent), "a long, b long, apart int").groupBy("a", "b").agg(F.min("apart").alias("apart")),
                       "join-completed")


def joined(part: DataFrame, more: DataFrame) -> DataFrame:
    """Components ``part`` after the edges ``more`` (u, v) have joined some of them."""
    if more.isEmpty():
        return part
    return components(part.select(F.col("id").alias("u"), F.col("component").alias("v")).union(more))


def _nearest_first(rest: DataFrame, part: DataFrame, docs: DataFrame, size: int, percent: int) -> DataFrame:
    """The components ``part`` joined by the links among the pairs ``rest``.

    In each of ``ROUNDS`` rounds every component tries the pair whose bitmaps
    differ least; pairs that have come to lie in one component need no check.
    What is left is checked in full.
    """
    def apart(part: DataFrame) -> DataFrame:
        known = part.select("id", "component")
        both = (rest.join(known.select(F.col("id").alias("a"), F.col("component").alias("p")), "a", "left")
                .join(known.select(F.col("id").alias("b"), F.col("component").alias("q")), "b", "left"))
        return (both.withColumn("p", F.coalesce("p", "a")).withColumn("q", F.coalesce("q", "b")).where("p <> q")
                .select("a", "b", "apart", "p", "q"))

    for _ in range(ROUNDS):
        if rest.isEmpty():
            return part
        left = materialize(apart(part), "join-apart")
        best = F.min(F.struct("apart", "a", "b")).alias("m")
        chosen = (left.groupBy("p").agg(best).select("m.a", "m.b").union(left.groupBy("q").agg(best).select("m.a", "m.b")))
        chosen = materialize(chosen.distinct(), "join-chosen")
        part = joined(part, verified(chosen, docs, size, percent))
        rest = materialize(left.select("a", "b", "apart").join(chosen, ["a", "b"], "left_anti"), "join-rest")
    left = materialize(apart(part).select("a", "b"), "join-last")
    return part if left.isEmpty() else joined(part, verified(left, docs, size, percent))


def links(docs: DataFrame, size: int = 4, percent: int = 85) -> tuple[DataFrame, DataFrame]:
    """Documents (doc_id, n_shingles, set_key, rep: smallest id with the set) and edges ``u, v``.

    The edges join every linked pair of different sets, by way of the smallest id of their component.
    """
    spark = docs.sparkSession
    prepare(spark)
    texts = docs.select("doc_id", "text")
    slim = materialize(texts.mapInArrow(_sized(size), "doc_id long, n_shingles long, set_key binary"), "join-sizes")
    known = slim.where("set_key is not null and doc_id is not null")
    classes = materialize(known.groupBy("set_key").agg(F.min("doc_id").alias("rep")), "join-classes")
    placed = materialize(slim.join(classes, "set_key", "left"), "join-docs")
    # ids none of whose texts stands for its set: their sets are read elsewhere
    copies = materialize(placed.groupBy("doc_id").agg(F.bool_or(F.col("rep") == F.col("doc_id")).alias("stands"))
                         .where("doc_id is not null and not coalesce(stands, false)").select("doc_id"), "join-copies")
    reps = rows_not_in(texts.where("doc_id is not null"), copies, "doc_id", ID_BITS)
    limit = np.uint64(min(1.0, ASSESSED * (1 - percent / 100)) * float((1 << 64) - 2048))
    # most tokens stand once, so they travel packed, in buckets whose number grows with the tokens
    tokens = slim.agg(F.coalesce(F.sum("n_shingles"), F.lit(0)).alias("n")).first()["n"]
    bits = max(10, (tokens // BUCKET).bit_length())
    counted = materialize(reps.mapInArrow(_assessed(size, limit, bits), "bucket long, tokens binary, counts binary")
                          .repartition(shuffle_partitions(spark), "bucket").sortWithinPartitions("bucket")
                          .mapInArrow(_repeated, "token long, n long"), "join-tokens")
    place = F.col("token").bitwiseAND(F.lit(TOKEN_BITS - 1))
    several = spark.sparkContext.broadcast(bitmap(counted, place, TOKEN_BITS))
    frequent = spark.sparkContext.broadcast(bitmap(counted.where(F.col("n") > FREQUENT), place, TOKEN_BITS))
    signed = materialize(reps.mapInArrow(_signed(size, percent, limit, several, frequent),
                                         "doc_id long, n long, rare int, bits binary, sigs array<long>").where("size(sigs) > 0"),
                         "join-signed")
    order = ["sig", "rare", "doc_id"]
    rows = signed.select(F.explode(F.slice("sigs", 1, CHAINS)).alias("sig"), "rare", "doc_id", "n")
    heads = materialize(rows.groupBy("sig").agg(F.count("*").alias("rows"), F.min(F.struct("rare", "doc_id", "n")).alias("first"))
                        .where(F.col("rows") > HEADED).select("sig", F.col("first.doc_id").alias("head"), F.col("first.n").alias("head_n")),
                        "join-heads")       # few, so broadcast by their size
    rows = rows.join(heads, "sig", "left").select("sig", "rare", "doc_id", "n", F.coalesce("head", "doc_id").alias("head"),
                                                  F.coalesce("head_n", "n").alias("head_n"))
    pairs = materialize(rows.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
                        .mapInArrow(_first_and_next(percent), "a long, b long").distinct(), "join-pairs")
    bits = signed.select("doc_id", "n", "bits").distinct()
    x = bits.select(F.col("doc_id").alias("a"), "n", F.col("bits").alias("x"))
    y = bits.select(F.col("doc_id").alias("b"), F.col("n").alias("m"), F.col("bits").alias("y"))
    first = materialize(pairs.join(x, "a").join(y, "b").select("a", "b", "n", "m", "x", "y")
                        .mapInArrow(_alike(percent), "a long, b long").distinct(), "join-first")
    part = components(verified(likely(first, reps, size, percent).select("a", "b"), reps, size, percent))
    rest = materialize(_completed(signed, part, percent).join(first, ["a", "b"], "left_anti"), "join-rest")
    part = _nearest_first(likely(rest, reps, size, percent), part, reps, size, percent)
    edges = part.select(F.col("id").alias("u"), F.col("component").alias("v"))
    # an id with several texts joins their sets
    several_sets = known.groupBy("doc_id").agg((F.min("set_key") != F.max("set_key")).alias("mixed")).where("mixed").select("doc_id")
    own = placed.join(several_sets, "doc_id", "left_semi").select(F.col("doc_id").alias("u"), F.col("rep").alias("v"))
    return placed, edges.union(own.where("v is not null"))


def join(docs: DataFrame, size: int = 4, percent: int = 85) -> DataFrame:
    """doc_id, n_shingles and component_id of every document."""
    placed, edges = links(docs, size, percent)
    part = materialize(components(edges).select(F.col("id").alias("rep"), "component"), "join-components")
    component = F.coalesce("component", "rep", "doc_id")
    return placed.join(part, "rep", "left").select(
        "doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), component).alias("component_id"))


ORACLE = r"""
with recursive w as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') as ws
  from documents),
sh as (
  select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < 4 then [array_to_string(ws, ' ')]
    else list_transform(range(1, len(ws) - 2), lambda i: array_to_string(ws[i:i + 3], ' ')) end) as s from w),
n as (select doc_id, count(*) as n from sh group by doc_id),
c as (select a.doc_id as x, b.doc_id as y, count(*) as c from sh a join sh b on a.s = b.s and a.doc_id < b.doc_id group by all),
half as (select x, y from c join n nx on nx.doc_id = x join n ny on ny.doc_id = y where 100 * c >= 85 * (nx.n + ny.n - c)),
link as (select x, y from half union all select y, x from half),
reach(id, m) as (select doc_id, doc_id from n union select link.y, reach.m from reach join link on link.x = reach.id where link.y > reach.m),
least_of as (select id, min(m) as m from reach group by id)
select d.doc_id, coalesce(n.n, 0) as n_shingles, coalesce(m, d.doc_id) as component_id
from documents d left join n using (doc_id) left join least_of on id = d.doc_id
"""
