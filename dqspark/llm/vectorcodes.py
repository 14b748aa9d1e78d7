"""Vector codes: product codebooks trained and searched by Orchard's algorithm.

A vector becomes integers ``floor(4096 * x)`` and is cut into ``PARTS`` equal
consecutive parts; each part position has a codebook of up to ``ENTRIES``
integer entries.  The nearest entry of a part is found by Orchard's search:
every entry has a list of the others by rising distance; the search walks the
list of the best entry so far, skips entries already measured, jumps to the
list of a better one as soon as it is found, and stops where a listed entry is
farther from the best one than twice the part's distance (by the triangle
inequality none beyond is as near).  All arithmetic is on integers, so ties go
to the lower index exactly.

The rows are kept as integers in the shared folder; a training round is one
pass whose tasks return sums per entry, which Spark adds up.  Only the
codebooks (``ENTRIES`` times the length of a vector) and their sums reach the
driver, whatever the number of rows.

Defined results: rows whose vector is null or holds null or non-finite
components are dropped, and so are vectors of another length than that of the
smallest vec_id; a length that 8 doesn't divide gives parts that differ by one
in length; fewer rows than entries give shorter codebooks; of rows with one
vec_id the smaller vector comes first, null ids come last; empty vectors are at
distance 0 of everything; components of 2**50 or more in magnitude are out of
range (code, error null, no part in training); an error or label_error beyond
64 bits is null; an empty table gives an empty result; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqspark.llm.common import materialize, prepare

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
SMALL = 1 << 25             # below this, squares of 2**11 components and sums of 2**37 rows fit in 64 bits
LARGEST = 1 << 62
SALTS = 8


def bounds(size: int) -> list[int]:
    """Where the parts of a vector of this length begin and end."""
    return [size * k // PARTS for k in range(PARTS + 1)]


def _integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """vec_id, label and the components (64-bit integers; null if out of range) of the kept rows."""
    for batch in batches:
        lists = batch.column(1)
        keep, raw = [], []
        for i in range(len(lists)):
            part = lists[i].values if lists[i].is_valid else None
            if part is None or part.null_count:
                continue
            x = np.floor(part.to_numpy(zero_copy_only=False).astype(np.float64) * float(SCALE))
            if not np.isfinite(part.to_numpy(zero_copy_only=False)).all():
                continue
            keep.append(i)
            raw.append(x.astype(np.int64).tobytes() if (np.abs(x) < LARGEST).all() else None)
        at = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0).take(at), batch.column(2).take(at),
                                          pa.array([8 * len(lists[i].values) for i in keep], pa.int64()),
                                          pa.array(raw, pa.binary())], names=["vec_id", "label", "bytes", "v"])


class Codebooks:
    """Entries of each part position, with their distances and neighbour lists."""

    def __init__(self, books: list[list[list[int]]]):
        wide = any(abs(c) >= SMALL for book in books for e in book for c in e)
        self.books = [np.array(b, object if wide else np.int64).reshape(len(b), len(b[0]) if b else 0) for b in books]
        self.apart, self.lists = [], []
        for b in self.books:
            d = ((b[:, None] - b[None]) ** 2).sum(2)
            order = np.array([sorted((j for j in range(len(b)) if j != i), key=lambda j: (d[i, j], j)) for i in range(len(b))],
                             np.int64).reshape(len(b), max(0, len(b) - 1))
            self.apart.append(d)
            self.lists.append(order)

    def nearest(self, part: int, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Index and squared distance of the nearest entry of every row of ``x``."""
        book, apart, lists = self.books[part], self.apart[part], self.lists[part]
        n, last = len(x), len(book) - 1
        best, at = np.zeros(n, np.int64), np.zeros(n, np.int64)
        dist = ((x - book[0]) ** 2).sum(1)
        seen = np.zeros((n, len(book)), bool)
        live = np.arange(n) if last else at[:0]
        while len(live):
            entry = lists[best[live], at[live]]
            near = (apart[best[live], entry] <= 4 * dist[live]).astype(bool)
            live, entry = live[near], entry[near]
            at[live] += 1
            new = ~seen[live, entry]
            rows, entry = live[new], entry[new]
            seen[rows, entry] = True
            d = ((x[rows] - book[entry]) ** 2).sum(1)
            better = ((d < dist[rows]) | ((d == dist[rows]) & (entry < best[rows]))).astype(bool)
            rows, entry = rows[better], entry[better]
            seen[rows, best[rows]] = True
            best[rows], dist[rows], at[rows] = entry, d[better], 0
            live = live[at[live] < last]
        return best, dist

    def digest(self) -> str:
        return hashlib.sha256(",".join(str(c) for b in self.books for e in b for c in e).encode()).hexdigest()


def _parts(raw: pa.Array, size: int) -> list[np.ndarray]:
    x = np.frombuffer(b"".join(raw.to_pylist()), np.int64).reshape(len(raw), size)
    if x.size and np.abs(x).max() >= SMALL:
        x = x.astype(object)
    at = bounds(size)
    return [x[:, at[k]:at[k + 1]] for k in range(PARTS)]


def _sums(books: Codebooks, size: int):
    """Rows and component sums of every entry, once per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        many = [[0] * len(b) for b in books.books]
        total = [[0] * len(b) for b in books.books]
        for batch in batches:
            for k, x in enumerate(_parts(batch.column(0), size)):
                best, _ = books.nearest(k, x)
                for e in np.unique(best).tolist():
                    rows = x[best == e]
                    many[k][e] += len(rows)
                    total[k][e] = total[k][e] + rows.sum(0).astype(object)
        out = [(k, e, j, many[k][e], Decimal(int(s))) for k in range(PARTS) for e in range(len(many[k])) if many[k][e]
               for j, s in enumerate(total[k][e])]
        columns = list(zip(*out)) or [[]] * 5
        types = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.decimal128(38, 0)]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)],
                                         names=["part", "entry", "place", "n", "total"])
    return run


def _coded(books: Codebooks, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            code, error = np.zeros((len(batch), PARTS), np.uint8), 0
            for k, x in enumerate(_parts(batch.column(2), size)):
                code[:, k], d = books.nearest(k, x)
                error = error + d.astype(object)
            errors = [int(e) if e < 1 << 63 else None for e in error] if len(batch) else []
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([c.tobytes().hex() for c in code], pa.string()),
                                              pa.array(errors, pa.int64())], names=["vec_id", "label", "code", "error"])
    return run


def train(vectors: DataFrame, size: int, entries: int = ENTRIES, rounds: int = ROUNDS) -> Codebooks:
    """Codebooks from rows ``vec_id, v``: the first entries are those of the smallest ids."""
    first = vectors.select("vec_id", "v").orderBy(F.col("vec_id").asc_nulls_last(), "v").limit(entries).collect()
    whole = [np.frombuffer(r["v"], np.int64).tolist() for r in first]
    at = bounds(size)
    books = [[v[at[k]:at[k + 1]] for v in whole] for k in range(PARTS)]
    for _ in range(rounds):
        sums = (vectors.select("v").mapInArrow(_sums(Codebooks(books), size), "part int, entry int, place int, n long, total decimal(38,0)")
                .groupBy("part", "entry", "place").agg(F.sum("n").alias("n"), F.sum("total").alias("total")))
        for r in sums.collect():            # one row per component of the codebooks
            books[r["part"]][r["entry"]][r["place"]] = int(r["total"]) // r["n"]
    return Codebooks(books)


def compress(rows: DataFrame, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every kept row of ``vec_id, embedding, label``."""
    prepare(rows.sparkSession)
    kind = rows.schema["label"].dataType.simpleString()
    kept = materialize(rows.select("vec_id", "embedding", "label").mapInArrow(
        _integers, f"vec_id long, label {kind}, bytes long, v binary"), "vectors")
    first = kept.select("vec_id", "bytes").orderBy(F.col("vec_id").asc_nulls_last(), "bytes").limit(1).collect()
    size = first[0]["bytes"] // 8 if first else 0
    fit = kept.where(F.col("bytes") == 8 * size)
    known = fit.where("v is not null")
    books = train(known, size, entries, rounds) if not known.isEmpty() else Codebooks([[]] * PARTS)
    coded = materialize(known.select("vec_id", "label", "v").mapInArrow(
        _coded(books, size), f"vec_id long, label {kind}, code string, error long").unionByName(
        fit.where("v is null").selectExpr("vec_id", "label", "cast(null as string) as code", "cast(null as long) as error")),
        "vector-codes")
    # a label may hold most rows: its total is written once per salt
    totals = coded.groupBy("label").agg(F.expr("try_sum(error)").alias("label_error"))
    totals = materialize(totals.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1)))), "vector-labels")
    t, c = totals.alias("t"), coded.withColumn("salt", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int")).alias("c")
    return (c.join(t, F.col("c.label").eqNullSafe(F.col("t.label")) & (F.col("c.salt") == F.col("t.salt")), "left")
            .select("vec_id", "code", "error", "label_error", F.lit(books.digest()).alias("codebooks_sha256")))


def _oracle() -> str:
    ctes = [f"""
k as materialized (select row_number() over () as id, vec_id, label, [cast(floor({SCALE} * x) as bigint) for x in embedding] as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
w as (select len(v) // {PARTS} as w from k limit 1),
p as materialized (select id, t.part, list_slice(v, cast(t.part * w + 1 as bigint), cast((t.part + 1) * w as bigint)) as x
  from k, w, (select unnest(range({PARTS})) as part) as t),
s as (select id, row_number() over (order by vec_id) - 1 as entry from k order by vec_id limit {ENTRIES}),
b0 as materialized (select part, entry, x as b from p join s using (id))"""]
    near = """a{r} as materialized (select id, part, any_value(x) as x, min({{'d': d, 'entry': entry}}) as m from (
  select id, p.part, x, entry, list_sum([(x[i] - b[i]) * (x[i] - b[i]) for i in range(1, len(x) + 1)])::bigint as d
  from p join b{r} using (part)) group by id, part)"""
    for r in range(ROUNDS):
        ctes.append(near.format(r=r))
        ctes.append(f"""b{r + 1} as materialized (select o.part, o.entry, coalesce(n.b, o.b) as b from b{r} o left join (
  select part, entry, list(c order by i) as b from (
    select part, entry, i, (s - ((s % n) + n) % n) // n as c from (
      select part, m.entry as entry, i, sum(x[i])::bigint as s, count(*) as n
      from a{r}, (select unnest(range(1, (select w from w) + 1)) as i) group by all)) group by part, entry) n using (part, entry))""")
    ctes.append(near.format(r=ROUNDS))
    return "with " + ",\n".join(ctes) + f""",
c as (select id, string_agg(lpad(printf('%x', cast(m.entry as bigint)), 2, '0'), '' order by part) as code, sum(m.d)::bigint as error
  from a{ROUNDS} group by id),
h as (select sha256(string_agg(array_to_string(b, ','), ',' order by part, entry)) as codebooks_sha256 from b{ROUNDS})
select vec_id, code, error, (sum(error) over (partition by label))::bigint as label_error, codebooks_sha256 from k join c using (id), h
"""


ORACLE = _oracle()
