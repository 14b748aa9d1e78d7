"""Mix sources to target weights by Pareto order sampling (DataFrame functions only).

Every document is expected ``r = target / size of its source`` times.  The
whole part of ``r`` is taken for certain; for the rest each document has the
inclusion probability ``pi = r - floor(r)`` and the rank
``odds(u) / odds(pi)`` with a uniform ``u`` that is a digest of its id.  In the
order of the ranks documents get one more copy until the words still due to
the source are reached; the one document at that border gives only the words
that are missing, so a source's words meet its rounded target exactly.

The border is found without a global sort: ranks are mapped to ``BUCKETS``
bins, sizes are summed per source and bin, and only the one bin that holds the
border is ordered row by row.

Defined results: null or empty text has size 0 and takes 0 words; a null
source is a source of its own, after all others; documents without an id draw
``u`` from their text's digest; equal rows get equal ranks (ties go by id and
size); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dqspark.llm.common import materialize

BUCKETS = 4096
WORD = r"[^\x20\x09-\x0D]+"
SEED = "mix-1:"


def size_of(text: str = "text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long")


def uniform(key: Column, seed: str = SEED) -> Column:
    """52 bits of a digest as a number strictly between 0 and 1."""
    digits = F.conv(F.substring(F.md5(F.concat(F.lit(seed), key).cast("binary")), 1, 13), 16, 10)
    return (digits.cast("long") + F.lit(0.5)) / F.lit(float(1 << 52))


def targets(sizes: DataFrame, weights=(5, 2, 1), max_repeat: int = 3) -> DataFrame:
    """One row per source: source, source_size, target.

    Weights go round the sources in code point order (null last).  All sizes
    are shared by weight; a source whose share is over ``max_repeat`` times its
    size keeps that much and the excess is shared again.  Taking sources by
    rising limit per weight, those limited form a prefix, so the final level
    is that of the first source within its limit.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weight = F.element_at(F.array(*[F.lit(int(w)) for w in weights]),
                          ((F.row_number().over(by_name) - 1) % len(weights) + 1).cast("int"))
    per = per.withColumn("weight", weight).withColumn("limit", F.col("source_size") * max_repeat)
    rising = Window.orderBy(F.col("limit") / F.col("weight"), F.col("source").asc_nulls_last())
    every = Window.partitionBy(F.lit(0))
    before = F.coalesce(F.sum("limit").over(rising.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    left = F.sum("weight").over(rising.rowsBetween(Window.currentRow, Window.unboundedFollowing))
    per = (per.withColumn("place", F.row_number().over(rising))
           .withColumn("level", (F.sum("source_size").over(every) - before) / left)
           .withColumn("within", F.col("limit") >= F.col("level") * F.col("weight")))
    level = F.min_by(F.when(F.col("within"), F.col("level")),
                     F.when(F.col("within"), F.col("place"))).over(every)
    return per.select("source", "source_size",
                      F.least(F.col("limit").cast("double"), level * F.col("weight")).alias("target"))


def mix(docs: DataFrame, weights=(5, 2, 1), max_repeat: int = 3, seed: str = SEED, carry: bool = False) -> DataFrame:
    """doc_id, size, source_size, target, taken and rank of every document.

    With ``carry``: all columns of ``docs`` (those named like a result are
    replaced), read again so that texts aren't shuffled.
    """
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.col("text").cast("binary")), F.lit(""))
    drawn = [size_of().alias("size"), uniform(key, seed).alias("u")]
    slim = materialize(docs.select("doc_id", "source", *drawn), "mix-sizes")
    base = (docs.select(F.struct("*").alias("row"), "doc_id", "source", *drawn) if carry
            else slim.withColumn("row", F.lit(None).cast("int")))
    per = materialize(targets(slim, weights, max_repeat), "mix-targets")
    ratio = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    per = (per.withColumnRenamed("source", "of_source").withColumn("copies", F.floor(ratio))
           .withColumn("pi", ratio - F.col("copies"))
           .withColumn("due", F.greatest(F.round("target").cast("long")
                                         - F.col("copies") * F.col("source_size"), F.lit(0))))

    def ranked(rows: DataFrame) -> DataFrame:
        odds = lambda x: x / (1 - x)
        return (rows.join(per, F.col("source").eqNullSafe(F.col("of_source"))).drop("of_source")
                .withColumn("rank", F.when(F.col("pi") > 0, odds(F.col("u")) / odds(F.col("pi")))
                            .otherwise(F.lit(float("inf"))))
                .withColumn("bin", F.when(F.col("pi") > 0, F.floor(
                    F.col("rank") / (1 + F.col("rank")) * BUCKETS)).otherwise(BUCKETS).cast("int")))

    binned = ranked(slim).groupBy("source", "bin").agg(F.sum("size").alias("words"), F.first("due").alias("due"))
    upto = Window.partitionBy("source").orderBy("bin")
    binned = binned.withColumn("before", F.sum("words").over(upto) - F.col("words"))
    border = materialize(binned.where((F.col("before") < F.col("due"))
                                      & (F.col("before") + F.col("words") >= F.col("due")))
                         .select(F.col("source").alias("of_source"), F.col("bin").alias("border"), "before"),
                         "mix-border")
    placed = (ranked(base).join(border, F.col("source").eqNullSafe(F.col("of_source")), "left").drop("of_source")
              .withColumn("border", F.coalesce("border", F.lit(-1))))
    copies = F.col("copies") * F.col("size")
    keep = ["row", "doc_id", "size", "source_size", "target"]
    whole = placed.where(F.col("bin") != F.col("border")).select(
        *keep, (copies + F.when(F.col("bin") < F.col("border"), F.col("size")).otherwise(0)).alias("taken"), "rank")
    order = Window.partitionBy("source").orderBy("rank", "doc_id", "size") \
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at_border = (placed.where(F.col("bin") == F.col("border"))
                 .withColumn("room", F.col("due") - F.col("before") - F.sum("size").over(order) + F.col("size"))
                 .select(*keep, (copies + F.greatest(F.lit(0), F.least("size", "room"))).alias("taken"), "rank"))
    out = whole.unionByName(at_border)
    if not carry:
        return out.drop("row")
    added = ["size", "source_size", "target", "taken", "rank"]
    return out.select(*[F.col("row")[c].alias(c) for c in docs.columns if c not in added], *added)


ORACLE = r"""
with slim as (
  select doc_id, source,
    coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::bigint as size,
    (('0x' || substr(md5('mix-1:' || coalesce(doc_id::varchar, md5(text), '')), 1, 13))::bigint + 0.5::double)
      / 4503599627370496::double as u
  from documents),
per0 as (
  select source, sum(size)::bigint as source_size,
    [5, 2, 1][((row_number() over (order by source asc nulls last)) - 1) % 3 + 1] as weight
  from slim group by source),
per1 as (
  select *, source_size * 3 as lim,
    row_number() over (order by source_size * 3 / weight::double, source asc nulls last) as place,
    ((sum(source_size) over ())::bigint
      - coalesce(sum(source_size * 3) over (order by source_size * 3 / weight::double, source asc nulls last
          rows between unbounded preceding and 1 preceding), 0)::bigint)::double
      / (sum(weight) over (order by source_size * 3 / weight::double, source asc nulls last
          rows between current row and unbounded following))::double as level
  from per0),
per as (
  select source, source_size,
    least(lim::double, (select level from per1 where lim >= level * weight order by place limit 1) * weight) as target
  from per1),
per2 as (select *, case when source_size > 0 then target / source_size else 0 end as ratio from per),
per3 as (
  select *, floor(ratio)::bigint as copies, ratio - floor(ratio) as pi,
    greatest(round(target)::bigint - floor(ratio)::bigint * source_size, 0) as due from per2),
ranked as (
  select s.*, p.* exclude (source),
    case when pi > 0 then (u / (1 - u)) / (pi / (1 - pi)) else 'inf'::double end as rank
  from slim s join per3 p on s.source is not distinct from p.source)
select doc_id, size, source_size, target,
  (copies * size + case when pi > 0 then greatest(0, least(size, due
     - (sum(size) over (partition by source order by rank, doc_id, size rows unbounded preceding))::bigint + size))
     else 0 end)::bigint as taken
from ranked
"""
