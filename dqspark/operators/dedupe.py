"""Blocked fuzzy self-join ("possible partial duplicates").

Semantics: rows with a name and an address, in the same block (department,
municipality) and with equal differentiator columns (null equals null), whose
token-sorted texts ``upper(strip(name)) | upper(strip(address))`` reach the
similarity threshold, are possible duplicates.

The score depends on the text alone, so the unit is a *class*: the rows of a
group with one text.  Results are pairs of classes with their row counts and
the number of row pairs they stand for, and the membership of each row;
copies are never paired one by one, neither for the pairs nor for their count.

Plan:

1. ``classes``: rows grouped by (group columns, text) with multiplicity ``m``,
   numbered and written once.
2. Lossless candidates by pigeonhole segments: the shorter text of a pair is cut
   into ``k + 1`` disjoint pieces, ``k`` the most edits any partner may be away
   (a function of its length), so at least one piece stands in the longer
   text unchanged.  Where it may stand follows from the pieces before and after
   it: at most one edit per earlier piece moves it from the left, at most one
   per later piece from the right (multi-match-aware positions).  Pieces and
   such substrings are joined on a hash of (group, length, piece number,
   characters), never a cross product; only hashes and class numbers travel.
3. Pairs of numbers are made distinct and written; texts are attached to those
   only, so no distance is computed twice.  Pieces carried by more than
   ``bucket`` texts have their key split, with the probing rows once per part;
   the plan is the same for all sizes.
4. Built-in prefilters (length bound, ``levenshtein(a, b, k) >= 0`` since
   ``lev <= indel``), then the exact LCS in an Arrow UDF.  The result is written
   before it is sorted, as a range sort reads its input twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqspark.functions import constants as K
from dqspark.functions import text as tx
from dqspark.functions.similarity import lcs_udf, similarity_from_lcs
from dqspark.session import written
from dqspark.sources.sinks import export_verified

@dataclass
class FuzzyConfig:
    key: str = "code"
    name: str = "name"
    address: str = "address"
    blocks: tuple = ("department", "municipality")
    differentiators: tuple = ("director", "sector")
    threshold: int = K.FUZZY_THRESHOLD
    bucket: int = 1000      # texts per piece beyond which its join key is split

    def group_columns(self) -> list[str]:
        return [*self.blocks, *self.differentiators]


DIRTY_FUZZY = FuzzyConfig()


def record_text(name, address) -> Column:
    return F.concat(F.upper(tx.ws_strip(name)), F.lit(K.FUZZY_TEXT_SEPARATOR), F.upper(tx.ws_strip(address)))


def _max_k(length: Column, t: int) -> Column:
    """Largest indel distance any partner of a string of this length may have
    and still reach ``t``: partners are at most ``len*(200-t)/t`` long."""
    partner = F.floor(length * (200 - t) / t)
    return F.floor((length + partner) * (100 - t) / 100).cast("int")


def with_texts(df: DataFrame, cfg: FuzzyConfig = DIRTY_FUZZY) -> DataFrame:
    """Rows that take part, with their text ``ts`` and group digest ``gid``."""
    base = df.where(F.col(cfg.name).isNotNull() & F.col(cfg.address).isNotNull())
    for b in cfg.blocks:                      # grouping drops null block keys
        base = base.where(F.col(b).isNotNull())
    group = F.to_json(F.struct(*cfg.group_columns()), {"ignoreNullFields": "false"})
    return (base.withColumn("ts", tx.token_sort(record_text(cfg.name, cfg.address)))
            .withColumn("gid", F.unhex(F.md5(group.cast("binary")))))


def classes(df: DataFrame, cfg: FuzzyConfig = DIRTY_FUZZY) -> DataFrame:
    """``(gid, group columns, ts, m, len)``: distinct texts of each group and their rows."""
    return (with_texts(df, cfg).groupBy("gid", *cfg.group_columns(), "ts").agg(F.count(F.lit(1)).alias("m"))
            .withColumn("len", F.length("ts")))


def numbered_classes(df: DataFrame, cfg: FuzzyConfig = DIRTY_FUZZY) -> DataFrame:
    """``classes`` with a number ``id`` each, written once."""
    return written(classes(df, cfg).withColumn("id", F.monotonically_increasing_id()), "fuzzy-classes")


def _pieces(length: Column, t: int) -> Column:
    """Number, start (from 0) and size of the pieces of a text of this length, as an array."""
    many = _max_k(length, t) + 1
    size, long = F.floor(length / many), F.pmod(length, many)       # the last ``long`` pieces are one longer
    return F.transform(F.sequence(F.lit(0), many - 1), lambda i: F.struct(
        i.alias("i"), (i * size + F.greatest(F.lit(0), i - many + long)).cast("int").alias("start"),
        (size + (i >= many - long).cast("int")).cast("int").alias("size")))


def _piece_key(length: Column, piece: Column, characters: Column) -> Column:
    return F.xxhash64("gid", length, piece["i"], characters)


def candidate_ids(texts: DataFrame, cfg: FuzzyConfig = DIRTY_FUZZY) -> DataFrame:
    """``(a, b)``: numbers of the classes that share a piece where it may stand, each pair once; a is the shorter."""
    t = cfg.threshold
    held = (texts.select("gid", "id", "ts", "len", F.explode(_pieces(F.col("len"), t)).alias("p"))
            .select(F.col("id").alias("a"), F.col("len").alias("la"), F.col("ts").alias("ta"),
                    _piece_key(F.col("len"), F.col("p"), F.col("ts").substr(F.col("p.start") + 1, F.col("p.size"))).alias("key")))
    probes = (texts.select("gid", "id", "ts", "len", F.explode(F.sequence(
        F.ceil(F.col("len") * t / (200 - t)).cast("int"), F.col("len"))).alias("la"))
        .select("*", _max_k(F.col("la"), t).alias("k"), F.explode(_pieces(F.col("la"), t)).alias("p")))
    p, more = F.col("p"), F.col("len") - F.col("la")
    first = F.greatest(F.lit(0), p["start"] - p["i"], p["start"] + more - (F.col("k") - p["i"]))
    last = F.least(F.col("len") - p["size"], p["start"] + p["i"], p["start"] + more + (F.col("k") - p["i"]))
    probes = (probes.withColumn("first", first).withColumn("last", last).where("first <= last")
              .select("gid", F.col("id").alias("b"), "len", "ts", "la", "p", F.explode(F.sequence("first", "last")).alias("at"))
              .select("b", F.col("len").alias("lb"), F.col("ts").alias("tb"),
                      _piece_key(F.col("la"), F.col("p"), F.col("ts").substr(F.col("at") + 1, F.col("p.size"))).alias("key")))
    order = F.xxhash64("ta"), F.xxhash64("tb")      # of two texts of one length, one is cut and the other probed
    held = held.select("a", "la", order[0].alias("ha"), "key")
    probes = probes.select("b", "lb", order[1].alias("hb"), "key").distinct()
    # only pieces of more than ``bucket`` texts are in this table: it shrinks as they get rarer
    crowded = (held.groupBy("key").agg(F.count(F.lit(1)).alias("f")).where(F.col("f") > cfg.bucket)
               .select("key", F.ceil(F.col("f") / cfg.bucket).cast("int").alias("parts")))
    parts = F.coalesce("parts", F.lit(1))
    held = held.join(crowded, "key", "left").withColumn("part", F.pmod(F.xxhash64("a"), parts).cast("int"))
    probes = probes.join(crowded, "key", "left").withColumn("part", F.explode(F.sequence(F.lit(0), parts - 1)))
    pairs = held.join(probes, ["key", "part"]).where(
        (F.col("la") < F.col("lb")) | ((F.col("la") == F.col("lb")) & (F.struct("ha", "a") < F.struct("hb", "b"))))
    return pairs.select("a", "b").distinct()


def candidate_pairs(texts: DataFrame, cfg: FuzzyConfig = DIRTY_FUZZY) -> DataFrame:
    """``(gid, ta, tb, la, lb, ma, mb)`` with ``ta < tb``: every pair of
    numbered classes that can reach the threshold, once."""
    pairs = written(candidate_ids(texts, cfg), "fuzzy-candidates")
    side = lambda n: texts.select(F.col("id").alias(n), F.col("gid").alias(f"g{n}"), F.struct("ts", "len", "m").alias(f"c{n}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where("ga = gb")       # keys are hashes
    low, high = F.least("ca", "cb"), F.greatest("ca", "cb")
    return both.select(F.col("ga").alias("gid"), low["ts"].alias("ta"), high["ts"].alias("tb"), low["len"].alias("la"),
                       high["len"].alias("lb"), low["m"].alias("ma"), high["m"].alias("mb"))


def _within(cand: DataFrame, t: int) -> DataFrame:
    k = F.floor((F.col("la") + F.col("lb")) * (100 - t) / 100).cast("int")
    return cand.withColumn("lev", F.call_function("levenshtein", F.col("ta"), F.col("tb"), k)).where("lev >= 0")


def scored_pairs(texts: DataFrame, cfg: FuzzyConfig = DIRTY_FUZZY) -> DataFrame:
    """Candidates that reach the threshold, with their ``similarity``."""
    t = cfg.threshold
    scored = _within(candidate_pairs(texts, cfg), t).withColumn("lcs", lcs_udf("ta", "tb"))
    return (scored.where(F.col("lcs") * 200 >= (F.col("la") + F.col("lb")) * t)
            .withColumn("similarity", similarity_from_lcs(F.col("lcs"), F.col("la"), F.col("lb"))))


def fuzzy_pairs(df: DataFrame, cfg: FuzzyConfig = DIRTY_FUZZY, ordered: bool = True) -> DataFrame:
    """Pairs of classes: group columns, ``text_1, text_2, similarity, rows_1,
    rows_2, pairs`` (row pairs they stand for); a class of several rows is a
    pair with itself.  ``fuzzy_members`` tells the rows of each class."""
    texts = numbered_classes(df, cfg)
    cols = cfg.group_columns()
    groups = texts.select("gid", *cols).distinct()
    out = ["text_1", "text_2", "similarity", "rows_1", "rows_2", "pairs"]
    across = (scored_pairs(texts, cfg).join(groups, "gid")
              .select(*cols, F.col("ta").alias("text_1"), F.col("tb").alias("text_2"), "similarity",
                      F.col("ma").alias("rows_1"), F.col("mb").alias("rows_2"),
                      (F.col("ma") * F.col("mb")).alias("pairs")))
    within = texts.where("m > 1").select(*cols, F.col("ts").alias("text_1"), F.col("ts").alias("text_2"),
                                         F.lit(100.0).alias("similarity"), F.col("m").alias("rows_1"),
                                         F.col("m").alias("rows_2"), F.expr("m * (m - 1) div 2").alias("pairs"))
    both = across.unionByName(within).select(*cols, *out)
    if not ordered:
        return both
    # candidates for manual review: most similar first (range-partitioned sort of the written pairs)
    return written(both, "fuzzy-pairs").orderBy(F.desc("similarity"), *[F.col(c).asc_nulls_last() for c in cols], "text_1", "text_2")


def fuzzy_members(df: DataFrame, cfg: FuzzyConfig = DIRTY_FUZZY) -> DataFrame:
    """Key, group columns and ``text`` of every row that takes part."""
    return with_texts(df, cfg).select(cfg.key, *cfg.group_columns(), F.col("ts").alias("text"))


def candidate_members(df: DataFrame, pairs: DataFrame, cfg: FuzzyConfig = DIRTY_FUZZY) -> DataFrame:
    """Key, name, address, group columns and ``text`` of the rows whose class is in ``pairs``."""
    cols = cfg.group_columns()
    rows = with_texts(df, cfg).select(cfg.key, cfg.name, cfg.address, *cols, F.col("ts").alias("text"))
    held = pairs.select(*cols, F.explode(F.array("text_1", "text_2")).alias("text")).distinct()
    same = [F.col(f"r.{c}").eqNullSafe(F.col(f"h.{c}")) for c in cols] + [F.col("r.text") == F.col("h.text")]
    return rows.alias("r").join(held.alias("h"), same, "left_semi")


def export_candidates(df: DataFrame, folder: str, cfg: FuzzyConfig = DIRTY_FUZZY, fmt: str = "parquet") -> None:
    """Candidate duplicates for review under ``folder``, both tables verified as written:
    ``pairs`` (``fuzzy_pairs``) and ``members`` (the rows behind their texts, to be joined on
    group columns and text).  Copies are rows of ``members``, never pairs."""
    found = written(fuzzy_pairs(df, cfg, ordered=False), "candidate-pairs")
    export_verified(found.orderBy(F.desc("similarity"), *cfg.group_columns(), "text_1", "text_2"), f"{folder}/pairs", fmt=fmt)
    export_verified(candidate_members(df, found, cfg), f"{folder}/members", fmt=fmt)


def fuzzy_pairs_count(df: DataFrame, cfg: FuzzyConfig = DIRTY_FUZZY) -> DataFrame:
    """Number of matching row pairs, from the classes' row counts."""
    texts = numbered_classes(df, cfg)
    across = scored_pairs(texts, cfg).select((F.col("ma") * F.col("mb")).alias("pairs"))
    within = texts.where("m > 1").select(F.expr("m * (m - 1) div 2").alias("pairs"))
    return across.union(within).agg(F.coalesce(F.sum("pairs"), F.lit(0)).cast("bigint").alias("pairs"))


def lev_prefilter_pairs(df: DataFrame, cfg: FuzzyConfig = DIRTY_FUZZY) -> DataFrame:
    """Distinct text pairs of a group with ``levenshtein(a, b) <=
    floor((100 - t) * (la + lb) / 100)``, their distance and exact similarity
    (which may fall below the threshold).

    ``k`` edits leave one of ``k + 1`` pieces whole whatever their kind, so
    every such pair is found, not only those that reach the threshold.
    """
    texts = numbered_classes(df, cfg)
    cols = cfg.group_columns()
    return (_within(candidate_pairs(texts, cfg), cfg.threshold).join(texts.select("gid", *cols).distinct(), "gid")
            .select(*cols, "ta", "tb", "lev",
                    similarity_from_lcs(lcs_udf("ta", "tb"), F.col("la"), F.col("lb")).alias("similarity")))
