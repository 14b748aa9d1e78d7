"""Phrase collocations by best-first growth with admissible score bounds.

Texts are lower-cased (A-Z), cut into pieces at ``[.,;:!?\\x0A-\\x0D]`` and
into words ``[^\\x20\\x09]+``; everything is per language.  A phrase of a
occurrences, cut into a first part of l and a rest of r occurrences, scores
``floor(1000000 * a * a / (l * r))``; the lowest cut counts (ties: the
shortest first part).  Candidates have ``LEAST`` occurrences or more; one whose
words lie in a longer candidate of at least ``COVER`` percent of its
occurrences is dropped.

Growth is by levels of the prefix tree.  All words of ``LEAST`` occurrences are
prefixes that may reach any score, so all are grown by a word.  A prefix
``x y`` of P occurrences bounds all phrases ``x y z``: they occur P times at
most and their rest no less often than they, so cutting after ``x`` gives
``floor(1000000 * P / f(x))`` at most.  The frontier is opened best bound first:
a level of the score is set per language (at first that of its 2000th best
pair), and prefixes whose bound reaches it are grown.  At or above the level
every score is then known, and of every pair there what may drop it (the
phrases grown from it, and those that end with it).  A language with 2000
survivors at its level is settled, ties included; the others go on with a lower
level and grow only what has been opened since.

Counting is exact and over all texts: tasks count a batch by dictionary and
sort, Spark adds the counts.  A word's id is a 64-bit digest of language and
word; if two words of the corpus have one id, all is counted with another key.
Membership filters of fixed size keep most words and prefixes that don't
matter out of the shuffle; joins decide.  Products are decimals of 38 digits (a
below 10**16).

Defined results: null texts are empty, a null language is ``und`` (together
with a language of that name), rows that repeat count each, ids and other
columns are ignored, an empty table gives an empty result, languages with fewer
survivors return all of them.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dqspark.llm.common import LOWER, bitmap, groups, marked, materialize, prepare, utf8

LEAST = 10
TOP = 2000
COVER = 50
WIDEN = 4                   # times as many pairs are looked at in the next round
FILTER_BITS = 1 << 23       # of a filter of words or prefixes: 1 MB
GROUP = 1 << 23             # bytes of text counted at once
SALTS = 8
KEYS = 8                    # attempts at ids without collision

BREAK, BLANK = np.zeros(256, bool), np.zeros(256, bool)
BREAK[[ord(c) for c in ".,;:!?"] + [0x0A, 0x0B, 0x0C, 0x0D]] = True
BLANK[[0x20, 0x09]] = True


def _tokens(texts: pa.Array, langs: pa.Array, key: int):
    """(language of each code, code of each word's language, distinct words, their
    place in them per word, ids of the words, whether the next word is in the same piece)."""
    data, offsets = utf8(texts)
    coded = langs.dictionary_encode()
    data = LOWER[data]
    n = len(data)
    inside = ~(BREAK[data] | BLANK[data])
    edge = np.zeros(n + 1, bool)
    edge[offsets] = True
    start = inside.copy()
    start[1:] &= ~inside[:-1] | edge[1:n]
    s = np.flatnonzero(start)
    row = np.searchsorted(offsets, s, side="right") - 1
    # all bytes of words, one after the other: word i ends where i + 1 begins
    before = np.concatenate([[0], np.cumsum(inside)])
    cuts = np.concatenate([before[s], before[-1:]]).astype(np.int32)
    flat = data[inside]
    words = pa.Array.from_buffers(pa.binary(), len(s), [None, pa.py_buffer(cuts), pa.py_buffer(flat)]).dictionary_encode()
    piece = np.cumsum(BREAK[data])[s] if n else s
    follows = np.zeros(len(s), bool)
    follows[:-1] = (row[1:] == row[:-1]) & (piece[1:] == piece[:-1])
    code = coded.indices.to_numpy()[row] if len(s) else s
    place = words.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    # distinct (language, word): ids of those only
    many = max(1, len(words.dictionary))
    both, at = np.unique(code.astype(np.int64) * many + place, return_inverse=True)
    names = [x.encode() for x in coded.dictionary.to_pylist()]
    spelled = words.dictionary
    seed = key.to_bytes(4, "little")
    raw = spelled.to_pylist()
    ids = np.frombuffer(b"".join(hashlib.blake2b(raw[b % many], digest_size=8, key=seed + hashlib.blake2b(
        names[b // many], digest_size=32).digest()).digest() for b in both.tolist()), np.int64)
    return coded.dictionary, both // many, spelled.take(pa.array(both % many)), at, ids, follows


def _grouped(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        _, offsets = utf8(batch.column(1))
        for i, j in groups(offsets, GROUP):
            yield batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i)


def _words(key: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, texts in _grouped(batches):
            names, code, spelled, at, ids, _ = _tokens(texts, langs, key)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids), names.take(pa.array(code)), pc.cast(spelled, pa.string()),
                 pa.array(np.bincount(at, minlength=len(ids)))], names=["id", "lang", "word", "n"])
    return run


def _holds(pairs: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Whether a filter of pairs, placed by ``_pair_place``, may hold each pair of ids."""
    return marked(pairs, ((x.view(np.uint64) >> np.uint64(20)) ^ y.view(np.uint64)) & np.uint64(64 * len(pairs) - 1))


def _pair_place(x: str, y: str, bits: int) -> Column:
    return F.expr(f"(shiftrightunsigned({x}, 20) ^ {y}) & {bits - 1}L")


def _pairs(key: int, frequent):
    """Pairs of frequent words and their occurrences in each group of texts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, texts in _grouped(batches):
            _, _, _, at, ids, follows = _tokens(texts, langs, key)
            known = marked(frequent.value, ids.view(np.uint64) & np.uint64(64 * len(frequent.value) - 1))[at] if len(at) else follows
            i = np.flatnonzero(follows & known)
            i = i[known[i + 1]]
            pair, n = np.unique(at[i] * len(ids) + at[i + 1], return_counts=True)
            many = max(1, len(ids))
            yield pa.RecordBatch.from_arrays([pa.array(ids[pair // many]), pa.array(ids[pair % many]), pa.array(n)],
                                             names=["x", "y", "n"])
    return run


def _triples(key: int, opened, ending):
    """Triples that begin with an opened prefix or end with a pair of ``ending``, as far as the filters tell."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for langs, texts in _grouped(batches):
            _, _, _, at, ids, follows = _tokens(texts, langs, key)
            i = np.flatnonzero(follows[:-1] & follows[1:]) if len(at) > 2 else at[:0]
            x, y, z = ids[at[i]], ids[at[i + 1]], ids[at[i + 2]]
            keep = _holds(opened.value, x, y) | _holds(ending.value, y, z)
            i = i[keep]
            many = max(1, len(ids))
            pair, first = np.unique(at[i] * many + at[i + 1], return_inverse=True)
            triple, n = np.unique(first * many + at[i + 2], return_counts=True)
            pair, last = pair[triple // many], triple % many
            yield pa.RecordBatch.from_arrays([pa.array(ids[pair // many]), pa.array(ids[pair % many]), pa.array(ids[last]),
                                              pa.array(n)], names=["x", "y", "z", "n"])
    return run


def score(a: str, left: str, right: str) -> Column:
    """floor(1000000 * a * a / (l * r)), exact."""
    wide = lambda c: f"cast({c} as decimal(16, 0))"
    return F.expr(f"cast((cast({wide(a)} * {wide(a)} as decimal(32, 0)) * cast(1000000 as decimal(7, 0)))"
                  f" div cast({wide(left)} * {wide(right)} as decimal(32, 0)) as bigint)")


def _salted(table: DataFrame) -> DataFrame:
    """``table`` once per salt, for joins with rows of which one key may have most."""
    return table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))


def _count(rows: DataFrame, keys: list[str], least: int) -> DataFrame:
    return rows.groupBy(*keys).agg(F.sum("n").alias("a")).where(F.col("a") >= least)


def _words_table(texts: DataFrame, least: int) -> tuple[int, DataFrame, DataFrame]:
    """Key of the ids, words of ``least`` occurrences (id, lang, word, f), and n per language."""
    for key in range(KEYS):
        words = materialize(texts.mapInArrow(_words(key), "id long, lang string, word string, n long")
                            .groupBy("id", "lang", "word").agg(F.sum("n").alias("f")), "colloc-words")
        if words.groupBy("id").count().where("count > 1").isEmpty():
            break
    else:
        raise ValueError("two words have one id under every key")
    return key, words.where(F.col("f") >= least), materialize(words.groupBy("lang").agg(F.sum("f").alias("n")), "colloc-n")


def _pairs_table(texts: DataFrame, key: int, words: DataFrame, least: int) -> DataFrame:
    """Pairs of ``least`` occurrences: x, y, lang, a, l, r, score, bound of what begins with them."""
    frequent = bitmap(words, F.col("id").bitwiseAND(F.lit(FILTER_BITS - 1)), FILTER_BITS)
    known = texts.sparkSession.sparkContext.broadcast(frequent)
    counted = materialize(_count(texts.mapInArrow(_pairs(key, known), "x long, y long, n long"), ["x", "y"], least)
                          .withColumn("salt", F.pmod(F.xxhash64("x", "y"), F.lit(SALTS)).cast("int")), "colloc-pair-counts")
    first = _salted(words.select(F.col("id").alias("x"), "lang", F.col("f").alias("l")))
    second = _salted(words.select(F.col("id").alias("y"), F.col("f").alias("r")))
    return materialize(counted.join(first, ["x", "salt"]).join(second, ["y", "salt"]).select(
        "x", "y", "lang", "a", "l", "r", score("a", "l", "r").alias("score"),
        F.expr("cast(cast(a as decimal(20, 0)) * 1000000 div l as bigint)").alias("bound")), "colloc-pairs")


def _level(scores: DataFrame, target: int) -> DataFrame:
    """``lang, tau``: the score of the ``target``-th best row of each language (0 if it has fewer).

    Rows are counted per score first, at most 1,000,001 rows per language.
    """
    per = scores.groupBy("lang", "score").agg(F.count("*").alias("rows"))
    upto = F.sum("rows").over(Window.partitionBy("lang").orderBy(F.desc("score")).rowsBetween(Window.unboundedPreceding, 0))
    return (per.withColumn("upto", upto).groupBy("lang")
            .agg(F.coalesce(F.max(F.when(F.col("upto") >= target, F.col("score"))), F.lit(0)).alias("tau")))


def _grow(texts: DataFrame, key: int, words: DataFrame, pairs: DataFrame, levels: DataFrame, least: int) -> DataFrame:
    """Triples of ``least`` occurrences opened between the old and the new level of their language.

    ``levels``: lang, tau, before (null: nothing is open).  Triples that
    begin with a prefix whose bound reaches the level, or end with a pair whose
    score does, and neither reached it before.
    """
    spark = texts.sparkSession
    leveled = pairs.join(F.broadcast(levels) if levels.count() <= 10000 else levels, "lang")
    new = lambda c: (F.col(c) >= F.col("tau")) & (F.col("before").isNull() | (F.col(c) < F.col("before")))
    filters = [spark.sparkContext.broadcast(bitmap(leveled.where(new(c)), _pair_place("x", "y", FILTER_BITS), FILTER_BITS))
               for c in ("bound", "score")]
    counted = materialize(_count(texts.mapInArrow(_triples(key, *filters), "x long, y long, z long, n long"), ["x", "y", "z"], least),
                          "colloc-triple-counts")
    head = leveled.select("x", "y", "lang", F.col("a").alias("head"), F.col("l").alias("fx"), "bound", "tau", "before")
    tail = pairs.select(F.col("x").alias("y"), F.col("y").alias("z"), F.col("a").alias("tail"), F.col("r").alias("fz"),
                        F.col("score").alias("tail_score"))
    opened = (F.col("bound") >= F.col("tau")) | (F.col("tail_score") >= F.col("tau"))
    seen = F.col("before").isNotNull() & ((F.col("bound") >= F.col("before")) | (F.col("tail_score") >= F.col("before")))
    both = counted.join(head, ["x", "y"]).join(tail, ["y", "z"]).where(opened & ~seen)
    one, two = score("a", "fx", "tail"), score("a", "head", "fz")
    return materialize(both.withColumn("one", one).withColumn("two", two).select(
        "x", "y", "z", "lang", "a", F.when(F.col("one") <= F.col("two"), F.col("fx")).otherwise(F.col("head")).alias("l"),
        F.when(F.col("one") <= F.col("two"), F.col("tail")).otherwise(F.col("fz")).alias("r"),
        F.least("one", "two").alias("score")), "colloc-triples")


def _survivors(pairs: DataFrame, triples: DataFrame, levels: DataFrame, cover: int) -> DataFrame:
    """Phrases at or above their language's level that no longer phrase covers; all of these are known."""
    ends = lambda x, y: triples.select(F.col(x).alias("x"), F.col(y).alias("y"), F.col("a").alias("longer"))
    longest = ends("x", "y").union(ends("y", "z")).groupBy("x", "y").agg(F.max("longer").alias("longer"))
    at = levels.select("lang", "tau")
    two = (pairs.join(at, "lang").where("score >= tau").join(longest, ["x", "y"], "left")
           .where(f"longer is null or 100 * cast(longer as decimal(20, 0)) < {cover} * cast(a as decimal(20, 0))"))
    three = triples.join(at, "lang").where("score >= tau")
    columns = ["lang", "x", "y", "z", "a", "l", "r", "score"]
    return two.withColumn("z", F.lit(None).cast("long")).select(*columns).union(three.select(*columns))


def mine(docs: DataFrame, top: int = TOP, least: int = LEAST, cover: int = COVER) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the ``top`` phrases of every language of ``docs``."""
    spark = docs.sparkSession
    prepare(spark)
    texts = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    key, words, total = _words_table(texts, least)
    pairs = _pairs_table(texts, key, words, least)
    target, triples = top, None
    levels = materialize(_level(pairs, target).withColumn("before", F.lit(None).cast("long")), "colloc-levels")
    settled = levels.limit(0)
    while True:
        grown = _grow(texts, key, words, pairs, levels, least)
        triples = grown if triples is None else triples.unionByName(grown)
        found = materialize(_survivors(pairs, triples, levels.unionByName(settled), cover), "colloc-found")
        enough = found.groupBy("lang").agg(F.count("*").alias("rows"))
        judged = materialize(levels.join(enough, "lang", "left").withColumn(
            "done", (F.coalesce("rows", F.lit(0)) >= top) | (F.col("tau") == 0)).drop("rows"), "colloc-judged")
        settled = settled.unionByName(judged.where("done").drop("done"))
        if judged.where("not done").isEmpty():
            break
        target *= WIDEN
        left = judged.where("not done").select("lang", F.col("tau").alias("before"))
        levels = materialize(left.join(_level(pairs, target), "lang").withColumn(
            "tau", F.when(F.col("tau") < F.col("before"), F.col("tau")).otherwise(F.floor(F.col("before") / 2)))
            .select("lang", "tau", "before"), "colloc-levels")
    return _ranked(found, words, total, top)


def _ranked(found: DataFrame, words: DataFrame, total: DataFrame, top: int) -> DataFrame:
    """The first ``top`` rows of each language with their spelling."""
    per = found.groupBy("lang", "score", "a").agg(F.count("*").alias("rows"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    above = F.sum("rows").over(order.rowsBetween(Window.unboundedPreceding, 0)) - F.col("rows")
    reached = per.withColumn("above", above).where(F.col("above") < top).select("lang", "score", "a")
    rows = materialize(found.join(reached, ["lang", "score", "a"]), "colloc-best")     # ties at the end included
    ids = rows.select(F.explode(F.array("x", "y", "z")).alias("id")).where("id is not null").distinct()
    spelled = materialize(words.join(ids, "id", "left_semi").select("id", "word"), "colloc-spelled")
    for k in "xyz":
        rows = rows.join(spelled.select(F.col("id").alias(k), F.col("word").alias(f"word_{k}")), k, "left")
    rows = rows.withColumn("phrase", F.concat_ws(" ", "word_x", "word_y", "word_z"))
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (rows.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
            .join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score"))


ORACLE = r"""
with pieces as (
  select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece from documents),
w as materialized (select lang, regexp_extract_all(piece, '[^\x20\x09]+') as ws from pieces),
f as materialized (
  select lang, k, phrase, count(*) as f from (
    select lang, 1 as k, unnest(ws) as phrase from w
    union all select lang, 2, unnest(list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) from w
    union all select lang, 3, unnest(list_transform(range(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2])) from w)
  group by all),
n as (select lang, sum(f)::bigint as n from f where k = 1 group by lang),
c as materialized (select lang, k, phrase, f as a, string_split(phrase, ' ') as ws from f where k > 1 and f >= 10),
cuts as materialized (
  select lang, k, phrase, a, cut, array_to_string(ws[1:cut], ' ') as left_part, array_to_string(ws[cut + 1:], ' ') as right_part
  from (select *, unnest(range(1, k)) as cut from c)),
scored as (
  select cuts.lang, cuts.k, cuts.phrase, a, cut, l.f as l, r.f as r,
    ((1000000::hugeint * a * a) // (l.f::hugeint * r.f))::bigint as score
  from cuts
  join f l on l.lang = cuts.lang and l.phrase = left_part
  join f r on r.lang = cuts.lang and r.phrase = right_part),
lowest as (
  select lang, k, phrase, a, l, r, score from scored
  qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
covering as (
  select lang, phrase, max(longer) as longer from (
    select lang, array_to_string(ws[1:2], ' ') as phrase, a as longer from c where k = 3
    union all select lang, array_to_string(ws[2:3], ' '), a from c where k = 3)
  group by all),
kept as (
  select lowest.* from lowest left join covering using (lang, phrase)
  where k = 3 or longer is null or 100 * longer < 50 * a)
select lang, row_number() over (partition by lang order by score desc, a desc, phrase) as rank, phrase, a, l, r, n, score
from kept join n using (lang)
qualify rank <= 2000
"""
