"""Chat formatting: roles of transcript lines by a hidden Markov model.

Input are transcript lines (``conv_id``, ``turn``, ``line``, ``text``; ``turn``
and ``line`` only give the order).  Each line has a feature: the speaker marker
it begins with (``User:``, ``### Assistant``, ``<|system|>``, ``Q:`` ... or
none), whether it asks something, and its length class.  The hidden states are
"first line" and "further line" of a turn for each role; start, transition and
emission probabilities are counted from labelled transcripts, with one added to each
count.  Viterbi recovers the states, first lines open turns, and turns are
rendered canonically with the markers removed.

A transcript may hold a large share of all lines, so Viterbi isn't run as one
pass over a group.  A line is a matrix of log probabilities from state to
state; the product of such matrices under (max, +) is the matrix of a block of
lines, and of a block of blocks, up to one per transcript.  Going down again,
the states at a block's ends fix those at the ends of its parts, down to the
lines.  Each task sees at most ``BLOCK`` parts of a block at a time.

Defined results: a null text is an empty line; rows without a conv_id form one
transcript of their own, with a null conv_id; equal (conv_id, turn, line) are ordered by text; without labelled
lines all states are as likely; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dqspark.llm.common import fold, materialize, prepare, shuffle_partitions

BLOCK = 512
ROLES = ("system", "user", "assistant")
STATES = 2 * len(ROLES)             # role * 2, plus 1 for further lines
OUTSIDE = STATES                    # the state before the first line
SIZE = STATES + 1
NEVER = -1e18
MARKERS = {
    "system": ("system", "sys", "instruction", "instructions", "context"),
    "user": ("user", "human", "customer", "question", "q", "me"),
    "assistant": ("assistant", "ai", "bot", "agent", "answer", "a", "model"),
}
_NAMES = "|".join(sorted((n for v in MARKERS.values() for n in v), key=len, reverse=True))
MARKER = rf"(?i)^\s*(?:<\|(?:im_start\|>)?|\[|#{{1,4}}\s*|\*\*)?\s*({_NAMES})\s*(?:\|>|\]|\*\*:?|:)\s*"
LENGTHS = 3
FEATURES = (len(ROLES) + 1) * 2 * LENGTHS


def feature(text: Column) -> Column:
    """0 .. FEATURES - 1: marker (role or none), question, length class."""
    text = F.coalesce(text, F.lit(""))
    name = F.lower(F.regexp_extract(text, MARKER, 1))
    marker = F.lit(len(ROLES))
    for i, role in enumerate(ROLES):
        marker = F.when(name.isin(*MARKERS[role]), i).otherwise(marker)
    size = F.length(text)
    length = F.when(size < 40, 0).when(size < 200, 1).otherwise(2)
    asks = F.rtrim(text).endswith("?").cast("int")
    return ((marker * 2 + asks) * LENGTHS + length).cast("int")


def state_of(role: Column, first: Column) -> Column:
    index = F.lit(None)
    for i, r in enumerate(ROLES):
        index = F.when(role == r, 2 * i).otherwise(index)
    return (index + F.when(first, 0).otherwise(1)).cast("int")


class Model:
    """Log probabilities; ``step[f]`` is the matrix of a line with feature f."""

    def __init__(self, move: np.ndarray, emit: np.ndarray):
        """Counts of moves (SIZE, STATES) and of features per state (STATES, FEATURES)."""
        self.step = np.full((FEATURES, SIZE, SIZE), NEVER)
        self.step[:, :, :STATES] = (np.log(move / move.sum(1, keepdims=True))[None]
                                    + np.log(emit / emit.sum(1, keepdims=True)).T[:, None, :])


def fit(lines: DataFrame) -> Model:
    """Count from labelled lines: conv_id, seq, line, text, role (``seq`` from ``numbered``)."""
    rows = lines.select("conv_id", "seq", state_of(F.col("role"), F.col("line") == 0).alias("state"),
                        feature(F.col("text")).alias("feature"))
    before = rows.select("conv_id", (F.col("seq") + 1).alias("seq"), F.col("state").alias("before"))
    pairs = rows.join(before, ["conv_id", "seq"], "left").where("state is not null")
    move, emit = np.ones((SIZE, STATES)), np.ones((STATES, FEATURES))
    # at most SIZE * STATES * FEATURES rows
    for r in pairs.groupBy("before", "state", "feature").count().collect():
        emit[r["state"], r["feature"]] += r["count"]
        move[OUTSIDE if r["before"] is None else r["before"], r["state"]] += r["count"]
    return Model(move, emit)


def _compose(matrices: np.ndarray) -> np.ndarray:
    out = matrices[0]
    for m in matrices[1:]:
        out = (out[:, :, None] + m[None]).max(1)
    return out


def _decode(matrices: np.ndarray, enter: int, leave: int) -> np.ndarray:
    """States after each part on the best way from ``enter`` to ``leave``."""
    n = len(matrices)
    score, back = matrices[0][enter], np.zeros((n, SIZE), np.int64)
    for k in range(1, n):
        total = score[:, None] + matrices[k]
        back[k] = total.argmax(0)
        score = total.max(0)
    out = np.empty(n, np.int64)
    out[-1] = leave
    for k in range(n - 1, 0, -1):
        out[k - 1] = back[k][out[k]]
    return out


def _matrices(rows: list[tuple], model: Model | None) -> np.ndarray:
    if model is not None:
        return model.step[np.array([r[2] for r in rows])]
    return np.stack([np.frombuffer(r[2], np.float64) for r in rows]).reshape(-1, SIZE, SIZE)


def _grouped(batches: Iterator[pa.RecordBatch]) -> Iterator[list[tuple]]:
    """Rows of one (conv_id, block) after the other."""
    held: list[tuple] = []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if held and row[:2] != held[0][:2]:
                yield held
                held = []
            held.append(row)
    if held:
        yield held


def _emit(rows: list[tuple], fields: list[tuple[str, pa.DataType]]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, (_, t) in zip(columns, fields, strict=True)],
                                      names=[n for n, _ in fields])


def _batched(rows: Iterator[tuple], fields, size: int = 4096) -> Iterator[pa.RecordBatch]:
    held = []
    for r in rows:
        held.append(r)
        if len(held) >= size:
            yield _emit(held, fields)
            held = []
    if held:
        yield _emit(held, fields)


def _up(parts: DataFrame, model: Model | None) -> DataFrame:
    """conv_id, seq, matrix of the blocks of ``conv_id, seq, item`` (lines: item is the feature)."""
    def run(batches):
        rows = ((g[0][0], g[0][1], _compose(_matrices(g, model)).tobytes()) for g in _grouped(batches))
        return _batched(rows, [("conv_id", pa.int64()), ("seq", pa.int64()), ("item", pa.binary())])
    n = shuffle_partitions(parts.sparkSession)
    dealt = parts.select("conv_id", F.expr(f"seq div {BLOCK}").alias("block"), "item", "seq")
    return (dealt.repartition(n, "conv_id", "block").sortWithinPartitions("conv_id", "block", "seq")
            .select("conv_id", "block", "item").mapInArrow(run, "conv_id long, seq long, item binary"))


def _down(parts: DataFrame, blocks: DataFrame, model: Model | None) -> DataFrame:
    """conv_id, seq, enter, leave of the parts, given those of the blocks (``conv_id, seq, enter, leave``)."""
    def run(batches):
        def rows():
            for g in _grouped(batches):
                enter = g[0][3]
                for r, state in zip(g, _decode(_matrices(g, model), enter, g[0][4]).tolist(), strict=True):
                    yield r[0], r[5], enter, state
                    enter = state
        return _batched(rows(), [("conv_id", pa.int64()), ("seq", pa.int64()), ("enter", pa.int32()),
                                 ("leave", pa.int32())])
    n = shuffle_partitions(parts.sparkSession)
    known = blocks.withColumnRenamed("seq", "block")
    dealt = (parts.select("conv_id", F.expr(f"seq div {BLOCK}").alias("block"), "item", "seq")
             .repartition(n, "conv_id", "block").join(known, ["conv_id", "block"])
             .sortWithinPartitions("conv_id", "block", "seq"))
    return dealt.select("conv_id", "block", "item", "enter", "leave", "seq").mapInArrow(
        run, "conv_id long, seq long, enter int, leave int")


def numbered(lines: DataFrame, name: str = "chat-lines", unnamed: int = -1) -> DataFrame:
    """``lines`` with their place ``seq`` in the transcript (a null conv_id is ``unnamed`` from here on).

    Lines are range partitioned in order; a line's place is its place in its
    run plus the lines of its transcript in the runs before.
    """
    spark = lines.sparkSession
    prepare(spark)
    order = ["conv_id", "turn", "line", "text"]
    lines = lines.withColumn("conv_id", F.coalesce(F.col("conv_id").cast("long"), F.lit(unnamed).cast("long")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, last, at = TaskContext.get().partitionId(), object(), 0
        for batch in batches:
            places = []
            for c in batch.column("conv_id").to_pylist():
                at = at + 1 if c == last else 0
                last = c
                places.append(at)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(places, pa.int64()),
                                              pa.array([part] * len(places), pa.int32())],
                                             names=[*batch.schema.names, "place", "run"])
    schema = type(lines.schema)(list(lines.schema.fields)).add("place", "long").add("run", "integer")
    placed = materialize(lines.repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
                         .mapInArrow(run, schema), name)
    # one row per transcript and run; only transcripts that span runs have more than one
    per_run = placed.groupBy("conv_id", "run").agg(F.count("*").alias("n"))
    upto = Window.partitionBy("conv_id").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    before = per_run.select(F.col("conv_id").alias("c"), F.col("run").alias("r"),
                            F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before")).where("before > 0")
    joined = placed.join(before, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("run") == F.col("r")), "left")
    return joined.select(*lines.columns, (F.col("place") + F.coalesce("before", F.lit(0))).alias("seq"))


def parse(lines: DataFrame, model: Model) -> DataFrame:
    """Numbered lines with ``role_pred`` and ``opens`` (first line of a turn)."""
    placed = lines.drop("role_pred", "opens")
    levels = [placed.select("conv_id", "seq", feature(F.col("text")).alias("item"))]
    most = placed.agg(F.max("seq")).first()[0]
    while True:
        levels.append(materialize(_up(levels[-1], model if len(levels) == 1 else None), f"chat-up{len(levels)}"))
        if most is None or most < BLOCK ** (len(levels) - 1):
            break

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [(c, s, OUTSIDE, int(np.frombuffer(m, np.float64).reshape(SIZE, SIZE)[OUTSIDE].argmax()))
                   for c, s, m in zip(*(x.to_pylist() for x in batch.columns), strict=True)]
            yield _emit(out, [("conv_id", pa.int64()), ("seq", pa.int64()), ("enter", pa.int32()), ("leave", pa.int32())])
    states = levels[-1].mapInArrow(ends, "conv_id long, seq long, enter int, leave int")
    for k in range(len(levels) - 2, -1, -1):
        states = materialize(_down(levels[k], states, model if k == 0 else None), f"chat-down{k}")
    role = F.element_at(F.array(*[F.lit(r) for r in ROLES]), (F.col("leave") / 2).cast("int") + 1)
    return (placed.join(states.select("conv_id", "seq", "leave"), ["conv_id", "seq"])
            .withColumn("role_pred", role)
            .withColumn("opens", (F.col("leave") % 2 == 0) | (F.col("seq") == 0)).drop("leave"))


def opening(parsed: DataFrame) -> DataFrame:
    """``parsed`` with ``opened``: the seq of the line that opens the line's turn.

    The last opening is looked for in the line's block of lines and, failing
    that, in the summary of the blocks before.
    """
    block = F.expr(f"seq div {BLOCK}")
    here = Window.partitionBy("conv_id", "block").orderBy("seq")
    rows = parsed.withColumn("block", block).withColumn("own", F.last(F.when(F.col("opens"), F.col("seq")), True).over(here))
    blocks = parsed.withColumn("block", block).groupBy("conv_id", "block").agg(
        F.max(F.when(F.col("opens"), F.col("seq"))).alias("m"))
    before = blocks.withColumn("carried", F.last("m", True).over(
        Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))).drop("m")
    return (rows.join(before, ["conv_id", "block"]).withColumn("opened", F.coalesce("own", "carried", F.lit(0)))
            .drop("own", "carried", "block"))


def render(parsed: DataFrame) -> DataFrame:
    """One row per recovered turn: conv_id, turn_start, role, lines, text, rendered (canonical form)."""
    body = F.regexp_replace(F.coalesce("text", F.lit("")), MARKER, "")
    rows = opening(parsed).select("conv_id", "opened", "seq", "role_pred", "opens",
                                  F.when(F.col("opens"), body).otherwise(F.coalesce("text", F.lit(""))).alias("body"))
    turns = rows.groupBy("conv_id", "opened").agg(
        F.max(F.when(F.col("seq") == F.col("opened"), F.col("role_pred"))).alias("role"), F.count("*").alias("lines"),
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("seq", "body"))), lambda x: x["body"]), "\n")
        .alias("text"))
    return turns.select("conv_id", F.col("opened").alias("turn_start"), "role", "lines", "text",
                        F.concat(F.lit("<|im_start|>"), "role", F.lit("\n"), "text", F.lit("<|im_end|>")).alias("rendered"))


# Transcripts made of the conversations table.

def transcripts(conversations: DataFrame) -> DataFrame:
    """Transcript lines of conversations: conv_id, turn, line, text and the true role.

    Each conversation writes its markers in one of five styles; by a hash, one
    turn in six has lost its marker.
    """
    h = F.pmod(F.xxhash64("conv_id"), F.lit(5))
    name = F.initcap("role")
    long = F.when(F.col("role") == "user", "Human").when(F.col("role") == "assistant", "AI").otherwise("System")
    short = F.when(F.col("role") == "user", "Q").when(F.col("role") == "assistant", "A").otherwise("Context")
    marker = (F.when(h == 0, F.concat(name, F.lit(": "))).when(h == 1, F.concat(F.lit("### "), long, F.lit(": ")))
              .when(h == 2, F.concat(F.lit("<|"), "role", F.lit("|>"))).when(h == 3, F.concat(short, F.lit(": ")))
              .otherwise(F.concat(F.lit("**"), name, F.lit("**: "))))
    lost = F.pmod(F.xxhash64("conv_id", "turn", F.lit("lost")), F.lit(6)) == 0
    text = F.concat(F.when(lost, "").otherwise(F.coalesce(marker, F.lit(""))), F.coalesce("text", F.lit("")))
    return conversations.select("conv_id", F.col("turn").cast("long").alias("turn"), "role",
                                F.posexplode(F.split(text, "\n")).alias("line", "text"))


def recovered(spark: SparkSession, conversations: DataFrame) -> DataFrame:
    """Turns of every conversation recovered from its transcript; learns from folds 0, 1 and 3 of 4."""
    prepare(spark)
    ends = conversations.select(F.col("conv_id").cast("long").alias("c")).agg(F.min("c").alias("low"), F.max("c").alias("high")).first()
    # an id that no conversation has stands for null while lines are grouped
    unnamed = -1 if ends["high"] is None else ends["high"] + 1 if ends["high"] < (1 << 63) - 1 else ends["low"] - 1
    lines = materialize(numbered(transcripts(conversations), unnamed=unnamed), "chat-placed")
    turns = render(parse(lines.drop("role"), fit(lines.where(fold("conv_id", 4) != 2))))
    return turns.withColumn("conv_id", F.nullif("conv_id", F.lit(unnamed).cast("long")))


def strip_marker(text: str) -> str:
    return re.sub(MARKER, "", text)
