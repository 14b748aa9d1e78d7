"""Quality classifier on learned subword embeddings.

Every word and every run of four bytes of a text is hashed to a bucket; each
bucket has a learned vector.  A text is the average of its words' vectors plus
that of its n-grams' vectors, and a softmax layer over that average gives the
probabilities of the labels.  Vectors and output layer are trained together by
stochastic gradient descent in numpy.

Training takes at most about ``per_class`` labelled texts of each label,
chosen by a hash of their id: tasks turn them into bucket counts, one task
runs the descent over those bounded rows.  The output layer is linear, so for
scoring each bucket keeps one number, its vector times the difference of the
two output columns, and a text's score needs one pass over its bytes.

Defined results: a null or empty text (or one of white space) has score 0;
without labels of both kinds every other text scores 0.5; a document that has
several labels counts with their average, rounded up from one half; labels
without a document are ignored; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqspark.llm.common import fold, fresh, groups, prepare, span_hashes, utf8, words

WORD_BITS = 15
GRAM_BITS = 15
GRAM = 4
DIM = 16
EPOCHS = 6
RATE = 0.5
PER_CLASS = 2000
THRESHOLD = 0.3

_GRAM_MUL = np.uint64(0x9E3779B97F4A7C15)


def features(data: np.ndarray, offsets: np.ndarray):
    """Buckets, weights and rows of the features of a group of texts.

    Weights of a text's words add up to 1, and so do those of its n-grams.
    """
    s, e, row = words(data, offsets)
    n = len(offsets) - 1
    word = (span_hashes(data, s, e) >> np.uint64(64 - WORD_BITS)).astype(np.int64)
    per_word = 1.0 / np.maximum(1, np.bincount(row, minlength=n))
    at = np.arange(max(0, len(data) - GRAM + 1))
    gram_row = np.searchsorted(offsets, at, side="right") - 1
    inside = at + GRAM <= offsets[gram_row + 1] if len(at) else np.zeros(0, bool)
    value = np.zeros(len(at), np.uint64)
    for k in range(GRAM):
        value |= data[k:k + len(at)].astype(np.uint64) << np.uint64(8 * k)
    gram = ((value[inside] * _GRAM_MUL) >> np.uint64(64 - GRAM_BITS)).astype(np.int64) + (1 << WORD_BITS)
    gram_row = gram_row[inside]
    per_gram = 1.0 / np.maximum(1, np.bincount(gram_row, minlength=n))
    return word, row, per_word, gram, gram_row, per_gram


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """label, key and the bucket weights of each training text."""
    for batch in batches:
        label, key = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        data, offsets = utf8(batch.column(2))
        out = []
        for i in range(len(label)):
            piece = data[offsets[i]:offsets[i + 1]]
            word, _, pw, gram, _, pg = features(piece, np.array([0, len(piece)]))
            ids, inverse = np.unique(np.concatenate([word, gram]), return_inverse=True)
            weight = np.bincount(inverse, np.concatenate([np.full(len(word), pw[0]), np.full(len(gram), pg[0])]),
                                 minlength=len(ids))
            out.append((label[i], key[i], ids.astype(np.int32).tobytes(), weight.astype(np.float32).tobytes()))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(
                zip(*out, strict=True), (pa.int32(), pa.int64(), pa.binary(), pa.binary()), strict=True)],
                names=["label", "key", "ids", "weights"])


def train(rows: list[tuple[int, np.ndarray, np.ndarray]], seed: int = 7) -> np.ndarray:
    """Per-bucket contribution to the logit of label 1, then the bias, as float32."""
    rng = np.random.default_rng(seed)
    size = (1 << WORD_BITS) + (1 << GRAM_BITS)
    vectors = rng.uniform(-1 / DIM, 1 / DIM, (size, DIM)).astype(np.float32)
    out, bias = np.zeros((DIM, 2), np.float32), np.zeros(2, np.float32)
    labels = [r[0] for r in rows]
    if len(set(labels)) == 2:
        share = np.bincount(labels, minlength=2) / len(labels)
        steps, step = EPOCHS * len(rows), 0
        for _ in range(EPOCHS):
            for i in rng.permutation(len(rows)):
                label, ids, weight = rows[i]
                hidden = weight @ vectors[ids]
                logit = hidden @ out + bias
                p = np.exp(logit - logit.max())
                p /= p.sum()
                p[label] -= 1
                p *= RATE * (1 - step / steps) * 0.5 / share[label]     # labels count alike
                back = out @ p
                out -= np.outer(hidden, p)
                bias -= p
                vectors[ids] -= np.outer(weight, back)
                step += 1
    contrast = vectors @ (out[:, 1] - out[:, 0])
    return np.append(contrast, bias[1] - bias[0]).astype(np.float32)


def _trained(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = []
    for batch in batches:
        for label, ids, weight in zip(*(batch.column(c).to_pylist() for c in ("label", "ids", "weights")), strict=True):
            rows.append((label, np.frombuffer(ids, np.int32), np.frombuffer(weight, np.float32)))
    yield pa.RecordBatch.from_arrays([pa.array([train(rows).tobytes()], pa.binary())], names=["model"])


def fit(docs: DataFrame, labels: DataFrame, per_class: int = PER_CLASS) -> np.ndarray:
    """Learn from the labelled documents whose id is outside fold 0 of 5."""
    prepare(docs.sparkSession)
    known = (labels.where("quality is not null and doc_id is not null").where(fold("doc_id", 5) != 0)
             .groupBy("doc_id").agg((F.avg("quality") >= 0.5).cast("int").alias("label")))
    rate = {r["label"]: min(1.0, per_class / r["count"]) for r in known.groupBy("label").count().collect()}
    draw = F.pmod(F.xxhash64(F.lit("quality"), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    chosen = known.where(draw < F.when(F.col("label") == 1, rate.get(1, 0.0)).otherwise(rate.get(0, 0.0)))
    # about 2 * per_class rows of two numbers: the bound of this broadcast
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("label", "doc_id", "text")
    counted = texts.mapInArrow(_counted, "label int, key long, ids binary, weights binary")
    model = (counted.repartition(1).sortWithinPartitions("key", "label")
             .mapInArrow(_trained, "model binary").first())
    return np.frombuffer(model["model"], np.float32) if model else train([])     # no row: nothing to learn from


def score_texts(column: pa.Array, model: np.ndarray) -> np.ndarray:
    data, offsets = utf8(column)
    contrast, bias = model[:-1].astype(np.float64), float(model[-1])
    out = np.zeros(len(offsets) - 1)
    for i, j in groups(offsets):
        at = offsets[i:j + 1] - offsets[i]
        word, row, pw, gram, gram_row, pg = features(data[offsets[i]:offsets[j]], at)
        n = j - i
        logit = (np.bincount(row, contrast[word], n) * pw + np.bincount(gram_row, contrast[gram], n) * pg + bias)
        has = np.bincount(row, minlength=n) > 0
        out[i:j] = np.where(has, 1 / (1 + np.exp(-np.clip(logit, -60, 60))), 0.0)
    return out


def score(docs: DataFrame, model: np.ndarray, name: str = "quality_score") -> DataFrame:
    """All columns of ``docs`` and the score as ``name``; the model is shipped with the tasks."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = pa.array(score_texts(batch.column("text"), shared.value), pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, scores], names=[*batch.schema.names, name])
    schema = docs.schema
    return docs.mapInArrow(run, type(schema)(list(schema.fields)).add(name, "double"))


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """doc_id, held_out, score and predicted label of every document."""
    scored = score(docs.select("doc_id", "text"), fit(docs, labels))
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), F.col("quality_score").alias("score"),
                         (F.col("quality_score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The documents that the classifier doesn't reject, with the columns of ``docs``."""
    name = fresh(docs, "quality_score")
    return score(docs, fit(docs, labels), name).where(F.col(name) >= threshold).select(*docs.columns)
