"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1 drawn from its code point; the
boundary between words has one too.  Three successive symbols are bound into
one vector: the first letter's vector shifted twice, times the second's shifted
once, times the third's.  A text is the bundle (sum) of its trigram vectors,
a language the bundle of its training texts scaled to length 1.  A text gets
the language whose prototype has the largest cosine with it; the score is that
cosine, cut to 0..1.

Texts are worked on in groups: the trigrams present in a group are numbered,
each text becomes a row of counts, and one matrix product of the counts with
the bound trigram vectors bundles all texts of the group.

``fit`` learns from at most about ``per_language`` texts of each language,
chosen by a hash of their id.  Every language gets a prototype, so the model
grows with the number of languages (``DIM`` numbers each).

Defined results: a null text, or one without a letter, is ``und`` with score 0,
as is every text if there is nothing to learn from; equal cosines go to the
language first by code point; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dqspark.llm.common import fold, prepare

DIM = 1024
PER_LANGUAGE = 2000
GROUP_DOCS = 128
GROUP_CHARS = 1 << 19
SLICE = 2048                # trigram vectors expanded at once
UNKNOWN = "und"

_LETTER: np.ndarray | None = None
_VECTORS: dict[int, np.ndarray] = {}


def _letters() -> np.ndarray:
    global _LETTER
    if _LETTER is None:
        _LETTER = np.fromiter((chr(i).isalpha() for i in range(0x110000)), bool, 0x110000)
    return _LETTER


def letter_vector(code: int, dim: int = DIM) -> np.ndarray:
    v = _VECTORS.get(code)
    if v is None or len(v) != dim:
        v = _VECTORS[code] = np.random.default_rng(code + 1).integers(0, 2, dim, np.int8) * np.int8(2) - np.int8(1)
    return v


def symbols(text: str | None) -> np.ndarray:
    """Lower-case letters with 0 for each run of other characters, and at both ends."""
    codes = np.frombuffer((text or "").lower().encode("utf-32-le", "surrogatepass"), np.uint32)
    codes = np.concatenate([[0], np.where(_letters()[codes], codes, 0), [0]])
    keep = np.ones(len(codes), bool)
    keep[1:] = (codes[1:] != 0) | (codes[:-1] != 0)
    return codes[keep]


def bundle(texts: list[str | None], dim: int = DIM) -> np.ndarray:
    """One row per text: the sum of its bound trigram vectors (zeros without a letter)."""
    rows = [symbols(t) for t in texts]
    doc = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    codes = np.concatenate(rows) if rows else np.zeros(0, np.int64)
    out = np.zeros((len(rows), dim), np.float32)
    if len(codes) < 3:
        return out
    known, ids = np.unique(codes, return_inverse=True)
    inside = doc[:-2] == doc[2:]
    a = len(known)
    tri = ((ids[:-2] * a + ids[1:-1]) * a + ids[2:])[inside]
    doc = doc[:-2][inside]
    if not len(tri):
        return out
    if a ** 3 <= 1 << 22:
        seen = np.flatnonzero(np.bincount(tri, minlength=1))
        number = np.zeros(a ** 3, np.int64)
        number[seen] = np.arange(len(seen))
        tri = number[tri]
    else:
        seen, tri = np.unique(tri, return_inverse=True)
    letters = np.stack([letter_vector(int(c), dim) for c in known])
    once, twice = np.roll(letters, 1, 1), np.roll(letters, 2, 1)
    first, second, third = seen // (a * a), seen // a % a, seen % a
    order = np.argsort(tri, kind="stable")
    tri, doc = tri[order], doc[order]
    cuts = np.searchsorted(tri, np.arange(0, len(seen) + SLICE, SLICE))
    for k, s in enumerate(range(0, len(seen), SLICE)):
        e = min(s + SLICE, len(seen))
        part = slice(cuts[k], cuts[k + 1])
        counts = np.bincount(doc[part] * (e - s) + tri[part] - s, minlength=len(rows) * (e - s))
        bound = twice[first[s:e]] * once[second[s:e]] * letters[third[s:e]]
        out += counts.reshape(len(rows), e - s).astype(np.float32) @ bound.astype(np.float32)
    return out


def _unit(x: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(x, axis=1, keepdims=True)
    return x / np.where(length > 0, length, 1)


def _groups(texts: list[str | None]) -> Iterator[slice]:
    begin = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if i + 1 - begin >= GROUP_DOCS or size >= GROUP_CHARS:
            yield slice(begin, i + 1)
            begin, size = i + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


@dataclass
class Model:
    languages: list[str]
    prototypes: np.ndarray      # one row of length 1 per language

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        names, scores = [], []
        for part in _groups(texts):
            v = _unit(bundle(texts[part], self.prototypes.shape[1]))
            if not self.languages:
                names += [UNKNOWN] * len(v)
                scores += [0.0] * len(v)
                continue
            cos = v @ self.prototypes.T
            best = cos.argmax(1)
            has = v.any(1)
            names += [self.languages[b] if h else UNKNOWN for b, h in zip(best, has, strict=True)]
            scores += np.where(has, np.clip(cos.max(1), 0, 1), 0).astype(float).tolist()
        return names, scores


def _bundles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per task and language the sum of the texts' vectors of length 1."""
    total: dict[str, np.ndarray] = {}
    for batch in batches:
        langs, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        for part in _groups(texts):
            for lang, v in zip(langs[part], _unit(bundle(texts[part])), strict=True):
                total[lang] = total.get(lang, 0) + v.astype(np.float64)
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total), pa.string()),
                                          pa.array([v.tolist() for v in total.values()], pa.list_(pa.float64()))],
                                         names=["lang", "v"])


def fit(train: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Learn from the rows of ``doc_id, text, lang`` with a language."""
    train = train.where("lang is not null and text is not null").select("doc_id", "text", "lang")
    rates = train.groupBy("lang").agg(F.least(F.lit(1.0), per_language / F.count("*")).alias("rate"))
    draw = F.pmod(F.xxhash64(F.lit("langid"), "doc_id"), F.lit(1 << 30)) / F.lit(float(1 << 30))
    # a language that is rare enough is read whole, so each one has a prototype
    sums = (train.join(rates, "lang").where(draw < F.col("rate")).select("lang", "text")
            .mapInArrow(_bundles, "lang string, v array<double>")
            .select("lang", F.posexplode("v").alias("i", "x")).groupBy("lang", "i").agg(F.sum("x").alias("x"))
            .groupBy("lang").agg(F.sort_array(F.collect_list(F.struct("i", "x"))).alias("v")).orderBy("lang").collect())
    vectors = np.array([[c["x"] for c in r["v"]] for r in sums], np.float32).reshape(len(sums), -1 if sums else DIM)
    return Model([r["lang"] for r in sums], _unit(vectors))


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, scores = model.predict(batch.column(2).to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(names, pa.string()),
                                              pa.array(scores, pa.float64())],
                                             names=["doc_id", "held_out", "lang_pred", "score"])
    rows = docs.select("doc_id", (fold("doc_id", 4) == 2).alias("held_out"), "text")
    return rows.mapInArrow(run, "doc_id long, held_out boolean, lang_pred string, score double")


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the folds 0, 1 and 3 and predict every document."""
    prepare(docs.sparkSession)
    return predict(docs, fit(docs.where(fold("doc_id", 4) != 2)))
