"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns."""

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from dqspark.llm import chat, decontam, fingerprints, forest, langid, mixing, pii, quality, suffix, warc
from tests.llm import brute

LONG = " ".join(f"word{i} and" for i in range(20000))
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, score double, size long, taken long, "
          "possibly boolean, filter_bits long, quality_score double, kept boolean, pii_values int, row string, rank double")


def doc(i, text, lang="en", source="s"):
    return (i, text, lang, source, None if text is None else len(text), 0.5, 1, 2, True, 3, 0.1, False, 4, "r", 0.0)


P = "one passage that stands in several documents and is long enough to be found again " * 4
ROWS = [doc(1, "the cat sat on the mat and looked at the dog " + P), doc(2, None), doc(3, ""), doc(4, " \n\t "),
        doc(5, "word"), doc(6, "12 34 !!"), doc(7, LONG, "de"), doc(8, LONG, "de"), doc(None, "no id here at all"),
        doc(None, None, None, None), doc(9, P + "and an end", None, None), doc(10, "word", "fr", ""),
        doc(11, "same text twice " + P), doc(11, "same text twice " + P), doc(12, "漢字 é ß ñ " * 30, "zh", "z")]


@pytest.fixture(scope="module")
def edge(spark):
    return spark.createDataFrame(ROWS, SCHEMA).cache()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def side(spark):
    labels = spark.createDataFrame([(1, 1, 0), (5, 0, 0), (7, 1, 1), (None, 1, 0), (9, None, 0), (11, 1, 0), (11, 0, 0), (99, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    bench = spark.createDataFrame([(1, "several documents and is long enough to be found"), (None, "looked at the dog one passage"),
                                   (3, None), (4, ""), (5, "mat"), (1, "several documents and is long enough to be found")],
                                  "item_id long, text string")
    return labels, bench


def test_language(edge, none):
    got = langid.identify(edge).collect()
    assert len(got) == len(ROWS)
    by = {r["doc_id"]: r for r in got}
    assert all(by[i]["lang_pred"] == "und" and by[i]["score"] == 0 for i in (2, 3, 4, 6))
    assert langid.identify(none).count() == 0


def test_language_has_no_limit_of_classes(spark):
    rows = [(i, f"zo{i} zu{i} za abc def", f"l{i % 700}") for i in range(1400)]
    model = langid.fit(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    assert sorted(model.languages) == sorted({r[2] for r in rows})


def test_quality(edge, none, side):
    labels, _ = side
    got = quality.classify(edge, labels).collect()
    assert len(got) == len(ROWS) and all(0 <= r["score"] <= 1 for r in got)
    by = {r["doc_id"]: r["score"] for r in got}
    assert by[2] == by[3] == by[4] == 0 and by[7] == by[8]
    assert quality.classify(none, labels).count() == 0
    assert {r["score"] for r in quality.classify(edge.where("text is not null"), labels.limit(0)).collect()} == {0.0, 0.5}


def test_chat(spark):
    rows = [(1, 0, "user", "hi", 5), (1, 0, "user", "hi", 5), (1, 1, None, None, 5), (None, 0, "user", "a\nb", 5),
            (-1, 0, "user", "of a real conversation", 5), (2, None, "assistant", "", 5), (3, 0, "robot", "User: x\nAI: y", 5), (4, 0, "user", "x\n" * 3000, 5)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seq int")
    got = chat.recovered(spark, df.drop("seq")).collect()
    assert {r["conv_id"] for r in got} == {1, None, -1, 2, 3, 4} and all(r["role"] in chat.ROLES for r in got)
    assert sum(r["lines"] for r in got if r["conv_id"] == 4) == 3001
    assert sum(r["lines"] for r in got if r["conv_id"] is None) == 2 and sum(r["lines"] for r in got if r["conv_id"] == -1) == 1
    assert chat.recovered(spark, df.drop("seq").limit(0)).count() == 0


def test_decontamination(edge, none, side):
    _, bench = side
    got = {(r["doc_id"], r["item_id"]) for r in decontam.leaks(edge, bench).collect()}
    assert got == {(1, 1), (1, None), (1, 5), (9, 1), (11, 1)}        # short items too, where they stand exactly
    kept = decontam.clean(edge, bench)
    assert kept.columns == edge.columns and kept.count() == len(ROWS) - 4
    assert decontam.leaks(none, bench).count() == 0 and decontam.leaks(edge, bench.limit(0)).count() == 0
    assert decontam.clean(edge, bench.limit(0)).count() == len(ROWS)


def test_fingerprints(edge, none):
    got = fingerprints.edited_pairs(edge).collect()
    assert len(got) == len(ROWS)
    one = fingerprints.edited_pairs(edge.where("doc_id = 5")).first()
    assert one["near_next"] == 1 and one["n_chars"] == 4
    rows = [(r[0], r[1]) for r in ROWS if r[0] is not None and r[0] != 11]
    got = fingerprints.edited_pairs(edge.where("doc_id is not null and doc_id <> 11")).collect()
    assert {r["doc_id"]: (r["n_chars"], r["edited_sha256"]) for r in got} == brute.edited(rows)
    assert fingerprints.edited_pairs(none).count() == 0


def test_mixing(edge, none):
    got = mixing.mix(edge).collect()
    assert len(got) == len(ROWS) and sum(r["size"] for r in got) == sum(len(brute.WORD.findall(r[1] or "")) for r in ROWS)
    assert all(0 <= r["taken"] <= 3 * r["size"] for r in got)
    carried = mixing.mix(edge, carry=True)
    assert set(edge.columns) | {"target", "source_size"} == set(carried.columns) and len(carried.columns) == len(set(carried.columns))
    per = carried.groupBy("source").agg(F.sum("taken").alias("n"), F.max("target").alias("t")).collect()
    assert all(abs(r["n"] - r["t"]) <= 0.5 for r in per)
    assert mixing.mix(none).count() == 0 and mixing.mix(none, carry=True).count() == 0


def test_near_duplicates(edge, none):
    got = forest.near_duplicates(edge).collect()
    assert len(got) == len(ROWS)
    by = {r["doc_id"]: r for r in got}
    assert by[8]["component_id"] == 7 and by[10]["component_id"] == 5 and by[3]["component_id"] == 3
    assert by[None]["kept"] and by[None]["component_id"] is None and by[2]["n_shingles"] == 0
    kept = forest.deduplicate(edge)
    assert kept.columns == edge.columns
    assert {r["doc_id"] for r in kept.collect()} == {1, 2, 3, 4, 5, 6, 7, None, 9, 11, 12}
    assert forest.near_duplicates(none).count() == 0 and forest.deduplicate(none).count() == 0


def test_suffixes(edge, none):
    got = sorted((r["doc_id"] or 0, *r[1:]) for r in suffix.remove_repeats(edge).collect())
    expected = brute.without_repeats([r[1] for r in ROWS])
    assert got == sorted((r[0] or 0, *e) for r, e in zip(ROWS, expected))
    assert suffix.remove_repeats(none).count() == 0


def test_suffixes_across_shards(spark, monkeypatch):
    """Anchors with many different runs are dealt to several shards; nothing is lost between them."""
    monkeypatch.setattr(suffix, "HOT", 3)
    monkeypatch.setattr(suffix, "SHARD_ROWS", 5)
    import random
    rng = random.Random(4)
    noise = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    core, tail = noise(260), noise(120)
    texts = [noise(rng.randrange(60)) + core[rng.randrange(8):] + (tail if k % 7 == 0 else "") + noise(150) for k in range(40)]
    got = {r["doc_id"]: tuple(r)[1:] for r in suffix.remove_repeats(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()}
    assert got == dict(enumerate(brute.without_repeats(texts)))


def test_pii(edge, none):
    got = pii.pseudonymise(edge, b"key")
    assert set(got.columns) == set(edge.columns) and got.count() == len(ROWS)
    assert {r["doc_id"] for r in got.where("text is null").collect()} == {2, None}
    assert pii.pseudonyms(none, b"key").count() == 0


def test_warc(spark):
    pages = spark.createDataFrame(
        [(1, "u1", "same", 1), (2, None, "same", 2), (3, "u\r\n3", "", 3), (4, "u", None, 4), (None, "u", "same", 5),
         (5, "u", "x" * 300000, 6), (5, "u", "x" * 300000, 6)], "page_id long, url string, html string, offset long")
    got = sorted(((r["page_id"] or 0), r["payload_bytes"], r["record_type"], r["refers_to"]) for r in warc.round_trip(pages).collect())
    assert got == [(0, 4, "response", None), (1, 4, "revisit", 2), (2, 4, "response", None), (3, 0, "revisit", 4),
                   (4, 0, "response", None), (5, 300000, "response", None), (5, 300000, "response", None)]
    assert warc.round_trip(pages.limit(0)).count() == 0


@pytest.mark.parametrize("name", [n for n, _ in corpus_pipeline.STAGES])
def test_stages(spark, edge, none, side, tmp_path, name):
    labels, bench = side
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    stage = dict(corpus_pipeline.STAGES)[name]
    got = stage(spark, edge, str(tmp_path))
    assert got.count() <= len(ROWS) and (name == "mixing" or got.columns == edge.columns)
    assert stage(spark, none, str(tmp_path)).count() == 0
