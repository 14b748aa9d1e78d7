"""The registered queries on the smallest data against plain versions, SQL or held-out truth."""

import duckdb
import pytest

import __spark_entry__ as E
import corpus_pipeline
from dqspark.llm import chat, decontam, pii
from dqspark.sources.tables import TABLES, table
from tests.conftest import SF_MID, SF_SMALL
from tests.llm import brute


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{SF_SMALL}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def docs(duck):
    return duck.sql("select doc_id, text, lang from documents order by doc_id").fetchall()


def rows(spark, name, *columns):
    return [tuple(r) for r in E.queries()[name](spark, SF_SMALL).select(*columns).collect()]


@pytest.mark.parametrize("name", ["op6_mixing", "op7_forest", "op8_suffix", "op10_warc", "op11_vector_codes",
                                  "op12_collocations", "op13_jaccard"])
def test_against_sql(spark, duck, name):
    rel = duck.sql(E.oracle_sql()[name])
    columns = sorted(rel.columns)
    got = rows(spark, name, *columns)
    order = [rel.columns.index(c) for c in columns]
    assert sorted(map(repr, got)) == sorted(repr(tuple(r[i] for i in order)) for r in rel.fetchall())


def test_language(spark, docs):
    got = rows(spark, "op1_langid", "doc_id", "held_out", "lang_pred", "score")
    truth = {d[0]: d[2] for d in docs}
    assert all(h == (brute.fold(i, 4) == 2) and 0 <= s <= 1 for i, h, _, s in got) and len(got) == len(docs)
    held = [(truth[i], p) for i, h, p, _ in got if h]
    assert sum(a == b for a, b in held) >= 0.9 * len(held)


def test_quality(spark):
    """Held-out documents of the middle size, as the smallest has few labels to learn from."""
    got = [tuple(r) for r in E.queries()["op2_quality"](spark, SF_MID).select("doc_id", "held_out", "score", "predicted").collect()]
    truth = dict(duckdb.sql(f"select doc_id, quality from read_parquet('{SF_MID}/labels.parquet')").fetchall())
    assert all(h == (brute.fold(i, 5) == 0) and 0 <= s <= 1 and p == (s >= 0.3) for i, h, s, p in got)
    held = [(s, truth[i]) for i, h, s, _ in got if h and i in truth]
    good, bad = ([s for s, t in held if t == k] for k in (1, 0))
    assert sum(a > b for a in good for b in bad) >= 0.95 * len(good) * len(bad)
    assert sum(s >= 0.3 for s in good) >= 0.95 * len(good)


def test_chat(spark, duck):
    truth = duck.sql("select conv_id, turn, role from conversations order by 1, 2").fetchall()
    lines = chat.numbered(chat.transcripts(table(spark, SF_SMALL, "conversations")))
    model = chat.fit(lines)
    got = chat.parse(lines, model).where("line = 0").select("conv_id", "turn", "role", "role_pred").collect()
    assert len(got) == len(truth)
    assert sum(r["role"] == r["role_pred"] for r in got) >= 0.9 * len(got)
    turns = rows(spark, "op3_chat", "conv_id", "role", "text", "rendered")
    assert abs(len(turns) - len(truth)) <= 0.1 * len(truth)
    assert all(r == f"<|im_start|>{role}\n{t}<|im_end|>" for _, role, t, r in turns)
    texts = {t for _, _, t, _ in turns}
    whole = [t for (t,) in duck.sql("select text from conversations").fetchall()]
    assert sum(t in texts for t in whole) >= 0.8 * len(whole)


def test_decontamination(spark, duck, docs):
    items = duck.sql("select item_id, text from benchmark").fetchall()
    plain = [(i, decontam.normalised(t)) for i, t, _ in docs]
    exact = {(d, i) for i, t in items for d, x in plain if decontam.normalised(t) in x}
    got = rows(spark, "op4_decontamination", "doc_id", "item_id", "distance")
    assert {(d, i) for d, i, k in got if k == 0} == exact and exact
    text, size = dict(plain), {i: decontam.normalised(t) for i, t in items}
    for d, i, k in got:
        assert k <= len(size[i]) // decontam.RATE
        if k:
            assert brute.distance_to_part(size[i], text[d]) <= k


def test_fingerprints(spark, docs):
    expected = brute.edited([d[:2] for d in docs])
    got = rows(spark, "op5_fingerprints", "doc_id", "n_chars", "edited_sha256", "fingerprint", "near_edited", "near_next")
    assert {r[0]: r[1:3] for r in got} == expected
    text = {d[0]: d[1] for d in docs}
    by_text = {}
    for i, _, _, f, a, b in got:
        assert 0 <= a <= 1 and 0 <= b <= 1
        assert by_text.setdefault(text[i], f) == f
    assert len(set(by_text.values())) == len(by_text)


def test_near_duplicates(spark, docs):
    expected = brute.near_groups([d[:2] for d in docs])
    got = rows(spark, "op7_forest", "doc_id", "n_shingles", "component_id", "kept")
    assert {r[0]: r[1:3] for r in got} == expected
    assert all(k == (i == c) for i, _, c, k in got)


def test_suffixes(spark, docs):
    got = {r[0]: r[1:] for r in rows(spark, "op8_suffix", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")}
    expected = brute.without_repeats([d[1] for d in docs])
    assert got == {d[0]: e for d, e in zip(docs, expected)}


def test_pii(spark, docs):
    got = {r[0]: r[1:] for r in rows(spark, "op9_pii", "doc_id", "text", "pii_values")}
    assert len(got) == len(docs)
    for i, text, _ in docs:
        assert pii.replace(got[i][0], pii.session_key(spark), invert=True)[0] == text
        assert (got[i][0] != text) == (got[i][1] > 0)


def test_pipeline(spark, duck, docs):
    """Each stage against a plain reading of its own input."""
    from dqspark.llm import quality
    from dqspark.llm.common import materialize
    assert corpus_pipeline.ORACLE_SQL is None
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    labels = dict(duck.sql("select doc_id, quality from labels").fetchall())
    items = [decontam.normalised(t) for (t,) in duck.sql("select text from benchmark").fetchall()]
    df, before = table(spark, SF_SMALL, "documents"), {d[0]: d[1] for d in docs}
    model = quality.fit(df, table(spark, SF_SMALL, "labels"))
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        df = materialize(stage(spark, df, SF_SMALL), "test-stage")
        got = [r.asDict() for r in df.collect()]
        after = {r["doc_id"]: r["text"] for r in got}
        assert len(after) == len(got) and (k == 4 or df.columns == names)
        if k == 0:
            import pyarrow as pa
            score = quality.score_texts(pa.array(list(before.values()), pa.string()), model)
            assert set(after) == {i for i, s in zip(before, score) if s >= 0.3}
            assert sum(labels.get(i) == 1 for i in before if i not in after) <= 0.05 * len(before)
        elif k == 1:
            groups = brute.near_groups(list(before.items()), 5)
            assert set(after) == {i for i, (_, c) in groups.items() if i == c}
        elif k == 2:
            plain = {i: decontam.normalised(t) for i, t in before.items()}
            exact = {i for i, t in plain.items() if any(x in t for x in items)}
            assert exact.isdisjoint(after) and len(before) - len(after) - len(exact) <= 2
        elif k == 3:
            assert {i: pii.replace(t, pii.session_key(spark))[0] for i, t in before.items()} == after
            assert all(r["n_chars"] == len(r["text"]) for r in got)
        else:
            assert set(after) <= set(before) and all(after[i] == before[i] for i in after)
            taken = {}
            for r in got:
                assert 0 < r["taken"] <= 3 * r["size"] == 3 * len(brute.WORD.findall(r["text"]))
                t = taken.setdefault(r["source"], [r["target"], 0])
                t[1] += r["taken"]
            assert all(abs(a - b) <= 1 for a, b in taken.values())
        before = after
