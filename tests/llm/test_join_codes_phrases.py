"""Vector codes, collocations and the Jaccard join against plain versions, with edge cases."""

import hashlib
import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from dqspark.llm import collocations, jaccard, vectorcodes
from tests.llm import brute
from tests.llm.test_edges import LONG, P, ROWS, SCHEMA


# ---------------------------------------------------------------- vector codes
def plain_codes(rows, parts=8, entries=16, rounds=6):
    kept = [(i, [math.floor(4096 * x) for x in v], lab) for i, v, lab in rows
            if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    order = sorted((i, v) for i, v, _ in kept)[:entries]
    w = len(order[0][1]) // parts
    cut = lambda v: [v[k * w:(k + 1) * w] for k in range(parts)]
    books = [[cut(v)[k] for _, v in order] for k in range(parts)]

    def near(k, x):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), j) for j, e in enumerate(books[k]))

    for _ in range(rounds):
        new = []
        for k in range(parts):
            got = {}
            for _, v, _ in kept:
                got.setdefault(near(k, cut(v)[k])[1], []).append(cut(v)[k])
            new.append([[sum(c) // len(got[j]) for c in zip(*got[j])] if j in got else e for j, e in enumerate(books[k])])
        books = new
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out = [(i, "".join(f"{near(k, x)[1]:02x}" for k, x in enumerate(cut(v))), sum(near(k, x)[0] for k, x in enumerate(cut(v))), lab)
           for i, v, lab in kept]
    per = Counter()
    for _, _, e, lab in out:
        per[lab] += e
    return sorted((i, c, e, per[lab], sha) for i, c, e, lab in out)


def coded(spark, rows, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")
    return sorted(tuple(r) for r in vectorcodes.compress(df).collect())


def test_codes_with_ties_nulls_and_copies(spark):
    rng = random.Random(1)
    rows = [(i, [rng.randrange(-4, 5) / 4 for _ in range(16)], rng.choice([None, 1, 2])) for i in range(150)]
    rows += [(200 + i, rows[i][1], 1) for i in range(20)]
    junk = [(300, None, 1), (301, [None] + [0.0] * 15, 1), (302, [float("nan")] * 16, 1), (303, [float("inf")] * 16, None)]
    assert coded(spark, rows + junk) == plain_codes(rows)


def test_codes_of_few_and_odd_rows(spark):
    few = [(i, [float(i * j % 5) for j in range(8)], 1) for i in range(5)]
    assert coded(spark, few) == plain_codes(few)
    assert coded(spark, []) == [] and coded(spark, [(1, None, 1)]) == []
    got = coded(spark, [(1, [], 1), (2, [], None)])
    assert [(r[0], r[1], r[2]) for r in got] == [(1, "00" * 8, 0), (2, "00" * 8, 0)]
    # lengths differ: that of the smallest id counts; a null id is kept
    df = spark.createDataFrame([(1, [1.0] * 8, 1), (2, [1.0] * 4, 1), (None, [1.0] * 8, 1)], "vec_id long, embedding array<double>, label int")
    assert sorted(str(r["vec_id"]) for r in vectorcodes.compress(df).collect()) == ["1", "None"]


def test_codes_of_large_components(spark):
    """Sums and squares beyond 64 bits stay exact; results beyond them are null."""
    rows = [(i, [float((i * 7 + j) % 5) * 2.0 ** 16 + i for j in range(8)], i % 2) for i in range(30)]
    assert coded(spark, rows, "double") == plain_codes(rows)
    far = rows + [(100, [2.0 ** 40 * (j + 1) for j in range(8)], 9), (101, [1e300] * 8, 8)]
    got = {r[0]: r for r in coded(spark, far, "double")}
    assert got[101][1] is None and got[101][2] is None and len(got) == 32
    expected = {r[0]: r for r in plain_codes(far[:-1])}
    assert all(got[i][1] == expected[i][1] for i in expected)
    assert all(got[i][2] == (e[2] if e[2] < 2 ** 63 else None) for i, e in expected.items())


def test_orchard_search_equals_a_scan():
    rng = np.random.default_rng(3)
    for n in (1, 2, 16, 40):
        books = [rng.integers(-5, 6, (n, 3)).tolist() for _ in range(8)]
        x = rng.integers(-6, 7, (500, 3))
        best, dist = vectorcodes.Codebooks(books).nearest(0, x)
        d = ((x[:, None] - np.array(books[0])[None]) ** 2).sum(2)
        assert (best == d.argmin(1)).all() and (dist == d.min(1)).all()


# ---------------------------------------------------------------- collocations
def plain_phrases(rows, top, least=10, cover=50):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(brute.UPPER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f[lang, tuple(words[i:i + k])] += 1
    found = {}
    cand = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= least}
    longer = {}
    for (lang, p), a in cand.items():
        for part in (p[:2], p[1:]) if len(p) == 3 else ():
            longer[lang, part] = max(a, longer.get((lang, part), 0))
    for (lang, p), a in cand.items():
        s, k = min((1000000 * a * a // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p)))
        if len(p) == 2 and 100 * longer.get((lang, p), -1) >= cover * a:
            continue
        found.setdefault(lang, []).append((-s, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return sorted((lang, i + 1, p.decode(), -a, left, r, n[lang], -s) for lang, rows in found.items()
                  for i, (s, a, p, left, r) in enumerate(sorted(rows)[:top]))


def phrase_rows(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(40)] + ["É", "Straße", "漢字", "the", " x"]
    out = []
    for k in range(120):
        body = []
        for _ in range(rng.randrange(60)):
            body += rng.choice([["New", "york"], ["new", "york", "city"], ["a", "a", "a"], [rng.choice(words)], [rng.choice(words)],
                                ["ad", "hoc"], ["de", "facto", "rule"]])
            body.append(rng.choice(["", "", "", ",", ".", "\n", "\t"]))
        out.append((rng.choice(["en", "de", None, "und"]), " ".join(body)))
    return out + [("en", None), (None, ""), ("xx", "a b"), ("en", " ., \t")]


@pytest.mark.parametrize("top", [3, 12])
def test_phrases(spark, monkeypatch, top):
    """Small tops settle at a high level; filters of a few bits let almost everything pass."""
    rows = phrase_rows(top)
    df = spark.createDataFrame(rows, "lang string, text string").repartition(5)
    if top == 12:
        monkeypatch.setattr(collocations, "FILTER_BITS", 64)
        monkeypatch.setattr(collocations, "GROUP", 200)
    got = sorted(tuple(r) for r in collocations.mine(df, top=top).collect())
    assert got == plain_phrases(rows, top)


def test_phrases_take_several_rounds(spark):
    """Pairs above the first level are covered by longer phrases, so the level has to fall."""
    rows = [("en", ", ".join([f"p{i} q{i} r{i}"] * 12)) for i in range(6)]
    rows += [("en", ", ".join([f"u{i} v{i}"] * 11 + [f"u{i} z{j}" for j in range(i + 1)] * 3)) for i in range(8)]
    df = spark.createDataFrame(rows, "lang string, text string")
    assert sorted(tuple(r) for r in collocations.mine(df, top=9).collect()) == plain_phrases(rows, 9)


def test_products_beyond_64_bits(spark):
    df = spark.createDataFrame([(3 * 10 ** 12, 3 * 10 ** 12, 10 ** 13), (10 ** 15, 10 ** 15, 10 ** 15), (10, 11, 12)], "a long, l long, r long")
    got = [r[0] for r in df.select(collocations.score("a", "l", "r")).collect()]
    assert got == [300000, 1000000, 1000000 * 100 // 132]


def test_phrases_of_edge_tables(spark):
    edge = spark.createDataFrame(ROWS, SCHEMA)
    assert sorted(tuple(r) for r in collocations.mine(edge, least=2).collect()) == \
        plain_phrases([(r[2], r[1]) for r in ROWS], 2000, least=2)
    assert collocations.mine(edge.limit(0)).count() == 0


# ---------------------------------------------------------------- Jaccard join
def joined(spark, rows, **args):
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    return {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(df, **args).collect()}


def near_rows(seed, n_base=12, copies=8):
    rng = random.Random(seed)
    vocab = [f"t{i}" for i in range(200)]
    common = [rng.choice(vocab) for _ in range(60)]         # a passage in most documents
    rows = []
    for _ in range(n_base):
        base = [rng.choice(vocab) for _ in range(rng.choice([3, 6, 9, 17, 33, 70, 250]))]
        if rng.random() < 0.6:
            base = base + common
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.choice([0, 1, 1, 2, 3, 6])):
                at = rng.randrange(len(w))
                w[at:at + 1] = rng.choice([[], [rng.choice(vocab)], [rng.choice(vocab), rng.choice(vocab)]])
            rows.append((len(rows) * 3 + 1, " ".join(w)))
    rng.shuffle(rows)
    return rows


@pytest.mark.parametrize("seed,frequent,bits,percent", [(2, 2, 1 << 24, 85), (3, 0, 64, 80)])
def test_join(spark, monkeypatch, seed, frequent, bits, percent):
    """Also with nearly all tokens in pairs, and with filters that let almost everything pass."""
    monkeypatch.setattr(jaccard, "FREQUENT", frequent)
    monkeypatch.setattr(jaccard, "TOKEN_BITS", bits)
    monkeypatch.setattr(jaccard, "BLOCK", 5)
    rows = near_rows(seed)
    assert joined(spark, rows, percent=percent) == brute.near_groups(rows, 4, percent)


def test_join_of_a_star(spark):
    """Independent copies that link with their base alone hang on it; unlinked ones of the template stay apart."""
    rng = random.Random(8)
    base = [f"b{i}" for i in range(300)]
    rows = [(1000, " ".join(base))]
    for k in range(300):
        w = list(base)
        for at in rng.sample(range(300), 5 if k % 3 else 14):
            w[at] = f"x{k}-{at}"
        rows.append((k, " ".join(w)))
    expected = brute.near_groups(rows, 4, 85)
    assert len({c for _, c in expected.values()}) > 50
    assert joined(spark, rows) == expected


def test_signatures_meet():
    """Any two linked sets share a signature, however their tokens are classed."""
    rng = np.random.default_rng(5)
    for trial in range(300):
        n = int(rng.integers(1, 400))
        percent = int(rng.choice([50, 70, 85, 95]))
        pool = np.unique(rng.integers(0, 1 << 63, 2 * n + 40, np.uint64) * np.uint64(2))
        rng.shuffle(pool)
        common = int(rng.integers(max(1, n * percent // 100), n + 1))
        x, y = np.sort(pool[:n]), np.sort(np.concatenate([pool[:common], pool[n:n + int(rng.integers(0, n - common + 2))]]))
        both = len(np.intersect1d(x, y))
        if 100 * both < percent * (len(x) + len(y) - both):
            continue
        frequent = rng.integers(0, 1 << 63, 4096, np.uint64)
        several = np.full(4096, ~np.uint64(0))
        limit = np.uint64(int(rng.random() * (1 << 63)) * 2)
        a, b = (jaccard.signatures(t, limit, several, frequent, percent)[1] for t in (x, y))
        assert len(np.intersect1d(a, b)), (n, common, percent, trial)


def test_bitmaps_never_drop_a_link():
    rng = np.random.default_rng(6)
    for _ in range(300):
        pool = rng.integers(0, 1 << 63, 900, np.uint64)
        x = np.unique(pool[:int(rng.integers(6, 600))])
        y = np.unique(np.concatenate([x[int(rng.integers(0, len(x) // 10 + 1)):], pool[600:600 + int(rng.integers(0, 30))]]))
        both = len(np.intersect1d(x, y))
        if 100 * both >= 85 * (len(x) + len(y) - both):
            p, q = (np.frombuffer(jaccard.parity(t).tobytes(), np.uint64)[None] for t in (x, y))
            assert jaccard._near(p, q, np.array([len(x)]), np.array([len(y)]), 85).all()


def test_join_of_edge_tables(spark):
    edge = spark.createDataFrame(ROWS, SCHEMA)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join(edge).collect() if r["doc_id"] is not None}
    rows = [(r[0], r[1]) for r in ROWS if r[0] is not None]
    assert got == brute.near_groups(rows, 4, 85)
    assert jaccard.join(edge).count() == len(ROWS) and jaccard.join(edge.limit(0)).count() == 0
    # an id with two texts joins their groups, whichever stands for its set
    twice = [(1, "one two three four five six"), (2, P), (3, "one two three four five six"), (3, P), (9, LONG)]
    df = spark.createDataFrame(twice, "doc_id long, text string")
    assert {(r["doc_id"], r["component_id"]) for r in jaccard.join(df).collect()} == {(1, 1), (2, 1), (3, 1), (9, 9)}


def test_subclasses_leave_a_signature():
    for percent, band in itertools.product((50, 70, 85, 95, 100), range(14)):
        many = jaccard.subclasses(band, percent)
        for n in (1 << band, (2 << band) - 1):
            assert not many or n - many > jaccard.errors(n, percent)


def test_fine_bitmaps_never_differ_more_than_their_sets():
    rng = np.random.default_rng(6)
    for n, m, common in ((1, 1, 0), (300, 280, 250), (5000, 4300, 4200), (5000, 600, 600), (40_000, 38_000, 37_500)):
        tokens = rng.integers(0, 1 << 63, n + m - common).astype(np.uint64)
        x, y = np.sort(tokens[:n]), np.sort(tokens[n - common:])
        bits = jaccard.apart(jaccard.fine_parity(x), jaccard.fine_parity(y))
        assert bits <= n + m - 2 * common and bits == jaccard.apart(jaccard.fine_parity(y), jaccard.fine_parity(x))
        assert bits >= 0.5 * min(n + m - 2 * common, m) or n < 10 or m < n / 2


def test_pairs_of_many_shared_signatures_are_given_once(spark, monkeypatch):
    import pyarrow as pa
    from pyspark.sql import functions as F

    from dqspark.llm import jaccard
    from dqspark.llm.components import components
    sets = [np.unique(np.random.default_rng(1).integers(0, 1 << 60, 40, np.uint64)) for _ in range(3)]
    rows = [(s, 0, 0, 0, d, 40, d, jaccard.parity(x).tobytes()) for s in range(300) for d, x in enumerate(sets)]
    batch = pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows)],
                                       names=["sig", "i", "j", "block", "doc_id", "n", "component", "bits"])
    for spread in (jaccard.SPREAD, 50):
        monkeypatch.setattr(jaccard, "SPREAD", spread)
        out = pa.Table.from_batches(jaccard._in_blocks(85)(batch.slice(k, 100) for k in range(0, 900, 100)))
        assert sorted(zip(out["a"].to_pylist(), out["b"].to_pylist(), out["apart"].to_pylist())) == [(0, 1, 0), (0, 2, 0), (1, 2, 0)]
    # signatures of the same rows stand for one another, others don't
    signed = spark.createDataFrame([(1, 40, [7, 8, 9]), (2, 40, [7, 8]), (3, 40, [9, 10]), (4, 40, [10, 11])],
                                   "doc_id long, n long, sigs array<long>").withColumn("bits", F.lit(jaccard.parity(sets[0]).tobytes()))
    none = components(spark.createDataFrame([], "u long, v long"))
    names = []
    written = jaccard.materialize

    def noted(df, name):
        names.append((name, written(df, name)))
        return names[-1][1]
    monkeypatch.setattr(jaccard, "materialize", noted)
    got = {(r.a, r.b) for r in jaccard._completed(signed, none, 85).collect()}
    assert got == {(1, 2), (1, 3), (3, 4)}
    assert dict(names)["join-mixed"].count() == 3         # of 7 and 8 one is looked at, 11 not at all


def test_tasks_leave_a_pair_to_its_smallest_signature():
    """Of tasks that see the same near copies at other signatures one gives a pair."""
    import pyarrow as pa
    bits = jaccard.parity(np.unique(np.random.default_rng(1).integers(0, 1 << 60, 40, np.uint64))).tobytes()
    sigs = {1: list(range(40)), 2: list(range(3, 40)), 3: list(range(38, 43)), 4: [41]}
    given = []
    for s in range(43):
        at = [d for d in sigs if s in sigs[d]]
        batch = pa.RecordBatch.from_arrays(
            [pa.array([v] * len(at), pa.int64()) for v in (s, 0, 0, 0)] + [pa.array(at, pa.int64()), pa.array([40] * len(at), pa.int64()),
             pa.array(at, pa.int64()), pa.array([bits] * len(at), pa.binary()),
             pa.array([sigs[d][:jaccard.LEAST] for d in at], pa.list_(pa.int64()))],
            names=["sig", "i", "j", "block", "doc_id", "n", "component", "bits", "low"])
        for out in jaccard._in_blocks(85)(iter([batch])):
            given += [(s, *p) for p in zip(out["a"].to_pylist(), out["b"].to_pylist())]
    assert [g for g in given if g[1:] == (1, 2)] == [(3, 1, 2)]
    assert [g for g in given if g[1:] == (3, 4)] == [(41, 3, 4)]
    # not among the smallest of both: at each
    assert [g[0] for g in given if g[1:] == (1, 3)] == [38, 39] and [g[0] for g in given if g[1:] == (2, 3)] == [38, 39]
    assert len(given) == 6


def test_completed_gives_every_pair_that_shares_a_signature(spark, monkeypatch):
    from pyspark.sql import functions as F

    from dqspark.llm.components import components
    monkeypatch.setattr(jaccard, "BLOCK", 4)
    rng = random.Random(12)
    rows = [(d, 40, sorted(rng.sample(range(-30, 30), rng.choice([1, 2, 5, 14])))) for d in range(40)]
    rows += [(3, 40, [-31, 5, 29]), (4, 40, [-31, 31]), (3, 41, [30]), (5, 40, [30, 31])]       # ids with several texts
    edges = [(1, 2), (1, 6), (1, 7), (8, 9)]
    part = components(spark.createDataFrame(edges, "u long, v long"))
    group = {2: 1, 6: 1, 7: 1, 9: 8}
    expected = {(min(a, b), max(a, b)) for (a, _, x), (b, _, y) in itertools.combinations(rows, 2)
                if set(x) & set(y) and group.get(a, a) != group.get(b, b)}
    bits = jaccard.parity(np.unique(np.random.default_rng(1).integers(0, 1 << 60, 40, np.uint64))).tobytes()
    signed = spark.createDataFrame(rows, "doc_id long, n long, sigs array<long>").withColumn("bits", F.lit(bits))
    got = [(r.a, r.b) for r in jaccard._completed(signed, part, 85).collect()]
    assert len(got) == len(set(got)) and set(got) == expected


def test_rows_of_a_large_signature_meet_its_first_one_in_all_tasks(spark, monkeypatch):
    """Near copies hang on their core however many tasks their rows stand in."""
    rng = random.Random(9)
    base = [f"b{i}" for i in range(300)]
    rows = [(0, " ".join(base))]
    for k in range(1, 300):
        w = list(base)
        for at in rng.sample(range(300), 2):
            w[at] = f"x{k}-{at}"
        rows.append((k, " ".join(w)))
    found = {}
    written = jaccard.materialize
    monkeypatch.setattr(jaccard, "materialize", lambda df, name: found.setdefault(name, []).append(written(df, name)) or found[name][-1])
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = joined(spark, rows)
        pairs = {(r.a, r.b) for r in found["join-pairs"][0].collect()}
        signed = [r for r in found["join-signed"][0].collect()]
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert {c for _, c in got.values()} == {0}
    large = 0
    chains = [(s, r.rare, r.doc_id, r.n) for r in signed for s in r.sigs[:jaccard.CHAINS]]
    for _, chain in itertools.groupby(sorted(chains), lambda c: c[0]):
        (_, _, first, n), *others = chain
        if len(others) > 64:
            large += 1
            assert all((min(first, d), max(first, d)) in pairs for _, _, d, m in others if 100 * min(n, m) >= 85 * max(n, m))
    assert large
