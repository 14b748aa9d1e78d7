"""Fuzzy self-join: quirk fixtures and a brute-force comparison."""

import itertools
import random

from dqspark.functions.similarity import lcs_length
from dqspark.operators import dedupe

SCHEMA = "code string, name string, address string, department string, municipality string, " \
         "director string, sector string"


def text_of(r):
    return " ".join(sorted(f"{r[1].strip().upper()} | {r[2].strip().upper()}".split()))


def brute_force(rows, t=95):
    """All pairs i<j of keys in one block with equal differentiators (None == None)."""
    ok = [r for r in rows if r[1] is not None and r[2] is not None and r[3] is not None and r[4] is not None]
    out = []
    for a, b in itertools.combinations(ok, 2):
        if (a[3], a[4], a[5], a[6]) != (b[3], b[4], b[5], b[6]):
            continue
        x, y = text_of(a), text_of(b)
        if 200 * lcs_length(x, y) >= t * (len(x) + len(y)):
            out.append(tuple(sorted([a[0], b[0]])))
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def spark_pairs(spark, rows, cfg=dedupe.DIRTY_FUZZY):
    """Row pairs, from the pairs of classes and their members."""
    df, group = frame(spark, rows), cfg.group_columns()
    members = {}
    for r in dedupe.fuzzy_members(df, cfg).collect():
        members.setdefault((*(r[c] for c in group), r["text"]), []).append(r[cfg.key])
    out = []
    for p in dedupe.fuzzy_pairs(df, cfg).collect():
        g = tuple(p[c] for c in group)
        a, b = members[(*g, p.text_1)], members[(*g, p.text_2)]
        found = itertools.combinations(a, 2) if p.text_1 == p.text_2 else itertools.product(a, b)
        found = [tuple(sorted(x)) for x in found]
        assert len(found) == p.pairs and (len(a), len(b)) == (p.rows_1, p.rows_2)
        out += found
    return sorted(out)


def test_quirk_fixture(spark):
    rows = [
        ("01", "ESCUELA UNO", "5 AVENIDA", "D", "M", "X", "S"),
        ("02", "UNO ESCUELA", "AVENIDA 5", "D", "M", "X", "S"),      # same tokens -> 100
        ("03", "ESCUELA UNO", "5 AVENIDA", "D", "M", None, "S"),     # null differentiator one side
        ("04", "ESCUELA UNO", "5 AVENIDA", "D", "M", None, "S"),     # both null -> kept
        ("05", "ESCUELA UNO", None, "D", "M", "X", "S"),             # null address -> dropped
        ("06", "ESCUELA UNO", "5 AVENIDA", "D", "OTHER", "X", "S"),  # singleton block
    ]
    assert spark_pairs(spark, rows) == [("01", "02"), ("03", "04")]
    assert {r.similarity for r in dedupe.fuzzy_pairs(frame(spark, rows)).collect()} == {100.0}


def _near_duplicates(seed, n=120):
    rnd = random.Random(seed)
    words = ["ESCUELA", "COLEGIO", "NACIONAL", "MIXTA", "RURAL", "SAN", "JOSE", "MARIA", "LA", "PAZ"]
    streets = ["CALLE", "AVENIDA", "ZONA", "KM", "ALDEA", "CASERIO"]
    rows = []
    for i in range(n):
        name = " ".join(rnd.choice(words) for _ in range(rnd.randint(2, 4)))
        addr = f"{rnd.randint(1, 20)} {rnd.choice(streets)} {rnd.randint(1, 9)}"
        if rows and rnd.random() < 0.5:               # near copy of an earlier row
            base = rnd.choice(rows)
            name, addr = base[1], base[2]
            if rnd.random() < 0.5:
                k = rnd.randrange(len(name))
                name = name[:k] + rnd.choice("AEIOU ") + name[k + 1:]
            if rnd.random() < 0.3:
                name = "  " + name.lower() + " "
        rows.append((f"{i:04d}", name, addr, rnd.choice("AB"), rnd.choice("XY"),
                     rnd.choice(["DIR", None]), "S"))
    return rows


def test_matches_brute_force_on_random_near_duplicates(spark):
    for seed in (1, 2, 3):
        rows = _near_duplicates(seed)
        assert spark_pairs(spark, rows) == brute_force(rows), seed


def test_exact_copies_are_counted_not_paired(spark):
    from pyspark.sql import functions as F
    one = spark.createDataFrame([("01", "ESCUELA", "CALLE 1", "D", "M", "X", "S"), ("02", "ESCUELB", "CALLE 1", "D", "M", "X", "S")],
                                SCHEMA)
    many = one.crossJoin(spark.range(100_000)).drop("id").unionByName(
        spark.createDataFrame([("03", "ESCUELA GRANDE MUY LARGA", "CALLE LARGA 1", "D", "M", "X", "S"),
                               ("04", "ESCUELA GRANDE MUY LARGO", "CALLE LARGA 1", "D", "M", "X", "S")], SCHEMA))
    got = {r.rows_1: r.pairs for r in dedupe.fuzzy_pairs(many).collect()}
    assert got == {100_000: 100_000 * 99_999 // 2, 1: 1}
    assert dedupe.fuzzy_pairs_count(many).first().pairs == 100_000 * 99_999 + 1
    assert dedupe.classes(many).agg(F.sum("m")).first()[0] == 200_002


def test_hot_key_split_keeps_every_pair(spark):
    for seed, bucket in ((5, 3), (13, 2)):      # nearly every q-gram is split
        rows = _near_duplicates(seed, n=150)
        assert spark_pairs(spark, rows, dedupe.FuzzyConfig(bucket=bucket)) == brute_force(rows)


def test_count_and_order(spark):
    rows = _near_duplicates(7)
    pairs = dedupe.fuzzy_pairs(frame(spark, rows)).collect()
    assert dedupe.fuzzy_pairs_count(frame(spark, rows)).first().pairs == len(brute_force(rows))
    sims = [r.similarity for r in pairs]
    assert sims == sorted(sims, reverse=True)


def _lev(a, b):
    prev = list(range(len(b) + 1))
    for i, ca in enumerate(a, 1):
        cur = [i]
        for j, cb in enumerate(b, 1):
            cur.append(min(prev[j] + 1, cur[j - 1] + 1, prev[j - 1] + (ca != cb)))
        prev = cur
    return prev[-1]


def test_lev_prefilter_finds_every_pair_within_the_bound(spark):
    rows = _near_duplicates(11, n=100)

    def ts(r):
        return " ".join(sorted(f"{r[1].strip().upper()} | {r[2].strip().upper()}".split()))
    groups = {}
    for r in rows:
        if r[1] is not None and r[2] is not None:
            groups.setdefault((r[3], r[4], r[5], r[6]), set()).add(ts(r))
    expected = set()
    for g, texts in groups.items():
        for a, b in itertools.combinations(sorted(texts), 2):
            d = _lev(a, b)
            if d <= (len(a) + len(b)) * 5 // 100:
                expected.add((a, b, d))
    got = {(r.ta, r.tb, r.lev) for r in dedupe.lev_prefilter_pairs(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert got == expected


def test_pieces_find_every_pair_at_lower_thresholds(spark):
    """Many edits a text: more pieces, down to empty ones; candidates stay near the matches on varied texts."""
    from pyspark.sql import functions as F
    rnd = random.Random(21)
    rows = []
    for i in range(160):
        if rows and rnd.random() < 0.5:
            text = list(rnd.choice(rows)[1])
            for _ in range(rnd.randrange(1, 5)):
                at = rnd.randrange(len(text))
                text[at:at + rnd.randrange(2)] = rnd.choice(["", "A", "XY"])
            name = "".join(text) or "A"
        else:
            name = "".join(rnd.choice("ABCDEFGHIJ ") for _ in range(rnd.choice([3, 12, 30, 60])))
        rows.append((f"{i:04d}", name.strip() or "B", "C", "D", "M", None, "S"))
    for t in (85, 55):
        cfg = dedupe.FuzzyConfig(threshold=t)
        assert spark_pairs(spark, rows, cfg) == brute_force(rows, t)
    texts = dedupe.numbered_classes(frame(spark, rows))
    found, n = dedupe.candidate_ids(texts).count(), texts.count()
    assert found <= n * (n - 1) / 2 / 20
    assert texts.select(F.countDistinct("id")).first()[0] == n


def test_export_for_review_holds_the_rows_behind_the_pairs(spark, tmp_path):
    rows = [("1", "Escuela Primera del Norte", "Calle 1", "d", "m", None, "s"), ("2", "Escuela Primera del Norte", "Calle 1", "d", "m", None, "s"),
            ("3", "Escuela Primera del Norte", "Calle 2", "d", "m", None, "s"), ("4", "Otra", "Avenida", "d", "m", None, "s"),
            ("5", "Escuela Primera del Norte", "Calle 1", "d", "m", "x", "s"), ("6", None, "Calle 1", "d", "m", None, "s")]
    df = spark.createDataFrame(rows, "code string, name string, address string, department string, municipality string, "
                                     "director string, sector string")
    for fmt in ("parquet", "csv"):
        path = str(tmp_path / fmt)
        dedupe.export_candidates(df, path, fmt=fmt)
        members = spark.read.format(fmt).option("header", True).load(f"{path}/members")
        assert sorted((r.code, r["name"], r.address) for r in members.collect()) == [r[:3] for r in rows[:3]]
        assert spark.read.format(fmt).option("header", True).load(f"{path}/pairs").count() == 2
