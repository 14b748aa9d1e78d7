from pyspark.sql import functions as F

from dqspark.operators import profile, variants


def test_duplicates_with_nulls(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("a", "x")], "p string, q string")
    assert profile.duplicate_count(df).first().duplicates == 1
    ex = profile.duplicate_examples(df).collect()
    assert [tuple(r) for r in ex] == [("a", None), ("a", None)]


def test_missing_and_distinct(spark):
    df = spark.createDataFrame([("a", None), ("b", None), ("a", "x"), (None, "y")], "p string, q string")
    vf = profile.value_freq(df)
    m = {r.variable: (r.missing, r.missing_pct) for r in profile.missing(df).collect()}
    assert m == {"p": (1, 25.0), "q": (2, 50.0)}
    d = {r.variable: r.distinct_values for r in profile.distinct_counts(vf).collect()}
    assert d == {"p": 2, "q": 2}


def test_variant_groups(spark):
    df = spark.createDataFrame([(v,) for v in ["Privado", "PRIVADO", "MUNICIPÁL", "MUNICIPAL", "OFICIAL"]],
                               "sector string")
    g = variants.variant_groups(profile.value_freq(df)).orderBy("key").collect()
    assert sorted((r.key, r.n_variants, r.value) for r in g) == [
        ("MUNICIPAL", 2, "MUNICIPAL"), ("MUNICIPAL", 2, "MUNICIPÁL"), ("PRIVADO", 2, "PRIVADO"), ("PRIVADO", 2, "Privado")]


def test_variants_of_columns_with_many_values(spark):
    values = [f"v{i}" for i in range(61)] + [f"V{i}." for i in range(61)]
    vf = profile.value_freq(spark.createDataFrame([(v,) for v in values], "c string"))
    assert variants.variant_keys(vf).count() == 61 and variants.variant_groups(vf).count() == 122
    assert variants.variant_keys(vf, max_distinct=60).count() == 0
    assert [tuple(r) for r in variants.skipped_columns(vf, 60).collect()] == [("c", 122)]
    s = variants.variant_summary(variants.variant_groups(vf)).first()
    assert s.groups == 61 and s.examples == "V0. | v0; V1. | v1; V10. | v10; V11. | v11; V12. | v12"


def test_category_key_marks(spark):
    import re
    import unicodedata
    from dqspark.functions.category import category_key

    def plain(v):
        t = "".join(c for c in unicodedata.normalize("NFKD", v.strip().upper()) if not unicodedata.combining(c))
        return " ".join(re.findall("[A-Z0-9]+", t))
    values = ["MUNICIPÁL", " ﬁn-de  año ", "straße", "a\u0903b", "a\u0301b", "①②", "x̂ỳ", "-", ""]
    got = spark.createDataFrame([(v,) for v in values], "v string").select(category_key("v")).collect()
    assert [r[0] for r in got] == [plain(v) for v in values]


def test_domain_report_is_complete(spark):
    from dqspark.operators import domain
    rows = [(f"X{i}9",) for i in range(25)] + [("ANA",)]
    vf = profile.value_freq(spark.createDataFrame(rows, "d string"))
    bad = domain.violations(vf, [domain.Check("d", domain.NAME)])
    assert domain.report(bad, ["d", "e"]).count() == 26
    assert [tuple(r) for r in domain.counts(bad, ["d", "e"]).collect()] == [("d", 1, 25), ("e", 2, 0)]


def test_format_issues(spark):
    df = spark.createDataFrame([(" a", "x  y"), ("P�REZ", "ok"), ("b", None)], "p string, q string")
    f = {r.variable: r for r in profile.format_issues(df, phone_column="q").collect()}
    assert (f["p"].edge_ws, f["p"].multi_ws, f["p"].corrupt, f["p"].corrupt_examples) == (1, 0, 1, "P�REZ")
    assert (f["q"].multi_ws, f["q"].letters) == (1, 2)
    assert f["p"].letters is None


def test_first_k_values_is_bounded(spark):
    df = spark.range(1000).select(F.lit("g").alias("g"), F.format_string("%04d", "id").alias("v"))
    r = profile.first_k_values(df, "g", "v", k=3).first()
    assert r.examples == "0000, 0001, 0002"


def test_distinct_counts_approx_close_to_exact(spark):
    from dqspark.sources.tables import dirty_registry
    from tests.conftest import SF_MID
    d = dirty_registry(spark, SF_MID)
    exact = {r.variable: r.distinct_values for r in profile.distinct_counts(profile.value_freq(d)).collect()}
    approx = {r.variable: r.distinct_values for r in profile.distinct_counts_approx(d).collect()}
    for k, v in exact.items():
        assert abs(approx[k] - v) <= max(2, 0.05 * v), (k, v, approx[k])


def test_category_key_of_every_character_needs_no_python(spark):
    import contextlib
    import io
    import re
    import unicodedata
    from dqspark.functions import sql as SQLF
    from dqspark.functions.category import category_key

    def plain(v):
        t = "".join(c for c in unicodedata.normalize("NFKD", v) if not unicodedata.combining(c))
        return " ".join(re.findall("[A-Z0-9]+", t))
    points = [x for x in range(0x80, 0x110000) if not 0xD800 <= x < 0xE000 and unicodedata.category(chr(x)) not in ("Cn", "Co")]
    df = spark.createDataFrame([(i, "X" + "Y".join(map(chr, points[i:i + 64])) + "Z") for i in range(0, len(points), 64)],
                               "i int, v string").selectExpr("*", "upper(v) as u")
    SQLF.register(spark)
    got = df.select("u", category_key("v").alias("key"), F.expr("category_key(v)").alias("sql"))
    shown = io.StringIO()
    with contextlib.redirect_stdout(shown):
        got.explain()
    assert "Python" not in shown.getvalue() and "ArrowEval" not in shown.getvalue()
    rows = got.collect()
    assert len(rows) > 2000 and [r.key for r in rows] == [plain(r.u.strip()) for r in rows] and all(r.key == r.sql for r in rows)


def test_row_digest_is_one_and_tells_rows_apart(spark):
    rows = [("a", "b", 1), ("ab", "", 1), ("", "ab", 1), (None, "ab", 1), ("-", "ab", 1), ("a", "b", 2), ("1:a", "b", 1),
            ("a", "1:b", 1), (None, None, 1), ("-", "-", 1), ("a", "b", None)]
    df = spark.createDataFrame(rows + rows[:2], "p string, q string, k int")
    assert profile.duplicate_count(df).first().duplicates == 2
    key = df.select(*profile._row_key(df, df.columns, True))
    assert [t for _, t in key.dtypes] == ["binary", "int"] and key.distinct().count() == len(rows)
    assert {len(bytes(r[0])) for r in key.collect()} == {32}
    ex = profile.duplicate_examples(df).collect()
    assert [tuple(r) for r in ex] == [("a", "b", 1)] * 2 + [("ab", "", 1)] * 2


def test_dirty_registry_is_dealt_to_all_tasks(spark):
    from dqspark.sources.tables import dirty_registry
    d = dirty_registry(spark, "/root/testdata/sf0.01")
    per = [r["count"] for r in d.groupBy(F.spark_partition_id().alias("p")).count().collect()]
    many = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert len(per) == many and max(per) <= 2 * sum(per) / many
