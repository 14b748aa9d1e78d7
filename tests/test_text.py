"""Column predicates and transforms against Python's own str/re behaviour."""

import re

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from dqspark.functions import constants as K
from dqspark.functions import text as tx

WS_CHARS = [" ", "\t", "\n", " ", " ", "\u001c", "\u001f", "　", "\x0b"]
ALPHABET = st.sampled_from(list("ab0-_.,;:?*#/=ZONA9Á×") + WS_CHARS)


def col_values(spark, values, expr):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    return [r[0] for r in df.orderBy("i").select(expr.alias("x")).collect()]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=8), min_size=1, max_size=20))
def test_strip_and_collapse_match_python(spark, values):
    assert col_values(spark, values, tx.ws_strip("v")) == [v.strip() for v in values]
    py = [re.sub(r"\s{2,}", " ", v.strip()) for v in values]
    assert col_values(spark, values, tx.normalize_ws("v")) == py


@settings(max_examples=30, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=8), min_size=1, max_size=20))
def test_signature_and_junk_match_python(spark, values):
    def sig(v):
        return re.sub(r"[A-Za-zÀ-ÿ]", "A", re.sub(r"[0-9]", "N", v))
    assert col_values(spark, values, tx.shape_signature("v")) == [sig(v) for v in values]
    junk = re.compile(K.JUNK_PATTERN)
    assert col_values(spark, values, tx.is_junk("v")) == [bool(junk.match(v)) for v in values]
    ext = re.compile(K.JUNK_EXT_PATTERN)
    assert col_values(spark, values, tx.is_junk_ext("v")) == [bool(ext.match(v)) for v in values]


def test_phone_predicates(spark):
    vals = ["22334455", " 22334455", "2220-1723", "7.73746E+15", "TEL 5565", None]
    assert col_values(spark, vals, tx.matches_phone("v")) == [True, False, False, False, False, None]
    # diagnosis strips first: the leading-space phone is valid there
    assert col_values(spark, vals, tx.matches_phone(tx.ws_strip("v")))[1] is True


def test_junk_variants_differ(spark):
    vals = ["-", "..", "0", ",,", "/=#", "   ", "", None, "A-1"]
    assert col_values(spark, vals, tx.is_junk("v")) == [True, True, False, False, True, True, False, None, False]
    assert col_values(spark, vals, tx.is_junk_or_zero("v")) == [True, True, True, False, True, False, False,
                                                               False, False]
    assert col_values(spark, vals, tx.is_junk_ext("v")) == [True, True, False, True, True, True, False, None,
                                                           False]


def test_zero_typo_fix(spark):
    vals = ["EDNA ACEVED0", "A0B0", "A00", "X01", "Ñ0"]
    assert col_values(spark, vals, tx.fix_zero_typo("v")) == ["EDNA ACEVEDO", "AOBO", "A00", "X01", "ÑO"]
    assert col_values(spark, vals, tx.has_zero_typo("v")) == [True, True, False, False, True]


def test_disguised_tokens_and_placeholder(spark):
    vals = ["s/d", "Sin Dato", "DESCONOCIDO", "desconocido", "N/A", "ok"]
    assert col_values(spark, vals, tx.is_disguised_null("v")) == [True, True, True, True, True, False]


def test_shape_signature_classes(spark):
    vals = ["22-01-1221", "22-001", "AB-1", "×"]
    assert col_values(spark, vals, tx.shape_signature("v")) == ["AA-AA-AAAA", "AA-AAA", "AA-A", "A"]
    assert col_values(spark, vals, tx.shape_signature("v", keep_digit_class=True)) == \
        ["NN-NN-NNNN", "NN-NNN", "AA-N", "A"]


def test_token_sort(spark):
    vals = ["  B a  C ", "", "x"]
    assert col_values(spark, vals, tx.token_sort("v")) == ["B C a", "", "x"]


def test_zone_case_insensitive(spark):
    vals = ["ZONA 1", "zona  10", "ZONA1", " ZONA 3"]
    assert col_values(spark, vals, F.coalesce(tx.matches_zone("v"), F.lit(False))) == [True, True, False, False]


def test_sql_functions_equal_the_column_forms(spark):
    from pyspark.sql import functions as F
    from dqspark.functions import category, sql, text as tx
    sql.register(spark)
    values = [None, "", " ", "---", "a  b", "\ta'b\\", "Zona 12", "ZONA\n1", "12345678", "01-02-0003-04", "GUATEMALA0", "A01", "n/a ",
              "0", " . ", "Ñandú,  é", "x ", "b a c", "�", ",;:", "\x1c--", "Ｚ１"]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    forms = {n: getattr(tx, n, None) or getattr(category, n) for n in sql.NAMES}
    got = df.select("v", *[F.expr(f"{n}(v)").alias(n) for n in sql.NAMES])
    want = df.select("v", *[f("v").alias(n) for n, f in forms.items()])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
