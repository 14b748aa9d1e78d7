from hypothesis import given, settings
from hypothesis import strategies as st

from dqspark.functions.similarity import lcs_length, lcs_length_dp


@settings(max_examples=400, deadline=None)
@given(st.text("abcd é|", max_size=40), st.text("abcd é|", max_size=40))
def test_bit_parallel_lcs_equals_dynamic_program(a, b):
    assert lcs_length(a, b) == lcs_length_dp(a, b)


def test_lcs_udf_and_score(spark):
    from pyspark.sql import functions as F
    from dqspark.functions.similarity import lcs_udf, similarity_from_lcs
    df = spark.createDataFrame([("ABC", "ABD"), ("", ""), ("X Y", "X Y")], "a string, b string")
    out = df.select(similarity_from_lcs(lcs_udf("a", "b"), F.length("a"), F.length("b")).alias("s")).collect()
    assert [r.s for r in out] == [66.7, 100.0, 100.0]
