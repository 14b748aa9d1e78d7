from pyspark.sql import functions as F

from dqspark.operators import profile, state, variants
from dqspark.sources.tables import dirty_registry
from tests.conftest import SF_MID, SF_SMALL


def same(a, b):
    cols = sorted(a.columns)
    assert cols == sorted(b.columns)
    a, b = a.select(*cols), b.select(*cols)
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_merged_loads_equal_the_whole(spark, tmp_path):
    d = dirty_registry(spark, SF_SMALL)
    phone = d.columns[-1]
    part = F.pmod(F.xxhash64(*d.columns), F.lit(3))
    kept = state.ProfileState(spark, str(tmp_path / "state"), d.columns, phone)
    for i in range(3):
        kept.put(f"day {i}", d.where(part == i))
    kept.put("day 1", d.where(part == 1))               # again, as after a failure
    kept.put("wrong", d.limit(40))
    assert {r.load: r.rows for r in kept.loads().collect()}["wrong"] == 40
    kept.remove("wrong")
    kept.put("empty", d.limit(0))
    same(kept.value_freq(), profile.value_freq(d))
    same(kept.column_stats(), profile.column_stats(d, phone))
    text = profile.string_columns(d)
    same(variants.variant_groups(kept.value_freq(), columns=text), variants.variant_groups(profile.value_freq(d), columns=text))
    assert {r.load for r in kept.loads().collect()} == {"day 0", "day 1", "day 2", "empty"}


def test_state_without_loads(spark, tmp_path):
    kept = state.ProfileState(spark, str(tmp_path / "state"), ["a", "b"])
    assert kept.value_freq().count() == kept.column_stats().count() == kept.distinct_approx().count() == 0
    kept.remove("never put")
    assert kept.loads().count() == 0
    kept.put("x", spark.createDataFrame([(None, None), (None, "b")], "a string, b string"))
    assert {r.variable: r.distinct_values for r in kept.distinct_approx().collect()} == {"a": 0, "b": 1}


def test_united_sketches_estimate_the_whole(spark):
    d = dirty_registry(spark, SF_MID)
    parts = state.distinct_sketches(d.withColumn("half", F.pmod(F.xxhash64(*d.columns), F.lit(2))), ["half"], d.columns)
    assert parts.count() == 2 * len(d.columns)
    united = {r.variable: r.distinct_values for r in state.merged_distinct(parts).collect()}
    whole = {r.variable: r.distinct_values for r in state.merged_distinct(state.distinct_sketches(d)).collect()}
    exact = {r.variable: r.distinct_values for r in profile.distinct_counts(profile.value_freq(d)).collect()}
    for c in d.columns:
        assert abs(united[c] - exact[c]) <= 0.03 * exact[c] and abs(whole[c] - exact[c]) <= 0.03 * exact[c], c
