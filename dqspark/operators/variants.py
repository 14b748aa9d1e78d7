"""Category variants: distinct spellings that share a normalised key.

Results are one row per spelling, so a key with very many of them needs no
long list anywhere.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dqspark.functions import constants as K
from dqspark.functions.category import category_key


def _values(vf: DataFrame, columns: list[str] | None) -> DataFrame:
    v = vf.where(F.col("value").isNotNull())
    return v if columns is None else v.where(F.col("variable").isin(columns))


def skipped_columns(vf: DataFrame, max_distinct: int, columns: list[str] | None = None) -> DataFrame:
    """``(variable, distinct_values)`` of the columns that a gate leaves out."""
    return (_values(vf, columns).groupBy("variable").agg(F.count(F.lit(1)).alias("distinct_values"))
            .where(F.col("distinct_values") > max_distinct))


def _keyed(vf: DataFrame, max_distinct: int | None, columns: list[str] | None) -> DataFrame:
    v = _values(vf, columns)
    if max_distinct is not None:    # one row per column at most
        v = v.join(skipped_columns(vf, max_distinct, columns), "variable", "left_anti")
    return v.select("variable", "pos", "value", category_key("value").alias("key"))


def variant_keys(vf: DataFrame, max_distinct: int | None = None, columns: list[str] | None = None) -> DataFrame:
    """``(variable, pos, key, n_variants)`` of every key with more than one distinct raw value.

    With ``max_distinct`` columns with more distinct values are left out;
    ``skipped_columns`` names them.
    """
    return (_keyed(vf, max_distinct, columns).groupBy("variable", "pos", "key")
            .agg(F.count(F.lit(1)).alias("n_variants")).where(F.col("n_variants") > 1))


def variant_groups(vf: DataFrame, max_distinct: int | None = None, columns: list[str] | None = None) -> DataFrame:
    """``(variable, pos, key, n_variants, value)``: one row per spelling of such a key."""
    keys = variant_keys(vf, max_distinct, columns).drop("pos")
    return (_keyed(vf, max_distinct, columns).join(keys, ["variable", "key"])
            .select("variable", "pos", "key", "n_variants", "value"))


def variant_summary(groups: DataFrame, k: int = K.EXAMPLES_K) -> DataFrame:
    """``(variable, pos, groups, examples)``: the first ``k`` keys with their first ``k`` spellings."""
    keys = groups.select("variable", "pos", "key").distinct()
    counts = keys.groupBy("variable", "pos").agg(F.count(F.lit(1)).cast("bigint").alias("groups"))
    by_key = Window.partitionBy("variable").orderBy("key")
    shown = keys.withColumn("_rn", F.row_number().over(by_key)).where(F.col("_rn") <= k).select("variable", "key")
    by_value = Window.partitionBy("variable", "key").orderBy("value")
    spelt = (groups.join(shown, ["variable", "key"], "left_semi")
             .withColumn("_rn", F.row_number().over(by_value)).where(F.col("_rn") <= k)
             .groupBy("variable", "key").agg(F.array_join(F.array_sort(F.collect_list("value")), " | ").alias("s")))
    examples = spelt.groupBy("variable").agg(F.array_join(F.transform(
        F.array_sort(F.collect_list(F.struct("key", "s"))), lambda x: x["s"]), "; ").alias("examples"))
    return counts.join(examples, "variable").orderBy("pos")
