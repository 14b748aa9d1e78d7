"""Out-of-domain checks over the value-frequency frame.

All checks work on distinct values (the frequency frame), not rows, and all
columns are checked in one pass: the value is prepared and tested with a
per-row ``CASE`` on ``variable``, so the frame is read once and shuffled once
(per-column filters would be pushed below the frequency aggregate and turn
one scan into one per column).  The result is the complete long table
``(variable, value, n)`` of invalid distinct values; reports keep one row per
value, since the number of invalid values is unbounded.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dqspark.functions import constants as K
from dqspark.functions import text as tx

CATEGORICAL, NAME, KEY, PHONE = "categorical", "name", "key", "phone"


@dataclass(frozen=True)
class Check:
    column: str
    kind: str
    catalog: object = None    # collection of strings, one-column DataFrame, or None


def _bad(kind: str, v: Column, catalog) -> Column:
    if kind == CATEGORICAL:
        base = tx.is_junk(v) | v.rlike(tx.J_DIGIT)
        if isinstance(catalog, DataFrame):
            return base | F.col("_cv").isNull()
        return base | tx.not_in_catalog(v, catalog)
    if kind == NAME:
        return tx.is_invalid_name(v)
    if kind == KEY:
        return ~v.rlike(tx.J_KEY) | tx.is_junk(v)
    if kind == PHONE:
        return ~v.rlike(tx.J_PHONE) | tx.is_junk(v)
    raise ValueError(kind)


def violations(vf: DataFrame, checks: list[Check]) -> DataFrame:
    """``(variable, value, n)`` of invalid prepared values, all checks in one pass.

    Categorical values are compared upper-cased and stripped, the others
    stripped with case kept; empty values are ignored.
    """
    cols = [c.column for c in checks]
    upper_cols = [c.column for c in checks if c.kind == CATEGORICAL]
    v = vf.where(F.col("variable").isin(cols) & F.col("value").isNotNull())
    s = tx.ws_strip("value")
    prepared = (v.select("variable", F.when(F.col("variable").isin(upper_cols), F.upper(s)).otherwise(s)
                         .alias("value"), "n")
                .where(F.col("value") != "")
                .groupBy("variable", "value").agg(F.sum("n").cast("bigint").alias("n")))
    table_checks = [c for c in checks if c.kind == CATEGORICAL and isinstance(c.catalog, DataFrame)]
    if table_checks:
        cats = None
        for c in table_checks:
            cat = c.catalog.select(F.lit(c.column).alias("_cvar"), F.col(c.catalog.columns[0]).alias("_cv"))
            cats = cat if cats is None else cats.unionByName(cat)
        # a plain join: Spark broadcasts the catalogue if its measured bytes allow it
        prepared = prepared.join(cats.distinct(), (F.col("variable") == F.col("_cvar"))
                                 & (F.col("value") == F.col("_cv")), "left")
    bad = F.lit(False)
    for c in reversed(checks):
        bad = F.when(F.col("variable") == c.column, _bad(c.kind, F.col("value"), c.catalog)).otherwise(bad)
    return prepared.where(bad).select("variable", "value", "n")


def categorical_violations(vf: DataFrame, column: str, catalog=None) -> DataFrame:
    """Upper/stripped values that are junk, contain a digit, or are outside
    the catalogue (empty/None catalogue: no list check)."""
    return violations(vf, [Check(column, CATEGORICAL, catalog)])


def name_violations(vf: DataFrame, column: str) -> DataFrame:
    """Stripped values (case kept) that are junk or contain a digit."""
    return violations(vf, [Check(column, NAME)])


def key_violations(vf: DataFrame, column: str) -> DataFrame:
    return violations(vf, [Check(column, KEY)])


def phone_violations(vf: DataFrame, column: str) -> DataFrame:
    return violations(vf, [Check(column, PHONE)])


def _variables(spark, variables: list[str]) -> DataFrame:
    return spark.createDataFrame([(i + 1, v) for i, v in enumerate(variables)], "pos int, variable string")


def counts(violations_df: DataFrame, variables: list[str]) -> DataFrame:
    """``(variable, pos, invalid_values)`` for every checked variable."""
    n = violations_df.groupBy("variable").agg(F.count(F.lit(1)).alias("n"))
    return (_variables(violations_df.sparkSession, variables).join(n, "variable", "left")
            .select("variable", "pos", F.coalesce("n", F.lit(0)).cast("bigint").alias("invalid_values"))
            .orderBy("pos"))


def report(violations_df: DataFrame, variables: list[str]) -> DataFrame:
    """``(variable, pos, value, n)``: every invalid value; ``Ninguno`` and 0 for a clean variable."""
    base = _variables(violations_df.sparkSession, variables)
    return (base.join(violations_df, "variable", "left")
            .select("variable", "pos", F.coalesce("value", F.lit(K.NONE_TEXT)).alias("value"),
                    F.coalesce("n", F.lit(0)).cast("bigint").alias("n")))
