"""Profiles that grow by loads: stored partial aggregates, merged when read.

A ``ProfileState`` keeps, for every load (a file, a day, a batch), its value
frequencies, its counts by column and a distinct-value sketch by column.  All
three merge by addition or union, so the profile of everything loaded so far
costs the size of the aggregates, not another scan of the rows, and a load
can be put again (it replaces itself) or taken out.  The merged frames are
those of ``operators.profile``; ``domain``, ``variants``, ``shape_profile`` and
``plans.diagnosis`` take them as they take fresh ones.

Defined results: a load without rows is kept with counts of 0; a state without
loads gives empty frames; loads must have the state's columns (others are
ignored).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dqspark.operators import profile

LG_K = 14       # of the sketches: 2^14 registers, a relative standard error of about 0.8 %

_FREQ = "variable string, value string, n bigint"
_STATS = ("variable string, pos int, rows bigint, missing bigint, edge_ws bigint, multi_ws bigint, corrupt bigint, "
          "letters bigint, type string, is_text boolean")
_SKETCHES = "variable string, pos int, sketch binary"
_NO_LOAD = "__HIVE_DEFAULT_PARTITION__"      # the folder name of a null partition value
_COUNTS = ("rows", "missing", "edge_ws", "multi_ws", "corrupt", "letters")


def distinct_sketches(df: DataFrame, by: list[str | Column] = (), columns: list[str] | None = None,
                      lg_k: int = LG_K) -> DataFrame:
    """``(by..., variable, pos, sketch)``: a mergeable sketch of each column's distinct non-null values.

    One pass; the shuffle carries a sketch per column, group and partition.
    """
    cols = list(columns or df.columns)
    row = df.groupBy(*by).agg(*[F.hll_sketch_agg(F.col(c).cast("string"), F.lit(lg_k)).alias(f"sketch_{i}")
                                for i, c in enumerate(cols)])
    keys = row.columns[:len(by)]
    structs = [F.struct(F.lit(c).alias("variable"), F.lit(i + 1).alias("pos"), F.col(f"sketch_{i}").alias("sketch"))
               for i, c in enumerate(cols)]
    return row.select(*keys, F.explode(F.array(*structs)).alias("s")).select(*keys, "s.*")


def merged_distinct(sketches: DataFrame) -> DataFrame:
    """``(variable, pos, distinct_values)`` estimated from the union of the sketches."""
    return (sketches.groupBy("variable", "pos")
            .agg(F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("distinct_values")))


class ProfileState:
    """Partial aggregates of loads under ``folder`` (shared storage)."""

    def __init__(self, spark: SparkSession, folder: str, columns: list[str], phone_column: str | None = None):
        self.spark, self.folder, self.columns, self.phone_column = spark, folder.rstrip("/"), list(columns), phone_column

    def _parts(self, df: DataFrame) -> dict[str, DataFrame]:
        df = df.select(*self.columns)
        return {"freq": profile.value_freq(df).select("variable", "value", "n"),
                "stats": profile.column_stats(df, self.phone_column),
                "sketches": distinct_sketches(df)}

    def put(self, load: str, df: DataFrame) -> None:
        """Add the rows of a load; the same load put again replaces itself."""
        for name, part in self._parts(df).items():
            part.write.mode("overwrite").parquet(f"{self.folder}/{name}/load={load}")

    def remove(self, load: str) -> None:
        """Take a load out: its aggregates are written over by empty ones."""
        for name, schema in (("freq", _FREQ), ("stats", _STATS), ("sketches", _SKETCHES)):
            (self.spark.createDataFrame([], schema).write.mode("overwrite")
             .parquet(f"{self.folder}/{name}/load={load}"))

    def _read(self, name: str, schema: str) -> DataFrame:
        # without a load there is no folder yet: writing nothing makes it
        self.spark.createDataFrame([], schema).write.mode("overwrite").parquet(f"{self.folder}/{name}/load={_NO_LOAD}")
        return self.spark.read.schema(f"{schema}, load string").parquet(f"{self.folder}/{name}")

    def loads(self) -> DataFrame:
        """``(load, rows)`` of the loads that count."""
        return self._read("stats", _STATS).groupBy("load").agg(F.max("rows").alias("rows"))

    def value_freq(self) -> DataFrame:
        """The frame of ``profile.value_freq`` over all loads."""
        merged = self._read("freq", _FREQ).groupBy("variable", "value").agg(F.sum("n").alias("n"))
        return merged.withColumn("pos", profile._pos(self.columns))

    def column_stats(self) -> DataFrame:
        """The frame of ``profile.column_stats`` over all loads."""
        return self._read("stats", _STATS).groupBy("variable", "pos", "type", "is_text").agg(
            *[F.sum(c).alias(c) for c in _COUNTS])

    def distinct_approx(self) -> DataFrame:
        """``(variable, pos, distinct_values)`` from the loads' sketches."""
        return merged_distinct(self._read("sketches", _SKETCHES))
