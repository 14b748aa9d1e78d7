"""Connected components by alternating large-star and small-star steps.

Each step joins edges with the smallest neighbour of their ends; the edge
table shrinks to stars whose centre is the smallest id of the component.
Every round is one job that writes its edges to the shared folder, so the
lineage stays short and a lost executor costs one round.  The rows of a node
with very many edges are dealt to ``SALTS`` tasks.  Nothing but two sums per
round, observed while writing, reaches the driver; one of them, the number of
edges, sets the number of files of the next round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from dqspark.llm.common import materialize

SALTS = 4
EDGES = 1 << 16             # that a round writes to a file; more only where shuffle partitions are fewer


def _with_smallest(edges: DataFrame) -> DataFrame:
    """``edges`` with ``m``, the smallest of ``u`` and its neighbours."""
    least = edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    spread = least.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return edges.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(SALTS)).cast("int")).join(spread, ["u", "salt"])


def _round(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    large = _with_smallest(both).where("v > u and v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    # the smaller neighbours of a node, and the node itself, hang on the smallest
    small = _with_smallest(large).select(F.explode(F.array(
        F.struct(F.greatest("v", "m").alias("u"), F.least("v", "m").alias("v")),
        F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")).select("e.u", "e.v").where("u <> v")
    return small.distinct()


def _written(edges: DataFrame) -> tuple[DataFrame, tuple]:
    seen = Observation()
    table = materialize(edges.observe(seen, F.count(F.lit(1)).alias("n"),
                                      F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")), "components")
    return table, (seen.get["n"], seen.get["h"])


def components(edges: DataFrame) -> DataFrame:
    """id and component (its smallest id) of every end of the edges ``u, v``.

    Loops and repeated edges change nothing; edges with a null end are ignored.
    """
    edges, before = _written(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
                             .distinct())
    while before[0]:
        edges, after = _written(_round(edges).coalesce(-(-before[0] // EDGES)))
        if after == before:
            break
        before = after
    return (edges.select(F.col("u").alias("id"), F.col("v").alias("component"))
            .union(edges.select(F.col("v").alias("id"), F.col("v").alias("component")).distinct()))
