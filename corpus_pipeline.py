"""Corpus pipeline: quality, near-duplicates, decontamination, personal data, mixing.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor
kept; its result is written as Parquet and read again as the next one's input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dqspark.llm import decontam, forest, mixing, pii, quality
from dqspark.llm.common import materialize, prepare
from dqspark.sources.tables import table


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    prepare(spark)
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates (five-word shingles, similarity 0.8)."""
    prepare(spark)
    return forest.deduplicate(docs, size=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    prepare(spark)
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def hide_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data replaced by pseudonyms; n_chars follows where the text has changed."""
    prepare(spark)
    out = pii.pseudonymise(docs, pii.session_key(spark))
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.when(F.col("pii_values") > 0, F.length("text").cast(kind))
                             .otherwise(F.col("n_chars")))
    return out.select(*[c for c in docs.columns if c in out.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of the mix with the words it takes from each."""
    prepare(spark)
    return mixing.mix(docs, carry=True).where("taken > 0").drop("rank")


STAGES = [
    ("quality_classifier", keep_quality),
    ("minhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_contaminated),
    ("pii", hide_personal_data),
    ("mixing", mix_sources),
]

#: The stages train a classifier and search by hashing: not expressible in SQL, so tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
