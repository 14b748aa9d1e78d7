"""Registered queries of this subpackage: name -> (spark, sf_dir) -> DataFrame, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dqspark.llm import (chat, collocations, decontam, fingerprints, forest, jaccard, langid, mixing, pii, quality, suffix,
                         vectorcodes, warc)
from dqspark.llm.common import prepare
from dqspark.sources.tables import table


def op1_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.recovered(spark, table(spark, sf_dir, "conversations"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.edited_pairs(table(spark, sf_dir, "documents"))


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    prepare(spark)
    return mixing.mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def op7_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.near_duplicates(table(spark, sf_dir, "documents"))


def op8_suffix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix.remove_repeats(table(spark, sf_dir, "documents"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonyms(table(spark, sf_dir, "documents"), pii.session_key(spark))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.compress(table(spark, sf_dir, "embeddings"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.mine(table(spark, sf_dir, "documents"))


def op13_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.join(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_langid": op1_langid,
    "op2_quality": op2_quality,
    "op3_chat": op3_chat,
    "op4_decontamination": op4_decontamination,
    "op5_fingerprints": op5_fingerprints,
    "op6_mixing": op6_mixing,
    "op7_forest": op7_forest,
    "op8_suffix": op8_suffix,
    "op9_pii": op9_pii,
    "op10_warc": op10_warc,
    "op11_vector_codes": op11_vector_codes,
    "op12_collocations": op12_collocations,
    "op13_jaccard": op13_jaccard,
}

ORACLE: dict[str, str] = {
    "op6_mixing": mixing.ORACLE,
    "op7_forest": forest.ORACLE,
    "op8_suffix": suffix.ORACLE,
    "op10_warc": warc.ORACLE,
    "op11_vector_codes": vectorcodes.ORACLE,
    "op12_collocations": collocations.ORACLE,
    "op13_jaccard": jaccard.ORACLE,
}
