"""A corpus pipeline of four stages: what is toxic goes, what is poor goes, one of each near-duplicate group stays, the rest is packed."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from paperloom.llm import alike, packing, quality, toxicity
from paperloom.llm.shared import written

#: Near-duplicates share 0.8 of their distinct shingles of five words, by exact count. SimHash links within so many bits come first, and what they link isn't met again.
SHINGLE_WORDS, DIFFERING_BITS = 5, 2


def _labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, _labels(spark, sf_dir))


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality.keep_good(docs, _labels(spark, sf_dir))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return alike.one_of_each(docs, SHINGLE_WORDS, DIFFERING_BITS)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("quality", keep_good), ("simhash", drop_near_duplicates), ("packing", pack)]
#: SQL can express neither the trained stages nor the fingerprints.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each is written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
