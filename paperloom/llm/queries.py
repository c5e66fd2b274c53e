"""The registered queries of the training-data operators; each is thin and leaves the work to its operator."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import packing, pages, pieces, quality, search, shards, simhash, toxicity, urls, vectors

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def query(sql: str | None = None):
    """Register a query under its function's name, with SQL where SQL can express it."""

    def register(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLE[f.__name__] = sql
        return f

    return register


@query()
def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query()
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_digest(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query(search.ORACLE)
def op3_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.search_digest(_table(spark, sf_dir, "documents"))


@query(vectors.ORACLE)
def op4_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectors.near_vectors(_table(spark, sf_dir, "embeddings"))


@query()
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_digest(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query()
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query()
def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.shard_documents(_table(spark, sf_dir, "documents"))


@query(urls.ORACLE)
def op8_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_digest(_table(spark, sf_dir, "pages"))


@query()
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_digest(_table(spark, sf_dir, "documents"))


@query()
def op10_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pages.page_digest(_table(spark, sf_dir, "pages"))
