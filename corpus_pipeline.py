"""The corpus pipeline: language, repeated passages, near duplicates, mix and packing.

Each stage is one operator of ``lodestat.llm`` over all rows its predecessor kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lodestat.llm import langid, linededup, mixing, neardedup, packing
from lodestat.session import cut, ship

END_ID = 2
NEAR = (80, 100)  # Jaccard from which documents are near copies; the 0.85 of op3_near_dedup is that query's own


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is known."""
    ship(spark)
    return langid.known(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without passages that an earlier one holds."""
    ship(spark)
    return linededup.clean(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, at a Jaccard of 0.8 or more."""
    ship(spark)
    return neardedup.clean(docs, limit=NEAR)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target asks."""
    ship(spark)
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of sequences of 4096 ids."""
    import public_tokenizers

    ship(spark)
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"), END_ID)


STAGES = [("language", language), ("lines", lines), ("near_copies", near_copies), ("mix", mix), ("pack", pack)]
ORACLE_SQL = None  # kernels, sketches, random rounding and greedy packing are not SQL; see tests/llm


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written before the next one reads it."""
    docs = spark.read.parquet(f"{sf_dir.rstrip('/')}/documents.parquet")
    for name, stage in STAGES:
        docs = stage(spark, docs, sf_dir)
        if name != STAGES[-1][0]:
            docs = cut(docs)
    return docs
