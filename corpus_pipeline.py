"""A corpus pipeline: from raw documents to token ids. Each stage works on all that the one before it kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from scoreloom.functions.storage import settled
from scoreloom.llm.bpe import default_vocabulary, encoding_report
from scoreloom.llm.common import BATCH_SETTINGS
from scoreloom.llm.dedup import deduplicated
from scoreloom.llm.jaccard import Join
from scoreloom.llm.language import recognised
from scoreloom.llm.mixing import mix


# Texts in a batch that is read or goes to Python: the defaults of 4,096 and 10,000 may be hundreds of megabytes, and two batches are held at once.
BATCH = 500


def tuned(spark: SparkSession) -> None:
    """Stages are written by whoever calls them, so the settings stay for the session."""
    for name in BATCH_SETTINGS:
        spark.conf.set(name, str(BATCH))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learned language; those without any letter go, and those whose language is less likely than not."""
    tuned(spark)
    return recognised(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the one with the largest id."""
    return deduplicated(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by five-word shingles that are 80 percent alike, the one with the smallest id."""
    return Join(words=5, percent=80).without_near_copies(docs)


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's share asks for."""
    return mix(docs)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of each document of the mix, with digests of the ids and of the text they decode to."""
    tuned(spark)
    return encoding_report(docs, default_vocabulary(), keep_ids=True)


STAGES = [("language", language), ("exact", exact), ("near", near), ("mix", mixed), ("encode", encoded)]

# The language model, the components of links and the tokenizer have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage. Each stage's result is written to the shared folder and read again by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = settled(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
