"""A training corpus from raw documents: identify languages, drop near-duplicates, drop benchmark passages, mix
sources to their weights, and deal the rest into shards.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; between stages the driver of the pipeline writes
Parquet and reads it back, ``run`` chains them through written tables itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sharemill.llm.bm25_decontamination import keep_clean
from sharemill.llm.crf_language import keep_identified
from sharemill.llm.label_sharding import shard_documents
from sharemill.llm.minmax_dedup import Settings, keep_one
from sharemill.llm.poisson_mix import poisson_mix
from sharemill.llm.tables import quoted, staged, table

SHARDS = 8


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language that can be told; texts without letters go, and those whose words don't agree."""
    return keep_identified(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by a similarity of 0.8 or more of five-word shingles."""
    return keep_one(docs, Settings(words=5, percent=80, rows=5))


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    return keep_clean(docs, table(spark, sf_dir, "benchmark"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated so that sources weigh as the square root of their size, in shuffled order."""
    return poisson_mix(docs).select(*map(quoted, docs.columns))


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place of every document: shard and slot, with repeated texts side by side where quotas allow."""
    return shard_documents(docs, SHARDS)


STAGES = [
    ("language", language),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mixing),
    ("sharding", sharding),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)


#: The trained tagger and the propagation of labels have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None
