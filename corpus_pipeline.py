"""A corpus pipeline: every stage works on all that its predecessor kept, and its decisions take effect."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from siltstone.llm.exact_dedup import drop_copies
from siltstone.llm.jaccard_join import keep_representatives
from siltstone.llm.language_id import keep_identified
from siltstone.llm.mixing import mixed_documents
from siltstone.llm.packing import pack_documents
from siltstone.sinks.staging import stage

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, or without a language that is more probable than all others together, go."""
    return keep_identified(docs)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for A-Z case the largest doc_id stays."""
    return drop_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents connected by a similarity of 0.8 on five-word shingles the smallest doc_id stays."""
    return keep_representatives(docs, words=5, percent=80)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents are left out or repeated so that sources get their share; a repeat is a row."""
    return mixed_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return pack_documents(docs)


STAGES: list[tuple[str, Stage]] = [
    ("language", language),
    ("exact", exact),
    ("near", near),
    ("mix", mix),
    ("pack", pack),
]

# Language identification and the apportionment by seeded hashes have no SQL counterpart.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole documents table; each result is written as Parquet and reread."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return stage(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])
