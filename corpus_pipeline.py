"""Filtering, deduplication and mixing of a training corpus, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from linkscore.llm import decontaminate, jaccard, language, lines, mixing
from linkscore.runtime import stored


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told."""
    held_out = language.id_bucket(F.col("doc_id"), 4) == 2
    found = language.identify(docs, language.learn(docs.where(~held_out)))
    return found.where("NOT rejected").select(docs.columns)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that many of them share."""
    out = lines.dedup_lines(docs)
    return out.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def join_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates."""
    return jaccard.deduplicate(docs, n=5, percent=80).select(docs.columns)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document that is left."""
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("near_duplicates", join_near_duplicates),
    ("decontamination", drop_benchmark),
    ("mixing", mix_sources),
]

#: Compression, signatures and retrieval have no SQL form; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
