"""Corpus pipeline over ``documents``: quality rules, line dedup, near-duplicate removal, benchmark decontamination,
mixing to target weights. Each stage maps ``(spark, docs, sf_dir)`` to a DataFrame that the next one reads back
from Parquet; all but the last return the columns of ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from edgegraph.llm import decontam, line_dedup, mixing, neardup, quality
from edgegraph.llm.tables import shared_folder
from edgegraph.sources.tables import load_table


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go."""
    return quality.filter_documents(docs)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of repeated line runs of 50 words or more are cut out; documents that consist of them go."""
    return line_dedup.dedup_lines(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (similarity 0.8 of 5-word shingles) stays."""
    return neardup.drop_copies(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of the benchmark go."""
    return decontam.drop_leaks(docs, load_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of documents by target weights, dealt into shards: adds mix_shard and mix_order."""
    return mixing.mix(docs)


STAGES = [("quality_rules", quality_rules), ("line_dedup", dedup_lines), ("minhash_neardup", drop_near_copies),
          ("decontamination", decontaminate), ("mixing", mix_sources)]

# The line, near-duplicate and mixing stages follow hashes that DuckDB does not have; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole ``documents`` table; every stage's result is a table in the shared folder."""
    docs = load_table(spark, sf_dir, "documents")
    folder = shared_folder(spark, "pipeline")
    for i, (name, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{i}-{name}")
        docs = spark.read.parquet(f"{folder}/{i}-{name}")
    return docs
