"""Four stages from raw documents to packed sequences.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept,
and is written as Parquet and read again as the next one's docs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from turnloom.llm import jaccard, mixing, packing, quality
from turnloom.llm.common import table
from turnloom.session import cut_lineage


def rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    return quality.keep_good(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that the n-gram Jaccard join links: five words, 80 percent."""
    return jaccard.one_of_each(docs, percent=80, shingle=5)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The sources in their target shares; a row stands as often as it is taken."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents and their places in sequences."""
    return packing.pack_documents(docs)


STAGES = [("quality_rules", rules), ("ngram_jaccard", near_copies), ("pareto_mix", mix), ("best_fit_packing", pack)]
# Best fit depends on what was placed before and has no SQL form; tests hold the
# stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs, _ = cut_lineage(stage(spark, docs, sf_dir), name)
    return docs
