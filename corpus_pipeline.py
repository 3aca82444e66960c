"""The corpus pipeline: quality rules, line deduplication, near-duplicates, decontamination
and packing, each stage over all that its predecessor kept.

A stage takes (spark, docs, sf_dir) and returns a DataFrame. All but the last return the
columns of ``documents``; ``run`` writes each result to the shared folder and reads it
for the next stage, so a lost executor costs one stage at most.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from riskmart.llm.common import stored, table
from riskmart.llm.decontamination import decontaminated
from riskmart.llm.line_windows import remove_repeated_windows
from riskmart.llm.lsh_forest import without_near_duplicates
from riskmart.llm.quality_divergence import passing
from riskmart.llm.queries import tokenizer_path
from riskmart.llm.window_packing import pack_windows


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that fail the base rule or lie too far from their language go."""
    return passing(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of three-line windows are cut from the texts."""
    return remove_repeated_windows(docs, measures=False)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near-duplicates stays."""
    return without_near_duplicates(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminated(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents with their place in training sequences."""
    return pack_windows(docs, tokenizer_path()).drop("ids")


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("near dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

#: Tokenizers and BM25 retrieval have no SQL form; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
