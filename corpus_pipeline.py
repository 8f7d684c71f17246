"""From raw documents to packed training sequences, one written table after another.

Every stage takes all rows its predecessor kept. Null or empty texts go with the first stage; extra columns pass
through to the last one. An empty table gives no pieces.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from strata.llm import decontaminate, language_id, line_dedup, ngram_join, packing
from strata.llm.common import ship, small_batches, table
from strata.session import written

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language: profiles are learned from all of ``docs`` that name one; ``und`` goes, and so do
    texts none of whose n-grams is in a profile (score 0)."""
    small_batches(spark)
    return language_id.keep_identified(docs, language_id.learn_profiles(docs), above=0.0)


def new_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier line resembles; documents with no line left go."""
    return line_dedup.remove_repeated_lines(docs)


def different(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of every group of linked documents the one with the smallest doc_id."""
    small_batches(spark)
    return ngram_join.keep_one_of_each(docs)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in which no benchmark window occurs."""
    small_batches(spark)
    return decontaminate.remove_contaminated(docs, table(spark, sf_dir, "benchmark"))


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of what is left, with their place in the training sequences."""
    small_batches(spark)
    return packing.pack(docs).drop("ids")


STAGES: list[tuple[str, Stage]] = [
    ("language ID", identified),
    ("line dedup", new_lines),
    ("n-gram Jaccard join", different),
    ("benchmark decontamination", decontaminated),
    ("packing", packed),
]

#: Language profiles and the tokenizer are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship(spark)
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
