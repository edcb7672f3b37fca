"""Documents to packed training sequences, stage by stage.

Every stage reads what the one before has kept. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from duelist.llm import best_fit, decontaminate, jaccard_join, line_dedup, quality_em
from duelist.llm.common import documents, fresh, staged, tokenizer_path


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base test and that the vote model calls good."""
    return quality_em.keep_good(docs)


def line_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated passages are cut out; documents of which nothing is left go."""
    removed = fresh(docs, "removed")
    cut = line_dedup.drop_repeats(docs, removed=removed)
    left = cut.filter((F.size(removed) == 0) | F.col("text").rlike(r"\S")).drop(removed)
    return left.withColumn("n_chars", F.length("text").cast("long"))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of every class of near copies stays."""
    return jaccard_join.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with benchmark text go."""
    return decontaminate.drop_leaks(docs, documents(spark, sf_dir, "benchmark"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where every piece of every document goes."""
    return best_fit.pack(docs, tokenizer_path(), with_ids=False)


STAGES = [
    ("quality rules", quality_rules),
    ("line dedup", line_deduplication),
    ("n-gram Jaccard join", ngram_jaccard_join),
    ("benchmark decontamination", benchmark_decontamination),
    ("best-fit packing", best_fit_packing),
]

#: SQL has no tokenizer and no expectation maximisation; tests/llm holds the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
