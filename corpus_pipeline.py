"""From documents to packed training sequences, in five stages.

Each stage takes what its predecessor kept, as a table that was written and read again. All but the last
return the columns of documents; where a text changes, n_chars is counted anew.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from locusframe.llm import jaccard, packing, quality, secrets, suffixes
from locusframe.llm.queries import TOKENIZER_JSON, ship, table, tokenizer_path
from locusframe.scratch import materialize


def _recounted(docs: DataFrame) -> DataFrame:
    return docs.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else docs


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep."""
    ship(spark)
    return quality.keep_good(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document with the smallest id."""
    ship(spark)
    return jaccard.keep_first(docs)


def suffix_array_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 50 bytes that start in an earlier one."""
    ship(spark)
    return _recounted(suffixes.remove_repeats(docs))


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a mark in place of each secret."""
    return _recounted(secrets.clean(docs))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents and their places in sequences."""
    ship(spark)
    return packing.pack(docs, tokenizer_path(TOKENIZER_JSON))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules), ("ngram_jaccard_join", ngram_jaccard_join),
    ("suffix_array_dedup", suffix_array_dedup), ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing)]

#: No SQL: trained rules, tokenization and packing are beyond it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
