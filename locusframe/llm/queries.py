"""Queries of the operators in this package, each over its whole table, with the parameters of production."""

from __future__ import annotations

import shutil
import tempfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from locusframe.llm.sql import SQL

__all__ = ["QUERIES", "SQL"]

TOKENIZER_JSON = "byte_bpe_50k.json"


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give the executors this package, once per application, wherever the driver was started from."""
    context = spark.sparkContext
    if context.applicationId not in _shipped:
        root = Path(__file__).resolve().parents[2]
        archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='locusframe-')}/locusframe", "zip", root, "locusframe")
        context.addPyFile(archive)
        _shipped.add(context.applicationId)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    from locusframe.llm import pii

    docs = table(spark, sf_dir, "documents")
    return pii.report(docs, pii.train(docs))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from locusframe.llm import packing

    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path(TOKENIZER_JSON))


def op3_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from locusframe.llm import suffixes

    return suffixes.report(table(spark, sf_dir, "documents"))


def op4_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    from locusframe.llm import jaccard

    return jaccard.near_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from locusframe.llm import warc

    return warc.round_trip(table(spark, sf_dir, "pages"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from locusframe.llm import quality

    docs = table(spark, sf_dir, "documents")
    return quality.assess(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op7_secret_scans(spark: SparkSession, sf_dir: str) -> DataFrame:
    from locusframe.llm import secrets

    return secrets.report(table(spark, sf_dir, "documents"))


def op8_permutation_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    from locusframe.llm import neighbours

    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    from locusframe.llm import bpe

    return bpe.digests(table(spark, sf_dir, "documents"), tokenizer_path(TOKENIZER_JSON))


def op10_debruijn_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from locusframe.llm import debruijn

    return debruijn.report(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from locusframe.llm import spelling

    docs = table(spark, sf_dir, "documents")
    return spelling.variants(spelling.spelled_runs(docs, fault_every=97)).select("word", "form", "root", "n", "n_near", "form_n")


def op12_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from locusframe.llm import simhash

    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    from locusframe.llm import negatives

    rows = table(spark, sf_dir, "embeddings")
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    whole = F.transform("embedding", lambda x: F.floor(256 * x.cast("double")).cast("long"))
    rows = rows.where(F.coalesce(finite, F.lit(False))).select("vec_id", label.alias("label"), whole.alias("vector"))
    return negatives.hard_negatives(rows, F.col("vec_id") % 100 == 0)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_pii, op2_best_fit_packing, op3_suffix_array_dedup, op4_ngram_jaccard, op5_warc, op6_quality_rules, op7_secret_scans,
        op8_permutation_index, op9_byte_bpe, op10_debruijn_dedup, op11_spelling_variants, op12_simhash, op13_hard_negatives)
}
