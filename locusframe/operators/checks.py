"""Counts, previews and log queries over the result tables."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation, functions as F

# Columns of the per-run log report.
RUN_COLUMNS = (
    "run_ts", "filename", "status", "stage", "pipe_enabled", "pipe_cmd", "pipe_header_mode", "has_csq",
    "has_genotypes", "variants_rows", "calls_rows", "csq_rows", "error",
)


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """table_name and n of every table, in one job."""
    counts = [df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table_name"), "n")
              for name, df in tables.items()]
    return reduce(DataFrame.unionByName, counts)


def rows_per_file(df: DataFrame) -> DataFrame:
    """Rows per filename, most first."""
    return df.groupBy("filename").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "filename")


def filter_run(log: DataFrame, run_id: str) -> DataFrame:
    """Log rows of one run, newest first."""
    return log.where(F.col("run_id") == run_id).select(*RUN_COLUMNS).orderBy(F.desc("run_ts"), "filename")


def recent_log(log: DataFrame, n: int = 50) -> DataFrame:
    """The newest log rows."""
    return log.orderBy(F.desc("run_ts"), "filename").limit(n)


def quarantine_count(quarantine: DataFrame) -> DataFrame:
    return quarantine.agg(F.count(F.lit(1)).alias("quarantined_rows"))


def preview(df: DataFrame, n: int = 20, *order: str | Column) -> DataFrame:
    """The first ``n`` rows; with ``order`` always the same ones."""
    return (df.orderBy(*order) if order else df).limit(n)


def capture_row_counts(df: DataFrame, name: str = "rows") -> tuple[DataFrame, Observation]:
    """The frame with a row counter attached: the write that uses it also counts, without a second pass."""
    counter = Observation(name)
    return df.observe(counter, F.count(F.lit(1)).alias("n")), counter


def presence_flags(df: DataFrame) -> DataFrame:
    """has_csq and has_genotypes of a frame: the column is there and is an array."""
    from .consequences import has_consequences
    from .genotypes import has_genotypes

    return df.groupBy().agg(F.count(F.lit(1)).alias("records")).select(
        F.lit(has_consequences(df)).alias("has_csq"), F.lit(has_genotypes(df)).alias("has_genotypes"), "records")


def quarantine(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split records read with ``mode="keep"`` into good ones and (raw, source_file, reason)."""
    bad = F.col("corrupt_reason").isNotNull()
    rejected = df.where(bad).select(
        F.col("corrupt_line").alias("raw"), "source_file", F.col("corrupt_reason").alias("reason"))
    return df.where(~bad).drop("corrupt_line", "corrupt_reason"), rejected
