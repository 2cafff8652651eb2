"""One file, or one frame of nested records, to the three flat tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from ..operators.consequences import consequences_flat, has_consequences
from ..operators.genotypes import has_genotypes, variant_calls
from ..operators.variants import variants_flat
from ..scratch import materialize, scratch_run
from ..sources.files import VCF_SUFFIXES
from ..sources.tables import SINGLE_CALLS_SCHEMA, SINGLE_CONSEQUENCES_SCHEMA, write_table
from ..sources.vcf import promote_undeclared, read_vcf

# Names of the three result tables.
VARIANTS, CONSEQUENCES, CALLS = "variants_flat", "variant_consequences_flat", "variant_calls"


def flatten_records(records: DataFrame) -> dict[str, DataFrame]:
    """The three tables of a frame of records; empty typed tables where a section is absent."""
    spark = records.sparkSession
    return {
        VARIANTS: variants_flat(records),
        CONSEQUENCES: consequences_flat(records) if has_consequences(records)
        else spark.createDataFrame([], SINGLE_CONSEQUENCES_SCHEMA),
        CALLS: variant_calls(records) if has_genotypes(records)
        else spark.createDataFrame([], SINGLE_CALLS_SCHEMA),
    }


def flatten_single(spark: SparkSession, path: str, database: str | None = None,
                   suffixes: Sequence[str] = VCF_SUFFIXES) -> dict[str, DataFrame]:
    """Read one VCF file and flatten it as it is: no split, no normalization, no log.

    With ``database`` the text is parsed once, the tables are written and the written tables returned; INFO keys
    that no header declares are columns then, without it one JSON column.
    """
    def read() -> DataFrame:
        return read_vcf(spark, path, mode="fail", suffixes=suffixes).drop("source_file", "has_csq")

    if database is None:
        return flatten_records(read())
    with scratch_run(spark, "flatten"):
        records = promote_undeclared(materialize(read(), "records"))
        for name, df in flatten_records(records).items():
            write_table(df, f"{database}.{name}")
    return {name: spark.table(f"{database}.{name}") for name in (VARIANTS, CONSEQUENCES, CALLS)}
