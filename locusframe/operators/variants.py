"""One row per variant allele."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import one_based_pos, rendered, resolve_core_columns, typed_columns, variant_id, variant_key

PROVENANCE = ("filename", "source_file", "ingest_ts")
KEY_COLUMNS = ("variant_id", "variant_key", "chrom", "pos", "ref", "alt")


def provenance_columns(df: DataFrame) -> list[str]:
    """The provenance columns this frame carries, in output order."""
    return [name for name in PROVENANCE if name in df.columns]


def explode_alleles(df: DataFrame, carry: list[Column] | None = None) -> DataFrame:
    """One row per ALT with its keys; a record without ALT keeps one row with a NULL alt.

    ``carry`` lists what else the caller needs. Only that goes through the explode, so nested columns
    nobody reads are pruned from the scan. By default every column of the record is kept.
    """
    core = resolve_core_columns(df)
    if carry is None:
        carry = [F.col(f"`{name}`") for name in df.columns if name not in KEY_COLUMNS + PROVENANCE]
    rows = df.select(
        *provenance_columns(df),
        F.col(core["chrom"]).cast("string").alias("chrom"),
        one_based_pos(core["pos"]).alias("pos"),
        F.col(core["ref"]).cast("string").alias("ref"),
        F.explode_outer(F.col(core["alt"]).cast("array<string>")).alias("alt"),
        *carry,
    )
    key = variant_key(F.col("chrom"), F.col("pos"), F.col("ref"), F.col("alt"))
    first = provenance_columns(rows)
    return rows.select(
        *first, variant_id(key).alias("variant_id"), key.alias("variant_key"),
        *[F.col(f"`{name}`") for name in rows.columns if name not in first],
    )


def info_columns(df: DataFrame) -> list[str]:
    """Names of the INFO columns of the flat table: all but the consequences, sorted."""
    return sorted(c for c in df.columns if c.startswith("INFO_") and c != "INFO_CSQ")


def flatten_info(df: DataFrame) -> list[Column]:
    """INFO columns in sorted order: scalars keep their type, nested values become JSON."""
    return [
        rendered(F.col(f"`{name}`"), df.schema[name].dataType).alias(name)
        for name in info_columns(df)
    ]


def json_col(df: DataFrame, name: str) -> Column:
    """An array or map column as JSON text, typed NULL if the frame lacks it."""
    return (F.to_json(F.col(name)) if name in df.columns else F.lit(None).cast("string")).alias(name)


def variants_flat(df: DataFrame) -> DataFrame:
    """The flat variant table: keys, site columns and INFO values, one row per allele.

    INFO keys that no header declares are one JSON column, unless they were made columns before.
    """
    site = [
        json_col(df, "names"),
        *typed_columns(df, qual="double"),
        json_col(df, "filters"),
        *typed_columns(df, splitFromMultiAllelic="boolean"),
    ]
    undeclared = [json_col(df, "undeclared_info")] if "undeclared_info" in df.columns else []
    return explode_alleles(df, site + flatten_info(df) + undeclared)
