"""One row per predicted consequence of an allele."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

from ..functions import field_type, flatten_struct
from .variants import KEY_COLUMNS, explode_alleles, provenance_columns


def has_consequences(df: DataFrame) -> bool:
    return isinstance(field_type(df.schema, "INFO_CSQ"), T.ArrayType)


def explode_consequences(df: DataFrame) -> DataFrame:
    """One row per allele and INFO_CSQ entry, counted from 0; no entry gives one row, index NULL."""
    alleles = explode_alleles(df, [F.col("INFO_CSQ")])
    return alleles.select(
        *provenance_columns(df), *KEY_COLUMNS, F.posexplode_outer("INFO_CSQ").alias("csq_index", "csq"),
    )


def consequences_flat(df: DataFrame, match_allele: bool = False) -> DataFrame:
    """The flat consequence table.

    Entries with named fields become ``CSQ_<field>`` text columns, plain entries ``CSQ_raw``. Every
    entry is paired with every ALT; ``match_allele`` keeps only those whose Allele field is the ALT.
    """
    entry_type = field_type(df.schema, "INFO_CSQ").elementType
    rows = explode_consequences(df)
    if isinstance(entry_type, T.StructType):
        if match_allele:
            rows = rows.where(F.col("csq.Allele") == F.col("alt"))
        values = flatten_struct("CSQ_", F.col("csq"), entry_type)
    else:
        values = [F.col("csq").cast("string").alias("CSQ_raw")]
    return rows.select(*provenance_columns(df), *KEY_COLUMNS, "csq_index", *values)
