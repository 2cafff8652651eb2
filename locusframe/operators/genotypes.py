"""One row per sample and allele."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import field_type, first_field, genotype_string, has_field, rendered
from .variants import KEY_COLUMNS, explode_alleles, provenance_columns

# Names a genotype field may have, the one to prefer first.
DEPTH_FIELDS = ("depth", "DP")
QUALITY_FIELDS = ("conditionalQuality", "GQ")
ALLELE_DEPTH_FIELDS = ("alleleDepths", "AD")
LIKELIHOOD_FIELDS = ("phredLikelihoods", "genotypeLikelihoods", "PL")
# Caller-specific genotype fields of the calls table and their types.
CALLER_FIELDS = {
    "AF": "string", "SB": "string", "F1R2": "string", "F2R1": "string",
    "PID": "string", "PGT": "string", "PS": "int",
}
CALL_COLUMNS = ("sample_id", "GT", "DP", "GQ", "AD", "PL", "phased")


def has_genotypes(df: DataFrame) -> bool:
    return isinstance(field_type(df.schema, "genotypes"), T.ArrayType)


def explode_genotypes(df: DataFrame) -> DataFrame:
    """One row per allele and genotype; a record without genotypes keeps one row with NULL."""
    alleles = explode_alleles(df, [F.col("genotypes")])
    return alleles.select(*provenance_columns(df), *KEY_COLUMNS, F.explode_outer("genotypes").alias("g"))


def json_of(value: Column, struct_type: T.StructType, names: tuple[str, ...]) -> Column:
    """JSON of the first of ``names`` the genotype has."""
    name = next((n for n in names if has_field(struct_type, n)), None)
    if name is None:
        return F.lit(None).cast("string")
    return rendered(value.getField(name), field_type(struct_type, name), text=True)


def call_columns(g: Column, struct_type: T.StructType) -> list[Column]:
    """The standard columns of a call, typed NULL where the genotype lacks the field."""
    phased = first_field(g, struct_type, "phased").cast("boolean")
    if isinstance(field_type(struct_type, "calls"), T.ArrayType):
        gt = genotype_string(g.getField("calls"), phased)
    else:
        gt = F.lit(None).cast("string")
    return [
        first_field(g, struct_type, "sampleId").cast("string").alias("sample_id"),
        gt.alias("GT"),
        first_field(g, struct_type, *DEPTH_FIELDS).cast("int").alias("DP"),
        first_field(g, struct_type, *QUALITY_FIELDS).cast("int").alias("GQ"),
        json_of(g, struct_type, ALLELE_DEPTH_FIELDS).alias("AD"),
        json_of(g, struct_type, LIKELIHOOD_FIELDS).alias("PL"),
        phased.alias("phased"),
    ]


def caller_columns(g: Column, struct_type: T.StructType) -> list[Column]:
    """The caller-specific columns; nested values become JSON, absent ones a typed NULL."""
    return [
        (rendered(first_field(g, struct_type, name), field_type(struct_type, name), text=True) if data_type == "string"
         else first_field(g, struct_type, name)).try_cast(data_type).alias(name)
        for name, data_type in CALLER_FIELDS.items()
    ]


def variant_calls(df: DataFrame, caller_fields: bool = False, raw: str = "keep", keys: bool = False) -> DataFrame:
    """The flat calls table: provenance, variant_id, sample_id, GT, DP, GQ, AD, PL, phased.

    ``caller_fields`` adds AF, SB, F1R2, F2R1, PID, PGT and PS, ``keys`` the variant_key. Genotypes that are not structs are put
    into GT as text with ``raw="keep"`` and left out with ``raw="drop"``.
    """
    if raw not in ("keep", "drop"):
        raise ValueError(f"raw must be 'keep' or 'drop', got {raw!r}")
    rows = explode_genotypes(df)
    struct_type = field_type(df.schema, "genotypes").elementType
    g = F.col("g")
    if isinstance(struct_type, T.StructType):
        values = call_columns(g, struct_type)
    else:
        struct_type = T.StructType()
        empty = dict(zip(CALL_COLUMNS, call_columns(F.lit(None), struct_type)))
        values = list((empty | {"GT": g.cast("string").alias("GT")}).values())
        if raw == "drop":
            rows = rows.where(F.lit(False))
    if caller_fields:
        values += caller_columns(g, struct_type)
    return rows.select(*provenance_columns(df), "variant_id", *(["variant_key"] if keys else []), *values)
