"""Split multi-allelic records into one record per ALT."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from ..functions import has_field

# How many entries a field has when no header says so. A: one per ALT,
# R: one per allele with the reference first, G: one per genotype.
INFO_NUMBERS = {"INFO_AC": "A", "INFO_AF": "A", "INFO_AD": "R", "INFO_ADF": "R", "INFO_ADR": "R"}
GENOTYPE_NUMBERS = {
    "alleleDepths": "R", "AD": "R", "ADF": "R", "ADR": "R", "F1R2": "R", "F2R1": "R", "AF": "A",
    "phredLikelihoods": "G", "genotypeLikelihoods": "G", "PL": "G", "GL": "G", "GP": "G",
}
NUMBER_KEY = "vcf_number"


def info_number(field: T.StructField) -> str | None:
    return field.metadata.get(NUMBER_KEY) or INFO_NUMBERS.get(field.name)


def genotype_numbers(df: DataFrame) -> dict[str, str]:
    """Number of every genotype field: from the header where the reader kept it, else the defaults."""
    return GENOTYPE_NUMBERS | df.schema["genotypes"].metadata.get(NUMBER_KEY, {})


def subset(values: Column, number: str | None, i: Column, n: Column) -> Column:
    """The entries of one field that belong to ALT ``i`` (from 1) of ``n``.

    Genotype entries follow the diploid order; an array of any other length, as of another ploidy,
    has no entry for this allele and becomes NULL.
    """
    match number:
        case "A":
            return F.when(values.isNotNull(), F.array(F.get(values, i - 1)))
        case "R":
            return F.when(values.isNotNull(), F.array(F.get(values, F.lit(0)), F.get(values, i)))
        case "G":
            het = (i * (i + 1) / 2).cast("int")
            diploid = F.size(values) == ((n + 1) * (n + 2) / 2).cast("int")
            return F.when(diploid, F.array(F.get(values, F.lit(0)), F.get(values, het), F.get(values, het + i)))
        case _:
            return values


def split_calls(calls: Column, i: Column) -> Column:
    """Calls of this ALT become 1, reference calls stay 0, other alleles and missing calls are -1."""
    return F.transform(calls, lambda c: F.when(c == 0, 0).when(c == i, 1).when(c.isNotNull(), -1))


def split_genotype(g: Column, struct_type: T.StructType, numbers: dict[str, str], i: Column, n: Column) -> Column:
    fields = []
    for field in struct_type.fields:
        value = g.getField(field.name)
        if field.name == "calls" and isinstance(field.dataType, T.ArrayType):
            value = split_calls(value, i)
        elif isinstance(field.dataType, T.ArrayType):
            value = subset(value, numbers.get(field.name), i, n)
        fields.append(value.alias(field.name))
    return F.when(g.isNotNull(), F.struct(*fields))


def split_fault(df: DataFrame) -> Column:
    """Why a record of several ALTs cannot be split without loss: an INFO list that has not the length its Number says.

    NULL where all lists fit. A list that is absent, empty or one missing value fits. Genotype lists are not
    looked at, as their length depends on the ploidy.
    """
    n = F.size("alternateAlleles")
    found = []
    for field in df.schema.fields:
        number = info_number(field) if field.name.startswith("INFO_") and isinstance(field.dataType, T.ArrayType) else None
        if number in ("A", "R"):
            values = F.col(f"`{field.name}`")
            wanted = n if number == "A" else n + 1
            missing = (F.size(values) < 1) | ((F.size(values) == 1) & F.get(values, F.lit(0)).isNull())
            text = F.concat(F.lit(f"{field.name[5:]} has "), F.size(values).cast("string"), F.lit(" values for "), n.cast("string"), F.lit(" ALT"))
            found.append(F.when(values.isNotNull() & ~missing & (F.size(values) != wanted), text))
    return F.when(n > 1, F.coalesce(*found, F.lit(None).cast("string")))


def split_multiallelics(df: DataFrame) -> DataFrame:
    """One record per ALT; records with one ALT or none pass unchanged but for the flag.

    Per-allele INFO and genotype arrays keep the entries of their allele. The flag
    ``splitFromMultiAllelic`` is true for the records that were split.
    """
    alts = "alternateAlleles" if has_field(df.schema, "alternateAlleles") else "alt"
    taken = [F.col(f"`{name}`") for name in df.columns if name != alts]
    rows = df.select(*taken, F.col(alts).alias("_alts"), F.posexplode_outer(alts).alias("_index", "_alt"))
    i, n = F.col("_index") + 1, F.size("_alts")
    many = F.coalesce(n > 1, F.lit(False))

    def value(field: T.StructField) -> Column:
        column = F.col(f"`{field.name}`")
        if field.name == alts:
            return F.when(many, F.array(F.col("_alt"))).otherwise(F.col("_alts")).alias(alts)
        if field.name == "splitFromMultiAllelic":
            return many.alias(field.name)
        if field.name == "genotypes" and isinstance(field.dataType.elementType, T.StructType):
            numbers = genotype_numbers(df)
            each = F.transform(column, lambda g: split_genotype(g, field.dataType.elementType, numbers, i, n))
            return F.when(many, each).otherwise(column).alias(field.name, metadata=field.metadata)
        if field.name.startswith("INFO_") and isinstance(field.dataType, T.ArrayType):
            part = subset(column, info_number(field), i, n)
            return F.when(many, part).otherwise(column).alias(field.name, metadata=field.metadata)
        return column

    columns = [value(field) for field in df.schema.fields]
    if not has_field(df.schema, "splitFromMultiAllelic"):
        columns.append(many.alias("splitFromMultiAllelic"))
    return rows.select(*columns)
