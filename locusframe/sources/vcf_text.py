"""Nested records back to variant-call text."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import field_type, genotype_string, has_field, leaf_value, struct_leaves
from ..operators.split import genotype_numbers, info_number
from .header import read_headers
from .vcf import GENOTYPE_NAMES, SPLIT_FLAG

# The format line and the title of the eight site columns.
FILE_FORMAT = "##fileformat=VCFv4.2"
SITE_TITLE = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"


def _header_type(data_type: T.DataType) -> str:
    match data_type:
        case T.ArrayType():
            return _header_type(data_type.elementType)
        case T.BooleanType():
            return "Flag"
        case T.ByteType() | T.ShortType() | T.IntegerType() | T.LongType():
            return "Integer"
        case T.FloatType() | T.DoubleType() | T.DecimalType():
            return "Float"
        case _:
            return "String"


def _definition(kind: str, name: str, data_type: T.DataType, number: str | None, text: str = "") -> str:
    kind_of = _header_type(data_type)
    if not isinstance(data_type, T.ArrayType):
        number = "0" if kind_of == "Flag" and kind == "INFO" else "1"
    elif number in (None, "0", "1"):
        number = "."
    return f'##{kind}=<ID={name},Number={number},Type={kind_of},Description="{text}">'


def _genotype_fields(df: DataFrame) -> list[T.StructField]:
    """The genotype fields written next to GT."""
    struct_type = field_type(df.schema, "genotypes")
    if struct_type is None:
        return []
    return [f for f in struct_type.elementType.fields if f.name not in ("sampleId", "calls", "phased")]


def _text_name(name: str) -> str:
    return next((short for short, long in GENOTYPE_NAMES.items() if long == name), name)


def _csq_definition(entry: T.DataType) -> str:
    names = [name for name, _, _ in struct_leaves(entry)] if isinstance(entry, T.StructType) else []
    text = "Consequence annotations" + (f". Format: {'|'.join(names)}" if names else "")
    return _definition("INFO", "CSQ", T.ArrayType(T.StringType()), ".", text)


def infer_header(df: DataFrame) -> list[str]:
    """Header lines that describe the columns of these records.

    Where the frame knows by record whether its file has consequences, their line is not part of the
    common header but goes with the title line of those files.
    """
    lines = [FILE_FORMAT]
    for field in df.schema.fields:
        if field.name == "INFO_CSQ":
            if "has_csq" not in df.columns:
                lines.append(_csq_definition(field.dataType.elementType))
        elif field.name.startswith("INFO_"):
            lines.append(_definition("INFO", field.name[5:], field.dataType, info_number(field)))
    if has_field(df.schema, "splitFromMultiAllelic"):
        lines.append(_definition("INFO", SPLIT_FLAG, T.BooleanType(), "0", "one allele of a multi-allelic record"))
    if has_field(df.schema, "genotypes"):
        numbers = genotype_numbers(df)
        lines.append(_definition("FORMAT", "GT", T.StringType(), "1", "Genotype"))
        lines += [_definition("FORMAT", _text_name(f.name), f.dataType, numbers.get(f.name)) for f in _genotype_fields(df)]
    return lines


def file_header(spark: SparkSession, path: str) -> list[str]:
    """Header lines of an existing file, without its title line."""
    files = spark.createDataFrame([(path,)], "path string")
    lines = read_headers(spark, files).where(~F.col("line").startswith("#CHROM"))
    return [row.line for row in lines.toLocalIterator()]


def _scalar(value: Column) -> Column:
    return F.coalesce(value.cast("string"), F.lit("."))


def _value_text(value: Column, data_type: T.DataType) -> Column:
    """One value as text, NULL if there is nothing to write."""
    if isinstance(data_type, T.ArrayType):
        return F.when(F.size(value) > 0, F.array_join(F.transform(value, _scalar), ","))
    return value.cast("string")


def _entry_text(entry: Column, entry_type: T.DataType) -> Column:
    """One consequence: its leaves joined with ``|``, the values of a list with ``&``."""
    if not isinstance(entry_type, T.StructType):
        return entry.cast("string")
    texts = []
    for _, path, leaf in struct_leaves(entry_type):
        value = leaf_value(entry, path)
        text = F.array_join(value.cast("array<string>"), "&") if isinstance(leaf, T.ArrayType) else value.cast("string")
        texts.append(F.coalesce(text, F.lit("")))
    return F.concat_ws("|", *texts)


def _info_text(df: DataFrame) -> Column:
    parts = []
    if has_field(df.schema, "end"):
        natural = F.col("start") + F.length("referenceAllele")
        parts.append(F.when(F.col("end") != natural, F.concat(F.lit("END="), F.col("end").cast("string"))))
    for field in df.schema.fields:
        value = F.col(f"`{field.name}`")
        if field.name == "INFO_CSQ":
            entry_type = field.dataType.elementType
            entries = F.transform(value, lambda entry: _entry_text(entry, entry_type))
            parts.append(F.when(F.size(value) > 0, F.concat(F.lit("CSQ="), F.array_join(entries, ","))))
        elif field.name.startswith("INFO_") and field.name != "INFO_END":
            key = field.name[5:]
            if isinstance(field.dataType, T.BooleanType):
                parts.append(F.when(value, F.lit(key)))
            else:
                parts.append(F.concat(F.lit(f"{key}="), _value_text(value, field.dataType)))
    if has_field(df.schema, "splitFromMultiAllelic"):
        parts.append(F.when(F.col("splitFromMultiAllelic"), F.lit(SPLIT_FLAG)))
    if has_field(df.schema, "undeclared_info"):
        entries = F.transform(F.map_entries("undeclared_info"), lambda e: F.concat_ws("=", e["key"], e["value"]))
        parts.append(F.when(F.size(entries) > 0, F.array_join(entries, ";")))
    return F.coalesce(F.nullif(F.concat_ws(";", *parts), F.lit("")), F.lit("."))


def _sample_text(g: Column, df: DataFrame) -> Column:
    struct_type = df.schema["genotypes"].dataType.elementType
    gt = F.lit(None).cast("string")
    if has_field(struct_type, "calls"):
        phased = g.getField("phased") if has_field(struct_type, "phased") else F.lit(False)
        gt = genotype_string(g.getField("calls"), phased)
    values = [gt] + [_value_text(g.getField(f.name), f.dataType) for f in _genotype_fields(df)]
    return F.concat_ws(":", *[F.coalesce(v, F.lit(".")) for v in values])


def _joined(value: Column, separator: str) -> Column:
    return F.coalesce(F.when(F.size(value) > 0, F.array_join(value, separator)), F.lit("."))


def record_lines(df: DataFrame, inferred: bool = True) -> DataFrame:
    """source_file, title and line of every record.

    The title line carries the sample names, so it belongs to the record's file and not to the frame.
    """
    missing = F.lit(None).cast("array<string>")
    cells = [
        F.col("contigName"), (F.col("start") + 1).cast("string"),
        _joined(F.col("names") if "names" in df.columns else missing, ";"),
        F.col("referenceAllele"), _joined(F.col("alternateAlleles"), ","),
        _scalar(F.col("qual") if "qual" in df.columns else F.lit(None)),
        _joined(F.col("filters") if "filters" in df.columns else missing, ";"),
        _info_text(df),
    ]
    title = F.lit(SITE_TITLE)
    if has_field(df.schema, "genotypes"):
        keys = ":".join(["GT"] + [_text_name(f.name) for f in _genotype_fields(df)])
        samples = F.transform("genotypes", lambda g: g.getField("sampleId"))
        texts = F.transform("genotypes", lambda g: _sample_text(g, df))
        known = F.col("genotypes").isNotNull()
        cells.append(F.when(known, F.concat_ws("\t", F.lit(keys), texts)))
        title = F.when(known, F.concat_ws("\t", title, F.lit("FORMAT"), samples)).otherwise(title)
    if inferred and {"has_csq", "INFO_CSQ"} <= set(df.columns):
        csq = _csq_definition(df.schema["INFO_CSQ"].dataType.elementType)
        title = F.when(F.col("has_csq"), F.concat(F.lit(csq + "\n"), title)).otherwise(title)
    source = F.col("source_file") if "source_file" in df.columns else F.lit("")
    return df.select(source.alias("source_file"), title.alias("title"), F.concat_ws("\t", *cells).alias("line"))


def _header_writer(header: Sequence[str]):
    """The task that puts the header before the first record of each file it sees."""
    def write(batches: Iterator) -> Iterator:
        import pyarrow as pa

        schema = pa.schema([("source_file", pa.string()), ("line", pa.string())])
        current = None
        for batch in batches:
            files, titles, lines = (batch.column(i).to_pylist() for i in range(3))
            out_files, out_lines = [], []
            for source, title, line in zip(files, titles, lines):
                if (source, title) != current:
                    current = (source, title)
                    top = [*header, *title.split("\n")]
                    out_files += [source] * len(top)
                    out_lines += top
                out_files.append(source)
                out_lines.append(line)
            yield pa.RecordBatch.from_pydict({"source_file": out_files, "line": out_lines}, schema)

    return write


def to_vcf_lines(df: DataFrame, header: Sequence[str] | None = None) -> DataFrame:
    """Records as text lines (source_file, line), header included.

    Each partition starts with the header and repeats it where another source file begins, so a part
    file written with ``write.text`` from records of one source is a complete VCF file.
    """
    lines = record_lines(df, inferred=header is None)
    header = list(header) if header is not None else infer_header(df)
    return lines.mapInArrow(_header_writer(header), "source_file string, line string")
