"""Headers of VCF files: what the columns of a scan over many files are.

Only the first lines of each file are read. They become a small table with one row per header line;
the distinct field definitions, whose number does not grow with the data, are all the driver sees.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from .files import DIRECT_SCHEMES, source_path

HEADER_SCHEMA = "source_file string, line string"
# Header types and their Spark types, and the order in which differing ones widen.
SPARK_TYPES = {
    "Flag": T.BooleanType(), "Integer": T.IntegerType(), "Float": T.DoubleType(), "Character": T.StringType(),
    "String": T.StringType(),
}
WIDENING = ("Flag", "Integer", "Float", "Character", "String")


@dataclass(frozen=True)
class Field:
    """One INFO or FORMAT definition, merged over all files."""

    name: str
    type: str
    number: str

    @property
    def spark_type(self) -> T.DataType:
        base = SPARK_TYPES[self.type]
        return base if self.is_scalar else T.ArrayType(base)

    @property
    def is_text(self) -> bool:
        return self.type in ("Character", "String")

    @property
    def is_scalar(self) -> bool:
        return self.type == "Flag" or self.number in ("0", "1")


@dataclass(frozen=True)
class Layout:
    """Everything a scan needs to know before it starts."""

    info: tuple[Field, ...] = ()
    formats: tuple[Field, ...] = ()
    csq_formats: tuple[str, ...] = ()
    has_csq: bool = False
    has_samples: bool = False
    optional_flags: frozenset[str] = field(default_factory=frozenset)
    sample_bytes: int = 0
    file_bytes: int = 0

    @property
    def csq_fields(self) -> list[str]:
        """Names of the consequence fields, first seen first; empty if no header describes them."""
        return list(dict.fromkeys(name for text in self.csq_formats for name in text.split("|")))


def _head_reader():
    """The task that opens listed files and yields their header lines, up to the first other line.

    It is a nested function so that it travels to the workers with its body.
    """
    def read(batches: Iterator) -> Iterator:
        import gzip
        import io
        import zlib

        from urllib.parse import quote

        import pyarrow as pa
        from pyarrow import fs

        schema = pa.schema([("source_file", pa.string()), ("line", pa.string())])
        for batch in batches:
            for path in batch.column("path").to_pylist():
                uri = quote(path.replace("s3a://", "s3://", 1), safe="/:@!$&'()*+,;=~")
                system, inner = fs.FileSystem.from_uri(uri)
                lines = []
                with system.open_input_stream(inner, compression=None) as stream:
                    source = gzip.GzipFile(fileobj=stream) if path.lower().endswith(".gz") else stream
                    try:
                        for line in io.TextIOWrapper(io.BufferedReader(source), encoding="utf-8", errors="replace"):
                            if not line.startswith("#"):
                                break
                            lines.append(line.rstrip("\r\n"))
                    except (EOFError, gzip.BadGzipFile, zlib.error):
                        pass  # a damaged archive: whatever was readable is its header
                yield pa.RecordBatch.from_pydict({"source_file": [path] * len(lines), "line": lines}, schema)

    return read


def read_headers(spark: SparkSession, files: DataFrame, method: str = "auto") -> DataFrame:
    """Header lines (source_file, line) of the files listed in column ``path``.

    ``direct`` opens each file in a task and stops after its header, ``scan`` filters a text scan of
    the whole files; ``auto`` takes direct where all paths allow it.
    """
    if method not in ("auto", "direct", "scan"):
        raise ValueError(f"method must be auto, direct or scan, got {method!r}")
    if method != "scan":
        scheme = F.regexp_extract("path", r"^(\w+):", 1)
        listed = files.agg(F.count(F.lit(1)).alias("n"), F.bool_and(scheme.isin(*DIRECT_SCHEMES)).alias("direct")).first()
    if method == "direct" or (method == "auto" and listed.direct):
        tasks = min(max(listed.n, 1), spark.sparkContext.defaultParallelism * 4)
        return files.select("path").repartition(tasks, "path").mapInArrow(_head_reader(), HEADER_SCHEMA)
    paths = [row.path for row in files.select("path").toLocalIterator()]
    lines = spark.read.text(paths).select(source_path().alias("source_file"), F.col("value").alias("line"))
    return lines.where(F.col("line").startswith("#"))


def _attribute(name: str) -> Column:
    return F.regexp_extract("line", rf"[<,]{name}=([^,>]*)", 1)


def definitions(headers: DataFrame) -> DataFrame:
    """INFO and FORMAT lines as columns: source_file, kind, id, number, type, csq_format."""
    lines = headers.where(F.col("line").rlike("^##(INFO|FORMAT)=<"))
    return lines.select(
        "source_file",
        F.regexp_extract("line", "^##(INFO|FORMAT)=", 1).alias("kind"),
        _attribute("ID").alias("id"), _attribute("Number").alias("number"), _attribute("Type").alias("type"),
        _csq_format().alias("csq_format"),
    ).where(F.col("id") != "")


def _csq_format() -> Column:
    return F.nullif(F.trim(F.regexp_extract("line", r'Format:\s*([^">]*)', 1)), F.lit(""))


def per_file(headers: DataFrame) -> DataFrame:
    """One row per file with a title line: samples, column_count, csq_format, flags and what sections it has."""
    line = F.col("line")
    is_csq = line.rlike("^##INFO=<.*?ID=CSQ[,>]")
    is_flag = line.rlike("^##INFO=<.*?Type=Flag[,>]")
    columns = F.split("title", "\t")
    grouped = headers.groupBy("source_file").agg(
        F.max(F.when(line.startswith("#CHROM"), line)).alias("title"),
        F.bool_or(is_csq).alias("has_csq"),
        F.max(F.when(is_csq, _csq_format())).alias("csq_format"),
        F.collect_set(F.when(is_flag, _attribute("ID"))).alias("flags"))
    return grouped.where(F.col("title").isNotNull()).select(
        "source_file",
        F.size(columns).alias("column_count"),
        (F.size(columns) > 8).alias("has_genotypes"),
        F.when(F.size(columns) > 9, F.slice(columns, F.lit(10), F.size(columns))).otherwise(
            F.array().cast("array<string>")).alias("samples"),
        "has_csq", "csq_format", "flags")


def merge_layout(headers: DataFrame) -> Layout:
    """The union of all headers: differing types widen, differing numbers make an array."""
    defined = definitions(headers)
    rows = defined.groupBy("kind", "id").agg(
        F.collect_set("type").alias("types"), F.collect_set("number").alias("numbers"),
        F.count_distinct("source_file").alias("files"),
        F.array_sort(F.collect_set("csq_format")).alias("csq_formats")).orderBy("kind", "id").collect()
    totals = per_file_totals(headers)
    titles = headers.where(F.col("line").startswith("#CHROM")).select("line").distinct().agg(
        F.sum(2 * F.length("line") + 64).alias("bytes")).first()
    per_path = sum(len(r.csq_formats[-1]) if r.csq_formats else 8 + len(r.id) for r in rows)

    def merged(row) -> Field:
        kind = max((t for t in row.types if t in WIDENING), key=WIDENING.index, default="String")
        number = row.numbers[0] if len(row.numbers) == 1 else "."
        return Field(row.id, kind, number)

    csq = next((r for r in rows if r.kind == "INFO" and r.id == "CSQ"), None)
    return Layout(
        info=tuple(merged(r) for r in rows if r.kind == "INFO" and r.id != "CSQ"),
        formats=tuple(merged(r) for r in rows if r.kind == "FORMAT"),
        csq_formats=tuple(csq.csq_formats) if csq else (),
        has_csq=csq is not None,
        has_samples=bool(totals.with_samples),
        optional_flags=frozenset(r.id for r in rows if r.kind == "INFO" and r.files < totals.files),
        sample_bytes=int(titles.bytes or 0),
        file_bytes=int(totals.bytes or 0) + int(totals.files) * per_path,
    )


def per_file_totals(headers: DataFrame):
    """Files with a title line, those with samples, and about the bytes of what is told of each besides its samples."""
    title = headers.where(F.col("line").startswith("#CHROM"))
    return title.agg(
        F.count_distinct("source_file").alias("files"), F.sum(2 * F.length("source_file") + 256).alias("bytes"),
        F.count_if(F.size(F.split("line", "\t")) > 8).alias("with_samples")).first()
