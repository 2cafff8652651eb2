"""Ingest a directory of VCF files into the flat tables, with a log row per file.

All files go through one plan, not a loop:

1. list the files and read their headers (first lines only);
2. scan the text once and write the parsed records, malformed lines marked;
3. judge every file from per-file counts of that table, and drop the bad ones;
4. split and normalize, judge the files by the records at fault there if asked to, and optionally pipe;
5. project the three tables from the written records. Each projection reads only its own columns and
   needs no shuffle; the files of this run replace their own partitions;
6. count the written partitions and append the log.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from ..functions import basename, provenance
from ..operators.checks import quarantine
from ..operators.consequences import consequences_flat, has_consequences
from ..operators.genotypes import has_genotypes, variant_calls
from ..operators.normalize import normalize_fault, normalize_variants
from ..operators.pipe import COMMAND_FAILED, pipe_partitions
from ..operators.split import split_fault, split_multiallelics
from ..operators.variants import variants_flat
from ..scratch import RECORDS_PER_FILE, materialize, scratch_run
from ..sources.fasta import reference_chunks
from ..sources.files import VCF_SUFFIXES, discover_files
from ..sources.header import per_file, read_headers
from ..sources.tables import (
    CALLS_SCHEMA, CONSEQUENCES_SCHEMA, FILE_LOG_SCHEMA, PARTITION, QUARANTINE_SCHEMA, append_table, drop_files,
    ensure_table, partition_column, replace_files, reset_outputs, write_table,
)
from ..sources.vcf import promote_undeclared, read_vcf
from ..sources.vcf_text import file_header, record_lines
from .flatten import CALLS, CONSEQUENCES, VARIANTS

# Names of the two bookkeeping tables and the longest error text kept.
FILE_LOG, QUARANTINE = "vcf_ingest_file_log", "vcf_pipe_quarantine"
ERROR_CHARS = 32000
#: Stages that can fail a file after it was read, and what could not be done there.
DONE = {"split": "split", "normalize": "normalized"}


@dataclass(frozen=True)
class IngestConfig:
    """What to ingest and how; nothing here is global."""

    source: str | Sequence[str]
    database: str
    only: frozenset[str] | None = None
    limit: int | None = None
    suffixes: Sequence[str] = VCF_SUFFIXES
    header_method: str = "auto"
    reference_fasta: str | None = None
    chunk_size: int = 8192
    pipe_cmd: Sequence[str] | None = None
    pipe_header: str = "infer"
    pipe_header_vcf: str | None = None
    reset_first: bool = False
    skip_bad_files: bool = True
    max_malformed_share: float | None = None
    max_split_share: float | None = None
    max_normalize_share: float | None = None
    capture_row_counts: bool = True
    match_allele: bool = False
    broadcast_bytes: int = 64 << 20
    gz_spread_bytes: int = 128 << 20
    keep_scratch: bool = False

    def __post_init__(self) -> None:
        if self.pipe_header not in ("infer", "file"):
            raise ValueError(f"pipe_header must be 'infer' or 'file', got {self.pipe_header!r}")
        if self.pipe_cmd and self.pipe_header == "file" and not self.pipe_header_vcf:
            raise ValueError("pipe_header='file' needs pipe_header_vcf")
        if self.max_normalize_share is not None and not self.reference_fasta:
            raise ValueError("max_normalize_share needs reference_fasta")

    def table(self, name: str) -> str:
        return f"{self.database}.{name}"


def judge_files(files: DataFrame, headers: DataFrame, records: DataFrame, max_malformed_share: float | None,
                unreadable: DataFrame) -> DataFrame:
    """One row per listed file: path, filename, has_csq, has_genotypes, lines, malformed, error, failed_stage.

    A file is bad if it cannot be read, if it has no title line, or if more than ``max_malformed_share`` of
    its lines are malformed (None: any number may be; they are in quarantine). Files without any line are
    listed too.
    """
    counted = records.groupBy("source_file").agg(
        F.count(F.lit(1)).alias("lines"), F.count("corrupt_reason").alias("malformed"),
        F.min("corrupt_reason").alias("first_reason"))
    sections = per_file(headers).select("source_file", "has_csq", "has_genotypes", F.lit(True).alias("has_header"))
    rows = (
        files.select(F.col("path").alias("source_file"), "filename")
        .join(sections, "source_file", "left").join(counted, "source_file", "left").join(unreadable, "source_file", "left"))
    lines, malformed = F.coalesce("lines", F.lit(0)), F.coalesce("malformed", F.lit(0))
    too_many = F.lit(False) if max_malformed_share is None else malformed > lines * max_malformed_share
    error = (
        F.when(F.col("read_error").isNotNull(), F.col("read_error"))
        .when(F.col("has_header").isNull(), "file has no header")
        .when(too_many,
              F.concat(malformed.cast("string"), F.lit(" of "), lines.cast("string"),
                       F.lit(" lines malformed: "), F.col("first_reason"))))
    return rows.select(
        "source_file", "filename", F.coalesce("has_csq", F.lit(False)).alias("has_csq"),
        F.coalesce("has_genotypes", F.lit(False)).alias("has_genotypes"),
        lines.alias("lines"), malformed.alias("malformed"), error.alias("error"),
        F.when(error.isNotNull(), "read").alias("failed_stage"))


def judge_stages(verdicts: DataFrame, records: DataFrame, limits: dict[str, float]) -> DataFrame:
    """The verdicts after later stages: a file is bad if more than the given share of its records is at fault in one.

    ``limits`` names the stages in their order; ``records`` has a column ``<stage>_fault`` for each, the reason
    or NULL. One aggregation folds them, the first stage beyond its limit gives the error.
    """
    counted = records.groupBy("source_file").agg(F.count(F.lit(1)).alias("records"), *[
        f(f"{stage}_fault").alias(f"{stage}_{name}") for stage in limits for name, f in (("n", F.count), ("first", F.min))])
    rows = verdicts.join(counted, "source_file", "left")
    error, failed = F.col("error"), F.col("failed_stage")
    for stage, share in limits.items():
        beyond = F.col(f"{stage}_n") > F.col("records") * share
        text = F.concat(F.col(f"{stage}_n").cast("string"), F.lit(" of "), F.col("records").cast("string"),
                        F.lit(f" records cannot be {DONE[stage]}: "), F.col(f"{stage}_first"))
        failed = F.coalesce(failed, F.when(error.isNull() & beyond, stage))
        error = F.coalesce(error, F.when(beyond, text))
    return rows.withColumns({"error": error, "failed_stage": failed}).select(*verdicts.columns)


def unreadable_files(files: DataFrame) -> DataFrame:
    """(source_file, read_error) of the gzip files that do not unpack, found by tasks that unpack them to the end."""
    def test(batches: Iterator) -> Iterator:
        import gzip
        import zlib

        from urllib.parse import quote

        import pyarrow as pa
        from pyarrow import fs

        schema = pa.schema([("source_file", pa.string()), ("read_error", pa.string())])
        for batch in batches:
            for path in batch.column(0).to_pylist():
                uri = quote(path.replace("s3a://", "s3://", 1), safe="/:@!$&'()*+,;=~")
                system, inner = fs.FileSystem.from_uri(uri)
                with system.open_input_stream(inner, compression=None) as stream, gzip.GzipFile(fileobj=stream) as unpacked:
                    try:
                        while unpacked.read(1 << 20):
                            pass
                    except (EOFError, gzip.BadGzipFile, zlib.error) as error:
                        found = {"source_file": [path], "read_error": [f"file cannot be read: {error}"]}
                        yield pa.RecordBatch.from_pydict(found, schema)

    packed = files.where(F.lower("path").endswith(".gz")).select("path")
    tasks = files.sparkSession.sparkContext.defaultParallelism * 4
    return packed.repartition(tasks, "path").mapInArrow(test, "source_file string, read_error string")


def _is_damage(error: Exception) -> bool:
    """Whether a job ended because of what a file holds, not because of where it is."""
    text = str(error)
    return any(x in text for x in ("EOFException", "Unexpected end of", "ZipException", "not a gzip file", "incorrect header check",
                                   "invalid stored block", "invalid block type", "invalid distance", "incorrect data check", "FAILED_READ_FILE",
                                   "BadGzipFile", "EOFError", "while decompressing data", "damaged block"))


def without_files(records: DataFrame, bad: DataFrame, bad_count: int, broadcast_rows: int = 100_000) -> DataFrame:
    """Drop the records of bad files; their list is broadcast while it is short."""
    if bad_count == 0:
        return records
    names = bad.select("source_file")
    return records.join(F.broadcast(names) if bad_count <= broadcast_rows else names, "source_file", "left_anti")


def _rows_of(spark: SparkSession, name: str, files: DataFrame, most: int = 1000) -> DataFrame:
    """The rows of some source files; a short list prunes partitions when the query is planned."""
    some = [row[0] for row in files.select(PARTITION).limit(most + 1).collect()]
    table = spark.table(name)
    if len(some) <= most:
        return table.where(F.col(PARTITION).isin(some))
    return table.join(files.select(PARTITION), PARTITION, "left_semi")


def _stale_files(spark: SparkSession, name: str, files: DataFrame, run_ts: datetime) -> list[str]:
    """Files of this run whose rows in a table come from an earlier run: the new version has none."""
    old = _rows_of(spark, name, files).where(F.col("ingest_ts") < F.lit(run_ts))
    return [row[0] for row in old.select(PARTITION).distinct().toLocalIterator()]


def _file_counts(spark: SparkSession, cfg: IngestConfig, files: DataFrame) -> DataFrame:
    """Rows of each file in each table, from partition names and the row counts in file footers."""
    counts = files.select(PARTITION)
    for table, column in ((VARIANTS, "variants_rows"), (CALLS, "calls_rows"), (CONSEQUENCES, "csq_rows")):
        rows = _rows_of(spark, cfg.table(table), files).groupBy(PARTITION).agg(F.count(F.lit(1)).alias(column))
        counts = counts.join(rows, PARTITION, "left")
    return counts


def ingest(spark: SparkSession, cfg: IngestConfig) -> DataFrame:
    """Run the whole pipeline; returns the log rows of this run."""
    run_id, run_ts = str(uuid.uuid4()), datetime.now(timezone.utc)
    outputs = (VARIANTS, CONSEQUENCES, CALLS, FILE_LOG, QUARANTINE)
    if cfg.reset_first:
        reset_outputs(spark, [cfg.table(name) for name in outputs])
    ensure_table(spark, cfg.table(FILE_LOG), FILE_LOG_SCHEMA)
    ensure_table(spark, cfg.table(QUARANTINE), QUARANTINE_SCHEMA, partition_by=PARTITION)

    with scratch_run(spark, f"ingest-{run_id}", keep=cfg.keep_scratch):
        files = materialize(discover_files(spark, cfg.source, cfg.suffixes, cfg.only, cfg.limit), "files")
        headers = materialize(read_headers(spark, files, cfg.header_method), "headers")
        options = {"mode": "keep", "only": cfg.only, "limit": cfg.limit, "suffixes": cfg.suffixes, "headers": headers, "files": files,
                   "header_method": cfg.header_method, "broadcast_bytes": cfg.broadcast_bytes, "gz_spread_bytes": cfg.gz_spread_bytes,
                   "ordered": True}
        unreadable = spark.createDataFrame([], "source_file string, read_error string")
        try:
            parsed = materialize(read_vcf(spark, cfg.source, **options), "records", RECORDS_PER_FILE)
        except Exception as error:  # whole archives are unpacked a second time only if one is damaged
            if not _is_damage(error):
                raise
            unreadable = materialize(unreadable_files(files), "unreadable")
            names = [r.source_file for r in unreadable.select("source_file").toLocalIterator()]
            if not names:
                raise
            parsed = materialize(read_vcf(spark, cfg.source, **options, without=names), "records", RECORDS_PER_FILE)

        def settled(found: DataFrame, name: str) -> tuple[DataFrame, int]:
            """Verdicts in a table and how many are bad; they end a strict run."""
            stats = Observation()
            found = materialize(found.observe(stats, F.count("error").alias("bad")), name)
            bad = stats.get["bad"]
            if bad and not cfg.skip_bad_files:
                first = found.where(F.col("error").isNotNull()).orderBy("source_file").first()
                _log(found.where(F.col("error").isNotNull()), run_id, run_ts, cfg, None, None)
                raise ValueError(f"{first.source_file}: {first.error}")
            return found, bad

        verdicts, bad_count = settled(judge_files(files, headers, parsed, cfg.max_malformed_share, unreadable), "verdicts")
        good, rejected = quarantine(parsed)
        good = promote_undeclared(good)
        records = without_files(good, verdicts.where(F.col("error").isNotNull()), bad_count)
        limits = {stage: share for stage, share in (("split", cfg.max_split_share), ("normalize", cfg.max_normalize_share))
                  if share is not None}
        if "split" in limits:
            records = records.withColumn("split_fault", split_fault(records))
        records = split_multiallelics(records)
        if cfg.reference_fasta:
            chunks = materialize(reference_chunks(spark, cfg.reference_fasta, cfg.chunk_size), "reference")
            records = normalize_variants(records, chunks, cfg.chunk_size, cfg.broadcast_bytes)
        if limits:
            if "normalize" in limits:
                records = records.withColumn("normalize_fault", normalize_fault(records))
            records = materialize(records, "normalized", RECORDS_PER_FILE)
            before = bad_count
            verdicts, bad_count = settled(judge_stages(verdicts, records, limits), "stage-verdicts")
            records = records.drop(*[f"{stage}_fault" for stage in limits])
            if bad_count > before:
                late = verdicts.where(F.col("failed_stage").isin(*limits)).select("source_file", F.col("error").alias("reason"))
                lost = record_lines(records).withColumnRenamed("line", "raw")
                lost = lost.join(F.broadcast(late) if bad_count <= 100_000 else late, "source_file")
                rejected = rejected.unionByName(lost.select("source_file", "raw", "reason"))
                records = without_files(records, late, bad_count)
        piped_out = None
        if cfg.pipe_cmd:
            header = file_header(spark, cfg.pipe_header_vcf) if cfg.pipe_header == "file" else None
            records, piped_out = pipe_partitions(
                records.drop("normalizationStatus"), cfg.pipe_cmd, header,
                on_error="quarantine" if cfg.skip_bad_files else "fail")
            records = promote_undeclared(records)
            rejected = rejected.unionByName(piped_out)
            flags = records.groupBy("source_file").agg(F.bool_or("has_csq").alias("piped_csq"))
            verdicts = verdicts.join(flags, "source_file", "left").withColumn(
                "has_csq", F.coalesce("piped_csq", "has_csq")).drop("piped_csq")
        _replace_quarantine(spark, cfg, materialize(rejected, "rejected", RECORDS_PER_FILE), verdicts, run_id)

        replaced = verdicts.where(F.col("error").isNull())
        _write_outputs(spark, cfg, records, replaced, run_ts)
        counts = _file_counts(spark, cfg, replaced) if cfg.capture_row_counts else None
        _log(verdicts, run_id, run_ts, cfg, counts, piped_out)
    return spark.table(cfg.table(FILE_LOG)).where(F.col("run_id") == run_id)


def _replace_quarantine(spark: SparkSession, cfg: IngestConfig, rejected: DataFrame, files: DataFrame, run_id: str) -> None:
    """The rejected lines of this run take the place of those that earlier runs had for the same files."""
    name = cfg.table(QUARANTINE)
    if partition_column(spark, name) != PARTITION:
        write_table(spark.table(name), name, partition_by=PARTITION)  # a table of an older version
    replace_files(rejected.select("raw", "reason", F.lit(run_id).alias("run_id"), "source_file"), name)
    old = _rows_of(spark, name, files).where(F.col("run_id").isNull() | (F.col("run_id") != run_id))
    drop_files(spark, name, [row[0] for row in old.select(PARTITION).distinct().toLocalIterator()])


def _write_outputs(spark: SparkSession, cfg: IngestConfig, records: DataFrame, files: DataFrame, run_ts: datetime) -> None:
    stamped = provenance(records, F.col("source_file"), run_ts)

    def placed(rows: DataFrame, *order: str) -> DataFrame:
        """In the order of positions inside each file, so that a filter on them skips row groups.

        The write sorts by file anyway; this sort takes its place.
        """
        return rows.sortWithinPartitions(PARTITION, *order)

    replace_files(placed(variants_flat(stamped.drop("has_csq")), "chrom", "pos"), cfg.table(VARIANTS))
    if has_consequences(stamped):
        rows = stamped.where("has_csq").drop("has_csq")
        replace_files(placed(consequences_flat(rows, cfg.match_allele), "chrom", "pos"), cfg.table(CONSEQUENCES))
    if has_genotypes(stamped):
        rows = stamped.where(F.col("genotypes").isNotNull()).drop("has_csq")
        replace_files(variant_calls(rows, caller_fields=True), cfg.table(CALLS))
    ensure_table(spark, cfg.table(CONSEQUENCES), CONSEQUENCES_SCHEMA, partition_by=PARTITION)
    ensure_table(spark, cfg.table(CALLS), CALLS_SCHEMA, partition_by=PARTITION)
    for name in (VARIANTS, CONSEQUENCES, CALLS):
        drop_files(spark, cfg.table(name), _stale_files(spark, cfg.table(name), files, run_ts))


def _log(verdicts: DataFrame, run_id: str, run_ts: datetime, cfg: IngestConfig,
         counts: DataFrame | None, piped_out: DataFrame | None) -> None:
    """Append one row per file: what happened to it and how many rows it gave.

    A file is skipped at its reading, split or normalization if it has an error there, skipped in the pipe if the
    command failed on it, and else processed, with the reason of a rejected answer as error if there is one.
    """
    rows, failures = verdicts, None
    if piped_out is not None:
        failures = piped_out.groupBy("source_file").agg(
            F.min("reason").alias("pipe_error"), F.max(F.col("reason").startswith(COMMAND_FAILED)).alias("pipe_failed"))
    for extra in (counts, failures):
        if extra is not None:
            rows = rows.join(extra, "source_file", "left")

    def given(name: str, ddl: str):
        return F.col(name) if name in rows.columns else F.lit(None).cast(ddl)

    read_error, pipe_error = F.col("error"), given("pipe_error", "string")
    good = read_error.isNull()
    lost = good & F.coalesce(given("pipe_failed", "boolean"), F.lit(False))
    done = good & ~lost

    def counted(name: str):
        if counts is None:
            return F.lit(None).cast("bigint").alias(name)
        return F.when(good, F.coalesce(F.col(name), F.lit(0))).alias(name)

    columns = [
        F.lit(run_id).alias("run_id"), F.lit(run_ts).cast("timestamp").alias("run_ts"),
        F.col("source_file").alias("vcf_path"), basename(F.col("source_file")).alias("filename"),
        F.when(done, "processed").otherwise("skipped").alias("status"),
        F.when(~good, F.col("failed_stage")).when(lost, "pipe").otherwise("write").alias("stage"),
        F.lit(bool(cfg.pipe_cmd)).alias("pipe_enabled"),
        F.lit(" ".join(cfg.pipe_cmd) if cfg.pipe_cmd else None).cast("string").alias("pipe_cmd"),
        F.lit(cfg.pipe_header).alias("pipe_header_mode"),
        F.lit(cfg.pipe_header_vcf).cast("string").alias("pipe_header_vcf"),
        F.lit(cfg.table(QUARANTINE)).alias("pipe_quarantine_table"),
        "has_csq", "has_genotypes",
        counted("variants_rows"), counted("calls_rows"), counted("csq_rows"),
        F.substring(F.coalesce(read_error, pipe_error), 1, ERROR_CHARS).alias("error"),
    ]
    append_table(rows.select(*columns), cfg.table(FILE_LOG))
