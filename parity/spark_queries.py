"""The registered Spark queries: one per operator, each over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

import locusframe as lf
from locusframe.functions import provenance, resolve_core_columns, typed_columns
from locusframe.operators.genotypes import CALLER_FIELDS
from locusframe.scratch import materialize, scratch_path
from locusframe.sources.header import merge_layout, per_file
from locusframe.sources.vcf import parse_by_file, scan_lines
from locusframe.sources.vcf_text import record_lines

from . import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(function: Query) -> Query:
    REGISTRY[function.__name__] = function
    return function


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fx.records(spark, sf_dir)


def _with_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return provenance(fx.sourced(fx.records(spark, sf_dir)), F.col("source_file"))


def _json(*names: str):
    return [F.to_json(n).alias(n) for n in names]


# --- projections -------------------------------------------------------------------------------

@query
def explode_alleles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lf.explode_alleles(_records(spark, sf_dir), [F.col("rec")])
    return rows.select("rec", "chrom", "pos", "ref", "alt", "variant_key")


@query
def variant_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lf.explode_alleles(_records(spark, sf_dir), [])
    return rows.select("variant_key", "chrom")


@query
def variant_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lf.explode_alleles(_records(spark, sf_dir), [])
    return rows.groupBy("chrom").agg(F.count_distinct("variant_id").alias("ids"), F.count(F.lit(1)).alias("n"))


@query
def pos_from_start(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lf.explode_alleles(_records(spark, sf_dir), [F.col("start")]).select("start", "pos")


@query
def core_columns_alt_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    short = _records(spark, sf_dir).select(
        "rec", F.col("contigName").alias("chrom"), (F.col("start") + 1).alias("pos"),
        F.col("referenceAllele").alias("ref"), F.col("alternateAlleles").alias("alt"))
    names = resolve_core_columns(short)
    rows = lf.explode_alleles(short, [F.col("rec")])
    return rows.select("rec", "variant_key", "pos", F.lit(names["pos"]).alias("pos_column"))


@query
def safe_missing_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _records(spark, sf_dir)
    return df.select("rec", *typed_columns(df, qual="double", absent="int"))


@query
def provenance_filename(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _with_files(spark, sf_dir)
    return rows.groupBy("source_file", "filename").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("ingest_ts").alias("stamps"))


@query
def info_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _records(spark, sf_dir)
    return df.select("rec", *lf.flatten_info(df))


@query
def variants_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lf.variants_flat(_records(spark, sf_dir)).drop("variant_id")


@query
def presence_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _records(spark, sf_dir)
    return lf.presence_flags(df).withColumn("case", F.lit("all")).unionByName(
        lf.presence_flags(df.drop("INFO_CSQ", "genotypes")).withColumn("case", F.lit("none")))


# --- consequences ------------------------------------------------------------------------------

@query
def csq_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lf.explode_consequences(_records(spark, sf_dir))
    return rows.select("variant_key", "csq_index", F.col("csq.Allele").alias("allele"))


@query
def csq_struct_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lf.consequences_flat(_records(spark, sf_dir))
    return rows.select(*[c for c in rows.columns if c.startswith("CSQ_")])


@query
def consequences_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lf.consequences_flat(_records(spark, sf_dir)).drop("variant_id")


@query
def consequences_match_allele(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lf.consequences_flat(_records(spark, sf_dir), match_allele=True).drop("variant_id")


@query
def consequences_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = F.transform("INFO_CSQ", lambda c: F.concat_ws("|", c["Allele"], c["Consequence"]))
    return lf.consequences_flat(_records(spark, sf_dir).withColumn("INFO_CSQ", raw)).drop("variant_id")


# --- genotypes ---------------------------------------------------------------------------------

@query
def calls_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lf.explode_genotypes(_records(spark, sf_dir))
    return rows.select("variant_key", F.col("g.sampleId").alias("sample_id"), F.col("g.depth").alias("depth"))


def _calls(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Calls with the key of their allele, so that values of another row cannot pass for right."""
    return lf.variant_calls(_records(spark, sf_dir), keys=True).select("variant_key", "sample_id", *columns)


@query
def gt_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _calls(spark, sf_dir, "GT", "phased")


@query
def call_dp_gq(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _calls(spark, sf_dir, "DP", "GQ")


@query
def call_ad_pl(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _calls(spark, sf_dir, "AD", "PL")


@query
def variant_calls(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _calls(spark, sf_dir, "GT", "DP", "GQ", "AD", "PL", "phased")


@query
def calls_short_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    short = F.transform("genotypes", lambda g: F.struct(
        g["sampleId"].alias("sampleId"), g["depth"].alias("DP"), g["conditionalQuality"].alias("GQ"),
        g["alleleDepths"].alias("AD"), g["phredLikelihoods"].alias("PL")))
    return lf.variant_calls(_records(spark, sf_dir).withColumn("genotypes", short), keys=True).drop("variant_id")


@query
def calls_raw_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = F.transform("genotypes", lambda g: g["sampleId"])
    df = _records(spark, sf_dir).withColumn("genotypes", names)
    kept = lf.variant_calls(df).drop("variant_id").withColumn("raw", F.lit("keep"))
    return kept.unionByName(lf.variant_calls(df, raw="drop").drop("variant_id").withColumn("raw", F.lit("drop")))


@query
def call_extra_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    extra = F.transform("genotypes", lambda g: F.struct(
        g["sampleId"].alias("sampleId"), g["depth"].alias("PS"), g["alleleDepths"].alias("F1R2"),
        g["phredLikelihoods"].alias("SB"), F.concat(g["sampleId"], F.lit("_p")).alias("PID")))
    rows = lf.variant_calls(_records(spark, sf_dir).withColumn("genotypes", extra), caller_fields=True, keys=True)
    return rows.select("variant_key", "sample_id", *CALLER_FIELDS)


# --- split, normalize, pipe, quarantine --------------------------------------------------------

@query
def split_multiallelics(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = lf.split_multiallelics(_records(spark, sf_dir))
    rows = rows.select("rec", *_json("alternateAlleles", "INFO_AC"), "splitFromMultiAllelic", F.explode("genotypes").alias("g"))
    return rows.select(
        "rec", "alternateAlleles", "INFO_AC", "splitFromMultiAllelic", F.col("g.sampleId").alias("sample_id"),
        *[F.to_json(f"g.{n}").alias(n) for n in ("calls", "alleleDepths", "phredLikelihoods")])


def _normalized(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    chunks = lf.reference_chunks(spark, fx.write_fasta(spark, sf_dir), fx.CHUNK_SIZE)
    records = materialize(fx.alleles(spark, sf_dir), "alleles")
    rows = lf.normalize_variants(records, materialize(chunks, "chunks"), fx.CHUNK_SIZE, **options)
    return rows.select(
        "rec", "contigName", "start", "end", "referenceAllele",
        F.get("alternateAlleles", F.lit(0)).alias("alternateAllele"),
        F.col("normalizationStatus.changed").alias("changed"),
        F.col("normalizationStatus.errorMessage").alias("error"))


@query
def normalize_left_align(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normalized(spark, sf_dir)


@query
def normalize_shuffled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _normalized(spark, sf_dir, broadcast_bytes=0)


def _text_rows(records: DataFrame) -> DataFrame:
    """Site and call columns of records that went through text, one row per call."""
    rows = lf.explode_alleles(records, [
        *_json("names", "filters", "INFO_AC"), F.col("qual"), F.col("INFO_DP"), F.col("INFO_DB"), F.col("genotypes")])
    rows = rows.withColumn("g", F.explode_outer("genotypes"))
    return rows.select(
        "variant_key", "names", "qual", "filters", "INFO_AC", "INFO_DB", "INFO_DP",
        F.col("g.sampleId").alias("sample_id"),
        F.to_json("g.calls").alias("calls"), F.col("g.phased").alias("phased"), F.col("g.depth").alias("DP"),
        F.col("g.conditionalQuality").alias("GQ"),
        F.to_json("g.alleleDepths").alias("AD"), F.to_json("g.phredLikelihoods").alias("PL"))


@query
def vcf_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fx.write_vcf(_records(spark, sf_dir).drop("rec"), "roundtrip")
    return _text_rows(lf.read_vcf(spark, path, mode="fail", suffixes=fx.TEXT))


@query
def vcf_roundtrip_consequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fx.write_vcf(_records(spark, sf_dir).drop("rec", "genotypes"), "roundtrip-csq")
    return lf.consequences_flat(lf.read_vcf(spark, path, mode="fail", suffixes=fx.TEXT)).drop("variant_id", "source_file")


@query
def to_vcf_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = lf.to_vcf_lines(_records(spark, sf_dir).drop("rec"))
    return lines.where(~F.col("line").startswith("#")).select("line")


@query
def pipe_identity(spark: SparkSession, sf_dir: str) -> DataFrame:
    records, _ = lf.pipe_partitions(_records(spark, sf_dir).drop("rec"), ["cat"])
    return _text_rows(records)


@query
def pipe_failure(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, rejected = lf.pipe_partitions(_records(spark, sf_dir).drop("rec"), ["false"])
    return rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("raw").alias("lines"))


def _damaged(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Good and rejected records of text in which two lines in ten are damaged."""
    df = _records(spark, sf_dir).drop("genotypes")
    lines = record_lines(df.drop("rec"), inferred=False)
    position = F.regexp_extract("line", r"^[^\t]*\t(\d+)", 1).cast("long")
    digit = F.call_function("div", position - 1, F.lit(50)) % 10
    line = (
        F.when(digit == 3, F.regexp_replace("line", r"^([^\t]*)\t\d+", "$1\tx"))
        .when(digit == 7, F.regexp_replace("line", r"\t[^\t]*$", ""))
        .otherwise(F.col("line")))
    headers = spark.createDataFrame(
        [("", text) for text in [*lf.infer_header(df.drop("rec")), "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"]],
        "source_file string, line string")
    parsed = parse_by_file(lines.select("source_file", line.alias("line")), per_file(headers), merge_layout(headers), "keep")
    return lf.quarantine(parsed)


@query
def quarantine_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    good, rejected = _damaged(spark, sf_dir)
    kept = good.groupBy().agg(F.count(F.lit(1)).alias("n")).select(F.lit("good").alias("reason"), "n")
    return kept.unionByName(rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n")))


@query
def quarantine_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lf.quarantine_count(_damaged(spark, sf_dir)[1])


# --- reference sequence ------------------------------------------------------------------------

@query
def fasta_contig_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = lf.fasta_contig_index(spark, fx.write_fasta(spark, sf_dir))
    return index.select("name", "length", "line_bases", "line_width")


@query
def ref_chunk_bases(spark: SparkSession, sf_dir: str) -> DataFrame:
    chunks = lf.reference_chunks(spark, fx.write_fasta(spark, sf_dir), fx.CHUNK_SIZE)
    return chunks.select("contigName", "chunk", "start", F.md5("bases").alias("bases_md5"), F.length("bases").alias("n"))


# --- tables and checks -------------------------------------------------------------------------

@query
def write_read_back(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{fx.database(spark)}.variants_flat"
    lf.write_table(lf.variants_flat(_records(spark, sf_dir)), name)
    return lf.load_table(spark, name).drop("variant_id")


@query
def schema_merge_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{fx.database(spark)}.variants_flat"
    df = _records(spark, sf_dir)
    lf.append_table(lf.variants_flat(df.drop("INFO_AC")), name)
    lf.append_table(lf.variants_flat(df.drop("INFO_DP", "INFO_DB")), name)
    return lf.load_table(spark, name).select("variant_key", "INFO_AC", "INFO_DB", "INFO_DP")


@query
def schema_widen_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A column that is an integer, then a double, then text; and one that becomes an array."""
    name = f"{fx.database(spark)}.grown"
    rec = _records(spark, sf_dir).select("rec")
    for run, (value, list_value) in enumerate((("rec % 7", "rec % 7"), ("rec / 4", "array(rec % 7)"), ("concat('r', rec)", "rec % 5"))):
        kind = ("int", "double", "string")[run]
        lf.append_table(rec.selectExpr(f"{run} AS run", "rec", f"cast({value} AS {kind}) AS x", f"{list_value} AS y"), name)
    return lf.load_table(spark, name).select("run", "rec", "x", F.to_json("y").alias("y"))


@query
def replace_widened_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files replaced while a column widens, and again across the schemas of a table."""
    name = f"{fx.database(spark)}.grown"
    df = _with_files(spark, sf_dir).select("rec", "filename", "source_file")
    for run, (kind, files) in enumerate((("int", 7), ("double", 3), ("double", 5), ("string", 2))):
        lf.replace_files(df.where(F.col("rec") % 7 < files).selectExpr(
            "rec", "filename", f"{run} AS run", f"cast(rec % 1000 AS {kind}) AS x", "source_file"), name)
    return lf.load_table(spark, name).groupBy("filename", "run").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("x").cast("double")).cast("long").alias("x"), F.max(F.length("x")).cast("int").alias("longest"))


@query
def replace_source_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{fx.database(spark)}.variants_flat"
    df = _with_files(spark, sf_dir)
    lf.replace_files(lf.variants_flat(df), name)
    lf.replace_files(lf.variants_flat(df.where("filename = 'batch3.vcf'").drop("INFO_DP")), name)
    return lf.load_table(spark, name).groupBy("filename").agg(
        F.count(F.lit(1)).alias("n"), F.count("INFO_DP").alias("with_dp"))


@query
def placeholder_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lf.table_counts(lf.flatten_records(_records(spark, sf_dir).drop("INFO_CSQ", "genotypes")))


@query
def reset_outputs(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = f"{fx.database(spark)}.variants_flat"
    flat = lf.variants_flat(_records(spark, sf_dir))
    lf.write_table(flat, name)
    before = lf.load_table(spark, name).count()
    dropped = lf.reset_outputs(spark, [name, f"{name}_absent"])
    lf.ensure_table(spark, name, flat.schema)
    return lf.table_counts({"after": lf.load_table(spark, name)}).select(
        "table_name", "n", F.lit(before).alias("before"), F.lit(len(dropped)).alias("dropped"))


@query
def table_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lf.table_counts(lf.flatten_records(_records(spark, sf_dir)))


@query
def variants_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lf.rows_per_file(lf.variants_flat(_with_files(spark, sf_dir)))


@query
def calls_per_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lf.rows_per_file(lf.variant_calls(_with_files(spark, sf_dir)))


@query
def recent_log_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lf.recent_log(fx.file_log(spark, sf_dir), 50).select("run_id", "filename", "status", "variants_rows")


@query
def file_log_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lf.filter_run(fx.file_log(spark, sf_dir), "run3").drop("run_ts")


@query
def preview_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = lf.variants_flat(_records(spark, sf_dir)).drop("variant_id")
    return lf.preview(flat, 20, "chrom", "pos", "alt").select("variant_key", "names", "qual", "INFO_AC")


@query
def row_count_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    database = fx.database(spark)
    counted = []
    for name, df in lf.flatten_records(_records(spark, sf_dir)).items():
        df, counter = lf.capture_row_counts(df, name)
        lf.write_table(df, f"{database}.{name}")
        counted.append((name, counter.get["n"]))
    return spark.createDataFrame(counted, "table_name string, n bigint")


# --- files and whole runs ----------------------------------------------------------------------

@query
def discover_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fx.write_vcf(_records(spark, sf_dir).drop("rec", "genotypes"), "discover")
    files = lf.discover_files(spark, path, fx.TEXT)
    lines = scan_lines(spark, path, fx.TEXT)
    found = lines.join(files, lines["source_file"] == files["path"], "left_semi")
    return found.agg(F.count(F.lit(1)).alias("lines"), F.count_distinct("line").alias("distinct_lines"))


@query
def discover_mixed_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every file at the top of a folder and its lines: hidden and empty ones too, nothing of a folder below."""
    lines = record_lines(_records(spark, sf_dir).drop("genotypes"))
    piece = F.regexp_extract("line", r"^[^\t]*\t(\d+)", 1).cast("long")
    lines = lines.select("line", (F.call_function("div", piece - 1, F.lit(50)) % 5).alias("piece"))
    path = fx.write_named(lines, "mixed", ["a.txt", "_b.txt", ".c.txt", "day=1/d.txt", "it's 100% [e].TXT"], "empty.txt")
    files = lf.discover_files(spark, path, fx.TEXT)
    read = scan_lines(spark, path, fx.TEXT).groupBy(F.col("source_file").alias("path")).agg(F.count(F.lit(1)).alias("lines"))
    return files.join(read, "path", "full").select("filename", F.coalesce("lines", F.lit(0)).alias("lines"), (F.col("length") > 0).alias("has_bytes"))


@query
def read_blocked_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Blocked archives, each read by many tasks."""
    path = fx.write_blocked(_records(spark, sf_dir).drop("rec").repartitionByRange(fx.pieces(spark, sf_dir, 3), "start"), "blocked")
    return _text_rows(lf.read_vcf(spark, path, suffixes=fx.TEXT, gz_spread_bytes=1, range_bytes=50_000))


@query
def call_slices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calls from text without the nested array of all samples."""
    path = fx.write_vcf(_records(spark, sf_dir).drop("rec"), "slices")
    rows = lf.explode_alleles(lf.read_call_slices(spark, path, samples_at_once=3, suffixes=fx.TEXT), [F.col("genotypes")])
    calls = rows.select("variant_key", F.explode("genotypes").alias("g"))
    return calls.select("variant_key", F.col("g.sampleId").alias("sample_id"), F.to_json("g.calls").alias("calls"), F.col("g.depth").alias("DP"),
                        F.to_json("g.alleleDepths").alias("AD"), F.to_json("g.phredLikelihoods").alias("PL"))


@query
def damaged_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text with undeclared and repeated keys and values of wrong type: a row for each line, with every value of it."""
    df = _records(spark, sf_dir).drop("INFO_CSQ")
    lines = record_lines(df.drop("rec"), inferred=False)
    position = F.regexp_extract("line", r"^[^\t]*\t(\d+)", 1).cast("long")
    rec = F.call_function("div", position - 1, F.lit(50))
    line = (
        F.when(rec % 10 == 1, F.regexp_replace("line", r"DP=\d+", F.concat(F.lit("DP=x"), rec.cast("string"))))
        .when(rec % 10 == 2, F.regexp_replace("line", r"DP=(\d+)", F.concat(F.lit("DP=$1;dp=low;NEW=n"), rec.cast("string"), F.lit(";MARK"))))
        .when(rec % 10 == 3, F.regexp_replace("line", r"DP=(\d+)", "DP=$1;DP=7;NEW=a;NEW=b"))
        .when(rec % 10 == 4, F.regexp_replace("line", r"GT:DP", "GT:XY"))
        .when(rec % 10 == 5, F.concat("line", F.lit(":1:2:3")))
        .when(rec % 10 == 6, F.regexp_replace("line", r"\d+$", "1.5"))
        .otherwise(F.col("line")))
    title = record_lines(df.drop("rec"), inferred=False).select("title").first().title
    headers = spark.createDataFrame([("", text) for text in [*lf.infer_header(df.drop("rec")), title]], "source_file string, line string")
    parsed = parse_by_file(lines.select("source_file", line.alias("line")), per_file(headers), merge_layout(headers), "keep")
    good, rejected = lf.quarantine(materialize(parsed, "parsed"))  # three passes over them follow
    good = lf.promote_undeclared(good)
    kept = good.select(
        F.call_function("div", F.col("start"), F.lit(50)).alias("rec"), "INFO_DP", "INFO_DP_2", "INFO_dp_3", "INFO_NEW", "INFO_MARK",
        F.lit(None).cast("string").alias("reason"), F.lit(None).cast("string").alias("value"))
    text = F.coalesce(F.nullif(F.regexp_extract("raw", r"(DP=x\d+)", 1), F.lit("")), F.nullif(F.regexp_extract("raw", r"(GT:XY)", 1), F.lit("")),
                      F.regexp_extract("raw", r"([^:]*)$", 1))
    lost = rejected.select(F.call_function("div", F.regexp_extract("raw", r"^[^\t]*\t(\d+)", 1).cast("long") - 1, F.lit(50)).alias("rec"),
                           "reason", text.alias("value"))
    return kept.unionByName(lost, allowMissingColumns=True).withColumnRenamed("INFO_DP", "declared_dp").withColumnRenamed(
        "INFO_dp_3", "small_dp").withColumnRenamed("INFO_DP_2", "repeated_dp")


#: Adds to each record the number of the process (P) and of the line in it (N).
COUNT = ["/bin/sh", "-c", """awk -v p=$$ 'BEGIN{FS=OFS="\\t"}
/^#CHROM/{print "##INFO=<ID=P,Number=1,Type=Integer,Description=\\"process\\">"; print "##INFO=<ID=N,Number=1,Type=Integer,Description=\\"line\\">"}
/^#/{print; next} {$8=$8";P="p";N="(++n); print}'"""]


def _counted(piped: DataFrame, slices: int) -> DataFrame:
    """Records that came through the counting command, those out of order in a process, and whether starts are bounded."""
    before = F.lag("start").over(Window.partitionBy("source_file", "INFO_P").orderBy("INFO_N"))
    rows = piped.select("source_file", "INFO_P", "start", (before > F.col("start")).alias("late"))
    return rows.agg(F.count(F.lit(1)).alias("records"), F.count_if("late").alias("out_of_order"),
                    (F.count_distinct("source_file", "INFO_P") <= slices).alias("starts_bounded"))


def _packed_in_order(df: DataFrame, label: str, files: int, **options) -> DataFrame:
    """Records of gzip text in the order of their positions, spread over tasks in slices."""
    path = scratch_path(df.sparkSession, label)
    lf.to_vcf_lines(df.repartitionByRange(files, "start").sortWithinPartitions("start")).select("line").write.option("compression", "gzip").text(path)
    return lf.read_vcf(df.sparkSession, path, suffixes=fx.TEXT, gz_spread_bytes=20_000, ordered=True, **options)


@query
def pipe_order_after_gzip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Archives unpacked by one task each and spread: the command still sees slices whole and in order."""
    records = materialize(_packed_in_order(_records(spark, sf_dir).drop("rec", "genotypes"), "packed", fx.pieces(spark, sf_dir, 3)), "spread")
    slices = records.select("source_file", "slice").distinct().count()
    return _counted(lf.pipe_partitions(records, COUNT)[0], slices)


@query
def pipe_order_after_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same after a normalization that had to deal the records out."""
    records = materialize(_packed_in_order(fx.alleles(spark, sf_dir).drop("rec"), "packed-indels", fx.pieces(spark, sf_dir, 3)), "spread")
    slices = records.select("source_file", "slice").distinct().count()
    chunks = materialize(lf.reference_chunks(spark, fx.write_fasta(spark, sf_dir), fx.CHUNK_SIZE), "chunks")
    moved = lf.normalize_variants(records, chunks, fx.CHUNK_SIZE, broadcast_bytes=0)
    original = (F.shiftleft("slice", 32) + F.col("line_number")).alias("start")  # positions moved, so places are compared
    return _counted(lf.pipe_partitions(moved.drop("normalizationStatus", "start", "end").select("*", original), COUNT)[0], slices)


@query
def flatten_single(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fx.write_vcf(_records(spark, sf_dir).drop("rec"), "single")
    return _three_tables(lf.flatten_single(spark, path, fx.database(spark), fx.TEXT))


def _three_tables(tables: dict[str, DataFrame]) -> DataFrame:
    """The three result tables as rows (table_name, entry), the entry in text."""
    variants, consequences, calls = (tables[n] for n in ("variants_flat", "variant_consequences_flat", "variant_calls"))

    def text(df: DataFrame, name: str, *columns: str) -> DataFrame:
        parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
        return df.select(F.lit(name).alias("table_name"), F.concat_ws("|", *parts).alias("entry"))

    keyed = variants.select("variant_id", "variant_key").distinct()
    return (
        text(variants, "variants_flat", "variant_key", "names", "filters", "INFO_DP", "INFO_AC")
        .unionByName(text(consequences, "variant_consequences_flat", "variant_key", "csq_index", "CSQ_Allele",
                          "CSQ_Consequence", "CSQ_Extra_IMPACT"))
        .unionByName(text(calls.join(keyed, "variant_id"), "variant_calls", "variant_key", "sample_id", "GT", "DP",
                          "GQ", "AD", "PL")))


def _ingested(spark: SparkSession, cfg: lf.IngestConfig) -> dict[str, DataFrame]:
    return {n: lf.load_table(spark, cfg.table(n)) for n in ("variants_flat", "variant_consequences_flat", "variant_calls")}


@query
def ingest_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fx.write_vcf(_records(spark, sf_dir).drop("rec").repartition(fx.pieces(spark, sf_dir, 4), "start"), "ingest")
    cfg = lf.IngestConfig(path, fx.database(spark), suffixes=fx.TEXT, pipe_cmd=["cat"])
    lf.ingest(spark, cfg)
    return _three_tables(_ingested(spark, cfg))


@query
def ingest_normalized(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fx.write_vcf(fx.alleles(spark, sf_dir).drop("rec"), "ingest-indels")
    cfg = lf.IngestConfig(path, fx.database(spark), suffixes=fx.TEXT, chunk_size=fx.CHUNK_SIZE,
                          reference_fasta=fx.write_fasta(spark, sf_dir))
    lf.ingest(spark, cfg)
    return lf.load_table(spark, cfg.table("variants_flat")).select("variant_key", "chrom", "pos", "ref", "alt")


@query
def file_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fx.write_vcf(_records(spark, sf_dir).drop("rec"), "log")
    log = lf.ingest(spark, lf.IngestConfig(path, fx.database(spark), suffixes=fx.TEXT))
    return log.groupBy("status", "stage", "pipe_enabled", "has_csq", "has_genotypes", "error").agg(
        *[F.sum(c).alias(c) for c in ("variants_rows", "calls_rows", "csq_rows")])


@query
def failed_stages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of another reference and files with lists of a wrong length beside good ones: each fails in its stage."""
    df = fx.alleles(spark, sf_dir)
    ref, alt = F.col("referenceAllele"), F.get("alternateAlleles", F.lit(0))

    def part(k: int) -> DataFrame:
        return df.where(F.col("rec") % 3 == k).withColumn("INFO_AC", F.array(F.lit(1)))

    other = part(1).withColumns({
        "referenceAllele": F.translate(ref, "ACGT", "CGTA"), "alternateAlleles": F.array(F.translate(alt, "ACGT", "CGTA"))})
    uneven = part(2).withColumns({
        "alternateAlleles": F.array(alt, F.concat(alt, F.lit("TTTTTT"))), "INFO_AC": F.array(F.lit(1), F.lit(2), F.lit(3))})
    folders = [fx.write_vcf(rows.drop("rec"), label) for label, rows in (("good", part(0)), ("other", other), ("uneven", uneven))]
    cfg = lf.IngestConfig(folders, fx.database(spark), suffixes=fx.TEXT, chunk_size=fx.CHUNK_SIZE,
                          reference_fasta=fx.write_fasta(spark, sf_dir), max_split_share=0.5, max_normalize_share=0.5)
    log = lf.ingest(spark, cfg).where("error IS NOT NULL OR variants_rows > 0")
    lost = lf.load_table(spark, cfg.table("vcf_pipe_quarantine")).groupBy(F.col("source_file").alias("vcf_path")).agg(
        F.count(F.lit(1)).alias("quarantined"))
    return log.join(lost, "vcf_path", "left").groupBy(
        "status", "stage", F.substring_index("error", ": ", -1).alias("reason")).agg(
        F.sum("variants_rows").alias("variants_rows"), F.sum("quarantined").alias("quarantined"))


@query
def bad_file_skipped(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = _records(spark, sf_dir).drop("rec")
    good, bad = fx.write_vcf(df, "good"), fx.write_vcf(df, "bad", header=False)
    cfg = lf.IngestConfig([good, bad], fx.database(spark), suffixes=fx.TEXT)
    log = lf.ingest(spark, cfg).groupBy("status", "stage", "error").agg(
        *[F.sum(c).alias(c) for c in ("variants_rows", "calls_rows", "csq_rows")])
    rejected = lf.load_table(spark, cfg.table("vcf_pipe_quarantine")).groupBy("reason").agg(F.count(F.lit(1)).alias("quarantined"))
    return log.join(rejected, F.col("error") == F.col("reason"), "left").drop("reason")
