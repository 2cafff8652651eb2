"""Result tables, the whole pipeline over directories, and the pipe to external commands."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from test_reader import STANDARD, fmt, info, line, vcf
from test_reference import fasta

import locusframe as lf
from locusframe.sources.tables import CALLS_SCHEMA, FILE_LOG_SCHEMA

ROW = line("chr1", 5, "rs1", "A", "C,G", "30", "PASS", "DP=3;AF=0.5,0.25", "GT:AD:PL", "0/1:3,4,5:0,1,2,3,4,5", "1|2")
CSQ = info("CSQ", ".", "String", "x. Format: Allele|Effect")


def records(spark, rows, schema):
    return spark.createDataFrame(rows, schema)


def log_rows(log):
    return {r.filename: r for r in log.collect()}


@pytest.fixture
def folder(tmp_path):
    path = tmp_path / "in"
    path.mkdir()
    return path


def test_variant_id_golden(spark):
    df = records(spark, [("chr1", 5, "A", ["G"]), ("chr1", 5, "A", [])], "chrom string, pos bigint, ref string, alt array<string>")
    rows = {r.variant_key: r.variant_id for r in lf.explode_alleles(df).collect()}
    assert rows == {"chr1:5:A:G": "-242243585728411302", "chr1:5:A": "6729947531483766865"}


def test_missing_core_column(spark):
    df = records(spark, [("chr1", 5)], "chrom string, pos bigint")
    with pytest.raises(ValueError, match="no column for ref, alt.*chrom, pos"):
        lf.variants_flat(df)


def test_raw_option_is_checked(spark):
    df = records(spark, [("c", 1, "A", ["T"], ["x"])],
                 "chrom string, pos bigint, ref string, alt array<string>, genotypes array<string>")
    assert [r.GT for r in lf.variant_calls(df).collect()] == ["x"]
    assert lf.variant_calls(df, raw="drop").count() == 0
    with pytest.raises(ValueError, match="raw must be"):
        lf.variant_calls(df, raw="maybe")


def test_split_non_diploid_and_header_numbers(spark, folder):
    header = [info("AC", "A", "Integer"), info("RD", "R", "Integer"), fmt("GT", 1, "String"), fmt("PL", "G", "Integer"),
              fmt("ALTS", "A", "Integer")]
    vcf(folder / "a.vcf", header, [
        line("1", 3, ".", "A", "C,G", ".", ".", "AC=1,2;RD=7,8,9", "GT:PL:ALTS", "0/2:0,1,2,3,4,5:4,6", "1:0,1,2:.")], ["d", "h"])
    one, two = lf.split_multiallelics(lf.read_vcf(spark, str(folder))).orderBy("INFO_AC").collect()
    assert (one.alternateAlleles, one.INFO_AC, one.INFO_RD, one.splitFromMultiAllelic) == (["C"], [1], [7, 8], True)
    assert (two.alternateAlleles, two.INFO_AC, two.INFO_RD) == (["G"], [2], [7, 9])
    assert [(g.calls, g.phredLikelihoods, g.ALTS) for g in one.genotypes] == [([0, -1], [0, 1, 2], [4]), ([1], None, None)]
    assert [(g.calls, g.phredLikelihoods, g.ALTS) for g in two.genotypes] == [([0, 1], [0, 3, 5], [6]), ([-1], None, None)]


def test_append_adds_columns_both_ways(spark, database):
    name = f"{database}.t"
    lf.append_table(records(spark, [(1, "a")], "k int, INFO_A string"), name)
    lf.append_table(records(spark, [(2, 5)], "k int, INFO_B int"), name)
    rows = lf.load_table(spark, name).orderBy("k").collect()
    assert [tuple(r) for r in rows] == [(1, "a", None), (2, None, 5)]
    lf.write_table(records(spark, [(9,)], "k int"), name)
    assert lf.load_table(spark, name).columns == ["k"]


def test_replace_keeps_other_files(spark, database):
    name = f"{database}.t"
    lf.replace_files(records(spark, [(1, "f1"), (2, "f2")], "k int, source_file string"), name)
    lf.replace_files(records(spark, [(3, "x", "f1")], "k int, n string, source_file string"), name)
    rows = lf.load_table(spark, name).orderBy("k").collect()
    assert [tuple(r) for r in rows] == [(2, None, "f2"), (3, "x", "f1")]
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_placeholders_and_reset(spark, database):
    name = f"{database}.calls"
    lf.ensure_table(spark, name, CALLS_SCHEMA)
    lf.ensure_table(spark, f"{database}.log", FILE_LOG_SCHEMA)
    assert len(spark.table(name).columns) == 18 and len(spark.table(f"{database}.log").columns) == 17
    lf.append_table(spark.createDataFrame([("v",)], "variant_id string"), name)
    lf.ensure_table(spark, name, CALLS_SCHEMA)
    assert spark.table(name).count() == 1
    lf.ensure_table(spark, name, CALLS_SCHEMA, first_write=True)
    assert spark.table(name).count() == 0
    spark.sql(f"CREATE VIEW {database}.v AS SELECT 1 AS one")
    assert lf.reset_outputs(spark, [name, f"{database}.v", f"{database}.absent"]) == [name, f"{database}.v"]
    assert not spark.catalog.tableExists(name)
    with pytest.raises(ValueError, match="catalog.schema.name"):
        lf.reset_outputs(spark, ["db.name"])


def test_flatten_single_without_sections(spark, folder, database):
    path = vcf(folder / "a.vcf", [info("DP", 1, "Integer")], [line("1", 3, ".", "A", "C,G", ".", ".", "DP=1")])
    tables = lf.flatten_single(spark, path, database)
    counts = {r.table_name: r.n for r in lf.table_counts(tables).collect()}
    assert counts == {"variants_flat": 2, "variant_consequences_flat": 0, "variant_calls": 0}
    assert tables["variant_consequences_flat"].columns[-1] == "CSQ_raw"
    assert tables["variants_flat"].columns == [
        "variant_id", "variant_key", "chrom", "pos", "ref", "alt", "names", "qual", "filters",
        "splitFromMultiAllelic", "INFO_DP"]


def test_ingest_directory(spark, folder, database):
    vcf(folder / "a.vcf", [*STANDARD, CSQ], [ROW, ROW.replace("DP=3", "DP=4;CSQ=C|x,G|y")], ["S1", "S2"])
    vcf(folder / "sites.vcf.gz", [info("DP", 1, "Float")], [line("chr2", 7, ".", "A", ".", ".", ".", "DP=1.5")])
    vcf(folder / "empty.vcf", STANDARD, [], ["S1"])
    (folder / "none.vcf").write_text("\n")
    (folder / "bad.vcf").write_text(ROW + "\n")
    (folder / "notes.txt").write_text("x")
    cfg = lf.IngestConfig(str(folder), database)
    log = log_rows(lf.ingest(spark, cfg))
    assert set(log) == {"a.vcf", "sites.vcf.gz", "empty.vcf", "none.vcf", "bad.vcf"}
    done = {n: (r.status, r.stage, r.has_csq, r.has_genotypes, r.variants_rows, r.calls_rows, r.csq_rows) for n, r in log.items()}
    assert done["a.vcf"] == ("processed", "write", True, True, 4, 8, 6)
    assert done["sites.vcf.gz"] == ("processed", "write", False, False, 1, 0, 0)
    assert done["empty.vcf"] == ("processed", "write", False, True, 0, 0, 0)
    assert done["none.vcf"] == ("skipped", "read", False, False, None, None, None)
    assert log["bad.vcf"].error == "file has no header"
    variants = spark.table(f"{database}.variants_flat")
    assert variants.select("ingest_ts").distinct().count() == 1
    assert {r.filename: r.n for r in lf.rows_per_file(variants).collect()} == {"a.vcf": 4, "sites.vcf.gz": 1}
    calls = spark.table(f"{database}.variant_calls")
    assert sorted((r.sample_id, r.GT, r.AD, r.PL) for r in calls.collect())[:2] == [("S1", "0/.", "[3,5]", "[0,3,5]")] * 2
    assert spark.table(f"{database}.vcf_pipe_quarantine").count() == 1

    # once more: nothing doubles, the log grows; a changed file replaces its rows, also where it has none now
    lf.ingest(spark, cfg)
    assert spark.table(f"{database}.variants_flat").count() == 5
    vcf(folder / "a.vcf", [info("NEW", 1, "String")], [line("chr9", 1, ".", "A", "T", ".", ".", "NEW=v")])
    second = log_rows(lf.ingest(spark, lf.IngestConfig(str(folder), database, only=frozenset({"a.vcf"}))))
    assert set(second) == {"a.vcf"}
    rows = {r.filename: (r.chrom, r.INFO_NEW) for r in spark.table(f"{database}.variants_flat").collect()}
    assert rows == {"a.vcf": ("chr9", "v"), "sites.vcf.gz": ("chr2", None)}
    assert spark.table(f"{database}.variant_calls").count() == 0
    assert spark.table(f"{database}.variant_consequences_flat").count() == 0
    assert spark.table(f"{database}.vcf_ingest_file_log").count() == 11

    # a full reset leaves only the files of the run
    lf.ingest(spark, lf.IngestConfig(str(folder), database, only=frozenset({"sites.vcf.gz"}), reset_first=True))
    assert spark.table(f"{database}.variants_flat").count() == 1
    assert spark.table(f"{database}.vcf_ingest_file_log").count() == 1


def test_malformed_share_decides(spark, folder, database):
    good = [line("1", i + 1, ".", "A", "T", ".", ".", ".") for i in range(9)]
    vcf(folder / "few.vcf", [], [*good, "broken"])
    vcf(folder / "many.vcf", [], [*good[:2], "broken"])
    log = log_rows(lf.ingest(spark, lf.IngestConfig(str(folder), database, max_malformed_share=0.1)))
    assert log["few.vcf"].status == "processed" and log["few.vcf"].variants_rows == 9
    assert log["many.vcf"].status == "skipped"
    assert log["many.vcf"].error == "1 of 3 lines malformed: wrong number of columns"
    assert spark.table(f"{database}.vcf_pipe_quarantine").count() == 2


def test_strict_run_raises_and_logs(spark, folder, database):
    (folder / "bad.vcf").write_text(ROW + "\n")
    with pytest.raises(ValueError, match="bad.vcf: file has no header"):
        lf.ingest(spark, lf.IngestConfig(str(folder), database, skip_bad_files=False))
    log = spark.table(f"{database}.vcf_ingest_file_log").collect()
    assert [(r.filename, r.status, r.stage) for r in log] == [("bad.vcf", "skipped", "read")]


STAGED = [info("AC", "A", "Integer"), info("RD", "R", "Integer")]


@pytest.fixture
def staged(folder, tmp_path):
    """A good file, one of another reference, one with lists that do not fit, and one with both faults."""
    def rows(ref, counts):
        return [line("c", 2, ".", ref, "T,G", ".", ".", f"AC={counts};RD=4,5,6"), line("c", 3, ".", "A", "T", ".", ".", "AC=1")]

    vcf(folder / "good.vcf", STAGED, rows("C", "1,2"))
    vcf(folder / "other.vcf", STAGED, rows("A", "1,2"))
    vcf(folder / "uneven.vcf", STAGED, [*rows("C", "1,2,3"), line("c", 2, ".", "C", "T,G", ".", ".", "AC=.;RD=.")])
    vcf(folder / "both.vcf", STAGED, rows("A", "7"))
    return {"reference_fasta": fasta(tmp_path / "ref.fa", [("c", "GCAAAAAT")]), "chunk_size": 4}


def test_failures_of_stages_skip_their_file_alone(spark, folder, staged, database):
    cfg = lf.IngestConfig(str(folder), database, max_split_share=0.0, max_normalize_share=0.5, **staged)
    log = log_rows(lf.ingest(spark, cfg))
    assert {n: (r.status, r.stage, r.variants_rows, r.error) for n, r in log.items()} == {
        "good.vcf": ("processed", "write", 3, None),
        "other.vcf": ("skipped", "normalize", None, "2 of 3 records cannot be normalized: REF differs from the reference"),
        "uneven.vcf": ("skipped", "split", None, "2 of 5 records cannot be split: AC has 3 values for 2 ALT"),
        "both.vcf": ("skipped", "split", None, "2 of 3 records cannot be split: AC has 1 values for 2 ALT")}
    assert [r.filename for r in spark.table(f"{database}.variants_flat").select("filename").distinct().collect()] == ["good.vcf"]
    rejected = spark.table(f"{database}.vcf_pipe_quarantine").groupBy("reason").count().collect()
    assert {r.reason: r["count"] for r in rejected} == {log[n].error: k for n, k in (("other.vcf", 3), ("uneven.vcf", 5), ("both.vcf", 3))}


def test_stage_limits_are_off_lenient_or_strict(spark, folder, staged, database):
    log = log_rows(lf.ingest(spark, lf.IngestConfig(str(folder), database, **staged)))
    assert {r.status for r in log.values()} == {"processed"}
    log = log_rows(lf.ingest(spark, lf.IngestConfig(str(folder), database, max_split_share=0.9, max_normalize_share=0.9, **staged)))
    assert {(r.status, r.stage) for r in log.values()} == {("processed", "write")}
    with pytest.raises(ValueError, match="other.vcf: 2 of 3 records cannot be normalized"):
        lf.ingest(spark, lf.IngestConfig(str(folder), database, skip_bad_files=False, max_normalize_share=0.1,
                                         only=frozenset({"good.vcf", "other.vcf"}), **staged))
    with pytest.raises(ValueError, match="needs reference_fasta"):
        lf.IngestConfig("x", "d", max_normalize_share=0.1)


def test_no_files_and_bad_settings(spark, folder, database):
    with pytest.raises(ValueError, match="no .vcf"):
        lf.ingest(spark, lf.IngestConfig(str(folder), database))
    with pytest.raises(ValueError, match="pipe_header must be"):
        lf.IngestConfig("x", "d", pipe_header="guess")
    with pytest.raises(ValueError, match="needs pipe_header_vcf"):
        lf.IngestConfig("x", "d", pipe_cmd=["cat"], pipe_header="file")


def test_ingest_normalizes(spark, folder, tmp_path, database):
    ref = fasta(tmp_path / "ref.fa", [("c", "GCAAAAAT")])
    vcf(folder / "a.vcf", [fmt("GT", 1, "String")], [line("c", 6, ".", "AA", "A,AAA", ".", ".", ".", "GT", "1/2")], ["S"])
    lf.ingest(spark, lf.IngestConfig(str(folder), database, reference_fasta=ref, chunk_size=4))
    variants = spark.table(f"{database}.variants_flat")
    assert sorted(r.variant_key for r in variants.collect()) == ["c:2:C:CA", "c:2:CA:C"]
    calls = spark.table(f"{database}.variant_calls").join(variants.select("variant_id", "variant_key"), "variant_id")
    assert {r.variant_key: r.GT for r in calls.collect()} == {"c:2:CA:C": "1/.", "c:2:C:CA": "./1"}


ANNOTATE = ["/bin/sh", "-c",
            "awk 'BEGIN{FS=OFS=\"\\t\"} /^#CHROM/{print \"##INFO=<ID=CSQ,Number=.,Type=String,Description=\\\"Format: Allele|Effect\\\">\"}"
            " /^#/{print; next} {$8=$8\";CSQ=\"$5\"|found\"; print}'"]


def test_annotator_adds_consequences(spark, folder, database):
    vcf(folder / "a.vcf", STANDARD, [ROW], ["S1", "S2"])
    log = lf.ingest(spark, lf.IngestConfig(str(folder), database, pipe_cmd=ANNOTATE)).first()
    assert (log.has_csq, log.csq_rows, log.pipe_enabled) == (True, 2, True)
    rows = spark.table(f"{database}.variant_consequences_flat").collect()
    assert sorted((r.alt, r.CSQ_Allele, r.CSQ_Effect) for r in rows) == [("C", "C", "found"), ("G", "G", "found")]
    assert all(r.splitFromMultiAllelic for r in spark.table(f"{database}.variants_flat").collect())


def test_pipe_with_header_of_a_file(spark, folder, database):
    path = vcf(folder / "a.vcf", STANDARD, [ROW], ["S1", "S2"])
    cfg = lf.IngestConfig(str(folder), database, pipe_cmd=["cat"], pipe_header="file", pipe_header_vcf=path)
    log = lf.ingest(spark, cfg).first()
    assert (log.status, log.pipe_header_mode, log.pipe_header_vcf, log.variants_rows) == ("processed", "file", path, 2)


def test_failing_command_quarantines_only_its_file(spark, folder, database):
    vcf(folder / "a.vcf", STANDARD, [ROW], ["S1", "S2"])
    vcf(folder / "b.vcf", STANDARD, [ROW.replace("rs1", "poison")], ["S1", "S2"])
    cmd = ["/bin/sh", "-c", "text=$(cat); case \"$text\" in *poison*) echo no good >&2; exit 3;; *) printf '%s\\n' \"$text\";; esac"]
    log = log_rows(lf.ingest(spark, lf.IngestConfig(str(folder), database, pipe_cmd=cmd)))
    assert (log["a.vcf"].status, log["a.vcf"].variants_rows) == ("processed", 2)
    assert (log["b.vcf"].status, log["b.vcf"].stage) == ("skipped", "pipe")
    assert log["b.vcf"].error == "command ended with status 3: no good"
    rejected = spark.table(f"{database}.vcf_pipe_quarantine").collect()
    assert len(rejected) == 2 and all("poison" in r.raw for r in rejected)


def test_failing_command_raises_when_asked(spark, folder):
    vcf(folder / "a.vcf", STANDARD, [ROW], ["S1", "S2"])
    df = lf.read_vcf(spark, str(folder))
    with pytest.raises(RuntimeError, match="false failed"):
        lf.pipe_partitions(df, ["false"], on_error="fail")


def test_small_pipe_runs_keep_every_record(spark, folder):
    lines = [line("1", i + 1, ".", "A", "T", ".", ".", ".") for i in range(200)]
    vcf(folder / "a.vcf", [], lines)
    good, bad = lf.pipe_partitions(lf.read_vcf(spark, str(folder)), ["cat"], chunk_bytes=100)
    assert good.count() == 200 and bad.count() == 0


def test_counts_come_with_the_write(spark, database):
    df, counter = lf.capture_row_counts(spark.range(7).toDF("k"))
    lf.write_table(df, f"{database}.t")
    assert counter.get == {"n": 7}


def test_calls_are_samples_times_alleles(spark, folder):
    vcf(folder / "a.vcf", STANDARD, [ROW, line("chr1", 9, ".", "A", ".", ".", ".", ".", "GT", "0/0", "0/0")], ["S1", "S2"])
    df = lf.read_vcf(spark, str(folder))
    want = df.agg(F.sum(F.size("genotypes") * F.greatest(F.size("alternateAlleles"), F.lit(1)))).first()[0]
    assert lf.variant_calls(df).count() == want == 6


def test_wider_types_lose_nothing(spark, folder, database):
    for number, (kind, value) in enumerate([("Integer", "7"), ("Float", "0.75"), ("String", "x1"), ("Integer", "3")]):
        vcf(folder / f"f{number}.vcf", [info("X", 1, kind)], [line("1", number + 1, ".", "A", "T", ".", ".", f"X={value}")])
        log = lf.ingest(spark, lf.IngestConfig(str(folder), database, only=frozenset({f"f{number}.vcf"}))).first()
        assert log.status == "processed"
        held = sorted(str(r.INFO_X) for r in spark.table(f"{database}.variants_flat").collect())
        assert held == [["7"], ["0.75", "7.0"], ["0.75", "7.0", "x1"], ["0.75", "3", "7.0", "x1"]][number]


def test_scalar_beside_array_and_large_numbers(spark, database):
    name = f"{database}.grown"
    lf.write_table(spark.sql("SELECT 1 AS k, 5 AS a, CAST(9007199254740993 AS bigint) AS b"), name)
    lf.append_table(spark.sql("SELECT 2 AS k, array(1.5D, 2D) AS a, 0.5D AS b"), name)
    rows = {r.k: (r.a, r.b) for r in spark.table(name).collect()}
    assert rows == {1: ([5.0], "9007199254740993"), 2: ([1.5, 2.0], "0.5")}


def test_damaged_archive_is_skipped_and_logged(spark, folder, database):
    import gzip

    vcf(folder / "good.vcf", STANDARD, [ROW], ["S1", "S2"])
    text = (folder / "good.vcf").read_bytes() + b"".join(b"chr1\t%d\t.\tA\tT\t.\t.\t.\tGT\t0/1\t%d/1\n" % (k, k * k % 7) for k in range(4000))
    packed = gzip.compress(text)
    (folder / "cut.vcf.gz").write_bytes(packed[:len(packed) // 2])
    log = log_rows(lf.ingest(spark, lf.IngestConfig(str(folder), database)))
    assert (log["good.vcf"].status, log["good.vcf"].variants_rows) == ("processed", 2)
    assert (log["cut.vcf.gz"].status, log["cut.vcf.gz"].stage) == ("skipped", "read")
    assert log["cut.vcf.gz"].error.startswith("file cannot be read")


def test_pipe_cuts_at_line_feeds_only_and_starts_once_per_file(spark, folder, tmp_path):
    odd = "a\x85b\u2028c\x0cd"
    vcf(folder / "a.vcf", [info("T", 1, "String")], [line("1", k + 1, ".", "A", "T", ".", ".", f"T={odd}") for k in range(500)])
    starts = tmp_path / "starts"
    cmd = ["/bin/sh", "-c", f"echo x >> {starts}; cat"]
    good, bad = lf.pipe_partitions(lf.read_vcf(spark, str(folder)), cmd)
    assert good.where(F.col("INFO_T") == odd).count() == 500 and bad.count() == 0
    assert len(starts.read_text().split()) == 1


def test_log_says_what_happened_without_counts(spark, folder, database):
    vcf(folder / "a.vcf", STANDARD, [ROW], ["S1", "S2"])
    plain = lf.IngestConfig(str(folder), database, skip_bad_files=False, capture_row_counts=False)
    assert [(r.status, r.variants_rows) for r in lf.ingest(spark, plain).collect()] == [("processed", None)]
    adds = lf.IngestConfig(str(folder), database, capture_row_counts=False, pipe_cmd=["/bin/sh", "-c", "cat; echo broken"])
    for _ in range(2):  # rejected lines of a file are replaced, not doubled
        log = lf.ingest(spark, adds).first()
        assert (log.status, log.stage) == ("processed", "write") and "wrong number" in log.error
        rejected = spark.table(f"{database}.vcf_pipe_quarantine").collect()
        assert [(r.raw, r.run_id) for r in rejected] == [("broken", log.run_id)]


def test_result_files_are_in_the_order_of_positions(spark, folder, database):
    from urllib.parse import unquote

    import pyarrow.parquet as pq

    rows = [line(f"chr{k % 3}", 1 + k * 7919 % 5000, ".", "A", "T", ".", ".", ".") for k in range(5000)]
    vcf(folder / "mixed.vcf", [], rows)
    lf.ingest(spark, lf.IngestConfig(str(folder), database))
    table = spark.table(f"{database}.variants_flat")
    for path in table.inputFiles():
        held = pq.ParquetFile(unquote(path.removeprefix("file://"))).read(["chrom", "pos"]).to_pylist()
        assert [(r["chrom"], r["pos"]) for r in held] == sorted((r["chrom"], r["pos"]) for r in held)
    plan = table.where("chrom = 'chr1' AND pos < 100")._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(chrom), IsNotNull(pos), EqualTo(chrom,chr1), LessThan(pos,100)]" in plan
