"""VCF text: headers, types, malformed lines, compression, samples by file, and the way back."""

from __future__ import annotations

import gzip

import pytest
from pyspark.sql import functions as F, types as T

import locusframe as lf
from locusframe.sources.header import merge_layout, read_headers
from locusframe.sources.vcf import GENOTYPE_NAMES
from locusframe.sources.vcf_text import file_header

TITLE = "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO"


def info(name, number, kind, text="x"):
    return f'##INFO=<ID={name},Number={number},Type={kind},Description="{text}">'


def fmt(name, number, kind):
    return f'##FORMAT=<ID={name},Number={number},Type={kind},Description="x">'


def vcf(path, header, lines, samples=(), newline="\n"):
    title = TITLE + ("\tFORMAT\t" + "\t".join(samples) if samples else "")
    text = newline.join(["##fileformat=VCFv4.2", *header, title, *lines]) + newline
    data = text.encode()
    path.write_bytes(gzip.compress(data) if path.name.endswith(".gz") else data)
    return str(path)


def line(*cells):
    return "\t".join(str(c) for c in cells)


STANDARD = [info("DP", 1, "Integer"), info("AF", "A", "Float"), info("DB", 0, "Flag"), info("NOTE", 1, "String"),
            fmt("GT", 1, "String"), fmt("DP", 1, "Integer"), fmt("GQ", 1, "Integer"), fmt("AD", "R", "Integer"),
            fmt("PL", "G", "Integer"), fmt("PS", 1, "Integer")]


def test_types_and_missing_values(spark, tmp_path):
    vcf(tmp_path / "a.vcf", STANDARD, [
        line("chr1", 5, "rs1;rs2", "A", "C,G", "30.5", "q10;s50", "DP=3;AF=0.5,.;DB;NOTE=a=b", "GT:DP:GQ:AD:PL",
             "0|1:12:99:3,4,.:0,1,2,3,4,5", "./.", "1/2:.:7"),
        line("chr1", 9, ".", "AC", ".", ".", ".", ".", "GT", "0", ".", "2|0|1"),
    ], ["S1", "S2", "S3"])
    df = lf.read_vcf(spark, str(tmp_path), mode="fail")
    first, second = df.orderBy("start").collect()
    assert (first.contigName, first.start, first.end, first.names) == ("chr1", 4, 5, ["rs1", "rs2"])
    assert (first.alternateAlleles, first.qual, first.filters) == (["C", "G"], 30.5, ["q10", "s50"])
    assert (first.INFO_DP, first.INFO_AF, first.INFO_DB, first.INFO_NOTE) == (3, [0.5, None], True, "a=b")
    s1, s2, s3 = first.genotypes
    assert (s1.sampleId, s1.calls, s1.phased, s1.depth, s1.conditionalQuality) == ("S1", [0, 1], True, 12, 99)
    assert (s1.alleleDepths, s1.phredLikelihoods, s1.PS) == ([3, 4, None], [0, 1, 2, 3, 4, 5], None)
    assert (s2.calls, s2.phased, s2.depth, s2.alleleDepths) == ([-1, -1], False, None, None)
    assert (s3.calls, s3.depth, s3.conditionalQuality) == ([1, 2], None, 7)
    assert (second.names, second.alternateAlleles, second.qual, second.filters) == (None, [], None, None)
    assert (second.end, second.INFO_DB, second.INFO_DP) == (10, False, None)
    assert [g.calls for g in second.genotypes] == [[0], [-1], [2, 0, 1]]


def test_info_end_and_repeated_key(spark, tmp_path):
    vcf(tmp_path / "a.vcf", [info("DP", 1, "Integer"), info("END", 1, "Integer")],
        [line("1", 100, ".", "N", "<DEL>", ".", "PASS", "END=500;DP=1;DP=2")])
    row = lf.read_vcf(spark, str(tmp_path)).first()
    assert (row.start, row.end, row.INFO_END, row.INFO_DP) == (99, 500, 500, 1)


def test_crlf_and_gzip(spark, tmp_path):
    body = [line("1", 7, ".", "A", "T", ".", ".", "DP=2")]
    vcf(tmp_path / "crlf.vcf", [info("DP", 1, "Integer")], body, newline="\r\n")
    vcf(tmp_path / "packed.VCF.gz", [info("DP", 1, "Integer")], body)
    rows = lf.read_vcf(spark, str(tmp_path), mode="fail").collect()
    assert [(r.start, r.INFO_DP) for r in rows] == [(6, 2), (6, 2)]


def test_gzip_lines_are_spread_over_tasks(spark, tmp_path):
    vcf(tmp_path / "big.vcf.gz", [], [line("1", i + 1, ".", "A", "T", ".", ".", ".") for i in range(3000)])
    df = lf.read_vcf(spark, str(tmp_path), gz_spread_bytes=2000)
    assert df.count() == 3000
    assert df.select(F.spark_partition_id()).distinct().count() > 1


def test_headers_merge_over_files(spark, tmp_path):
    vcf(tmp_path / "a.vcf", [info("X", 1, "Integer"), info("Y", 1, "Float"), info("F", 0, "Flag")],
        [line("1", 1, ".", "A", "T", ".", ".", "X=1;Y=0.5")])
    vcf(tmp_path / "b.vcf", [info("X", 1, "Float"), info("Y", ".", "Float"), fmt("GT", 1, "String")],
        [line("2", 1, ".", "A", "T", ".", ".", "X=1.5;Y=1,2", "GT", "0/1")], ["other"])
    df = lf.read_vcf(spark, str(tmp_path))
    assert df.schema["INFO_X"].dataType == T.DoubleType()
    assert df.schema["INFO_Y"].dataType == T.ArrayType(T.DoubleType())
    a, b = df.orderBy("contigName").collect()
    assert (a.INFO_X, a.INFO_Y, a.INFO_F, a.genotypes) == (1.0, [0.5], False, None)
    assert (b.INFO_X, b.INFO_Y, b.INFO_F) == (1.5, [1.0, 2.0], None)
    assert [g.sampleId for g in b.genotypes] == ["other"]


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, 300])
def test_samples_stay_with_their_file(spark, tmp_path, broadcast_bytes):
    for i in range(9):
        vcf(tmp_path / f"f{i}.vcf", [fmt("GT", 1, "String")],
            [line("1", i + 1, ".", "A", "T", ".", ".", ".", "GT", "0/1")], [f"sample{i // 2}"])
    df = lf.read_vcf(spark, str(tmp_path), broadcast_bytes=broadcast_bytes)
    rows = df.select("start", F.explode("genotypes.sampleId").alias("s")).orderBy("start").collect()
    assert [tuple(r) for r in rows] == [(i, f"sample{i // 2}") for i in range(9)]


def test_the_plan_does_not_grow_with_the_files(spark, tmp_path):
    sizes = []
    for many in (3, 30):
        folder = tmp_path / str(many)
        folder.mkdir()
        for i in range(many):
            vcf(folder / f"f{i}.vcf", [fmt("GT", 1, "String")], [line("1", 1, ".", "A", "T", ".", ".", ".", "GT", "0/1")], [f"s{i}"])
        for bound in (64 << 20, 300):
            plan = lf.read_vcf(spark, str(folder), broadcast_bytes=bound)._jdf.queryExecution().optimizedPlan()
            sizes.append((bound, plan.collectLeaves().size(), plan.toString().count("Join")))
    assert sizes[:2] == sizes[2:]


def test_calls_of_a_wide_file_in_slices(spark, tmp_path):
    names = [f"s{k}" for k in range(10_000)]
    cells = [f"{k % 3}|{k % 2}:{k % 50}" if k % 7 else "./.:." for k in range(10_000)]
    lines = [line("1", p, ".", "A", alt, ".", ".", ".", "GT:DP", *cells) for p, alt in ((5, "C,G"), (9, "."), (12, "T"))]
    vcf(tmp_path / "wide.vcf", [fmt("GT", 1, "String"), fmt("DP", 1, "Integer")], lines, names)
    vcf(tmp_path / "sites.vcf", [], [line("2", 5, ".", "A", "T", ".", ".", ".")])
    whole = lf.variant_calls(lf.read_vcf(spark, str(tmp_path)), caller_fields=True)
    for width in (256, 9999, 20_000):
        sliced = lf.read_call_slices(spark, str(tmp_path), width)
        assert sliced.agg(F.max(F.size("genotypes"))).first()[0] == min(width, 10_000)
        calls = lf.variant_calls(sliced, caller_fields=True)
        assert calls.columns == whole.columns and calls.count() == 40_001
        assert calls.exceptAll(whole).count() == 0 == whole.exceptAll(calls).count()


def test_consequence_formats(spark, tmp_path):
    vcf(tmp_path / "a.vcf", [info("CSQ", ".", "String", "x. Format: Allele|Effect|Impact")],
        [line("1", 1, ".", "A", "T", ".", ".", "CSQ=T|missense|LOW,T||")])
    one = lf.read_vcf(spark, str(tmp_path)).first().INFO_CSQ
    assert [tuple(c) for c in one] == [("T", "missense", "LOW"), ("T", "", "")]
    vcf(tmp_path / "b.vcf", [info("CSQ", ".", "String", "x. Format: Impact|Allele")],
        [line("2", 1, ".", "A", "T", ".", ".", "CSQ=HIGH|T")])
    df = lf.read_vcf(spark, str(tmp_path))
    entries = {r.contigName: [c.asDict() for c in r.INFO_CSQ] for r in df.collect()}
    assert entries["1"][0] == {"Allele": "T", "Effect": "missense", "Impact": "LOW"}
    assert entries["2"][0] == {"Allele": "T", "Effect": None, "Impact": "HIGH"}


def test_consequences_without_format_stay_text(spark, tmp_path):
    vcf(tmp_path / "a.vcf", [info("CSQ", ".", "String")], [line("1", 1, ".", "A", "T", ".", ".", "CSQ=T|x,T|y")])
    flat = lf.consequences_flat(lf.read_vcf(spark, str(tmp_path)))
    assert sorted(r.CSQ_raw for r in flat.collect()) == ["T|x", "T|y"]


BAD = [
    line("1", "x", ".", "A", "T", ".", ".", "."),
    line("1", 5, ".", "A", "T", ".", "."),
    line("1", 5, ".", ".", "T", ".", ".", "."),
    line("1", 5, ".", "A", "T", "high", ".", "."),
    line("1", 5, ".", "A", "T", ".", ".", ".", "extra"),
]


def test_modes_for_malformed_lines(spark, tmp_path):
    vcf(tmp_path / "a.vcf", [], [line("1", 4, ".", "A", "T", ".", ".", "."), *BAD])
    assert lf.read_vcf(spark, str(tmp_path), mode="drop").count() == 1
    kept = lf.read_vcf(spark, str(tmp_path), mode="keep")
    good, rejected = lf.quarantine(kept)
    assert good.count() == 1
    assert sorted(r.raw for r in rejected.collect()) == sorted(BAD)
    assert good.count() + rejected.count() == 1 + len(BAD)
    with pytest.raises(Exception, match="malformed VCF line"):
        lf.read_vcf(spark, str(tmp_path), mode="fail").collect()
    with pytest.raises(ValueError, match="mode must be"):
        lf.read_vcf(spark, str(tmp_path), mode="other")


def test_file_without_header_has_no_good_line(spark, tmp_path):
    (tmp_path / "a.vcf").write_text(line("1", 4, ".", "A", "T", ".", ".", ".") + "\n")
    rows = lf.read_vcf(spark, str(tmp_path), mode="keep").collect()
    assert [r.corrupt_reason for r in rows] == ["file has no header"]


def test_headers_by_task_and_by_scan_agree(spark, tmp_path):
    vcf(tmp_path / "a b+c%.vcf", STANDARD, [line("1", 4, ".", "A", "T", ".", ".", ".", "GT", "0")], ["S"])
    vcf(tmp_path / "z.vcf.gz", [info("Q", 1, "Float")], [line("1", 4, ".", "A", "T", ".", ".", ".")])
    files = lf.discover_files(spark, str(tmp_path))
    direct, scan = (read_headers(spark, files, m).orderBy("source_file", "line").collect() for m in ("direct", "scan"))
    assert direct == scan and len(direct) == 3 + len(STANDARD) + 2
    assert merge_layout(read_headers(spark, files)).has_samples
    assert lf.read_vcf(spark, str(tmp_path)).select("source_file").distinct().count() == 2


def test_discovery(spark, tmp_path):
    for name in ("b.vcf", "a.VCF.gz", "notes.txt", "c.vcf.bak"):
        (tmp_path / name).write_bytes(b"x")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "x.vcf").write_bytes(b"x")
    names = lambda **kw: [r.filename for r in lf.discover_files(spark, str(tmp_path), **kw).collect()]
    assert names() == ["a.VCF.gz", "b.vcf"]
    assert names(only={"b.vcf", "absent.vcf"}) == ["b.vcf"]
    assert names(limit=1) == ["a.VCF.gz"]
    with pytest.raises(ValueError, match="no .vcf"):
        lf.discover_files(spark, str(tmp_path), only={"absent.vcf"})


def test_limit_and_only_reach_the_scan(spark, tmp_path):
    for i in range(4):
        vcf(tmp_path / f"f{i}.vcf", [], [line("1", i + 1, ".", "A", "T", ".", ".", ".")])
    assert sorted(r.start for r in lf.read_vcf(spark, str(tmp_path), limit=2).collect()) == [0, 1]
    assert [r.start for r in lf.read_vcf(spark, str(tmp_path), only=["f3.vcf"]).collect()] == [3]


def test_text_roundtrip(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    vcf(source / "a.vcf", STANDARD, [
        line("chr1", 5, "rs1", "A", "C,G", "30.5", "PASS", "DP=3;AF=0.5,0.1;DB;NOTE=x", "GT:DP:GQ:AD:PL:PS",
             "0|1:12:99:3,4,5:0,1,2,3,4,5:77", "./.:.:.:.:.:."),
        line("chr1", 9, ".", "AC", ".", ".", ".", "AF=.", "GT:DP:GQ:AD:PL:PS", "0:.:.:.:.:.", ".:1:2:3:4:5"),
    ], ["S1", "S2"])
    records = lf.read_vcf(spark, str(source))
    out = str(tmp_path / "out")
    lf.to_vcf_lines(records).select("line").write.text(out)
    again = lf.read_vcf(spark, out, mode="fail", suffixes=[".txt"])
    assert again.schema.fieldNames() == records.schema.fieldNames()
    drop = lambda df: sorted(map(repr, df.drop("source_file", "INFO_AF").collect()))
    assert drop(again) == drop(records)


def test_given_header_is_written(spark, tmp_path):
    path = vcf(tmp_path / "a.vcf", [info("DP", 1, "Integer", "original text")], [line("1", 4, ".", "A", "T", ".", ".", "DP=1")])
    header = file_header(spark, path)
    lines = [r.line for r in lf.to_vcf_lines(lf.read_vcf(spark, path), header).collect()]
    assert any("original text" in text for text in lines)
    assert lines.index(TITLE) == len(lines) - 2


def test_genotype_names_cover_the_reserved_fields():
    assert set(GENOTYPE_NAMES) == {"DP", "GQ", "AD", "PL", "GL"}
