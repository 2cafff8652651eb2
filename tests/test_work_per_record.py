"""What grows with the input: work repeated within a plan, rows of a task, tasks for small slices."""

from __future__ import annotations

import gzip

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import functions as F

import locusframe as lf
from locusframe.operators.normalize import _look_left
from locusframe.scratch import materialize
from locusframe.sources import vcf
from locusframe.sources.header import merge_layout, per_file
from locusframe.sources.ranges import read_ranges
from locusframe.sources.vcf import parse_by_file
from parity import fixtures as fx

HEADER = ["##fileformat=VCFv4.2", '##INFO=<ID=DP,Number=1,Type=Integer,Description="">', '##INFO=<ID=AC,Number=A,Type=Integer,Description="">',
          '##FORMAT=<ID=GT,Number=1,Type=String,Description="">', '##FORMAT=<ID=AD,Number=R,Type=Integer,Description="">',
          "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tS0"]


def parsed(spark, mode):
    lines = spark.createDataFrame([
        ("a", "1\t5\t.\tA\tC,G\t.\tPASS\tDP=3;AC=1,.\tGT:AD\t0/1:4,.,6"), ("a", "1\tx\t.\tA\tC\t.\tPASS\tDP=3\tGT\t0/1"),
        ("a", "1\t6\t.\tA\tC\t.\tPASS\tDP=y\tGT\t0/1"), ("a", "1\t7\t.\tA\tC\t.\tPASS\t.\tGT:AD\t0/1:4,z")], "source_file string, line string")
    headers = spark.createDataFrame([("a", line) for line in HEADER], "source_file string, line string")
    return parse_by_file(lines, per_file(headers), merge_layout(headers), mode)


def test_a_filter_on_the_fault_does_not_repeat_the_parse(spark):
    good, rejected = lf.quarantine(parsed(spark, "keep"))
    for df in (good, rejected, parsed(spark, "drop")):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert plan.count("split(line") == 1
    assert [(r.start, r.INFO_DP, r.INFO_AC, r.genotypes[0].alleleDepths) for r in good.collect()] == [(4, 3, [1, None], [4, None, 6])]
    assert {r.reason for r in rejected.collect()} == {
        "position is no number", "INFO DP is no Integer", "sample value that does not fit its FORMAT"}


def test_records_of_a_task_and_of_a_file_are_bounded(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(fx, "TASK_ROWS", 50)
    pq.write_table(pa.table({"o_orderkey": pa.array(range(1000), pa.int64())}), f"{tmp_path}/orders.parquet")
    assert fx.orders(spark, str(tmp_path)).rdd.getNumPartitions() == 20
    assert (fx.pieces(spark, str(tmp_path), 3), fx.pieces(spark, str(tmp_path), 30)) == (20, 30)


def test_small_slices_of_a_packed_file_share_tasks(spark, tmp_path):
    path = f"{tmp_path}/a.txt.gz"
    with gzip.open(path, "wt") as text:
        text.writelines(f"{i} {i * i}\n" for i in range(20_000))
    files = spark.createDataFrame([(path, len(open(path, "rb").read()), "packed")], "path string, length long, kind string")
    read = read_ranges(files, 1000)
    assert read.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    rows = read.select("slice", "line_number", "line").collect()
    assert len({r.slice for r in rows}) > 100
    assert [r.line for r in sorted(rows)] == [f"{i} {i * i}" for i in range(20_000)]


def test_events_are_aggregated_without_the_bases_of_their_chunks(spark):
    chunks = spark.createDataFrame([("1", 0, 0, "ACGTTTTT"), ("1", 1, 8, "TTTTACGT")], "contigName string, chunk long, start long, bases string")
    pending = spark.createDataFrame([("1", 9, ["TT", "T"], ["T", ""], 1, 9)],
                                    "contigName string, start long, alleles array<string>, cores array<string>, tail int, edge long")
    looked = _look_left(pending, chunks, 8, 2)
    plan = looked._jdf.queryExecution().optimizedPlan()
    assert plan.nodeName() == "Aggregate" and "bases" not in plan.children().head().output().toString()
    row = looked.first()
    assert (row.stop.edge, row.stop.base, row.lowest, row.known, row.matches) == (3, "G", 0, True, True)


def test_plain_lines_are_read_without_functions_on_lists_and_as_by_them(spark, monkeypatch):
    texts = ["DP=3;AC=1,.", "AC=.;DP=.", "DB", "DP=;DB", ".", "DP", "DP=1;DP=2", "NEW=1;DP=4", "END=9;DP=5", "DB=1", "DP=1;;DB", "ADP=1", "DP=+5"]
    cells = ["GT:AD\t0/1:4,.,6", "GT:AD\t.|1", "AD:GT\t1,2:./.", "AD:GT\t1", "GT\t0", "GT:AD\t0/1:+4", "GT:AD\t1|0/1:.", "AD\t,3", "GT:AD\t0/1: 4", ".\t.",
             "GT:AD\t:", "GT:AD\t0/1:4:5", "GT:AD\t0/1:0x1F", "GT:AD\tA/1:2", "GT:AD\t0/1:99999999999"]
    rows = [("a", f"1\t{k}\t.\tA\tC\t.\tPASS\t{texts[k % len(texts)]}\t{cells[k % len(cells)]}") for k in range(len(texts) * len(cells))]
    lines = spark.createDataFrame(rows, "source_file string, line string")
    flag = '##INFO=<ID=DB,Number=0,Type=Flag,Description="">'
    headers = spark.createDataFrame([("a", line) for line in [*HEADER[:-1], flag, HEADER[-1]]], "source_file string, line string")

    def read(mode):
        df = parse_by_file(lines, per_file(headers), merge_layout(headers), mode).select("*")
        return sorted(map(repr, df.collect())), df

    kept, df = read("keep")
    assert len(kept) == len(rows) and "ArrowEvalPython" in df._jdf.queryExecution().executedPlan().toString()
    dropped = read("drop")[0]
    monkeypatch.setattr(vcf, "read_samples", lambda *_: None)
    monkeypatch.setattr(vcf, "_is_plain", lambda layout, info: F.lit(False))
    assert read("keep")[0] == kept and read("drop")[0] == dropped and 0 < len(dropped) < len(kept)


def test_a_task_over_written_records_reads_a_bounded_number(spark):
    rows = spark.range(400_000, numPartitions=1)
    written = materialize(rows, "bounded", 5_000)
    assert len(written.inputFiles()) == 80
    most = 5_000 * ((128 << 20) // (4 << 20))
    per_task = written.groupBy(F.spark_partition_id()).count().agg(F.max("count"), F.sum("count")).first()
    assert per_task[0] <= most < 400_000 == per_task[1]
