"""Files, values and order: every file is found, no value of a line vanishes, blocked archives are read in parts."""

from __future__ import annotations

import gzip
import random
import tracemalloc
import zlib

import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_reader import fmt, info, line, vcf

import locusframe as lf
from locusframe.operators.pipe import _command_runner
from locusframe.sources.ranges import _reader, file_kinds
from locusframe.sources.vcf import scan_lines


def blocked(text: bytes, size: int, level: int = 6) -> bytes:
    """Text as blocked gzip: members that state their size, and the empty one at the end."""
    out = b""
    for begin in [*range(0, len(text), size), None]:
        piece = b"" if begin is None else text[begin:begin + size]
        packer = zlib.compressobj(level, zlib.DEFLATED, -15)
        body = packer.compress(piece) + packer.flush()
        out += (b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff\x06\x00BC\x02\x00" + (len(body) + 25).to_bytes(2, "little") + body
                + zlib.crc32(piece).to_bytes(4, "little") + len(piece).to_bytes(4, "little"))
    return out


def read_by_ranges(path, kind, range_bytes, length):
    """What the tasks of a file read, one after the other."""
    found = []
    for number in range(max(1, -(-length // range_bytes))):
        row = {"path": [str(path)], "kind": [kind], "number": [number], "begin": [number * range_bytes], "end": [(number + 1) * range_bytes]}
        for batch in _reader(1 << 30)([pa.RecordBatch.from_pydict(row)]):
            found += [(r["slice"], r["line_number"], r["line"]) for r in batch.to_pylist()]
    return found


@pytest.mark.parametrize("kind", ["plain", "blocked"])
@pytest.mark.parametrize("range_bytes", [40, 1000, 70_000, 10**9])
def test_ranges_give_every_line_once_and_in_order(tmp_path, kind, range_bytes):
    rng = random.Random(range_bytes)
    for trial, last in enumerate(["", "\n", "\n\n", "x" * 5000]):
        lines = ["y" * rng.choice([0, 1, 5, 80, 900]) + str(k) for k in range(200)] + ["z" * 9000, "é\x85漢"]
        rng.shuffle(lines)
        text = ("\n".join(lines) + last).encode()
        path = tmp_path / f"{trial}.gz"
        data = blocked(text, rng.choice([64, 500, 7000]), rng.choice([0, 6])) if kind == "blocked" else text
        path.write_bytes(data)
        wanted = text.decode().split("\n")
        wanted = wanted[:-1] if not wanted[-1] else wanted
        found = read_by_ranges(path, kind, range_bytes, len(data))
        assert [x for _, _, x in found] == wanted
        assert found == sorted(found, key=lambda r: r[:2]) and len({r[:2] for r in found}) == len(found)


def test_text_that_looks_like_a_block_is_none(tmp_path):
    noise = b"\x1f\x8b\x08\x04" + bytes(6) + b"\x06\x00BC\x02\x00\x10\x00"
    text = b"\n".join(b"%d" % k + noise.replace(b"\n", b" ") * 3 for k in range(300)) + b"\n"
    data = blocked(text, 2000, 0)  # stored, so the noise stands in the file as it is
    path = tmp_path / "a.gz"
    path.write_bytes(data)
    assert len(read_by_ranges(path, "blocked", 500, len(data))) == 300


def test_kinds_and_damage(spark, tmp_path):
    good = blocked(b"a\nb\n" * 5000, 1000)
    for name, data in {"b.gz": good, "p.gz": gzip.compress(b"a\nb\n"), "t.vcf": b"a\n", "e.gz": b""}.items():
        (tmp_path / name).write_bytes(data)
    files = spark.createDataFrame([(str(tmp_path / n), 1) for n in ("b.gz", "p.gz", "t.vcf", "e.gz")], "path string, length long")
    assert {r.path[-4:]: r.kind for r in file_kinds(files).collect()} == {"b.gz": "blocked", "p.gz": "packed", ".vcf": "plain", "e.gz": "packed"}
    (tmp_path / "b.gz").write_bytes(good[:700] + b"??" + good[702:])
    with pytest.raises((ValueError, zlib.error)):
        read_by_ranges(tmp_path / "b.gz", "blocked", 10**9, len(good))


def test_blocked_archive_is_parsed_by_many_tasks(spark, tmp_path):
    plain = tmp_path / "plain.vcf"
    rows = [line("1", k + 1, f"rs{k}", "A", "T", ".", ".", f"DP={k}", "GT", "0/1") for k in range(4000)]
    vcf(plain, [info("DP", 1, "Integer"), fmt("GT", 1, "String")], rows, ["S"])
    folder = tmp_path / "in"
    folder.mkdir()
    (folder / "a.vcf.gz").write_bytes(blocked(plain.read_bytes(), 3000))
    df = lf.read_vcf(spark, str(folder), gz_spread_bytes=1000, range_bytes=2000, ordered=True)
    assert [(r.start, r.INFO_DP) for r in df.orderBy("slice", "line_number").collect()] == [(k, k) for k in range(4000)]
    assert df.select(F.spark_partition_id()).distinct().count() > 4
    whole = lf.read_vcf(spark, str(folder))
    assert whole.count() == 4000 and whole.select(F.spark_partition_id()).distinct().count() == 1


def test_every_file_of_a_folder_and_nothing_below(spark, tmp_path):
    rows = {name: [line("1", k + 1, ".", "A", "T", ".", ".", ".") for k in range(n)]
            for n, name in enumerate(("b.vcf", "_x.vcf", ".y.vcf", "it's [1] {2} 50%.vcf", "day=1/c.vcf", "deep.vcf/d.vcf"), 1)}
    for name, lines in rows.items():
        (tmp_path / name).parent.mkdir(exist_ok=True)
        vcf(tmp_path / name, [], lines)
    (tmp_path / "zero.vcf").write_bytes(b"")
    (tmp_path / "notes.txt").write_bytes(b"x")
    files = lf.discover_files(spark, str(tmp_path)).collect()
    assert [f.filename for f in files] == sorted(["b.vcf", "_x.vcf", ".y.vcf", "it's [1] {2} 50%.vcf", "zero.vcf"])
    assert {f.filename: f.length > 0 for f in files}["zero.vcf"] is False
    counted = lf.read_vcf(spark, str(tmp_path)).groupBy("source_file").count().collect()
    assert {r.source_file.rpartition("/")[2]: r["count"] for r in counted} == {n: len(x) for n, x in rows.items() if "/" not in n}
    assert {r.source_file for r in counted} <= {f.path for f in files}
    single = lf.discover_files(spark, [str(tmp_path / "day=1" / "c.vcf"), str(tmp_path / "_x.vcf")])
    assert [r.filename for r in single.collect()] == ["_x.vcf", "c.vcf"]
    assert lf.read_vcf(spark, [str(tmp_path / "day=1"), str(tmp_path / "_x.vcf")]).count() == 7
    assert lf.read_vcf(spark, str(tmp_path / "d*1")).count() == 5
    with pytest.raises(ValueError, match="no such path"):
        lf.discover_files(spark, str(tmp_path / "absent"))
    with pytest.raises(ValueError, match="names that begin with"):
        scan_lines(spark, str(tmp_path), direct=False)


def test_an_empty_file_has_a_log_row(spark, tmp_path, database):
    folder = tmp_path / "in"
    folder.mkdir()
    vcf(folder / "_a.vcf", [info("DP", 1, "Integer")], [line("1", 1, ".", "A", "T", ".", ".", "DP=3")])
    (folder / "zero.vcf").write_bytes(b"")
    log = {r.filename: (r.status, r.stage, r.variants_rows, r.error) for r in lf.ingest(spark, lf.IngestConfig(str(folder), database)).collect()}
    assert log == {"_a.vcf": ("processed", "write", 1, None), "zero.vcf": ("skipped", "read", None, "file has no header")}


HEADER = [info("DP", 1, "Integer"), info("AF", "A", "Float"), info("DB", 0, "Flag"), info("NOTE", 1, "String"),
          fmt("GT", 1, "String"), fmt("DP", 1, "Integer"), fmt("AD", "R", "Integer")]
GOOD = [
    ("DP=3;NEW=7;MARK;NEW=8;DB=x", {"NEW": "7,8", "MARK": None, "DB": "x"}),
    ("DP=3;DP=4;dp=5", {"DP": "4", "dp": "5"}),
    ("DP=.;AF=.,0.5;;NOTE=a=b;EMPTY=", {"EMPTY": ""}),
    ("SPLIT_FROM_MULTIALLELIC;END=9", None),
    (".", None),
]
BAD = [
    ("DP=abc", "GT:DP", "0/1:3", "INFO DP is no Integer"), ("AF=0.5,x", "GT:DP", "0/1:3", "INFO AF is no Float"),
    ("END=x", "GT:DP", "0/1:3", "INFO END is no Integer"), ("DP=1,2", "GT:DP", "0/1:3", "INFO DP is no Integer"),
    (".", "GT:XY", "0/1:3", "FORMAT key that no header declares"), (".", "GT:DP", "0/1:3:4", "sample value that does not fit its FORMAT"),
    (".", "GT:DP", "0/1:3.5", "sample value that does not fit its FORMAT"), (".", "GT:AD", "0/1:3,x", "sample value that does not fit its FORMAT"),
    (".", "GT:DP", "0/T:3", "sample value that does not fit its FORMAT"),
]


def test_no_value_vanishes(spark, tmp_path):
    good = [line("1", 5, ".", "A", "T", ".", ".", text, "GT:DP:AD", "0|1:.:3,.") for text, _ in GOOD]
    bad = [line("2", 5, ".", "A", "T", ".", ".", text, keys, cell) for text, keys, cell, _ in BAD]
    vcf(tmp_path / "a.vcf", HEADER, [*good, *bad], ["S"])
    kept, rejected = lf.quarantine(lf.read_vcf(spark, str(tmp_path), mode="keep", ordered=True))
    rows = kept.orderBy("line_number").collect()
    assert [r.undeclared_info for r in rows] == [extra for _, extra in GOOD]
    assert [(r.INFO_DP, r.INFO_AF) for r in rows[:3]] == [(3, None), (3, None), (None, [None, 0.5])]
    assert [g.asDict() for r in rows[:1] for g in r.genotypes] == [
        {"sampleId": "S", "calls": [0, 1], "phased": True, "depth": None, "alleleDepths": [3, None]}]
    assert {r.raw: r.reason for r in rejected.collect()} == {b: reason for b, (_, _, _, reason) in zip(bad, BAD)}
    assert lf.read_vcf(spark, str(tmp_path), mode="drop").count() == len(good)


@pytest.mark.parametrize("case", [0, 2, 4, 5, 7, 8])
def test_strict_reading_raises(spark, tmp_path, case):
    text, keys, cell, _ = BAD[case]
    vcf(tmp_path / "a.vcf", HEADER, [line("2", 5, ".", "A", "T", ".", ".", text, keys, cell)], ["S"])
    with pytest.raises(Exception, match="malformed VCF line in .*a.vcf"):
        lf.read_vcf(spark, str(tmp_path)).collect()


def test_undeclared_keys_become_columns_in_every_way_through(spark, tmp_path, database):
    folder = tmp_path / "in"
    folder.mkdir()
    vcf(folder / "a.vcf", HEADER[:4], [line("1", 5, ".", "A", "T", ".", ".", "DP=3;dp=low;MARK;odd key=1")])
    records = lf.read_vcf(spark, str(folder))
    flat = lf.variants_flat(records).first()
    assert flat.undeclared_info == '{"dp":"low","MARK":null,"odd key":"1"}'
    columns = lf.promote_undeclared(records).first().asDict()
    assert (columns["INFO_dp_2"], columns["INFO_MARK"], columns["INFO_odd key"]) == ("low", "true", "1")
    lines = [r.line for r in lf.to_vcf_lines(records).collect()]
    assert lines[-1].split("\t")[7] == "DP=3;dp=low;MARK;odd key=1"
    lf.ingest(spark, lf.IngestConfig(str(folder), database, pipe_cmd=["cat"]))
    row = spark.table(f"{database}.variants_flat").first().asDict()
    assert (row["INFO_DP"], row["INFO_MARK"], "undeclared_info" in row) == (3, "true", False)


def test_damaged_values_go_to_quarantine_in_an_ingest(spark, tmp_path, database):
    folder = tmp_path / "in"
    folder.mkdir()
    vcf(folder / "a.vcf", HEADER[:4], [line("1", 5, ".", "A", "T", ".", ".", "DP=x"), line("1", 6, ".", "A", "T", ".", ".", "DP=1")])
    log = lf.ingest(spark, lf.IngestConfig(str(folder), database)).first()
    assert (log.status, log.variants_rows) == ("processed", 1)
    assert [(r.raw.split("\t")[7], r.reason) for r in spark.table(f"{database}.vcf_pipe_quarantine").collect()] == [("DP=x", "INFO DP is no Integer")]


def feed(n, size, source="f"):
    text = "x" * size
    for begin in range(0, n, 1000):
        lines = [f"{k:09d}{text}" for k in range(n - begin, max(n - begin - 1000, 0), -1)]
        yield pa.RecordBatch.from_pydict({"source_file": [source] * len(lines), "title": ["#title"] * len(lines), "line": lines})


@pytest.mark.parametrize("cmd", [["sort"], ["cat"], ["tac"]])
def test_a_large_answer_does_not_fill_memory(cmd):
    n, size = 60_000, 1000
    tracemalloc.start()
    seen, last = 0, ""
    for batch in _command_runner(cmd, ["##header"], None)(feed(n, size)):
        assert batch.column("error").null_count == batch.num_rows
        lines = batch.column("line").to_pylist()
        seen += len(lines)
        if cmd == ["sort"]:
            assert [last, *lines] == sorted([last, *lines])
            last = lines[-1] if lines else last
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert seen == n + 2 and peak < 30 << 20


@pytest.mark.parametrize("cmd, lines", [("head -n 3", 3), ("exit 0", 0), ("exec 1>&-; sleep 0.5; cat > /dev/null", 0)])
def test_commands_that_stop_reading_or_answering(cmd, lines):
    batches = list(_command_runner(["/bin/sh", "-c", cmd], [], None)(feed(20_000, 500)))
    assert sum(b.num_rows - b.column("line").null_count for b in batches) == lines
    assert all(b.column("error").null_count == b.num_rows for b in batches)


def test_a_failing_command_says_why():
    batches = list(_command_runner(["/bin/sh", "-c", "cat > /dev/null; echo no good >&2; exit 4"], [], None)(feed(3000, 500)))
    errors = [e for b in batches for e in b.column("error").to_pylist() if e]
    assert errors == ["command ended with status 4: no good"]
