"""FASTA tables and normalization, against plain loops."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

import locusframe as lf


def fasta(path, contigs, width=10, end="\n", last_end=True):
    text = ""
    for name, bases in contigs:
        text += f">{name}{end}" + "".join(bases[i:i + width] + end for i in range(0, len(bases), width))
    if not last_end:
        text = text[: -len(end)]
    path.write_bytes(text.encode())
    return str(path)


def plain_index(path):
    rows, offset = [], 0
    for raw in open(path, "rb").read().split(b"\n"):
        width = len(raw) + 1
        text = raw.decode().strip()
        if text.startswith(">"):
            rows.append([text[1:].split()[0], 0, offset + width, None, None])
        elif rows and text:
            row = rows[-1]
            row[1] += len(text)
            if row[3] is None:
                row[3], row[4] = len(text), width
        offset += width
    return [tuple(r) for r in rows]


CONTIGS = [("chr1 first one", "ACGTACGTACGTAC"), ("empty", ""), ("chr2", "ac" * 20), ("chr3", "G")]


@pytest.mark.parametrize("end,last_end", [("\n", True), ("\r\n", True), ("\n", False)])
@pytest.mark.parametrize("split", [1 << 20, 24])
def test_contig_index(spark, tmp_path, end, last_end, split):
    path = fasta(tmp_path / "ref.fa", CONTIGS, end=end, last_end=last_end)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", split)
    try:
        rows = lf.fasta_contig_index(spark, path).orderBy("offset").collect()
        chunks = lf.reference_chunks(spark, path, 8).orderBy("contigName", "chunk").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    expected = plain_index(path)
    got = [tuple(r) for r in rows]
    if not last_end:
        got, expected = [r[:4] for r in got], [r[:4] for r in expected]
    assert got == expected
    whole = {}
    for c in chunks:
        assert c.start == c.chunk * 8 and len(c.bases) <= 8
        whole[c.contigName] = whole.get(c.contigName, "") + c.bases
    assert whole == {n.split()[0]: b.upper() for n, b in CONTIGS if b}


def left_align(sequence, start, alleles):
    """The textbook loop: cut the shared last base, extend to the left when an allele is empty."""
    alleles = list(alleles)
    while True:
        if all(alleles) and len({a[-1] for a in alleles}) == 1:
            if min(map(len, alleles)) == 1 and start == 0:
                break
            alleles = [a[:-1] for a in alleles]
            if not all(alleles):
                start -= 1
                alleles = [sequence[start] + a for a in alleles]
        else:
            break
    while min(map(len, alleles)) > 1 and len({a[0] for a in alleles}) == 1:
        alleles, start = [a[1:] for a in alleles], start + 1
    return start, alleles


def random_records(rng, contigs, n):
    rows = []
    while len(rows) < n:
        name = rng.choice(list(contigs))
        seq = contigs[name]
        start = rng.randrange(len(seq)) if rng.random() < 0.8 else rng.randrange(4)
        ref = seq[start:start + rng.randint(1, 6)]
        alts = []
        for _ in range(rng.choice([1, 1, 1, 2])):
            kind = rng.random()
            if kind < 0.4 and len(ref) > 1:
                alts.append(ref[rng.randrange(1, len(ref)):])
            elif kind < 0.7:
                alts.append(ref[: rng.randint(0, len(ref))] + ref[rng.randrange(len(ref)):] + ref[-1])
            else:
                alts.append("".join(rng.choice("ACGT") for _ in range(rng.randint(1, 4))))
        if ref and all(alts) and len({ref, *alts}) == 1 + len(alts):
            rows.append((len(rows), name, start, start + len(ref), ref, alts))
    return rows


SCHEMA = "rec int, contigName string, start bigint, `end` bigint, referenceAllele string, alternateAlleles array<string>"


@pytest.mark.parametrize("broadcast_bytes", [64 << 20, 0])
@pytest.mark.parametrize("size", [16, 64])
def test_normalization_equals_the_loop(spark, tmp_path, size, broadcast_bytes):
    rng = random.Random(size)
    contigs = {
        "mixed": "".join(rng.choice("ACGT") for _ in range(400)),
        "repeats": "".join(rng.choice(["A", "AC", "CAC", "AAAA"]) for _ in range(200)),
        "runs": "".join(rng.choice("AC") * rng.randint(1, 90) for _ in range(12)),
        "single": "A" * 300,
    }
    path = fasta(tmp_path / "ref.fa", list(contigs.items()), width=13)
    rows = random_records(rng, contigs, 1500)
    df = spark.createDataFrame(rows, SCHEMA)
    chunks = lf.reference_chunks(spark, path, size)
    result = lf.normalize_variants(df, chunks, size, broadcast_bytes=broadcast_bytes)
    got = {r.rec: r for r in result.collect()}
    assert len(got) == len(rows)
    for rec, name, start, end, ref, alts in rows:
        want_start, want = left_align(contigs[name], start, [ref, *alts])
        row = got[rec]
        assert (row.start, row.referenceAllele, row.alternateAlleles) == (want_start, want[0], want[1:]), (name, start, ref, alts)
        assert row.end == want_start + len(want[0])
        assert row.normalizationStatus.errorMessage is None
        assert row.normalizationStatus.changed == ((want_start, want) != (start, [ref, *alts]))
    again = lf.normalize_variants(result, chunks, size)
    assert again.where("normalizationStatus.changed").count() == 0


def test_left_alone(spark, tmp_path):
    path = fasta(tmp_path / "ref.fa", [("c", "ACGTTTTTACGT" * 3)])
    rows = [
        (0, "c", 3, 4, "T", ["<DEL>"]),
        (1, "c", 3, 4, "T", ["*"]),
        (2, "c", 0, 2, "GG", ["G"]),
        (3, "other", 3, 5, "TT", ["T"]),
        (4, "c", 3, 4, "T", []),
        (5, "c", 35, 38, "TAA", ["A"]),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    result = lf.normalize_variants(df, lf.reference_chunks(spark, path, 8), 8).orderBy("rec").collect()
    for row, given in zip(result, rows):
        assert (row.start, row.end, row.referenceAllele, row.alternateAlleles) == given[2:]
        assert not row.normalizationStatus.changed
    messages = [r.normalizationStatus.errorMessage for r in result]
    assert messages[:2] == ["symbolic or unnamed allele"] * 2
    assert messages[2] == "REF differs from the reference"
    assert messages[3] == "no reference bases here"
    assert messages[4] is None


def test_one_hot_event(spark, tmp_path):
    """Copies of one event: they are resolved once and all get the answer, on either way back."""
    path = fasta(tmp_path / "ref.fa", [("c", "G" + "A" * 50)])
    df = spark.range(0, 5000, numPartitions=8).select(
        F.col("id").cast("int").alias("rec"), F.lit("c").alias("contigName"), F.lit(40).cast("bigint").alias("start"),
        F.lit(42).cast("bigint").alias("end"), F.lit("AA").alias("referenceAllele"), F.array(F.lit("A")).alias("alternateAlleles"))
    for limit, together in ((64 << 20, 100_000), (0, 100_000), (0, 700)):
        out = lf.normalize_variants(df, lf.reference_chunks(spark, path, 8), 8, broadcast_bytes=limit, copies_together=together)
        rows = out.groupBy("start", "referenceAllele", "alternateAlleles").count().collect()
        assert [tuple(r) for r in rows] == [(0, "GA", ["G"], 5000)]


@pytest.mark.parametrize("limit", [64 << 20, 0])
def test_every_reference_allele_is_checked(spark, tmp_path, limit):
    path = fasta(tmp_path / "r.fa", [("c", "GTTACAGT" * 3)])
    chunks = lf.reference_chunks(spark, path, 4)
    rows = [(0, "GTT", ["TTA"]), (0, "TTA", ["TTG"]), (3, "A", ["C"]), (3, "C", ["A"]), (5, "AGTG", ["AGTC"]), (5, "ACTG", ["ACTC"]),
            (1, "TT", ["T"]), (1, "TA", ["T"]), (100, "A", ["C"])]
    df = spark.createDataFrame([("c", s, s + len(r), r, a) for s, r, a in rows],
                               "contigName string, start long, end long, referenceAllele string, alternateAlleles array<string>")
    got = lf.normalize_variants(df, chunks, 4, broadcast_bytes=limit)
    flagged = {(r.start, r.referenceAllele): r.normalizationStatus.changed for r in got.collect()
               if r.normalizationStatus.errorMessage == "REF differs from the reference"}
    assert flagged == {(0, "TTA"): False, (3, "C"): False, (5, "ACTG"): False, (1, "TA"): False}
    assert got.where("normalizationStatus.errorMessage IS NULL").count() == 5
