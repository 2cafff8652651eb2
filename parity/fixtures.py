"""Inputs of the registered queries, derived from the given tables by Spark."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from locusframe.scratch import scratch_path, scratch_root

TEXT = (".txt", ".txt.gz")
CONTIG_BLOCKS = 6400
BLOCK = 32
CHUNK_SIZE = 2048
#: Orders whose records one task makes; a file of text holds no more.
TASK_ROWS = 250_000

RECORDS = """
WITH o AS (SELECT *, CASE WHEN o_orderkey % 5 = 0 THEN 0 ELSE cast(1 + o_orderkey % 3 AS int) END AS n FROM {orders})
SELECT
  o_orderkey AS rec,
  concat('chr', cast(1 + o_custkey % 22 AS string)) AS contigName,
  o_orderkey * 50 AS start,
  o_orderkey * 50 + 1 AS `end`,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE array(concat('rs', cast(o_orderkey AS string))) END AS names,
  substr('ACGT', cast(1 + o_orderkey % 4 AS int), 1) AS referenceAllele,
  CASE WHEN n = 0 THEN cast(array() AS array<string>) ELSE
    transform(sequence(1, n), i -> substr('ACGT', cast(1 + (o_orderkey + i) % 4 AS int), 1)) END AS alternateAlleles,
  CASE WHEN o_orderstatus = 'P' THEN NULL ELSE o_totalprice END AS qual,
  array(CASE o_orderstatus WHEN 'F' THEN 'PASS' ELSE 'LowQual' END) AS filters,
  cast(o_custkey % 100 AS int) AS INFO_DP,
  o_orderkey % 2 = 0 AS INFO_DB,
  CASE WHEN n = 0 THEN cast(array() AS array<int>)
    ELSE transform(sequence(1, n), i -> cast((o_custkey + i) % 9 AS int)) END AS INFO_AC,
  CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE
    transform(filter(sequence(1, cast(1 + o_orderkey % 2 AS int)), i -> o_orderkey % 13 <> 0), i -> named_struct(
      'Allele', substr('ACGT', cast(1 + (o_orderkey + i) % 4 AS int), 1),
      'Consequence', CASE WHEN i = 1 THEN 'missense_variant' ELSE 'intron_variant' END,
      'Extra', named_struct('IMPACT', o_orderpriority, 'Flags', array(o_orderstatus, cast(i AS string))))) END AS INFO_CSQ,
  transform(sequence(0, 3), k -> named_struct(
    'sampleId', concat('S', cast(k AS string)),
    'calls', CASE WHEN (o_orderkey + k) % 17 = 0 THEN NULL ELSE
      array(cast((o_orderkey + k) % (n + 2) - 1 AS int), cast((o_orderkey + k * 3) % (n + 1) AS int)) END,
    'phased', CASE WHEN (o_orderkey + k) % 9 = 0 THEN NULL ELSE (o_orderkey + k) % 2 = 0 END,
    'depth', cast(10 + k AS int),
    'conditionalQuality', cast(o_custkey % 90 AS int),
    'alleleDepths', transform(sequence(0, n), j -> cast((o_orderkey + k + j) % 40 AS int)),
    'phredLikelihoods', transform(sequence(0, cast((n + 1) * (n + 2) / 2 AS int) - 1),
      j -> cast((o_orderkey + k + j) % 60 AS int)))) AS genotypes
FROM o
"""

LOG = """
SELECT concat('run', cast(o_custkey % 5 AS string)) AS run_id, cast(o_orderdate AS timestamp) AS run_ts,
  concat('/cohort/', cast(o_orderkey AS string), '.vcf') AS vcf_path,
  concat(cast(o_orderkey AS string), '.vcf') AS filename,
  CASE o_orderstatus WHEN 'F' THEN 'processed' ELSE 'skipped' END AS status,
  CASE o_orderstatus WHEN 'F' THEN 'write' ELSE 'read' END AS stage,
  o_orderkey % 2 = 0 AS pipe_enabled, 'cat' AS pipe_cmd, 'infer' AS pipe_header_mode,
  o_orderkey % 3 = 0 AS has_csq, o_orderkey % 4 <> 0 AS has_genotypes, o_orderkey AS variants_rows,
  o_orderkey * 4 AS calls_rows, o_orderkey * 2 AS csq_rows,
  CASE o_orderstatus WHEN 'F' THEN NULL ELSE concat('bad file of ', cast(o_custkey AS string)) END AS error
FROM {orders}
"""

REFERENCE_BLOCK = """
translate(md5(cast(o_orderkey AS string)), '0123456789abcdef',
  CASE WHEN (o_orderkey DIV 64) % 2 = 1 THEN 'AAACCCAAACCCACAC' ELSE 'ACGTACGTACGTACGT' END)
"""

# four kinds of variants inside each 32-base block, in the order of o_orderkey % 4: a deletion written
# with the base before it, one with the base after it, an insertion before a base, a padded substitution
ALLELES = """
SELECT o_orderkey AS rec, concat('ref', cast(o_orderkey DIV 6400 AS string)) AS contigName,
  (o_orderkey % 6400) * 32 + q AS start,
  CASE o_orderkey % 4 WHEN 2 THEN substr(b, q + 1, 1) WHEN 3 THEN substr(b, q + 1, len + 2)
    ELSE substr(b, q + 1, len + 1) END AS referenceAllele,
  array(CASE o_orderkey % 4 WHEN 0 THEN substr(b, q + 1, 1) WHEN 1 THEN substr(b, q + 1 + len, 1)
    WHEN 2 THEN concat(substr(b, q + 1, len), substr(b, q + 1, 1))
    ELSE concat(substr(b, q + 1, 1), translate(substr(b, q + 2, 1), 'ACGT', 'CGTA'), substr(b, q + 3, len)) END
  ) AS alternateAlleles
FROM (SELECT o_orderkey, {block} AS b, cast(o_orderkey % 20 AS int) AS q, cast(1 + o_orderkey % 3 AS int) AS len
  FROM {orders})
"""


def pieces(spark: SparkSession, sf_dir: str, least: int) -> int:
    """Tasks or files that the records are dealt to: ``least``, or as many as hold ``TASK_ROWS`` each."""
    return max(least, -(-spark.read.parquet(f"{sf_dir}/orders.parquet").count() // TASK_ROWS))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The orders table; a file with fewer splits than cores or wanted tasks is spread, since one row becomes a wide record."""
    df = spark.read.parquet(f"{sf_dir}/orders.parquet")
    tasks = pieces(spark, sf_dir, spark.sparkContext.defaultParallelism)
    return df.repartition(tasks, "o_orderkey") if df.rdd.getNumPartitions() < tasks else df


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested variant records, one per order, with four samples each."""
    return spark.sql(RECORDS, orders=orders(spark, sf_dir))


def sourced(df: DataFrame) -> DataFrame:
    """Records spread over seven source files, by record number."""
    part = (F.col("rec") % 7).cast("string")
    return df.withColumn("source_file", F.concat(F.lit("/cohort/set"), part, F.lit("/batch"), part, F.lit(".vcf")))


def file_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(LOG, orders=orders(spark, sf_dir))


def alleles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indels and padded substitutions that lie on the derived reference."""
    text = ALLELES.replace("{block}", REFERENCE_BLOCK)
    return spark.sql(text, orders=orders(spark, sf_dir)).withColumn("end", F.col("start") + F.length("referenceAllele"))


def write_fasta(spark: SparkSession, sf_dir: str) -> str:
    """The derived reference as FASTA text: a 32-base line per order, 6,400 lines to a contig.

    Contigs are whole within a part file, a part holds a range of them.
    """
    rows = orders(spark, sf_dir).select("o_orderkey", F.expr(REFERENCE_BLOCK).alias("bases"))
    contig = F.expr(f"o_orderkey DIV {CONTIG_BLOCKS}")
    name = F.concat(F.lit(">ref"), contig.cast("string"), F.lit(" derived from orders"))
    lines = F.when(F.col("o_orderkey") % CONTIG_BLOCKS == 0, F.array(name, F.col("bases"))).otherwise(F.array("bases"))
    text = rows.repartitionByRange(contig).sortWithinPartitions("o_orderkey").select(F.explode(lines).alias("value"))
    path = scratch_path(spark, "reference-text")
    text.write.text(path)
    return path


def write_vcf(df: DataFrame, label: str, header: bool = True) -> str:
    """Records as a folder of complete VCF texts; without ``header`` only their data lines."""
    from locusframe.sources.vcf_text import record_lines, to_vcf_lines

    path = scratch_path(df.sparkSession, label)
    lines = to_vcf_lines(df) if header else record_lines(df)
    lines.select("line").write.text(path)
    return path


def write_named(lines: DataFrame, label: str, names: list[str], empty: str) -> str:
    """A folder in which the lines of ``piece`` k are the file ``names[k]``, and one file is empty."""
    spark = lines.sparkSession
    path, jvm = scratch_path(spark, label), spark.sparkContext._jvm
    lines.repartition(len(names), "piece").write.partitionBy("piece").text(f"{path}-pieces")
    base = jvm.org.apache.hadoop.fs.Path(path)
    system = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for k, name in enumerate(names):
        target = jvm.org.apache.hadoop.fs.Path(f"{path}/{name}")
        system.mkdirs(target.getParent())
        parts = [s.getPath() for s in system.listStatus(jvm.org.apache.hadoop.fs.Path(f"{path}-pieces/piece={k}"))]
        system.rename(next(p for p in parts if p.getName().startswith("part-")), target)
    system.create(jvm.org.apache.hadoop.fs.Path(f"{path}/{empty}")).close()
    return path


def write_blocked(df: DataFrame, label: str) -> str:
    """Records as a folder of complete VCF texts in blocked gzip, a file for each partition."""
    from locusframe.sources.vcf_text import to_vcf_lines

    path = scratch_path(df.sparkSession, label)

    def write(batches):
        import zlib

        import pyarrow as pa
        from pyarrow import fs
        from pyspark import TaskContext

        system, inner = fs.FileSystem.from_uri(path)
        system.create_dir(inner)
        written, waiting = 0, b""
        with system.open_output_stream(f"{inner}/part-{TaskContext.get().partitionId():05d}.txt.gz", compression=None) as out:
            def block(text):
                packer = zlib.compressobj(6, zlib.DEFLATED, -15)
                body = packer.compress(text) + packer.flush()
                out.write(b"\x1f\x8b\x08\x04" + bytes(5) + b"\xff\x06\x00BC\x02\x00" + (len(body) + 25).to_bytes(2, "little") + body
                          + zlib.crc32(text).to_bytes(4, "little") + len(text).to_bytes(4, "little"))

            for batch in batches:
                for line in batch.column("line").to_pylist():
                    waiting += line.encode() + b"\n"
                    written += 1
                    while len(waiting) > 20000:
                        block(waiting[:20000])
                        waiting = waiting[20000:]
            block(waiting)
            block(b"")
        yield pa.RecordBatch.from_pydict({"n": pa.array([written], pa.int64())})

    to_vcf_lines(df).mapInArrow(write, "n long").collect()
    return path


def database(spark: SparkSession) -> str:
    """A fresh database below the scratch folder."""
    name = f"parity_{uuid.uuid4().hex[:12]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{scratch_root(spark)}/locusframe/{name}'")
    return f"spark_catalog.{name}"
