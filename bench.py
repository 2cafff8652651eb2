"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the tables (default /root/testdata/sf0.1), BENCH_CPUS the cores. Every query is run
in full into a sink that discards rows, or writes its tables where writing is the point. Text and FASTA
inputs are written before the clock starts. Each figure is the median of BENCH_RUNS runs (default 3)
after one run that warms up; whole ingests are run once after a warm-up on the smallest tables.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import SparkSession, functions as F

ROOT = Path(__file__).resolve().parent
sys.path.insert(0, str(ROOT))

import locusframe as lf  # noqa: E402
from locusframe.scratch import materialize  # noqa: E402
from parity import fixtures as fx  # noqa: E402
from parity.spark_queries import REGISTRY  # noqa: E402

PROJECTIONS = ("variants_flat", "consequences_flat", "variant_calls", "split_multiallelics", "explode_alleles",
               "variants_per_file", "recent_log_topk", "table_counts")


def session(cpus: str) -> SparkSession:
    base = tempfile.mkdtemp(prefix="locusframe-bench-")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("locusframe-bench")
        .config("spark.sql.shuffle.partitions", cpus if cpus.isdigit() else "8")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{base}/scratch")
        .config("spark.sql.warehouse.dir", f"{base}/warehouse")
        .config("spark.sql.maxConcurrentOutputFileWriters", "64")
        .getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(run, runs: int) -> float:
    run()
    seconds = []
    for _ in range(runs):
        begin = time.perf_counter()
        run()
        seconds.append(time.perf_counter() - begin)
    return round(statistics.median(seconds), 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = session(cpus)
    results: dict[str, float] = {}

    for name in PROJECTIONS:
        results[name] = timed(lambda: drain(REGISTRY[name](spark, sf_dir)), runs)

    records = materialize(fx.records(spark, sf_dir).drop("rec"), "records")
    text = fx.write_vcf(records, "text")
    results["read_vcf"] = timed(lambda: drain(lf.read_vcf(spark, text, mode="keep", suffixes=fx.TEXT)), runs)
    results["to_vcf_lines"] = timed(lambda: drain(lf.to_vcf_lines(records)), runs)
    results["pipe_cat"] = timed(lambda: drain(lf.pipe_partitions(records, ["cat"])[0]), 1)

    fasta = fx.write_fasta(spark, sf_dir)
    results["reference_chunks"] = timed(lambda: drain(lf.reference_chunks(spark, fasta, fx.CHUNK_SIZE)), runs)
    chunks = materialize(lf.reference_chunks(spark, fasta, fx.CHUNK_SIZE), "chunks")
    indels = materialize(fx.alleles(spark, sf_dir), "indels")
    results["normalize_variants"] = timed(lambda: drain(lf.normalize_variants(indels, chunks, fx.CHUNK_SIZE)), 1)

    small = str(Path(sf_dir).parent / "sf0.001")
    warm = fx.write_vcf(fx.records(spark, small).drop("rec"), "warm") if Path(small).exists() else text
    for label, options in (("ingest", {}), ("ingest_piped", {"pipe_cmd": ["cat"]})):
        lf.ingest(spark, lf.IngestConfig(warm, fx.database(spark), suffixes=fx.TEXT, **options))
        begin = time.perf_counter()
        log = lf.ingest(spark, lf.IngestConfig(text, fx.database(spark), suffixes=fx.TEXT, **options))
        results[label] = round(time.perf_counter() - begin, 3)
        assert log.where(F.col("status") != "processed").isEmpty()

    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(results.values()), 3), "unit": "sec",
        "queries": results, "sf": Path(sf_dir).name.removeprefix("sf"), "cpus": cpus, "spark": spark.version,
        "records": records.count(),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
