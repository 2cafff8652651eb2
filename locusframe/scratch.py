"""Shared scratch space used to cut lineage between the stages of a job.

A stage whose result is used more than once is written as Parquet below the folder named by
``spark.checkpoint.dir`` and read back, so a lost executor re-reads files and does not re-run the scan.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

#: Rows of a file of records, whose readers sort what they make of them.
RECORDS_PER_FILE = 25_000

_local_root: dict[str, str] = {}
_run_folder: ContextVar[str | None] = ContextVar("run_folder", default=None)


def scratch_root(spark: SparkSession) -> str:
    """Folder every executor can reach; a temporary one only for a local master without a setting."""
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if configured:
        return configured.rstrip("/")
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = context.applicationId
    if app not in _local_root:
        _local_root[app] = tempfile.mkdtemp(prefix="locusframe-")
    return _local_root[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    folder = _run_folder.get() or f"{scratch_root(spark)}/locusframe"
    return f"{folder}/{label}-{uuid.uuid4().hex}"


@contextmanager
def scratch_run(spark: SparkSession, label: str, keep: bool = False) -> Iterator[str]:
    """Collect everything written inside the block in one folder and remove it at the end."""
    folder = scratch_path(spark, label)
    token = _run_folder.set(folder)
    try:
        yield folder
    finally:
        _run_folder.reset(token)
        if not keep:
            remove_path(spark, folder)


def materialize(df: DataFrame, label: str, rows_per_file: int = 0) -> DataFrame:
    """Write ``df`` once and return the written table, with column metadata kept.

    ``rows_per_file`` bounds the rows of a task that reads the table: packed rows are small, so a split by bytes alone
    may hold millions of them, but each file counts at least ``spark.sql.files.openCostInBytes``.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("maxRecordsPerFile", rows_per_file).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder this package wrote, through the file system Spark itself uses."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
