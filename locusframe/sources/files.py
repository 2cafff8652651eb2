"""Find the input files of a directory.

Folders are listed by tasks through Arrow's file systems, or by the driver through Hadoop's where Arrow has none. So
every file of a folder is found whatever its name and size, nothing below it is, and a folder named ``day=1`` means
nothing.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions import basename

# File name endings that count as variant-call text, any case.
VCF_SUFFIXES = (".vcf", ".vcf.gz")
# File systems whose files a task opens by itself; others are read by Spark's text source alone.
DIRECT_SCHEMES = ("file", "hdfs", "s3", "s3a", "gs", "gcs", "abfs", "abfss")
# How names begin that Spark's sources leave out.
HIDDEN_PREFIXES = ("_", ".")

LISTING = "path string, length long"


def source_path() -> Column:
    """Path of the file a row was read from, as it is written in the file system (not URL-encoded)."""
    path = F.col("_metadata.file_path")
    return F.when(path.contains("%"), F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))).otherwise(path)


def parent(path: Column) -> Column:
    return F.regexp_replace(path, "/[^/]*$", "")


def is_hidden(path: Column) -> Column:
    """Whether Spark's sources leave out a file of that name."""
    return basename(path).substr(1, 1).isin(*HIDDEN_PREFIXES)


def has_suffix(path: Column, suffixes: Sequence[str]) -> Column:
    found = F.lit(False)
    for suffix in suffixes:
        found = found | F.lower(path).endswith(suffix.lower())
    return found


def suffix_glob(suffixes: Sequence[str]) -> str:
    """Glob for file names with one of the endings, in any case; files are dropped while listing."""
    def any_case(suffix: str) -> str:
        return "*" + "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)

    return "{" + ",".join(any_case(s) for s in suffixes) + "}"


@dataclass(frozen=True)
class Roots:
    """What the given paths stand for: folders, and single files with their lengths, all with scheme."""

    folders: tuple[str, ...]
    files: tuple[tuple[str, int], ...]

    @property
    def direct(self) -> bool:
        """Whether tasks can open everything below."""
        return all(path.partition(":")[0] in DIRECT_SCHEMES for path in [*self.folders, *(f for f, _ in self.files)])

    def globs(self, suffixes: Sequence[str]) -> list[str]:
        """Paths for Spark's readers that name the files of the folders one by one."""
        def plain(path: str) -> str:
            return "".join("\\" + c if c in "\\{}[]*?" else c for c in path)

        return [f"{plain(folder)}/{suffix_glob(suffixes)}" for folder in self.folders] + [plain(path) for path, _ in self.files]


def resolve_roots(spark: SparkSession, paths: str | Sequence[str]) -> Roots:
    """Paths may hold glob patterns; one that matches nothing is an error."""
    jvm, configuration = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    folders, files = [], []
    for given in [paths] if isinstance(paths, str) else paths:
        path = jvm.org.apache.hadoop.fs.Path(given)
        system = path.getFileSystem(configuration)
        found = [system.getFileStatus(path)] if system.exists(path) else list(system.globStatus(path) or ())
        if not found:
            raise ValueError(f"no such path: {given}")
        for status in found:
            name = status.getPath().toString()
            if status.isDirectory():
                folders.append(name)
            else:
                files.append((name, status.getLen()))
    return Roots(tuple(dict.fromkeys(folders)), tuple(dict.fromkeys(files)))


def _lister():
    """The task that lists folders. It is a nested function so that it travels to the workers with its body."""
    def run(batches: Iterator) -> Iterator:
        from urllib.parse import quote

        import pyarrow as pa
        from pyarrow import fs

        schema = pa.schema([("path", pa.string()), ("length", pa.int64())])
        for batch in batches:
            for folder in batch.column(0).to_pylist():
                uri = quote(folder.replace("s3a://", "s3://", 1), safe="/:@!$&'()*+,;=~")
                system, inner = fs.FileSystem.from_uri(uri)
                found = [x for x in system.get_file_info(fs.FileSelector(inner)) if x.type == fs.FileType.File]
                yield pa.RecordBatch.from_pydict(
                    {"path": [f"{folder}/{x.base_name}" for x in found], "length": [x.size for x in found]}, schema)

    return run


def list_folders(spark: SparkSession, roots: Roots) -> DataFrame:
    """path and length of every file directly below the folders, and of the single files."""
    single = spark.createDataFrame(list(roots.files), LISTING)
    if not roots.folders:
        return single
    if roots.direct:
        folders = spark.createDataFrame([(folder,) for folder in roots.folders], "path string")
        tasks = min(len(roots.folders), spark.sparkContext.defaultParallelism * 4)
        return folders.repartition(tasks).mapInArrow(_lister(), LISTING).unionByName(single)
    jvm, configuration = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    rows = []
    for folder in roots.folders:
        path = jvm.org.apache.hadoop.fs.Path(folder)
        rows += [(s.getPath().toString(), s.getLen()) for s in path.getFileSystem(configuration).listStatus(path) if s.isFile()]
    return spark.createDataFrame(rows, LISTING).unionByName(single)


def discover_files(
    spark: SparkSession, root: str | Sequence[str], suffixes: Sequence[str] = VCF_SUFFIXES,
    only: Iterable[str] | None = None, limit: int | None = None, required: bool = True,
) -> DataFrame:
    """path, filename and length of the matching files directly below ``root``, sorted by path.

    Empty files and names that begin with ``_`` or ``.`` are found too; file content is never read. ``only``
    keeps the given base names, ``limit`` the first paths. No match raises ValueError unless ``required`` is False.
    """
    listed = list_folders(spark, resolve_roots(spark, root)).where(has_suffix(F.col("path"), suffixes)).distinct()
    files = listed.select("path", basename(F.col("path")).alias("filename"), "length")
    if only is not None:
        files = files.where(F.col("filename").isin(sorted(set(only))))
    files = files.orderBy("path")
    if limit is not None:
        files = files.limit(limit)
    if required and files.isEmpty():
        raise ValueError(f"no {' or '.join(suffixes)} file found under {root if isinstance(root, str) else ', '.join(root)}")
    return files
