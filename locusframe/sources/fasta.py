"""FASTA files as tables: contig index and reference chunks.

A line's byte offset and base position come from running sums inside each input split plus the totals
of the splits before it, so a FASTA of any size is read in parallel and no task sees a whole contig.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from .files import source_path


def fasta_lines(spark: SparkSession, path: str) -> DataFrame:
    """Every line with its contig: file, header_offset, name, offset, width, is_header, bases, position.

    ``offset`` and ``width`` are bytes with the line ending counted, ``position`` is the 0-based position
    of the line's first base in its contig.
    """
    raw = spark.read.option("lineSep", "\n").text(path).select(
        source_path().alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("row"),
        F.col("value").startswith(">").alias("is_header"),
        F.rtrim(F.col("value"), F.lit("\r\n\t ")).alias("text"),
        (F.octet_length("value") + 1).cast("long").alias("width"),
    )
    raw = raw.withColumn("base_count", F.when(F.col("is_header"), 0).otherwise(F.length("text")).cast("long"))

    so_far = Window.partitionBy("file", "split").orderBy("row")
    before = so_far.rowsBetween(Window.unboundedPreceding, -1)
    up_to_here = so_far.rowsBetween(Window.unboundedPreceding, 0)
    lines = raw.withColumns({
        "offset": F.coalesce(F.sum("width").over(before), F.lit(0)),
        "bases_before": F.coalesce(F.sum("base_count").over(before), F.lit(0)),
    })
    header = F.when(F.col("is_header"), F.struct("offset", "bases_before", "text", "width"))
    lines = lines.withColumn("header", F.last(header, ignorenulls=True).over(up_to_here))

    # one row per split: what the splits before it add, and the header still open where it begins
    order = Window.partitionBy("file").orderBy("split")
    earlier = order.rowsBetween(Window.unboundedPreceding, -1)
    totals = lines.groupBy("file", "split").agg(
        F.sum("width").alias("bytes"), F.sum("base_count").alias("bases"),
        F.max(header).alias("last_header"))
    totals = totals.withColumns({
        "byte_base": F.coalesce(F.sum("bytes").over(earlier), F.lit(0)),
        "position_base": F.coalesce(F.sum("bases").over(earlier), F.lit(0)),
    })
    absolute = F.when(F.col("last_header").isNotNull(), F.struct(
        (F.col("last_header.offset") + F.col("byte_base")).alias("offset"),
        (F.col("last_header.bases_before") + F.col("position_base")).alias("bases_before"),
        F.col("last_header.text").alias("text"), F.col("last_header.width").alias("width")))
    totals = totals.select(
        "file", "split", "byte_base", "position_base",
        F.last(absolute, ignorenulls=True).over(earlier).alias("open_header"))

    joined = lines.join(totals, ["file", "split"])
    here = F.col("header").isNotNull()
    header_offset = F.when(here, F.col("header.offset") + F.col("byte_base")).otherwise(F.col("open_header.offset"))
    bases_at_header = F.when(here, F.col("header.bases_before") + F.col("position_base")) \
        .otherwise(F.col("open_header.bases_before"))
    text = F.when(here, F.col("header.text")).otherwise(F.col("open_header.text"))
    return joined.select(
        "file",
        header_offset.alias("header_offset"),
        F.regexp_extract(text, r"^>\s*(\S*)", 1).alias("name"),
        (F.col("offset") + F.col("byte_base")).alias("offset"),
        "width", "is_header",
        F.when(~F.col("is_header"), F.col("text")).alias("bases"),
        (F.col("bases_before") + F.col("position_base") - bases_at_header).alias("position"),
    ).where(F.col("header_offset").isNotNull())


def fasta_contig_index(spark: SparkSession, path: str) -> DataFrame:
    """name, length, offset, line_bases, line_width of every contig, as in a ``.fai`` file."""
    lines = fasta_lines(spark, path)
    is_base = ~F.col("is_header")
    at = F.when(is_base, F.col("offset"))
    index = lines.groupBy("file", "header_offset", "name").agg(
        F.coalesce(F.sum(F.length("bases")), F.lit(0)).alias("length"),
        F.max(F.when(F.col("is_header"), F.col("offset") + F.col("width"))).alias("offset"),
        F.min_by(F.length("bases"), at).alias("line_bases"),
        F.min_by("width", at).alias("line_width"),
    )
    return index.select("name", "length", "offset", "line_bases", "line_width")


def reference_chunks(spark: SparkSession, path: str, size: int = 8192) -> DataFrame:
    """The reference as a table: contigName, chunk, start, bases, each chunk ``size`` bases long.

    The last chunk of a contig may be shorter. Bases are upper case.
    """
    lines = fasta_lines(spark, path).where(~F.col("is_header") & (F.length("bases") > 0))
    first = F.call_function("div", F.col("position"), F.lit(size))
    last = F.call_function("div", F.col("position") + F.length("bases") - 1, F.lit(size))
    pieces = lines.select("name", "position", "bases", F.explode(F.sequence(first, last)).alias("chunk"))
    begin = F.greatest(F.col("chunk") * size, F.col("position"))
    end = F.least((F.col("chunk") + 1) * size, F.col("position") + F.length("bases"))
    piece = F.col("bases").substr((begin - F.col("position") + 1).cast("int"), (end - begin).cast("int"))
    grouped = pieces.groupBy(F.col("name").alias("contigName"), "chunk").agg(
        F.array_sort(F.collect_list(F.struct(begin.alias("at"), piece.alias("piece")))).alias("pieces"))
    return grouped.select(
        "contigName", "chunk", (F.col("chunk") * size).alias("start"),
        F.upper(F.array_join("pieces.piece", "")).alias("bases"))
