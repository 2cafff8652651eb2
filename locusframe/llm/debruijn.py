"""Substring dedup by compaction of a De Bruijn graph over words.

A window of 35 words is an edge between the two windows of 34 words in it. A word goes if an edge that
covers it occurs twice or more, in one document or several. Edges that cannot repeat are left out first:
equal windows have the same minimizer, the 10 words in them with the least hash, and only windows whose
minimizer occurs twice become edges. Repeated edges are found by a group, get the coordinates of their first
occurrence as source, and are joined back to their occurrences. Where an occurrence runs along its source
edge by edge the path does not branch, and it is compacted into one span; a branch begins another span.
Every span is then verified: the words at its coordinates and at those of its source have equal digests. If
one has not (edges are 64-bit hashes), all is done again with another, independent hash, so the result is exact.

Equal texts are one node path each: they are found first by digest, one of them stands for all, and all of
them go whole, so a third of all rows being one text adds no edges.

A null text has no words. Texts of fewer than 35 words stay whole; a very long text, or word, is hashed whole in
its task. Rows are told apart by a number of their
own, so repeated rows are copies of each other. Null ids are kept. An empty table gives an empty result.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from locusframe.llm import exchange, hashing
from locusframe.scratch import materialize

WINDOW, MINIMIZER = 35, 10


def word_values(data: np.ndarray, salt: int) -> np.ndarray:
    return hashing.words(data, salt=salt)[0]


def _smallest(values: np.ndarray, width: int) -> np.ndarray:
    """Position of the first smallest of each ``width`` neighbouring values, in blocks of bounded memory."""
    found, block = [], 1 << 16
    for begin in range(0, len(values) - width + 1, block):
        part = values[begin:begin + block + width - 1]
        found.append(np.lib.stride_tricks.sliding_window_view(part, width).argmin(1) + np.arange(
            begin, begin + len(part) - width + 1))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def minimizers(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each window the position of its minimizer, and the hashes of all runs a minimizer may be."""
    grams = hashing.runs(values, MINIMIZER)
    return _smallest(grams, WINDOW - MINIMIZER + 1), grams


def _edges(copy: DataFrame, shared: str, skip: str, bits: int, salt: int) -> DataFrame:
    """Written rows (edge, row, pos) of the windows whose minimizer repeats."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers, skipped = exchange.Answers(shared), exchange.Answers(skip)
        for whole in batches:
            for number, part in exchange.segments(whole):
                out, keys, held = set(skipped.values(number, "row").tolist()), answers.keys(number, "keys"), []
                for row, text in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    if row in out:
                        continue
                    values = word_values(hashing.to_bytes(text), salt)
                    at, grams = minimizers(values)
                    places = np.flatnonzero(exchange.contains(keys, exchange.coarse(grams, bits))[at])
                    edges = hashing.runs(values, WINDOW, places) if len(places) else np.zeros(0, np.uint64)
                    held.append((edges.view(np.int64), np.full(len(edges), row), places))
                if held:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(x), pa.int64()) for x in zip(*held)], ["edge", "row", "pos"])

    return materialize(copy.select("batch", "row", "text").mapInArrow(run, "edge long, row long, pos long"), "edges")


def _spans(edges: DataFrame) -> DataFrame:
    """Written spans (row, start, edges, src_row, src_start) of repeated edges along their sources."""
    repeated = materialize(edges.groupBy("edge").agg(
        F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "pos")).alias("src")).where("n > 1").select(
        "edge", F.col("src.row").alias("src_row"), F.col("src.pos").alias("src_pos")), "repeated-edges")
    found = edges.join(repeated, "edge").select("row", "pos", "src_row", "src_pos")
    along = Window.partitionBy("row").orderBy("pos")
    goes_on = (F.lag("pos").over(along) == F.col("pos") - 1) & (F.lag("src_row").over(along) == F.col("src_row")) & (
        F.lag("src_pos").over(along) == F.col("src_pos") - 1)
    heads = found.withColumn("head", (~F.coalesce(goes_on, F.lit(False))).cast("int"))
    numbered = heads.withColumn("path", F.sum("head").over(along.rowsBetween(Window.unboundedPreceding, 0)))
    return materialize(numbered.groupBy("row", "path").agg(
        F.min("pos").alias("start"), F.count(F.lit(1)).alias("edges"), F.min("src_row").alias("src_row"),
        F.min("src_pos").alias("src_start")).drop("path"), "spans")


def _unverified(copy: DataFrame, spans: DataFrame) -> DataFrame:
    """Spans whose words are not those of their source."""
    away = spans.where("row <> src_row OR start <> src_start")
    asked = away.select("row", "start", "edges").unionByName(
        away.select(F.col("src_row").alias("row"), F.col("src_start").alias("start"), "edges")).distinct()
    wanted = exchange.write_answers(asked.withColumn("batch", F.shiftright("row", exchange.BATCH_BITS)), "asked-spans")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers = exchange.Answers(wanted)
        for whole in batches:
            for number, part in exchange.segments(whole):
                table = answers.of(number)
                if table is None or not table.num_rows:
                    continue
                of_row: dict[int, list] = {}
                for row, start, edges in zip(*(table.column(c).to_pylist() for c in ("row", "start", "edges"))):
                    of_row.setdefault(row, []).append((start, edges))
                out: tuple[list, ...] = ([], [], [], [])
                for row, text in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    words = text.encode().split() if row in of_row else []
                    for start, edges in of_row.get(row, ()):
                        digest = hashlib.sha256(b" ".join(words[start:start + edges + WINDOW - 1])).digest()
                        for values, value in zip(out, (row, start, edges, digest)):
                            values.append(value)
                yield pa.RecordBatch.from_arrays([*(pa.array(x, pa.int64()) for x in out[:3]), pa.array(out[3], pa.binary())],
                                                 ["row", "start", "edges", "digest"])

    digests = materialize(copy.select("batch", "row", "text").mapInArrow(
        run, "row long, start long, edges long, digest binary"), "span-digests")
    source = digests.select(F.col("row").alias("src_row"), F.col("start").alias("src_start"), "edges",
                            F.col("digest").alias("src_digest"))
    return away.join(digests, ["row", "start", "edges"]).join(source, ["src_row", "src_start", "edges"]).where(
        "digest <> src_digest")


def report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, n_words, n_removed, kept_sha256 of the kept words joined by one space."""
    copy = exchange.stable_copy(docs, id_col, text_col)
    seen = exchange.copies(copy)
    skip = exchange.write_answers(seen.where("row <> first_row").select("batch", "row"), "copied-rows")
    whole_rows = exchange.write_answers(seen.select("batch", "row"), "rows-with-copies")
    bits, salt = exchange.bucket_bits(copy, 0.02), 0
    while True:
        def keys_of(text: str, salt: int = salt) -> np.ndarray:
            at, grams = minimizers(word_values(hashing.to_bytes(text), salt))
            return grams[np.unique(at)]

        shared = exchange.shared_keys(copy, keys_of, bits, skip, "shared-minimizers", within=True)
        exchange.release(copy.sparkSession)
        spans = _spans(_edges(copy, shared, skip, bits, salt))
        if _unverified(copy, spans).isEmpty():
            break
        salt += 1
    found = exchange.write_answers(spans.select(
        F.shiftright("row", exchange.BATCH_BITS).alias("batch"), "row", "start", "edges"), "removed-spans")
    schema = T.StructType([copy.schema["doc_id"], T.StructField("n_words", T.LongType()),
                           T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        copied, answers = exchange.Answers(whole_rows), exchange.Answers(found)
        for whole in batches:
            for number, part in exchange.segments(whole):
                everywhere, of_row = set(copied.values(number, "row").tolist()), {}
                if (table := answers.of(number)) is not None:
                    for row, start, edges in zip(*(table.column(c).to_pylist() for c in ("row", "start", "edges"))):
                        of_row.setdefault(row, []).append((start, start + edges + WINDOW - 1))
                totals, removed, digests = [], [], []
                for row, text in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    words = text.encode().split()
                    total = len(words)
                    if row in everywhere and total >= WINDOW:
                        words = []
                    elif row in of_row:
                        kept, until = [], 0
                        for start, end in sorted(of_row[row]):
                            kept += words[until:max(until, start)]
                            until = max(until, end)
                        words = kept + words[until:]
                    totals.append(total)
                    removed.append(total - len(words))
                    digests.append(hashlib.sha256(b" ".join(words)).hexdigest())
                yield pa.RecordBatch.from_arrays(
                    [part.column(3), pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string())],
                    schema.names)

    return copy.select("batch", "row", "text", "doc_id").mapInArrow(run, schema)
