"""Best-fit decreasing packing of documents into sequences of bounded length.

Documents are tokenized in tasks and only narrow rows, one per piece, go on. Best-fit decreasing looks at
nothing but lengths, and a length is one of ``capacity`` numbers. So the plan is made from the histogram
of lengths, at most ``capacity`` counts whatever the corpus: equal bins are held as one run, and a segment
tree over remaining capacities finds the tightest run that takes a piece in logarithmic time. The plan
says which ranks among the pieces of a length go where; ranks come from a salted window, so a length
shared by a third of all pieces is spread over tasks.

A null or empty text is a document of one token, its end mark. The text of an added token is that token. Repeated
rows are packed once each. A very long text is encoded whole and cut into pieces. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F, types as T

from locusframe.llm.bpe import codec
from locusframe.scratch import materialize

#: Pieces of one length and salt are ranked together.
RANKED_TOGETHER = 20_000


class CapacityTree:
    """Segment tree over remaining capacities: which is the least one of at least ``need`` that is open?"""

    def __init__(self, capacity: int):
        self.size = 1 << capacity.bit_length()
        self.open = [False] * (2 * self.size)

    def set(self, capacity: int, is_open: bool) -> None:
        at = capacity + self.size
        self.open[at] = is_open
        while at > 1:
            at //= 2
            self.open[at] = self.open[2 * at] or self.open[2 * at + 1]

    def tightest(self, need: int) -> int | None:
        at = need + self.size
        if self.open[at]:
            return need
        while at > 1:
            if at % 2 == 0 and self.open[at + 1]:
                at += 1
                while at < self.size:
                    at = 2 * at if self.open[2 * at] else 2 * at + 1
                return at - self.size
            at //= 2
        return None


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Rows (length, first rank, first sequence, pieces per sequence, offset).

    From ``first rank`` on, pieces fill ``pieces per sequence`` places of one sequence after another, the
    first of them at ``offset``; the next row of the same length ends the range.
    """
    tree, runs, rows, bins = CapacityTree(capacity), defaultdict(list), [], 0

    def put(room: int, first: int, count: int) -> None:
        if room and count:
            runs[room].append((first, count))
            tree.set(room, True)

    for length in sorted(histogram, reverse=True):
        rank, left = 0, histogram[length]
        while left:
            room = tree.tightest(length)
            if room is None:
                first, count, room = bins, -(-left // (capacity // length)), capacity
                bins += count
            else:
                first, count = runs[room].pop()
                tree.set(room, bool(runs[room]))
            each = room // length  # a bin just used is the tightest one until it is full
            full = min(count, left // each)
            if full:
                rows.append((length, rank, first, each, capacity - room))
                rank, left = rank + full * each, left - full * each
                put(room - each * length, first, full)
            if left and full < count:
                rows.append((length, rank, first + full, left, capacity - room))
                put(room - left * length, first + full, 1)
                rank, left, full = rank + left, 0, full + 1
            put(room, first + full, count - full)
    return rows


def pieces(docs: DataFrame, path: str, capacity: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """Per piece: the id, piece, start, length, ids_crc32. Only documents over ``capacity`` are cut, short piece first."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    longs = ("piece", "start", "length", "ids_crc32")
    schema = T.StructType([rows.schema["doc_id"], *(T.StructField(c, T.LongType()) for c in longs)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe, end = codec(path, added=True), np.array([end_id], "<u4").tobytes()
        for batch in batches:
            row, out = [], {c: [] for c in longs}
            for at, data in enumerate(bpe.encode(batch.column(1).to_pylist())):
                data += end
                total, begin, number = len(data) // 4, 0, 0
                while begin < total:
                    length = (total - begin) % capacity or capacity
                    row.append(at)
                    for c, x in zip(longs, (number, begin, length, zlib.crc32(data[4 * begin:4 * (begin + length)]))):
                        out[c].append(x)
                    begin, number = begin + length, number + 1
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), *(pa.array(out[c], pa.int64()) for c in longs)],
                schema.names)

    return rows.mapInArrow(run, schema)


def pack(docs: DataFrame, path: str, capacity: int = 2048, end_id: int = 0, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset."""
    spark = docs.sparkSession
    cut = materialize(pieces(docs, path, capacity, end_id, id_col, text_col), "pieces")
    histogram = {r.length: r.n for r in cut.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}
    rows = plan(histogram, capacity)

    salts = max(256, -(-sum(histogram.values()) // RANKED_TOGETHER))
    cut = cut.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts)))
    before = Window.partitionBy("length").orderBy("salt").rowsBetween(Window.unboundedPreceding, -1)
    bases = cut.groupBy("length", "salt").agg(F.count(F.lit(1)).alias("n")).select(
        "length", "salt", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    order = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "start")
    ranked = cut.withColumn("nth", F.row_number().over(order) - 1).join(bases, ["length", "salt"]).withColumn(
        "rank", F.col("base") + F.col("nth"))

    # The plan has few rows per length, bounded by the capacity alone; each task finds its own by bisection.
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    shared = spark.sparkContext.broadcast(table)
    names = ("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
    schema = T.StructType([cut.schema["doc_id"], T.StructField("piece", T.IntegerType()),
                           *(T.StructField(c, T.LongType()) for c in names[2:])])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        shift = np.int64(1) << np.int64(44)  # a length and a rank as one sorted number
        keys = table[:, 0] * shift + table[:, 1]
        for batch in batches:
            piece, start, length, crc, rank = (batch.column(k).to_numpy() for k in range(1, 6))
            at = np.searchsorted(keys, length * shift + rank, side="right") - 1
            _, first_rank, first, each, offset = table[at].T
            sequence, place_in = np.divmod(rank - first_rank, each)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc),
                 pa.array(first + sequence), pa.array(offset + place_in * length)], list(names))

    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(place, schema)
