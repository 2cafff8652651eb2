"""Hard negatives by an inverted multi-index over integer vectors.

For an anchor, its positives are the rows of the same label with the largest inner products; its negatives
for a positive are the largest rows of other labels whose inner product lies in a window given by the
positive's: ``low * positive <= 100 * negative <= high * positive``. Ties go to the smaller id. The result is
exact, and rows are pruned by bounds alone.

A vector is cut into two halves, and each half belongs to its nearest code of a codebook; a pair of codes is a
cell. The codebooks come from a bounded sample (``SAMPLE`` vectors, the first by a hash), every row is
indexed. Each code has a radius, the largest distance of any half that belongs to it, so the inner product of
an anchor with a row of a cell is at most the sum over both halves of anchor . code + |anchor| * radius. A
heap visits cells in the order of that sum (the multi-sequence algorithm), in rounds: the first up to a
``FIRST`` share of all rows, each next one ``GROWTH`` times as many. An anchor is done once its answers are
certified: enough were found and no cell that is left can reach the last of them, or none can reach the
windows. Only anchors not done go into the next round.

Rows are dealt into shards of neighbouring cells with at most ``SHARD`` rows, larger cells into several by a
hash, and anchors meet shards in blocks of at most ``BLOCK``, so a task holds one shard and one block whatever
the table. Of rows that agree in label and vector only as many of the smallest ids are kept as an answer can
hold. What the driver sees has the size of the codebooks.

Rows with a null id, label or vector, or with a null component, take no part. Rows equal in all three count
once; where an id repeats with another label or vector, each takes part, an anchor with each of its own, and
none is an "other row" of the same id. Vectors of unlike length never meet; those of length zero have inner
product zero. Inner products must fit 62 bits: larger ones raise. A window without rows, also that of a
negative positive score, gives no rows. Columns of other names are not read. An empty table gives an empty
result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from locusframe.scratch import materialize, scratch_path, scratch_run

#: Vectors the codebooks are fitted on, codes of a half, passes of the fit.
SAMPLE, CODES, PASSES = 4096, 32, 8
#: Rows of a shard, anchors of a block, share of the rows in the first round, growth of it.
SHARD, BLOCK, FIRST, GROWTH = 8192, 1024, 1 / 16, 4


@dataclass(frozen=True)
class Index:
    """What all tasks know of the rows of one vector length."""

    codebooks: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    counts: np.ndarray
    shard: np.ndarray
    pieces: np.ndarray

    @property
    def cut(self) -> int:
        return self.codebooks[0].shape[1]


def fit_codebook(halves: np.ndarray) -> np.ndarray:
    """Codes by Lloyd's algorithm, begun from evenly spread rows; a code without rows stays where it was."""
    codes = halves[np.unique(np.linspace(0, len(halves) - 1, min(CODES, len(halves))).astype(int))]
    for _ in range(PASSES):
        own = nearest_code(halves, codes)[0]
        sums = np.zeros_like(codes)
        np.add.at(sums, own, halves)
        n = np.bincount(own, minlength=len(codes))[:, None]
        codes = np.where(n > 0, sums / np.maximum(n, 1), codes)
    return codes


def nearest_code(halves: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nearest code of each half, and the distance from it."""
    away = (codes ** 2).sum(1)[None, :] - 2 * halves @ codes.T
    own = away.argmin(1)
    return own, np.linalg.norm(halves - codes[own], axis=1)


def half_bounds(anchor: np.ndarray, index: Index) -> list[np.ndarray]:
    """For each half the largest inner product a row of each code can have, rounding included."""
    halves = anchor[:index.cut].astype(float), anchor[index.cut:].astype(float)
    out = []
    for half, codes, radius in zip(halves, index.codebooks, index.radii):
        size = np.sqrt(half @ half)
        slack = 1e-9 * size * (np.sqrt((codes ** 2).sum(1)) + radius)
        out.append(codes @ half + size * radius + slack)
    return out


def visit(anchor: np.ndarray, index: Index, after: float, quota: float) -> tuple[float, np.ndarray]:
    """Cells in falling order of their bound, from below ``after``, until ``quota`` rows have been met since the start.

    Returns the bound below which nothing was visited (minus infinity if all rows were) and the visited cells
    that lie below ``after``. Cells of equal bounds are visited together.
    """
    first, second = half_bounds(anchor, index)
    order = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    a, b = first[order[0]], second[order[1]]
    heap, met, found, last = [(-(a[0] + b[0]), 0, 0)], 0, [], np.inf
    total = index.counts.sum()
    while heap and met < total:
        bound = -heap[0][0]
        if met >= quota and bound < last:
            return float(last), np.array(found, np.int64)
        _, i, j = heapq.heappop(heap)
        cell = int(order[0][i]) * len(second) + int(order[1][j])
        met += int(index.counts.flat[cell])
        last = bound
        if bound < after:
            found.append(cell)
        if j + 1 < len(b):
            heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
        if j == 0 and i + 1 < len(a):
            heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))
    return -np.inf, np.array(found, np.int64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of integer rows: in floating point while all sums are integers it holds, else in 64 bits."""
    most = float(np.abs(a).max(initial=0)) * float(np.abs(b).max(initial=0)) * max(a.shape[1], 1)
    if most < 2 ** 53:
        return (a.astype(float) @ b.astype(float).T).astype(np.int64)
    if most >= 2 ** 62:
        raise ValueError("inner products of these vectors do not fit 62 bits")
    return a @ b.T


def _matrix(packed: pd.Series, size: int) -> np.ndarray:
    return np.frombuffer(b"".join(packed), "<i8").reshape(len(packed), size)


def _encode(codebooks: dict[int, tuple[np.ndarray, np.ndarray]]):
    """The task that finds the cell of each row and packs its vector."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            for size, own in frame.groupby(frame["vector"].map(len)):
                vectors = np.stack(own["vector"].to_numpy()).reshape(len(own), size).astype(np.int64)
                cut = codebooks[size][0].shape[1]
                codes = [nearest_code(half.astype(float), book) for half, book in zip(
                    (vectors[:, :cut], vectors[:, cut:]), codebooks[size])]
                out = pd.DataFrame({
                    "size": np.full(len(own), size, np.int32), "c1": codes[0][0].astype(np.int32), "c2": codes[1][0].astype(np.int32),
                    "r1": codes[0][1], "r2": codes[1][1], "label": own["label"].to_numpy(np.int64), "ids": own["ids"].to_numpy(),
                    "packed": [v.tobytes() for v in vectors]})
                yield pa.RecordBatch.from_pandas(out, preserve_index=False, schema=pa.schema([
                    ("size", pa.int32()), ("c1", pa.int32()), ("c2", pa.int32()), ("r1", pa.float64()), ("r2", pa.float64()),
                    ("label", pa.int64()), ("ids", pa.list_(pa.int64())), ("packed", pa.binary())]))

    return run


ENCODED = "size int, c1 int, c2 int, r1 double, r2 double, label long, ids array<long>, packed binary"
ANCHOR = "anchor_row long, anchor_id long, label long, size int, packed binary, windows array<long>, after double"
VISIT = f"{ANCHOR}, until double, shards array<struct<shard:int,cells:array<int>>>"


def _plan(indexes: dict[int, Index], share: float):
    """The task that lists for each anchor the cells of this round, by shard."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            until, shards = [], []
            for row in frame.itertuples():
                index = indexes[row.size]
                total = index.counts.sum()
                bound, cells = visit(np.frombuffer(row.packed, "<i8"), index, row.after, max(SHARD, share * total))
                cells = cells[index.counts.flat[cells] > 0]
                by_shard: dict[int, list[int]] = {}
                for cell in cells.tolist():
                    for piece in range(index.pieces.flat[cell]):
                        by_shard.setdefault(int(index.shard.flat[cell]) + piece, []).append(cell)
                until.append(bound)
                shards.append([{"shard": k, "cells": v} for k, v in by_shard.items()])
            yield frame.assign(until=until, shards=shards)

    return run


def _best(scores: np.ndarray, ids: np.ndarray, own: int, k: int) -> list[tuple[int, int]]:
    """(score, id) of the ``k`` best entries of scores in any order, ids being lists, without the id ``own``."""
    taken = k + 1
    while True:
        if len(scores) > taken:
            at = np.flatnonzero(scores >= np.partition(scores, len(scores) - taken)[len(scores) - taken])
        else:
            at = np.arange(len(scores))
        rows = [(-s, i) for s, several in zip(scores[at].tolist(), ids[at]) for i in several if i != own]
        if len(rows) >= k or len(at) == len(scores):
            return [(-s, i) for s, i in heapq.nsmallest(k, rows)]
        taken *= 4  # an id that repeats with many vectors took the places


def _search(second: dict[int, int], k: int, low: int | None, high: int | None):
    """The task that scores the visited cells of a shard for a block of anchors; without a window for their positives."""
    def run(key: tuple, anchors: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(anchors) and len(members):
            size = int(members["size"].iloc[0])
            members = members.assign(cell=members["c1"].to_numpy(np.int64) * second[size] + members["c2"]).sort_values("cell", kind="stable")
            vectors, labels, cells = _matrix(members["packed"], size), members["label"].to_numpy(), members["cell"].to_numpy()
            ids = members["ids"].to_numpy()
            asked = _matrix(anchors["packed"], size)
            visited = np.zeros((len(anchors), len(members)), bool)
            for i, own in enumerate(anchors["cells"]):
                for begin, end in zip(np.searchsorted(cells, own), np.searchsorted(cells, own, side="right")):
                    visited[i, begin:end] = True
            used = np.flatnonzero(visited.any(0))
            for begin in range(0, len(anchors), 128):
                scores = products(asked[begin:begin + 128], vectors[used])
                for i, row in enumerate(anchors.iloc[begin:begin + 128].itertuples()):
                    here = visited[begin + i, used]
                    alike = labels[used] == row.label
                    if low is None:
                        at = np.flatnonzero(here & alike)
                        out += [(row.anchor_row, row.anchor_id, 0, s, n) for s, n in _best(scores[i, at], ids[used[at]], row.anchor_id, k)]
                        continue
                    at = np.flatnonzero(here & ~alike)
                    own = scores[i, at]
                    for window in set(row.windows):
                        inside = (100 * own >= low * window) & (100 * own <= high * window)
                        out += [(row.anchor_row, row.anchor_id, window, s, n) for s, n in _best(
                            own[inside], ids[used[at[inside]]], row.anchor_id, k)]
        return pd.DataFrame(out, columns=["anchor_row", "anchor_id", "window", "score", "other_id"]).astype("int64")

    return run


FOUND = "anchor_row long, anchor_id long, window long, score long, other_id long"


def _rounds(anchors: DataFrame, members: DataFrame, indexes: dict[int, Index], k: int, low: int | None,
            high: int | None) -> DataFrame:
    """The first ``k`` rows of each anchor and window, over as many rounds as it takes until all are certified."""
    spark = members.sparkSession
    active, found, share = anchors, None, FIRST
    second = {size: index.counts.shape[1] for size, index in indexes.items()}
    while True:
        visits = materialize(active.mapInPandas(_plan(indexes, share), VISIT), "visits")
        blocks = max(1, -(-visits.count() // BLOCK))
        every = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block")
        asked = visits.withColumn("at", F.explode("shards")).select(
            F.col("at.shard").alias("shard"), F.pmod(F.xxhash64("anchor_row"), F.lit(blocks)).cast("int").alias("block"),
            "anchor_row", "anchor_id", "label", "packed", "windows", F.col("at.cells").alias("cells"))
        held = members.select("shard", every, "size", "c1", "c2", "label", "ids", "packed")
        now = asked.groupBy("shard", "block").cogroup(held.groupBy("shard", "block")).applyInPandas(_search(second, k, low, high), FOUND)
        now = now if found is None else now.unionByName(found)
        first = Window.partitionBy("anchor_row", "window").orderBy(F.desc("score"), "other_id")
        found = materialize(now.withColumn("nth", F.row_number().over(first)).where(F.col("nth") <= k).drop("nth"), "found")
        reached = found.groupBy("anchor_row", "window").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("least"))
        open_rows = visits.where(F.col("until") > float("-inf")).withColumn(
            "window", F.explode(F.array(F.lit(0).cast("long")) if low is None else F.array_distinct("windows"))).join(
                reached, ["anchor_row", "window"], "left")
        done = (F.coalesce("n", F.lit(0)) >= k) & (F.col("least") >= F.col("until"))
        if low is not None:  # nothing that is left reaches the window
            done = done | (F.lit(low) * F.col("window") >= 100 * F.col("until")) | (F.lit(low) * F.col("window") > F.lit(high) * F.col("window"))
        left = open_rows.where(~F.coalesce(done, F.lit(False))).select("anchor_row").distinct()
        active = materialize(visits.join(left, "anchor_row", "left_semi").select(
            "anchor_row", "anchor_id", "label", "size", "packed", "windows", F.col("until").alias("after")), "active")
        if active.isEmpty():
            return found
        share = min(1.0, share * GROWTH)


def build(entries: DataFrame) -> tuple[DataFrame, dict[int, Index]]:
    """Written rows with their shard, and an index for each vector length, of written entries (label, vector, ids)."""
    sizes = [r[0] for r in entries.select(F.size("vector")).distinct().collect()]
    codebooks = {}
    for size in sizes:
        sample = entries.where(F.size("vector") == size).orderBy(F.xxhash64("vector"), "vector", "label").limit(SAMPLE)
        rows = [list(r.vector) for r in sample.select("vector").collect()]
        rows = np.array(rows, float).reshape(len(rows), size)
        codebooks[size] = fit_codebook(rows[:, :size // 2]), fit_codebook(rows[:, size // 2:])
    encoded = materialize(entries.mapInArrow(_encode(codebooks), ENCODED), "encoded")
    measured = encoded.groupBy("size", "c1", "c2").agg(
        F.count(F.lit(1)).alias("n"), F.max("r1").alias("r1"), F.max("r2").alias("r2")).collect()
    indexes, shards = {}, 0
    for size in sizes:
        shape = tuple(len(book) for book in codebooks[size])
        counts, radii = np.zeros(shape, np.int64), (np.zeros(shape[0]), np.zeros(shape[1]))
        for r in measured:
            if r["size"] == size:
                counts[r.c1, r.c2] = r.n
                radii[0][r.c1], radii[1][r.c2] = max(radii[0][r.c1], r.r1), max(radii[1][r.c2], r.r2)
        shard, pieces, room = np.zeros(shape, np.int64), np.ones(shape, np.int64), 0
        for cell, n in enumerate(counts.ravel().tolist()):
            if n > room:
                pieces.flat[cell] = max(1, -(-n // SHARD))
                shard.flat[cell], room = shards, (SHARD - n if n <= SHARD else 0)
                shards += int(pieces.flat[cell])
            else:
                shard.flat[cell], room = max(shards - 1, 0), room - n
        indexes[size] = Index(codebooks[size], radii, counts, shard, pieces)
    spark = entries.sparkSession
    homes = [(size, i, j, int(index.shard[i, j]), int(index.pieces[i, j])) for size, index in indexes.items()
             for i, j in zip(*(x.tolist() for x in np.nonzero(index.counts)))]
    table = spark.createDataFrame(homes, "size int, c1 int, c2 int, home int, pieces int")
    # As many rows as there are cells, at most CODES squared for each vector length.
    placed = encoded.join(F.broadcast(table), ["size", "c1", "c2"]).withColumn(
        "shard", F.col("home") + F.pmod(F.xxhash64("packed", "label"), F.col("pieces")).cast("int"))
    return materialize(placed.drop("home", "pieces", "r1", "r2"), "index"), indexes


def hard_negatives(vectors: DataFrame, is_anchor: Column, positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                   id_col: str = "vec_id", label_col: str = "label", vector_col: str = "vector") -> DataFrame:
    """Per anchor, positive and rank: anchor_id, positive_id, rank (from 1), negative_id, positive_score, negative_score.

    ``vector_col`` holds integers; ``low`` and ``high`` are hundredths of the positive's inner product.
    """
    spark: SparkSession = vectors.sparkSession
    path = scratch_path(spark, "hard-negatives")
    with scratch_run(spark, "hard-negatives-steps"):
        whole = F.coalesce(F.forall(F.col(vector_col), lambda x: x.isNotNull()), F.lit(False))
        rows = vectors.where(F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & whole).select(
            F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("long").alias("label"),
            F.col(vector_col).cast("array<long>").alias("vector"), F.coalesce(is_anchor, F.lit(False)).alias("asks")).distinct()
        rows = materialize(rows, "rows")
        most = max(positives, negatives) + 1
        salted = Window.partitionBy("label", "vector", "salt").orderBy("vec_id")
        few = rows.select("label", "vector", "vec_id", F.pmod(F.xxhash64("vec_id"), F.lit(64)).alias("salt")).withColumn(
            "nth", F.row_number().over(salted)).where(F.col("nth") <= most)
        entries = materialize(few.groupBy("label", "vector").agg(
            F.slice(F.sort_array(F.collect_set("vec_id")), 1, most).alias("ids")), "entries")
        members, indexes = build(entries)
        anchors = materialize(_packed_anchors(rows.where("asks")), "anchors")
        best = _rounds(anchors, members, indexes, positives, None, None)
        best = materialize(best.select("anchor_row", "anchor_id", F.col("other_id").alias("positive_id"),
                                       F.col("score").alias("positive_score")).distinct(), "best")
        windows = best.groupBy("anchor_row").agg(F.array_distinct(F.collect_list("positive_score")).alias("windows"))
        asking = materialize(anchors.drop("windows").join(windows, "anchor_row").select(
            "anchor_row", "anchor_id", "label", "size", "packed", "windows", "after"), "asking")
        hard = _rounds(asking, members, indexes, negatives, low, high)
        order = Window.partitionBy("anchor_row", "positive_id", "positive_score").orderBy(F.desc("negative_score"), "negative_id")
        joined = best.join(hard.select("anchor_row", F.col("window").alias("positive_score"), F.col("score").alias("negative_score"),
                                       F.col("other_id").alias("negative_id")), ["anchor_row", "positive_score"])
        joined.withColumn("rank", F.row_number().over(order).cast("int")).select(
            "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score").write.parquet(path)
    return spark.read.parquet(path)


def _packed_anchors(rows: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [np.array(v, "<i8").tobytes() for v in batch.column("vector").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("anchor_row"), batch.column("anchor_id"), batch.column("label"), batch.column("size"), pa.array(packed, pa.binary()),
                 pa.array([[]] * len(packed), pa.list_(pa.int64())), pa.array(np.full(len(packed), np.inf))],
                ["anchor_row", "anchor_id", "label", "size", "packed", "windows", "after"])

    narrow = rows.select(F.xxhash64("vec_id", "label", "vector").alias("anchor_row"), F.col("vec_id").alias("anchor_id"), "label",
                         F.size("vector").alias("size"), "vector")
    return narrow.mapInArrow(run, ANCHOR)
