"""Approximate nearest neighbours with a permutation index.

A vector is represented by its nearest pivots in order. Two vectors close to each other see the pivots in a
similar order, so candidates are ranked by the footrule between orders: how far the places of the pivots of
a query are from their places in the other list, a pivot missing from it counting as the place after the
last. The best candidates are ranked again by the exact cosine.

Pivots come from a bounded sample (``PIVOTS`` vectors, the first by a hash of their content); every vector
is indexed. Vectors are dealt by hash into shards of about ``SHARD`` rows, each with an inverted file of its
pivots, and queries meet shards in blocks of at most ``QUERY_BLOCK``, so a task holds one shard and one
block whatever the table. Each shard gives its best candidates of each query, and these are merged.

Equal vectors are one entry, whose smallest ids answer for all: with k neighbours to find, no other copies
can be among them. Vectors that are null, zero, or hold null or non-finite components take no part, nor do
null ids. A component that overflows a double's norm is scaled first. Rows of equal id and vector count
once; with different vectors an id takes part with each of them, and a query with each. Vectors of unlike
length are never neighbours. Ties go to the smaller id. An empty table gives an empty result.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from locusframe.scratch import materialize

PIVOTS, NEAREST, SHARD, QUERY_BLOCK = 512, 64, 2048, 2048
#: Share of a shard that is ranked by the exact measure.
RERANKED = 0.3


def usable(vector: Column) -> Column:
    """Neither null nor zero, all components present and finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return vector.isNotNull() & (F.size(vector) > 0) & F.coalesce(finite, F.lit(False)) & F.exists(vector, lambda x: x != 0)


def unit(vectors: np.ndarray) -> np.ndarray:
    scaled = vectors / np.abs(vectors).max(1, keepdims=True)
    return scaled / np.sqrt(np.einsum("ij,ij->i", scaled, scaled))[:, None]


def orders(vectors: np.ndarray, pivots: np.ndarray, nearest: int) -> np.ndarray:
    """The numbers of the nearest pivots of each unit vector, nearest first."""
    return np.argsort(-(vectors @ pivots.T), axis=1, kind="stable")[:, :nearest]


def footrule(query_orders: np.ndarray, member_orders: np.ndarray, pivots: int) -> np.ndarray:
    """Footrule distances, a row per query, gathered from the inverted files of the queries' pivots."""
    nearest = member_orders.shape[1]
    by_pivot = np.argsort(member_orders.ravel(), kind="stable")
    members, places = np.divmod(by_pivot, nearest)
    begins = np.searchsorted(member_orders.ravel()[by_pivot], np.arange(pivots + 1))
    # As if no pivot were shared; each posting then takes its difference into account.
    alone = 2 * (nearest - np.arange(nearest)).sum()
    out = np.full((len(query_orders), len(member_orders)), alone, np.int32)
    for own, row in zip(query_orders, out):
        for place, pivot in enumerate(own):
            a, b = begins[pivot], begins[pivot + 1]
            row[members[a:b]] += (abs(places[a:b] - place) - (nearest - places[a:b]) - (nearest - place)).astype(np.int32)
    return out


def _search(pivot_rows: dict[int, np.ndarray], k: int):
    def run(key: tuple, queries: pd.DataFrame, members: pd.DataFrame) -> pd.DataFrame:
        names = ["query_row", "query_id", "vec_id", "score"]
        if queries.empty or members.empty:
            return pd.DataFrame({n: pd.Series(dtype=float if n == "score" else int) for n in names})
        q, m = (unit(np.stack(x["vector"].to_numpy()).astype(float)) for x in (queries, members))
        pivots = unit(pivot_rows[q.shape[1]])
        nearest = min(NEAREST, len(pivots))
        reranked = min(len(m), max(64, int(np.ceil(RERANKED * len(m)))))
        member_orders, out = orders(m, pivots, nearest), []
        ids, copies = members["ids"].to_numpy(), None
        for begin in range(0, len(q), 128):
            block = q[begin:begin + 128]
            distance = footrule(orders(block, pivots, nearest), member_orders, len(pivots))
            best = np.argpartition(distance, reranked - 1, axis=1)[:, :reranked]
            for j, chosen in enumerate(best):
                own = queries.iloc[begin + j]
                score = m[chosen] @ block[j]
                # Entries that can hold the k nearest besides the query's own, with all that tie.
                cut = np.sort(score)[::-1][min(k, len(score) - 1)]
                for c in np.flatnonzero(score >= cut - 1e-12):
                    for vec_id in ids[chosen[c]]:
                        if vec_id != own.query_id:
                            out.append((own.query_row, own.query_id, vec_id, chosen[c], begin + j))
        if not out:
            return pd.DataFrame({n: pd.Series(dtype=float if n == "score" else int) for n in names})
        rows = pd.DataFrame(out, columns=["query_row", "query_id", "vec_id", "m", "q"])
        raw_q, raw_m = (np.stack(x["vector"].to_numpy()).astype(float) for x in (queries, members))
        rows["score"] = cosine(raw_q[rows["q"]], raw_m[rows["m"]])
        rows = rows.sort_values(["query_row", "score", "vec_id"], ascending=[True, False, True])
        return rows[rows.groupby("query_row").cumcount() < k][names]

    return run


def cosine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row by row, in double precision."""
    dot, aa, bb = (np.einsum("ij,ij->i", x, y) for x, y in ((a, b), (a, a), (b, b)))
    plain = (aa > 1e-280) & (bb > 1e-280) & np.isfinite(aa) & np.isfinite(bb)
    with np.errstate(all="ignore"):
        return np.where(plain, dot / (np.sqrt(aa) * np.sqrt(bb)), np.einsum("ij,ij->i", unit(a), unit(b)))


def nearest(vectors: DataFrame, is_query: Column, k: int = 5, id_col: str = "vec_id",
            vector_col: str = "embedding") -> DataFrame:
    """Per query and rank: query_id, rank (from 1), vec_id, score, for the rows where ``is_query`` holds."""
    spark = vectors.sparkSession
    rows = vectors.where(usable(F.col(vector_col)) & F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"),
        F.coalesce(is_query, F.lit(False)).alias("asks")).distinct()
    rows = materialize(rows.withColumn("digest", F.xxhash64("vector")), "vectors")
    # Of equal vectors the k + 1 smallest ids are all that any answer can hold.
    per_vector = Window.partitionBy("vector", "salt").orderBy("vec_id")
    salted = rows.select("vector", "digest", "vec_id", F.pmod(F.xxhash64("vec_id"), F.lit(64)).alias("salt"))
    few = salted.withColumn("nth", F.row_number().over(per_vector)).where(F.col("nth") <= k + 1)
    members = few.groupBy("vector").agg(F.first("digest").alias("digest"), F.slice(
        F.sort_array(F.collect_list("vec_id")), 1, k + 1).alias("ids"))
    members = materialize(members, "members")
    sizes = [r.size for r in members.select(F.size("vector").alias("size")).distinct().collect()]
    pivots = {size: np.array([list(r.vector) for r in members.where(F.size("vector") == size).orderBy(
        "digest", "vector").limit(PIVOTS).select("vector").collect()]) for size in sizes}
    asks = rows.where("asks")
    counts = members.agg(F.count(F.lit(1)).alias("members")).crossJoin(asks.agg(F.count(F.lit(1)).alias("asks"))).first()
    shards, blocks = max(1, -(-counts.members // SHARD)), max(1, -(-counts.asks // QUERY_BLOCK))
    size = F.size("vector").alias("size")
    shard_of = F.pmod(F.xxhash64("digest", F.lit(1)), F.lit(shards)).alias("shard")
    block_of = F.pmod(F.xxhash64("vec_id", F.lit(2)), F.lit(blocks)).alias("block")

    def every(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long")))

    placed = members.select(size, shard_of, every(blocks).alias("block"), "vector", "ids")
    queries = asks.select(size, every(shards).alias("shard"), block_of,
                          F.xxhash64("vec_id", "digest").alias("query_row"), F.col("vec_id").alias("query_id"), "vector")
    key = ["size", "shard", "block"]
    found = queries.groupBy(*key).cogroup(placed.groupBy(*key)).applyInPandas(
        _search(pivots, k), "query_row long, query_id long, vec_id long, score double")
    best = Window.partitionBy("query_row", "query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select(
        "query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
