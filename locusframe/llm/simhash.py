"""Near duplicates by SimHash fingerprints, found with vantage-point trees.

A text is lower-cased (A-Z) and cut into words at ASCII white space; its shingles are three words, repeats
included (fewer words: all of them as one; none: fingerprint zero). A bit of the fingerprint is set if it is
set in more than half of the shingles' XXH64 values. Fingerprints link at ``RADIUS`` or fewer differing bits.

Equal fingerprints are one row from then on. A vantage-point tree over a bounded sample (``SAMPLE``
fingerprints, the first by a hash) says how the space is cut: a node has a point and a radius, fingerprints
within the radius go inside, those beyond the radius less ``RADIUS`` outside. By the triangle inequality any
two that link meet in at least one child: both distances differ by at most ``RADIUS``. Only fingerprints
whose ball crosses a boundary go to both. Each leaf is a shard, searched by one task, which goes on splitting
in the same way until a part is small enough to compare directly, and returns one link per member to the
smallest of its cluster, not all pairs.

Where no point splits a part any more (many fingerprints within a few bits of each other), links are found
over neighbours instead: two fingerprints link if some fingerprint is at most one bit from both, so each gives
its 65 neighbours and equal ones meet. Shards of more than ``SHARD_MOST`` rows take this way in a shuffle
keyed by neighbour, where a key has at most 65 members. Components are then joined over written tables.

Null and empty texts, and texts without words, have fingerprint zero and are linked like any other. An empty
table gives an empty result. Rows of equal id are rows of their own; a null id is kept, is no candidate for
the smallest id, and a group of null ids alone has a null component. Other columns are not read, whatever
their names. A very long text is hashed in blocks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from locusframe.llm.components import components
from locusframe.scratch import materialize, scratch_path, scratch_run

U64 = np.uint64
#: Fixed values of the fingerprint: seed of the hash, words of a shingle, bits that linked fingerprints may differ in.
SEED, SHINGLE, RADIUS = 42, 3, 2
#: Fingerprints the shared tree is built from; rows wanted in a shard; most rows of a shard that a task searches.
SAMPLE, SHARD, SHARD_MOST = 1 << 14, 1 << 14, 1 << 21
#: Parts of a shard compared directly; points tried for a split; rows a split is judged by; least gain of a split.
DIRECT, TRIED, JUDGED, GAIN = 512, 12, 1024, 0.85
#: Hashes counted at once, as a bound on memory; neighbour keys sorted at once.
HASHES_AT_ONCE, KEYS_AT_ONCE = 1 << 15, 1 << 23


def shingle_hashes(data: bytes) -> np.ndarray:
    """XXH64 of the shingles of a text."""
    from xxhash import xxh64_intdigest

    words = data.lower().split()  # of bytes: A-Z and ASCII white space alone
    if not words:
        return np.zeros(0, U64)
    joined = memoryview(b" ".join(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    width = min(SHINGLE, len(words))
    stops = ends[width - 1:]
    starts = np.concatenate([[0], ends[:len(stops) - 1] + 1])
    return np.fromiter((xxh64_intdigest(joined[a:b], SEED) for a, b in zip(starts.tolist(), stops.tolist())), U64, len(stops))


def majority(hashes: np.ndarray) -> int:
    """The bits set in more than half of the hashes."""
    counts = np.zeros(64, np.int64)
    for begin in range(0, len(hashes), HASHES_AT_ONCE):
        block = hashes[begin:begin + HASHES_AT_ONCE].astype("<u8")
        counts += np.unpackbits(block.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of each row; the 64 bits as a signed number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [majority(shingle_hashes(text.as_buffer().to_pybytes() if text.is_valid else b""))
                      for text in batch.column(1).cast(pa.large_binary())]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.array(prints, U64).view(np.int64))], ["doc_id", "fingerprint"])

    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    schema = T.StructType([T.StructField("doc_id", rows.schema["doc_id"].dataType), T.StructField("fingerprint", T.LongType())])
    return rows.mapInArrow(run, schema)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b)


def best_split(rows: np.ndarray) -> tuple[np.uint64, int] | None:
    """(point, radius) that makes the work of two children smallest, None if none makes it notably smaller.

    It is judged by evenly spread rows; the work of a child is taken as the square of its rows, those that
    go to both counted twice.
    """
    seen = rows[np.linspace(0, len(rows) - 1, min(len(rows), JUDGED)).astype(np.int64)]
    points = seen[np.linspace(0, len(seen) - 1, min(len(seen), TRIED)).astype(np.int64)]
    best, least = None, GAIN * len(seen) ** 2
    for point in points:
        below = np.cumsum(np.bincount(distance(seen, point), minlength=65))
        radius = np.arange(65)
        inside = below.astype(float)
        outside = len(seen) - np.where(radius >= RADIUS, below[np.maximum(radius - RADIUS, 0)], 0)
        work = inside ** 2 + outside ** 2
        at = int(work.argmin())
        if work[at] < least:
            best, least = (point, at), work[at]
    return best


def divide(rows: np.ndarray, point: np.uint64, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Masks of the rows inside and outside; both hold where a ball of ``RADIUS`` crosses the boundary."""
    away = distance(rows, point).astype(np.int16)
    return away <= radius, away > radius - RADIUS


def grow(sample: np.ndarray, share: float) -> list[tuple[int, int, int, int]]:
    """Nodes (point, radius, inside, outside) of a tree; children below zero are leaves, -1 the first.

    Splitting ends at parts of at most ``share`` of the sample, or where it gains nothing.
    """
    nodes: list[list[int]] = []
    leaves = 0
    stack = [(np.sort(sample), -1, 0)]
    while stack:
        rows, parent, side = stack.pop()
        split = best_split(rows) if len(rows) > max(share * len(sample), 2) else None
        if split is None:
            leaves += 1
            here = -leaves
        else:
            here = len(nodes)
            nodes.append([int(split[0]), split[1], 0, 0])
            inside, outside = divide(rows, *split)
            stack += [(rows[inside], here, 2), (rows[outside], here, 3)]
        if parent >= 0:
            nodes[parent][side] = here
    return [tuple(n) for n in nodes]


def place(rows: np.ndarray, nodes: list[tuple[int, int, int, int]]) -> Iterator[tuple[int, np.ndarray]]:
    """(leaf, rows) of every leaf that rows belong to or overlap."""
    stack = [(0 if nodes else -1, rows)]
    while stack:
        here, own = stack.pop()
        if not len(own):
            continue
        if here < 0:
            yield -here - 1, own
        else:
            point, radius, inside, outside = nodes[here]
            near, far = divide(own, U64(point), radius)
            stack += [(inside, own[near]), (outside, own[far])]


def forest(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of ``n`` members the smallest one it is connected with, by links of members ``a`` and ``b``."""
    label = np.arange(n)
    while True:
        la, lb = label[a], label[b]
        apart = la != lb
        if not apart.any():
            return label
        a, b, la, lb = a[apart], b[apart], la[apart], lb[apart]
        np.minimum.at(label, np.maximum(la, lb), np.minimum(la, lb))
        while True:
            up = label[label]
            if (up == label).all():
                break
            label = up


def neighbours(rows: np.ndarray) -> np.ndarray:
    """Each fingerprint and those one bit away, a row each."""
    return rows[:, None] ^ np.concatenate([[U64(0)], U64(1) << np.arange(64, dtype=U64)])


def _by_neighbours(rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links among distinct rows through common neighbours; keys are dealt into passes that fit in memory."""
    passes = 1
    while len(rows) * 65 // passes > KEYS_AT_ONCE:
        passes *= 2
    for number in range(passes):
        keys, owners = [], []
        for begin in range(0, len(rows), 1 << 14):
            near = neighbours(rows[begin:begin + (1 << 14)])
            own = ((near * U64(0x9E3779B97F4A7C15)) >> U64(40)) % U64(passes) == number
            keys.append(near[own])
            owners.append(begin + np.nonzero(own)[0])
        key, owner = np.concatenate(keys), np.concatenate(owners)
        order = np.argsort(key, kind="stable")
        key, owner = key[order], owner[order]
        same = np.flatnonzero(key[1:] == key[:-1])
        yield owner[same], owner[same + 1]


def _part_links(rows: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links among distinct rows that no split divides any more."""
    if len(rows) <= DIRECT:
        yield np.nonzero(np.triu(distance(rows[:, None], rows[None, :]) <= RADIUS, 1))
    else:
        yield from _by_neighbours(rows)


def local_clusters(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(fingerprint, smallest fingerprint of its cluster) of the rows that link with another one."""
    rows = np.unique(rows)
    stack, found = [np.arange(len(rows))], []
    while stack:
        part = stack.pop()
        split = best_split(rows[part]) if len(part) > DIRECT else None
        if split is not None:
            stack += [part[mask] for mask in divide(rows[part], *split)]
            continue
        for a, b in _part_links(rows[part]):
            label = forest(len(part), a, b)
            moved = np.flatnonzero(label != np.arange(len(part)))
            found.append((part[moved], part[label[moved]]))
    if not found:
        return rows[:0], rows[:0]
    label = forest(len(rows), *(np.concatenate(x) for x in zip(*found)))
    linked = np.flatnonzero(label != np.arange(len(rows)))
    return rows[linked], rows[label[linked]]


def _leaf_links(table: pa.Table) -> pa.Table:
    a, b = local_clusters(table.column("fingerprint").to_numpy().view(U64))
    return pa.table({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})


def links(prints: DataFrame, rows: int) -> DataFrame:
    """(a, b) links that connect all distinct fingerprints within ``RADIUS``; ``prints`` is a written table of ``rows`` rows."""
    spark = prints.sparkSession
    few = prints.orderBy(F.xxhash64("fingerprint"), "fingerprint").limit(SAMPLE).collect()
    nodes = grow(np.array([r.fingerprint for r in few], np.int64).view(U64), SHARD / max(rows, 1))

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for leaf, own in place(batch.column(0).to_numpy().view(U64), nodes):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(own), leaf, np.int32)), pa.array(own.view(np.int64))], ["leaf", "fingerprint"])

    dealt = materialize(prints.select("fingerprint").mapInArrow(deal, "leaf int, fingerprint long"), "dealt")
    sizes = {r.leaf: r["count"] for r in dealt.groupBy("leaf").count().collect()}
    crowded = [leaf for leaf, n in sizes.items() if n > SHARD_MOST]
    searched = dealt.where(~F.col("leaf").isin(crowded)) if crowded else dealt
    tasks = max(spark.sparkContext.defaultParallelism, sum(sizes.values()) // (4 * SHARD))
    found = searched.repartition(tasks, "leaf").groupBy("leaf").applyInArrow(_leaf_links, "a long, b long")
    if crowded:
        found = found.unionByName(links_by_neighbours(dealt.where(F.col("leaf").isin(crowded)).select("fingerprint").distinct()))
    return found


def links_by_neighbours(prints: DataFrame) -> DataFrame:
    """The links of fingerprints that no tree separates: those with a neighbour in common, at most 65 a key."""
    one_bit = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda k: F.col("fingerprint").bitwiseXOR(
        F.call_function("shiftleft", F.lit(1).cast("long"), k)))
    keyed = prints.select("fingerprint", F.explode(F.concat(F.array("fingerprint"), one_bit)).alias("key"))
    met = keyed.groupBy("key").agg(F.sort_array(F.collect_list("fingerprint")).alias("all")).where(F.size("all") > 1)
    return met.select(F.explode(F.slice("all", 2, 65)).alias("a"), F.col("all")[0].alias("b")).distinct()


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, fingerprint (16 hex digits), component_id, the smallest id reachable over links."""
    spark: SparkSession = docs.sparkSession
    prints = materialize(fingerprints(docs, id_col, text_col), "fingerprints")
    path = scratch_path(spark, "simhash-classes")
    with scratch_run(spark, "simhash-steps"):
        classes = materialize(prints.groupBy("fingerprint").agg(F.min("doc_id").alias("first_doc")), "classes")
        found = materialize(links(classes, classes.count()), "links")
        grouped = components(found).select(F.col("node").alias("fingerprint"), "component")
        members = materialize(classes.join(grouped, "fingerprint", "left").select(
            "fingerprint", "first_doc", F.coalesce("component", "fingerprint").alias("component")), "members")
        first = members.groupBy("component").agg(F.min("first_doc").alias("component_id"))
        members.join(first, "component").select("fingerprint", "component_id").write.parquet(path)
    # Plain tables on both sides, so that a fingerprint of very many rows is a skewed join that Spark can split.
    return prints.join(spark.read.parquet(path), "fingerprint").select(
        "doc_id", F.lpad(F.lower(F.hex("fingerprint")), 16, "0").alias("fingerprint"), "component_id")
