"""Size-aware n-gram Jaccard join: near-duplicate documents by heavy and light sets.

Two documents link when their shingle sets have a Jaccard similarity of at least 0.8. Equal sets are one
class. What remains is joined by size: of a light (small) set every pair from its leading shingles is
enumerated, two light sets that link have one such pair in common; a heavy (large) set scans inverted lists
of single leading shingles. The boundary between light and heavy is where the rows of the enumeration,
summed over all sets, meet those of the lists; since lists are stars, it is no set that more pairs come of than lists.

Leading means: rarest first, in an order all sets agree on. A set of n shingles shares at least
ceil(0.8 n) with any partner, so two sets that link share their k first common shingles among the first
n - ceil(0.8 n) + k of each, for every k. With k = n/5 this is also the filter that comes first: a set
whose leading shingles are not in other sets often enough has no partner and leaves, before any set is
shuffled. Lists never give all pairs: a list links its members to its first member, and members that this
does not settle are joined within bands of their distance to it, since the Jaccard distance is a metric. Both
steps hold a sketch of each set, counts of its shingles by classes of their hash, which bounds what two sets can
have in common; the few pairs that pass are verified on the sets. Every possible link between sets of different
components is thus checked.

A null text has no words, an empty set, and links with nothing. A text of fewer words than a shingle is one
shingle, if it has a word; a very long text, or word, is hashed whole in its task. Rows are told apart by a number of their own: repeated rows get equal results,
null ids are kept and do not count when the smallest id of a component is sought. An empty table gives an
empty result. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from locusframe.llm import exchange, hashing
from locusframe.llm.components import components
from locusframe.llm.steps import Steps
from locusframe.scratch import materialize

WORDS, LEAST_PERCENT = 5, 80
#: Shingles in at least this many sets go to the end of the order; at most HEAVY_LIST of them are told apart.
COMMON, HEAVY_LIST = 32, 1 << 17
#: Classes of a sketch, a power of two.
SKETCH = 256

_BY_PLACE = hashing.mix(np.arange(1, 65, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)


def shingles(text: str | None, size: int = WORDS) -> np.ndarray:
    """Sorted distinct hashes of the shingles of a text; letters A-Z count as a-z."""
    words, _, _ = hashing.words(hashing.to_bytes(text), lower=True)
    if not len(words):
        return words
    if len(words) < size:
        size = len(words)
        place = _BY_PLACE[32:32 + size]  # a short text equals no shingle of a longer one
    else:
        place = _BY_PLACE[:size]
    count = len(words) - size + 1
    total = np.zeros(count, np.uint64)
    for k in range(size):
        total += words[k:k + count] * place[k]
    return hashing.distinct(hashing.mix(total))


def least_common(n, percent: int = LEAST_PERCENT):
    """Shingles that a set of n shares with any partner at the least."""
    return -(-percent * n // 100)


def leading(n: int, k: int) -> int:
    return min(n, n - least_common(n) + k)


def _filter_k(n: int) -> int:
    return -(-n // 5)


def _survivors(copy: DataFrame, skip: str, steps: Steps) -> DataFrame:
    """Written rows (row, doc_id, n, tokens); tokens are null where no other set can be a partner.

    So are those of the rows that ``skip`` names, texts that an earlier row has as well.
    """
    bits = exchange.bucket_bits(copy, 0.07)

    def leads(text: str) -> np.ndarray:
        tokens = shingles(text)
        return tokens[:leading(len(tokens), _filter_k(len(tokens)))] if len(tokens) else tokens

    shared = exchange.shared_keys(copy, leads, bits, skip, "shared-shingles")
    exchange.release(copy.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers, skipped = exchange.Answers(shared), exchange.Answers(skip)
        for whole in batches:
            for number, part in exchange.segments(whole):
                out, keys, sizes, sets = set(skipped.values(number, "row").tolist()), answers.keys(number, "keys"), [], []
                for row, text in zip(part.column(1).to_pylist(), part.column(2).to_pylist()):
                    tokens = shingles(text)
                    n = len(tokens)
                    # The smallest partner may have looked at fewer of the common shingles.
                    need = _filter_k(least_common(n))
                    head = tokens[:leading(n, _filter_k(n))]
                    some = n and row not in out and exchange.contains(keys, exchange.coarse(head, bits)).sum() >= need
                    sizes.append(n)
                    sets.append(tokens.view(np.int64) if some else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(1), part.column(3), pa.array(sizes, pa.int64()), pa.array(sets, pa.list_(pa.int64()))],
                    ["row", "doc_id", "n", "tokens"])

    rows = copy.select("batch", "row", "text", "doc_id")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return steps.write(rows.mapInArrow(run, f"row long, doc_id {kind}, n long, tokens array<long>"), "sets")


def _similar(a: Column, b: Column, common: Column) -> Column:
    return 100 * common >= LEAST_PERCENT * (a + b - common)


def _measured(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """``pairs`` (columns a, b) with na, nb and common, the number of shingles in both."""
    left = sets.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    return pairs.join(left, "a").join(right, "b").select(*pairs.columns, "na", "nb", F.size(F.array_intersect("ta", "tb")).alias("common"))


def _sketches(sets: DataFrame) -> DataFrame:
    """(node, n, sketch): how many shingles of a set fall into each of ``SKETCH`` classes of their hash.

    Of all sets, those that meet no other included: a sketch is small, and to pick the others would shuffle the sets.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [np.bincount(np.array(t, np.int64) & (SKETCH - 1), minlength=SKETCH).astype(np.int32) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(counts, pa.list_(pa.int32()))], ["node", "n", "sketch"])

    return sets.select("node", "tokens", "n").mapInArrow(run, "node long, n long, sketch array<int>")


def _may_have_in_common(a: Column, b: Column) -> Column:
    """At most so many shingles two sets have in common, by their sketches."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.least(x, y)), F.lit(0), lambda total, x: total + x)


def _boundary(leads: DataFrame) -> int:
    """The largest size of a light set: what is enumerated up to it plus what is listed beyond it is least.

    A list links its members to its first one alone, so a set costs one row for each of its lists; enumerated it
    costs one for each pair. Sizes are gathered in classes of an eighth of a power of two, so the answer to the
    driver has a bounded number of rows.
    """
    step = F.floor(8 * F.log2("n"))
    per_set = leads.groupBy(step.alias("size"), "node").agg(F.count(F.lit(1)).alias("p"), F.max("n").alias("n"))
    rows = sorted((r.size, r.largest, float(r.listed), float(r.pairs)) for r in per_set.groupBy("size").agg(
        F.max("n").alias("largest"), F.sum("p").alias("listed"), F.sum(F.col("p") * (F.col("p") + 1) / 2).alias("pairs")).collect())
    best, boundary, enumerated, rest = float("inf"), 0, 0.0, sum(r[2] for r in rows)
    for _, largest, scan, pair in [(0, 1, 0.0, 0.0), *rows]:
        enumerated, rest = enumerated + pair, rest - scan
        if enumerated + rest < best:
            best, boundary = enumerated + rest, largest
    return boundary


def _postings(sets: DataFrame, steps: Steps) -> DataFrame:
    """Written rows (key, node, n, heavy): signatures under which sets meet, light pairs and single shingles."""
    spark = sets.sparkSession
    tokens = sets.select(F.explode("tokens").alias("token"))
    total = max(1, sets.agg(F.sum("n")).first()[0] or 0)
    common_from = max(COMMON, total // HEAVY_LIST)
    # At most total / common_from, so at most HEAVY_LIST, shingles are this common.
    common = {r.token: r.df for r in tokens.groupBy("token").agg(F.count(F.lit(1)).alias("df")).where(
        F.col("df") >= common_from).collect()}
    names = np.array(sorted(common), np.int64)
    shared = spark.sparkContext.broadcast((names, np.array([common[t] for t in names.tolist()], np.int64)))

    def order(tokens: np.ndarray) -> np.ndarray:
        names, counts = shared.value
        if not len(names):
            return tokens
        at = np.searchsorted(names, tokens)
        at[at == len(names)] = 0
        return tokens[np.lexsort((tokens, np.where(names[at] == tokens, counts[at], 0)))]

    def lead(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [])
            for node, n, tokens in zip(*(batch.column(k).to_pylist() for k in range(3))):
                # One more than the lists need, for the pairs; each with its place in the order.
                head = order(np.array(tokens, np.int64))[:leading(n, 2)]
                out[0].extend(head.tolist())
                out[1].extend([node] * len(head))
                out[2].extend([n] * len(head))
                out[3].extend(range(len(head)))
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in out], ["token", "node", "n", "place"])

    leads = steps.write(sets.select("node", "n", "tokens").mapInArrow(lead, "token long, node long, n long, place long"), "leads")
    single = F.col("place") < F.col("n") - F.ceil(F.col("n") * LEAST_PERCENT / 100) + 1
    light = _boundary(leads.where(single))
    is_light = F.col("n") <= light
    one = leads.where(single).select(F.xxhash64(F.lit(1), "token").alias("key"), "node", "n", (~is_light).alias("heavy"))
    small = leads.where(is_light)
    subsets = small.groupBy("node", "n").agg(F.sort_array(F.collect_list("token")).alias("head"))
    pairs = subsets.select("node", "n", F.posexplode("head").alias("i", "x"), "head").select(
        "node", "n", "x", F.explode(F.slice("head", F.col("i") + 2, F.greatest(F.size("head") - F.col("i") - 1, F.lit(0)))).alias("y"))
    two = pairs.select(F.xxhash64(F.lit(2), "x", "y").alias("key"), "node", "n", F.lit(True).alias("heavy"))
    postings = steps.write(one.unionByName(two), "postings")
    steps.drop(leads)
    return postings


def links(sets: DataFrame, measured_all: Callable[[], None] = lambda: None) -> DataFrame:
    """Written links (a, b) that connect all linked ones of ``sets`` (node, n, tokens; sets are distinct).

    ``measured_all`` is called once the sets are not needed any more.
    """
    steps = Steps(sets.sparkSession)
    postings = _postings(sets, steps)
    # A list of single shingles in which no set is heavy is left to the pairs.
    hubs = postings.groupBy("key").agg(
        F.min("node").alias("hub"), F.count(F.lit(1)).alias("members"), F.max("heavy").alias("scanned"))
    hubs = steps.write(hubs.where("members > 1 AND scanned"), "hubs")
    member = steps.write(postings.join(hubs.select("key", "hub"), "key").select("hub", "node").distinct(), "hub-members")
    # A list of two is settled by its hub. Members of longer ones are compared with each other as well: those of one
    # hub together, since near copies share many lists.
    longer = steps.write(postings.join(hubs.where("members > 2").select("key", "hub"), "key").where("node <> hub").select(
        "hub", "node").distinct(), "longer-lists")
    steps.drop(postings, hubs)
    exchange.release(sets.sparkSession)
    sketches = steps.write(_sketches(sets), "sketches")
    left, right = (sketches.select(F.col("node").alias(name), F.col("n").alias(f"n{name}"), F.col("sketch").alias(f"sketch{name}"))
                   for name in ("hub", "node"))
    met = member.where("node <> hub").join(left, "hub").join(right, "node").select(
        "hub", "node", "nhub", "nnode", _may_have_in_common(F.col("sketchhub"), F.col("sketchnode")).alias("most"))
    star = steps.write(met.select(
        "hub", "node", F.col("nnode").alias("n"), (1 - F.col("most") / (F.col("nhub") + F.col("nnode") - F.col("most"))).alias("d"),
        _similar(F.col("nhub"), F.col("nnode"), F.col("most")).alias("may_link")), "stars")
    steps.drop(member)
    exchange.release(sets.sparkSession)
    # Sets travel only for the pairs that may link; those that the sketches tell apart have their distance from them.
    first = steps.write(_measured(star.where("may_link").select(F.col("hub").alias("a"), F.col("node").alias("b")), sets).where(
        _similar(F.col("na"), F.col("nb"), F.col("common"))).select("a", "b"), "first-links")
    settled = steps.write(components(first), "first-components")
    exchange.release(sets.sparkSession)

    # Members of a hub in different components, in bands of the distance of their sketches to the hub's: the Jaccard
    # distance of counts is a metric too and never above that of the sets, so those further apart than the reach do not link.
    placed = longer.join(star.drop("may_link"), ["hub", "node"]).join(settled, "node", "left").withColumn(
        "component", F.coalesce("component", "node"))
    mixed = steps.write(placed.groupBy("hub").agg(F.min("component").alias("low"), F.max("component").alias("high")).where(
        "low <> high").select("hub"), "mixed-hubs")
    reach = (100 - LEAST_PERCENT) / 100 + 1e-9
    cells = steps.write(placed.join(mixed, "hub", "left_semi").select(
        "hub", "node", "n", "d", "component", F.floor(F.col("d") / reach).cast("long").alias("cell")), "cells")
    steps.drop(longer, star, settled, mixed)
    x = cells.join(sketches.select("node", "sketch"), "node")
    # One side of a pair stands in its cell, the other in its own and the next, so a pair meets once at a hub.
    p, q = (x.select("hub", "cell", *(F.col(c).alias(c + s) for c in ("node", "n", "d", "component", "sketch"))) for s in "pq")
    q = q.withColumn("place", F.explode(F.array(F.lit(0), F.lit(1)))).withColumn("cell", F.col("cell") + F.col("place"))
    smaller, larger = F.least("np", "nq"), F.greatest("np", "nq")
    ordered = F.when(F.col("place") == 0, F.col("componentp") < F.col("componentq")).otherwise(F.col("componentp") != F.col("componentq"))
    close = ordered & (F.abs(F.col("dp") - F.col("dq")) <= reach) & (100 * smaller >= LEAST_PERCENT * larger)
    # The join itself leaves out what cannot link: few pairs leave it that are none.
    may_link = F.when(close, _similar(F.col("np"), F.col("nq"), _may_have_in_common(F.col("sketchp"), F.col("sketchq")))).otherwise(False)
    pairs = steps.write(p.join(q, (p["hub"] == q["hub"]) & (p["cell"] == q["cell"]) & may_link).select(
        F.least("nodep", "nodeq").alias("a"), F.greatest("nodep", "nodeq").alias("b")).distinct(), "pairs")
    steps.drop(cells, sketches)
    exchange.release(sets.sparkSession)
    second = _measured(pairs, sets).where(_similar(F.col("na"), F.col("nb"), F.col("common"))).select("a", "b")
    found = steps.write(first.unionByName(second), "all-links")
    steps.drop(first, pairs)
    measured_all()
    return found


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: row, doc_id, n_shingles, component_id, component_row (the row that stays of each group).

    ``component_id`` is the smallest id of the component; of a text without words its own.
    """
    return _grouped(exchange.stable_copy(docs, id_col, text_col))


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one row of each group of near-duplicates: the one of smallest id, then first in the input.

    Rows without words are in no group and stay. All columns are as they were.
    """
    names = [c for c in docs.columns if c != text_col]
    copy = exchange.stable_copy(docs, id_col, text_col, tuple(names))
    gone = exchange.write_answers(_grouped(copy).where("row <> component_row").select(
        F.shiftright("row", exchange.BATCH_BITS).alias("batch"), "row"), "near-duplicate-rows")
    others = [f"other_{k}" for k in range(len(names))]
    schema = copy.select("batch", "row", "was_null", "text", *others).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers = exchange.Answers(gone)
        for whole in batches:
            for number, part in exchange.segments(whole):
                rows = part.column(1).to_numpy()
                yield part.filter(pa.array(~np.isin(rows, answers.values(number, "row"))))

    kept = copy.select("batch", "row", "was_null", "text", *others).mapInArrow(run, schema)
    place = dict(zip(names, others))
    text = F.when(~F.col("was_null"), F.col("text"))
    return kept.select(*((text if c == text_col else F.col(place[c])).alias(c) for c in docs.columns))


def _grouped(copy: DataFrame) -> DataFrame:
    steps = Steps(copy.sparkSession)
    seen = exchange.copies(copy)
    every = _survivors(copy, exchange.write_answers(seen.where("row <> first_row").select("batch", "row"), "copied-rows"), steps)
    found = every.where("tokens IS NOT NULL").select("row", "n", "tokens")
    # Equal sets are one node, named by its smallest row.
    pair = F.struct(F.xxhash64("tokens").alias("x"), F.hash("tokens").alias("y"), "n")
    keyed = steps.write(found.select("row", pair.alias("digest")), "set-digests")
    nodes = steps.write(keyed.groupBy("digest").agg(F.min("row").alias("node")), "classes")
    members = steps.write(keyed.join(nodes, "digest").select("row", "node"), "members")
    distinct = nodes.select(F.col("node").alias("row")).join(found, "row").select(F.col("row").alias("node"), "n", "tokens")
    distinct = steps.write(distinct, "distinct-sets")
    narrow = steps.write(every.select("row", "doc_id", F.col("n").alias("n_shingles")), "rows")
    steps.drop(keyed, nodes, every)
    exchange.release(copy.sparkSession)
    joined = materialize(components(links(distinct, lambda: steps.drop(distinct))), "components")
    placed = materialize(members.join(joined, "node", "left").select(
        F.col("row").alias("anchor"), F.coalesce("component", "node").alias("component_row")), "class-members")
    anchored = materialize(narrow.join(
        seen.where("row <> first_row").select("row", "first_row"), "row", "left").withColumn(
        "anchor", F.coalesce("first_row", "row")).drop("first_row"), "anchored")
    # A text without words is linked with nothing, its copies included.
    own = F.when(F.col("n_shingles") > 0, F.coalesce("component_row", "anchor")).otherwise(F.col("row"))
    rows = materialize(anchored.join(placed, "anchor", "left").select(
        "row", "doc_id", "n_shingles", own.alias("component_row")), "placed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("is_null"), "doc_id", "row")).alias("first")
    groups = materialize(rows.groupBy("component_row").agg(first, F.count(F.lit(1)).alias("members")).where(
        "members > 1").select("component_row", F.col("first.doc_id").alias("first_id"), F.col("first.row").alias("first_row")), "groups")
    out = rows.join(groups, "component_row", "left")
    lone = F.col("first_row").isNull()
    return out.select("row", "doc_id", "n_shingles", F.when(lone, F.col("doc_id")).otherwise(F.col("first_id")).alias("component_id"),
                      F.when(lone, F.col("row")).otherwise(F.col("first_row")).alias("component_row"))


