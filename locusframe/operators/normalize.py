"""Trim and left-align variants against a table of reference chunks.

Trimming needs the record alone. Only an allele that trimming empties can move, and such records are
few: callers write most indels left-aligned already. So the reference is never joined to the records.
The distinct movable events, a narrow table, are resolved against the chunks, and the answer goes back
to the records by broadcast if its measured size allows, else by a salted join.

How far an event moves: with B the trimmed allele and d its length, the event may move left over a base
as long as that base repeats the one d further right. So the bases left of the event must continue B
periodically, which each chunk can check by itself; the chunk nearest to the event where the pattern
breaks holds the new position. An event that crosses all chunks looked at asks for twice as many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F, types as T

from ..functions import common_prefix_length, common_suffix_length, let, once
from ..scratch import materialize
from ..sources.ranges import ORDER, in_order

BASES = "^[ACGTNacgtn]+$"
NEAR_BASES = 32
EVENT = ("contigName", "start", "alleles")
SYMBOLIC = "symbolic or unnamed allele"
STATUS = T.StructType([T.StructField("changed", T.BooleanType()), T.StructField("errorMessage", T.StringType())])


def _status(changed: Column | bool, message: Column | None = None) -> Column:
    changed = changed if isinstance(changed, Column) else F.lit(changed)
    message = message if message is not None else F.lit(None).cast("string")
    return F.struct(changed.alias("changed"), message.alias("errorMessage")).cast(STATUS)


def _without_tail(alleles: Column, tail: Column) -> Column:
    return F.transform(alleles, lambda a: a.substr(F.lit(1), F.length(a) - tail))


def _shared_tail(alleles: Column) -> Column:
    """Length of the suffix all alleles share; most share none, which the last base shows."""
    first = F.get(alleles, F.lit(0))
    same_last = F.forall(alleles, lambda a: F.right(a, F.lit(1)) == F.right(first, F.lit(1)))
    return F.when(same_last, F.array_min(F.transform(alleles, lambda a: common_suffix_length(first, a)))).otherwise(0)


def _shared_head(alleles: Column) -> Column:
    first = F.get(alleles, F.lit(0))
    same_first = F.forall(alleles, lambda a: F.left(a, F.lit(1)) == F.left(first, F.lit(1)))
    return F.when(same_first, F.array_min(F.transform(alleles, lambda a: common_prefix_length(first, a)))).otherwise(0)


def _shortest(alleles: Column) -> Column:
    return F.array_min(F.transform(alleles, lambda a: F.length(a)))


def _is_movable(alleles: Column) -> Column:
    """Whether trimming empties an allele: the shortest one is the end of all others."""
    return F.exists(alleles, lambda short: F.forall(alleles, lambda a: a.endswith(short)))


TRIM = "kind string, event array<string>, start bigint, alleles array<string>"


def _trim(kind: str, event: Column | None = None, start: Column | None = None, alleles: Column | None = None) -> Column:
    values = (F.lit(kind), event, start, alleles)
    names = ("kind", "event", "start", "alleles")
    return F.struct(*[(F.lit(None) if v is None else v).alias(n) for v, n in zip(values, names)]).cast(f"struct<{TRIM}>")


def with_trim(df: DataFrame) -> DataFrame:
    """Add ``_trim``: what the record alone tells about its normal form.

    ``kind`` is plain (nothing to do), symbolic (left alone), trimmed (done, see start and alleles) or
    movable (trimming empties an allele, the reference is needed).
    """
    ref, alts, start = F.col("referenceAllele"), F.col("alternateAlleles"), F.col("start")

    def by_bases(alleles: Column) -> Column:
        def keep_head(cut: Column) -> Column:
            head = F.least(_shared_head(cut), _shortest(cut) - 1)
            return let(head, lambda h: F.when((h > 0) | (F.get(cut, F.lit(0)) != F.get(alleles, F.lit(0))), _trim(
                "trimmed", None, start + h, F.transform(cut, lambda a: a.substr(h + 1, F.length(a)))
            )).otherwise(_trim("plain")))

        trimmed = let(_shared_tail(alleles), lambda tail: let(_without_tail(alleles, tail), keep_head))
        return F.when(_is_movable(alleles), _trim("movable", alleles)).otherwise(trimmed)

    alleles = F.concat(F.array(ref), alts)
    only_alt = F.get(alts, F.lit(0))
    is_snv = (F.length(ref) == 1) & (F.size(alts) == 1) & (F.length(only_alt) == 1)
    named = F.forall(alleles, lambda a: F.coalesce(a.rlike(BASES), F.lit(False)))
    upper = F.transform(alleles, lambda a: F.upper(a))
    trim = (
        F.when(F.coalesce(F.size(alts), F.lit(0)) <= 0, _trim("plain"))
        .when(~named, _trim("symbolic"))
        .when(is_snv | (F.size(F.array_distinct(upper)) == 1), _trim("plain"))
        .otherwise(let(upper, by_bases)))
    return once(df, _trim=trim)


def movable_events(df: DataFrame) -> DataFrame:
    """The distinct (contigName, start, alleles) that need the reference, and how many records hold each (``copies``)."""
    alleles = F.transform(F.concat(F.array("referenceAllele"), "alternateAlleles"), lambda a: F.upper(a))
    rows = df.where(F.length("referenceAllele") + F.length(F.array_join("alternateAlleles", "")) > 2).select(
        "contigName", "start", alleles.alias("alleles"))
    named = F.forall("alleles", lambda a: F.coalesce(a.rlike(BASES), F.lit(False)))
    several = (F.size("alleles") > 1) & (F.size(F.array_distinct("alleles")) > 1)
    return rows.where(several & named & _is_movable(F.col("alleles"))).groupBy(*EVENT).agg(F.count(F.lit(1)).alias("copies"))


def _look_left(pending: DataFrame, chunks: DataFrame, size: int, span: int) -> DataFrame:
    """Move every pending event as far left as the ``span`` chunks before its edge allow.

    In the first round (edge = start) the chunks under the reference allele are read too, to check it.
    """
    start, edge, ref = F.col("start"), F.col("edge"), F.get("alleles", F.lit(0))
    nearest = F.greatest(F.call_function("div", edge - 1, F.lit(size)), F.lit(0))
    last = F.when(edge == start, F.call_function("div", start + F.length(ref) - 1, F.lit(size))).otherwise(nearest)
    wanted = pending.withColumn(
        "chunk", F.explode(F.sequence(F.greatest(nearest - (span - 1), F.lit(0)), F.greatest(nearest, last))))
    # the partitioning a shuffled join needs anyway; it also spreads the work where the chunks are broadcast
    wanted = wanted.repartition("contigName", "chunk")
    # a chunk is measured once, since to count the characters of a text Spark reads all of it
    held = chunks.select("contigName", "chunk", "bases", F.length("bases").alias("held"))
    rows = wanted.join(held, ["contigName", "chunk"], "left")

    chunk_start = F.col("chunk") * size
    bases = F.col("bases")
    before = F.greatest(F.least(edge - chunk_start, F.lit(size)), F.lit(0))
    length = F.when(F.col("held").isNotNull(), F.least(before, F.col("held")).cast("int"))
    distance = start - chunk_start - length

    def repeats(b: Column, bases_left: Column, n: Column) -> Column:
        """How many of the last ``n`` bases continue the pattern of ``b`` to the left."""
        period = F.length(b)
        pattern = F.repeat(F.reverse(b), F.ceil(n / period).cast("int") + 1)
        expected = pattern.substr(F.pmod(distance, period).cast("int") + 1, n)
        return common_prefix_length(F.reverse(bases_left), expected)

    def over_all(bases_left: Column, n: Column) -> Column:
        return F.array_min(F.transform(F.filter("cores", lambda b: b != ""), lambda b: repeats(b, bases_left, n)))

    # most events stop within a few bases; only the others are compared with the whole chunk
    near = F.least(length, F.lit(NEAR_BASES))
    moved = let(let(bases.substr(length - near + 1, near), lambda text: over_all(text, near)),
                lambda m: F.when((m < near) | (length <= NEAR_BASES), m).otherwise(over_all(bases.substr(F.lit(1), length), length)))
    rows = once(rows, moved=F.when(length > 0, moved))
    stop = F.when(
        F.col("moved") < length,
        F.struct((chunk_start + length - F.col("moved")).alias("edge"),
                 bases.substr(length - F.col("moved"), F.lit(1)).alias("base")))
    # the part of the reference allele that lies on this chunk, compared base by base
    from_base = F.greatest(start, chunk_start)
    to_base = F.least(start + F.length(ref), chunk_start + size)
    covered = (edge == start) & (to_base > from_base)
    found = bases.substr((from_base - chunk_start + 1).cast("int"), (to_base - from_base).cast("int"))
    expected = ref.substr((from_base - start + 1).cast("int"), (to_base - from_base).cast("int"))
    # the aggregation sorts its input, so the bases of the chunks must not be part of it
    narrow = rows.select(
        *EVENT, "cores", "tail", "edge", stop.alias("stop"), chunk_start.alias("lowest"), bases.isNotNull().alias("known"),
        F.when(covered, found == expected).alias("matches"))
    return narrow.groupBy(*EVENT, "cores", "tail", "edge").agg(
        F.max("stop").alias("stop"), F.min("lowest").alias("lowest"), F.bool_and("known").alias("known"),
        F.coalesce(F.bool_and("matches"), F.lit(True)).alias("matches"))


def spread_events(events: DataFrame, together: int) -> DataFrame:
    """The events of more than ``together`` records and the ``salts`` that keep that many of each together.

    There are at most records / ``together`` of them, so the list can be broadcast.
    """
    salts = F.ceil(F.col("copies") / together).cast("int")
    return events.where(F.col("copies") > together).select(*EVENT, salts.alias("salts"))


def resolve_events(events: DataFrame, chunks: DataFrame, size: int) -> tuple[DataFrame, int, int]:
    """The normal form of every movable event: new start and alleles, or why it stays.

    Also returns how many events there are and how many bytes they take.
    """
    pending = events.select(*EVENT).withColumn("tail", _shortest(F.col("alleles")))
    pending = pending.withColumn("cores", _without_tail(F.col("alleles"), F.col("tail")))
    pending = pending.withColumn("edge", F.col("start"))
    done: list[DataFrame] = []
    span, count, size_bytes = 2, 0, 0
    while True:
        looked = _look_left(pending, chunks, size, span)
        settled = F.col("stop").isNotNull() | (F.col("lowest") == 0) | ~F.col("known") | ~F.col("matches")
        stats = Observation()
        looked = materialize(
            looked.withColumn("settled", settled).observe(
                stats,
                F.count_if(~F.col("settled")).alias("open"),
                F.count_if(F.col("settled")).alias("settled"),
                F.coalesce(F.sum(F.when(F.col("settled"), F.length(F.array_join("alleles", ",")))), F.lit(0)).alias("chars"),
            ), "left-align")
        done.append(looked.where("settled"))
        found = stats.get
        count += found["settled"]
        size_bytes += 2 * found["chars"] + 64 * found["settled"]
        if not found["open"]:
            break
        span *= 2
        pending = looked.where(~F.col("settled")).select(*EVENT, "tail", "cores", F.col("lowest").alias("edge"))
    rows = done[0]
    for more in done[1:]:
        rows = rows.unionByName(more)

    ok = F.col("known") & F.col("matches")
    new_edge = F.coalesce(F.col("stop.edge"), F.lit(0))
    shift = F.col("start") - new_edge
    base = F.col("stop.base")

    def turn(b: Column) -> Column:
        """The bases of the event after it moved ``shift`` to the left."""
        k = F.pmod(shift, F.greatest(F.length(b), F.lit(1))).cast("int")
        return F.concat(F.right(b, k), b.substr(F.lit(1), F.length(b) - k))

    turned = F.transform("cores", turn)
    # at the first base of the contig nothing precedes, so the base after the event is appended
    event = F.get(F.filter(turned, lambda b: b != ""), F.lit(0))
    follows = F.when(shift > 0, event.substr(1, 1)).otherwise(
        F.get("alleles", F.lit(0)).substr(F.length(F.get("cores", F.lit(0))) + 1, F.lit(1)))
    placed = F.when(base.isNotNull(), F.transform(turned, lambda b: F.concat(base, b))).otherwise(
        F.transform(turned, lambda b: F.concat(b, follows)))
    message = F.when(~F.col("known"), "no reference bases here").when(~F.col("matches"), "REF differs from the reference")
    resolved = rows.select(
        *EVENT,
        F.when(ok, F.when(base.isNotNull(), new_edge - 1).otherwise(new_edge)).cast("long").alias("new_start"),
        F.when(ok, placed).alias("new_alleles"),
        message.alias("message"),
    )
    return resolved, count, size_bytes


def differing_references(df: DataFrame, chunks: DataFrame, size: int) -> DataFrame:
    """The distinct (contigName, start, ref) whose reference allele is not what the reference holds there.

    A narrow projection of the records is checked, each distinct one once. Where the reference has no bases
    there is nothing to compare with.
    """
    refs = df.select("contigName", "start", F.upper("referenceAllele").alias("ref")).where(F.col("ref").rlike(BASES)).distinct()
    start, last = F.col("start"), F.col("start") + F.length("ref") - 1
    first_chunk, last_chunk = (F.call_function("div", x, F.lit(size)) for x in (start, last))
    wanted = refs.where("start >= 0").withColumn("chunk", F.explode(F.sequence(first_chunk, last_chunk)))
    rows = wanted.join(chunks.select("contigName", "chunk", "bases"), ["contigName", "chunk"])
    chunk_start = F.col("chunk") * size
    begin, end = F.greatest(start, chunk_start), F.least(last + 1, chunk_start + F.length("bases"))
    count = F.greatest(end - begin, F.lit(0)).cast("int")
    found = F.col("bases").substr((begin - chunk_start + 1).cast("int"), count)
    expected = F.col("ref").substr((begin - start + 1).cast("int"), count)
    return rows.where(F.upper(found) != expected).select("contigName", "start", "ref").distinct()


def normalize_fault(df: DataFrame) -> Column:
    """Why a normalized record stayed as it is; NULL also for a symbolic allele, which has no normal form."""
    return F.nullif(F.col("normalizationStatus.errorMessage"), F.lit(SYMBOLIC))


def normalize_variants(
    df: DataFrame, chunks: DataFrame, chunk_size: int, broadcast_bytes: int = 64 << 20, copies_together: int = 100_000,
) -> DataFrame:
    """Records in normal form: shared bases trimmed, indels as far left as the reference allows.

    ``chunks`` comes from :func:`reference_chunks` with the same ``chunk_size``. Adds
    ``normalizationStatus`` (changed, errorMessage). Symbolic alleles and records whose REF is not what
    the reference holds stay as they are. Resolving the movable events runs Spark jobs here; the result
    is lazy. Pass a written table where the records are expensive, since its core columns are read twice.
    Records that know their place in a file stay in its order, also where they had to be dealt out. An event
    of more than ``copies_together`` records is then dealt to as many tasks as its count asks for.
    """
    events = materialize(movable_events(df), "movable-events")
    resolved, _, size_bytes = resolve_events(events, chunks, chunk_size)
    rows = with_trim(df)
    keys = {"_contig": "contigName", "_start": "start", "_event": "alleles"}
    answers = resolved.select(*[F.col(old).alias(new) for new, old in keys.items()], "new_start", "new_alleles", "message")
    match = [F.col("contigName") == F.col("_contig"), F.col("start") == F.col("_start"), F.col("_trim.event") == F.col("_event")]
    if size_bytes <= broadcast_bytes:
        joined = rows.join(F.broadcast(answers), match, "left")
    else:
        # records that need no reference stay where they are; those of a frequent event are dealt to as many
        # salts as its measured count asks for, and its answer is copied as often
        movable = F.col("_trim.kind") == "movable"
        frequent = spread_events(events, copies_together)
        named = frequent.select(*[F.col(old).alias(new) for new, old in keys.items()], "salts")
        spread = F.coalesce("salts", F.lit(1))
        place = F.xxhash64(F.spark_partition_id(), F.monotonically_increasing_id())
        salted = rows.where(movable).join(F.broadcast(named), match, "left").withColumn("_salt", F.pmod(place, spread).cast("int")).drop(*named.columns)
        copies = answers.join(F.broadcast(named), [*keys], "left").withColumn("_other", F.explode(F.sequence(F.lit(0), spread - 1))).drop("salts")
        moved = salted.join(copies, [*match, F.col("_salt") == F.col("_other")], "left").drop("_salt", "_other")
        joined = moved.unionByName(rows.where(~movable), allowMissingColumns=True)
    dealt = size_bytes > broadcast_bytes

    wrong = materialize(differing_references(df, chunks, chunk_size).select(
        F.col("contigName").alias("_wrong_contig"), F.col("start").alias("_wrong_start"), F.col("ref").alias("_wrong_ref")), "wrong-references")
    wrong_bytes = wrong.agg(F.sum(F.length("_wrong_contig") + F.length("_wrong_ref") + 64)).first()[0] or 0
    if wrong_bytes:
        dealt = dealt or wrong_bytes > broadcast_bytes
        joined = joined.join(F.broadcast(wrong) if wrong_bytes <= broadcast_bytes else wrong, [
            F.col("contigName") == F.col("_wrong_contig"), F.col("start") == F.col("_wrong_start"),
            F.upper("referenceAllele") == F.col("_wrong_ref")], "left")
    else:
        joined = joined.withColumn("_wrong_ref", F.lit(None).cast("string"))

    is_wrong = F.col("_wrong_ref").isNotNull()
    kind = F.when(~is_wrong | (F.col("_trim.kind") == "symbolic"), F.col("_trim.kind"))
    new_start = F.when(kind == "trimmed", F.col("_trim.start")).otherwise(F.col("new_start"))
    new_alleles = F.when(kind == "trimmed", F.col("_trim.alleles")).otherwise(F.when(~is_wrong, F.col("new_alleles")))
    moved = new_alleles.isNotNull()
    new_ref = F.get(new_alleles, F.lit(0))
    message = F.when(kind == "symbolic", SYMBOLIC).when(
        is_wrong, "REF differs from the reference").otherwise(F.col("message"))
    changes = {
        "start": F.when(moved, new_start).otherwise(F.col("start")),
        "end": F.when(moved, new_start + F.length(new_ref)).otherwise(F.col("end")) if "end" in df.columns else None,
        "referenceAllele": F.when(moved, new_ref).otherwise(F.col("referenceAllele")),
        "alternateAlleles": F.when(moved, F.slice(new_alleles, F.lit(2), F.size(new_alleles) - 1))
        .otherwise(F.col("alternateAlleles")),
    }
    columns = [
        changes[f.name].alias(f.name) if changes.get(f.name) is not None
        else F.col(f"`{f.name}`") for f in df.schema.fields if f.name != "normalizationStatus"
    ]
    different = moved & ((new_start != F.col("start")) | (new_ref != F.upper("referenceAllele"))
                         | (F.size(new_alleles) != F.size("alternateAlleles") + 1)
                         | (F.slice(new_alleles, F.lit(2), F.size(new_alleles)) != F.transform("alternateAlleles", lambda a: F.upper(a))))
    done = joined.select(*columns, _status(F.coalesce(different, F.lit(False)), message).alias("normalizationStatus"))
    return in_order(done) if dealt and {"source_file", *ORDER} <= set(df.columns) else done
