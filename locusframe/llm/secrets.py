"""Secret scans with multipart credential linking, in DataFrame functions only.

Base kinds are reported wherever they stand. Weak parts (identifiers, secrets, endpoints that would be noise
alone) are reported only where a complement, a part of another sort, stands in the same scope: an interval join
within a text, on the distance of starts. It runs as a range frame over parts ordered by start, so no pairs are
made and a text with many parts costs a sort. A weak part that overlaps a base span, and a weak secret that overlaps
an identifier or an endpoint, is that part again and complements nothing. Texts are scanned once; only the found parts, a few numbers each, are
written and shuffled, keyed by a row number, so one hot source or id does not gather in a task.

A null text counts as empty: no spans. A null id is kept. Rows are told apart by a number of their own, so
that repeated rows and ids give a result each. An empty table gives an empty result. Other columns are not
read by ``scan``; ``clean`` keeps them.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window, functions as F

from locusframe.scratch import materialize

#: Complements are looked for within this many code points, from start to start.
SCOPE = 200

#: Kinds in the order of reports, with the pattern and the group whose length counts.
PATTERNS = {
    "assign": (r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 1),
    "access": ("AKIA[A-Z0-9]+", 0),
    "hex": ("[0-9a-f]{24,}", 0),
    "identifier": (r"A(?:KI|SI|ID|RO|GP|NP)A[A-Z0-9]{8,}|"
                   r"""(?i:client_?id|key_?id|account_?id|user_?name|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9@._-]{3,}""", 0),
    "secret": ("[A-Za-z0-9+/_-]{16,}={0,2}", 0),
    "endpoint": (r"""https?://[A-Za-z0-9.-]{4,}(?::[0-9]+)?(?:/[^\x20\x09-\x0D"'<>]*)?""", 0),
}
KINDS = list(PATTERNS)
BASE = KINDS[:3]
#: Least length of what counts: the value of an assignment, an access key, a run of hexadecimal digits.
LEAST = {"assign": 6, "access": 20, "hex": 24}
#: Strings of which every match of a kind holds one, and what each match begins with: most texts are settled by a plain
#: search for the first, and most places of the others by the second, which is much cheaper than the whole pattern.
SIGNS = {
    "assign": ((":", "="), "(?=[PpSsTtAa][AaEeOoPp])"),
    "access": (("AKIA",), ""),
    "identifier": ((":", "=", "AKIA", "ASIA", "AIDA", "AROA", "AGPA", "ANPA"), "(?=[AaCcKkLlUu])"),
    "endpoint": (("://",), ""),
}
#: Which part a base span plays where weak parts look for complements.
PART = {"assign": "secret", "access": "identifier", "hex": "secret"}


def _is_mixed(match: Column) -> Column:
    """A weak secret mixes digits with both cases, or is a run of hexadecimal digits with both sorts."""
    mixed = match.rlike("[0-9]") & match.rlike("[A-Z]") & match.rlike("[a-z]")
    return mixed | (match.rlike("^[0-9a-f]+$") & match.rlike("[0-9]") & match.rlike("[a-f]"))


def _holds(text: Column, kind: str) -> Column:
    """Whether a text has a match of the kind."""
    signs, begin = SIGNS.get(kind, ((), ""))
    found = text.rlike(f"{begin}(?:{PATTERNS[kind][0]})")
    return reduce(or_, (F.contains(text, F.lit(x)) for x in signs)) & found if signs else found


def _hits(text: Column, kind: str) -> Column:
    """Every match of a kind in order: how far behind the one before it begins, its length, whether it counts."""
    pattern, group = PATTERNS[kind]
    fields = [F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("all")]
    if group:
        fields.append(F.regexp_extract_all(text, F.lit(pattern), F.lit(group)).alias("value"))

    def hit(x: Column, nth: Column) -> Column:
        if kind in LEAST:
            counts = F.length(x["value" if group else "all"]) >= LEAST[kind]
        else:
            counts = _is_mixed(x["all"]) if kind == "secret" else F.lit(True)
        return F.struct(F.lit(KINDS.index(kind)).alias("kind"), nth.cast("long").alias("nth"),
                        F.length(x["gap"]).cast("long").alias("gap"), F.length(x["all"]).cast("long").alias("size"),
                        counts.alias("counts"))

    none = F.array().cast("array<struct<kind:int,nth:bigint,gap:bigint,size:bigint,counts:boolean>>")
    found = F.transform(F.filter(F.arrays_zip(*fields), lambda x: x["all"].isNotNull()), hit)
    return F.when(_holds(text, kind), found).otherwise(none)


def _parts(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One written row per row of ``df``: a number, the id, and all matches; weak ones where two sorts may be."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    identified = _holds(text, "identifier") | _holds(text, "endpoint")
    none = F.array().cast("array<struct<kind:int,nth:bigint,gap:bigint,size:bigint,counts:boolean>>")
    weak = [F.when(identified, _hits(text, kind)).otherwise(none) for kind in KINDS[len(BASE):]]
    parts = F.concat(*(_hits(text, kind) for kind in BASE), *weak)
    return materialize(df.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                                 parts.alias("parts")), "secret-parts")


def _spans(parts: DataFrame, scope: int) -> DataFrame:
    """Spans by row: base ones, and weak ones that are linked. Columns row, kind, start, end."""
    hits = parts.select("row", F.inline("parts"))
    until = Window.partitionBy("row", "kind").orderBy("nth").rowsBetween(Window.unboundedPreceding, 0)
    end = F.sum(F.col("gap") + F.col("size")).over(until)
    spans = hits.select("row", "kind", "counts", (end - F.col("size")).alias("start"), end.alias("end")).where("counts")

    kind = F.col("kind")
    is_base = kind < len(BASE)

    def plays(part: str) -> Column:
        own = [KINDS.index(k) for k, p in PART.items() if p == part] + [KINDS.index(part)]
        return kind.isin(*own)

    around = Window.partitionBy("row").orderBy("start").rangeBetween(-scope, scope)
    up_to = Window.partitionBy("row").orderBy("start").rangeBetween(Window.unboundedPreceding, 0)
    onward = Window.partitionBy("row").orderBy("start").rangeBetween(0, Window.unboundedFollowing)
    # A weak secret may cover an identifier or an endpoint; the part that is named stays.
    named = kind.isin(KINDS.index("identifier"), KINDS.index("endpoint"))

    def apart_from(others: Column) -> Column:
        """Whether no span of the others reaches in from before, or begins before the end."""
        return (F.coalesce(F.max(F.when(others, F.col("end"))).over(up_to), F.lit(0)) <= F.col("start")) & (
            F.coalesce(F.min(F.when(others, F.col("start"))).over(onward), F.col("end")) >= F.col("end"))

    alone = spans.withColumn("alone", is_base | (apart_from(is_base) & (named | apart_from(named)))).where("alone")
    near = {part: F.max(plays(part)).over(around) for part in ("identifier", "secret", "endpoint")}
    linked = F.lit(False)
    for part in near:
        complement = reduce(or_, [near[other] for other in near if other != part])
        linked = linked | ((kind == KINDS.index(part)) & complement)
    return alone.withColumn("stays", is_base | linked).where("stays").select("row", "kind", "start", "end")


def scan(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """Per row of ``df``: row, doc_id, and spans, an array of (start, kind, end) by start and kind.

    Positions are code points, ends exclusive; kinds are places in ``KINDS``.
    """
    parts = _parts(df, id_col, text_col)
    span = F.struct("start", "kind", "end")
    grouped = _spans(parts, scope).groupBy("row").agg(F.array_sort(F.collect_list(span)).alias("spans"))
    none = F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>")
    return parts.select("row", "doc_id").join(grouped, "row", "left").select(
        "row", "doc_id", F.coalesce("spans", none).alias("spans"))


def as_text(spans: Column) -> Column:
    """Spans as kind:start:end, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """Per row: doc_id, counts of the base kinds, digest of the base spans, all spans as text."""
    base = F.filter("spans", lambda s: s["kind"] < len(BASE))

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == KINDS.index(kind))).cast("long").alias(f"n_{kind}")

    counts = map(count, BASE)
    return scan(df, id_col, text_col, scope).select(
        "doc_id", *counts, F.sha2(as_text(base), 256).alias("base_sha256"), as_text(F.col("spans")).alias("spans"))


def _masked(text: Column, spans: Column) -> Column:
    """The text with the characters of every span replaced by one mark for each kind."""
    def step(state: Column, s: Column) -> Column:
        begin = F.greatest(state["at"], s["start"])
        piece = F.substring(text, (state["at"] + 1).cast("int"), F.greatest(begin - state["at"], F.lit(0)).cast("int"))
        mark = F.when(s["end"] > state["at"], F.concat(F.lit("<"), F.get(F.array(*map(F.lit, KINDS)), s["kind"]), F.lit(">")))
        return F.struct(F.greatest(state["at"], s["end"]).alias("at"),
                        F.concat(state["pieces"], F.array(F.concat(piece, F.coalesce(mark, F.lit(""))))).alias("pieces"))

    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<string>").alias("pieces"))
    done = F.aggregate(spans, start, step, lambda state: F.concat(
        F.array_join(state["pieces"], ""), F.substring(text, (state["at"] + 1).cast("int"), F.lit(2147483647))))
    return F.when(F.size(spans) > 0, done).otherwise(text)


def clean(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", scope: int = SCOPE) -> DataFrame:
    """``df`` with every span in ``text_col`` replaced by a mark; other columns and clean texts as they are.

    Texts that no pattern of a base kind, identifier or endpoint matches hold no span and pass straight through; only
    the others meet their spans in a join, by a digest of the text.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    may_hold = reduce(or_, (_holds(text, kind) for kind in (*BASE, "identifier", "endpoint")))
    keyed = df.where(may_hold).withColumn("__text_hash", F.sha2(text, 256))
    found = scan(keyed.select("__text_hash", text_col), "__text_hash", text_col, scope)
    dirty = materialize(found.where(F.size("spans") > 0).groupBy(F.col("doc_id").alias("__text_hash")).agg(
        F.first("spans").alias("__spans")), "secret-spans")
    spans = F.coalesce("__spans", F.array().cast("array<struct<start:bigint,kind:int,end:bigint>>"))
    masked = keyed.join(dirty, "__text_hash", "left").select(
        *(_masked(F.col(c), spans).alias(c) if c == text_col else F.col(f"`{c}`") for c in df.columns))
    return df.where(~may_hold).unionByName(masked)
