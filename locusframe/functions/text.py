"""String measures built from native expressions, used on alleles and reference bases."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    A column used several times in an expression is copied into each place when Spark merges
    projections or pushes a filter below one; a lambda variable is not.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def once(df: DataFrame, **columns: Column) -> DataFrame:
    """``df`` with further columns, each evaluated once a row whatever uses them.

    They come from a list of one struct: Spark neither merges a projection nor pushes a filter below that, so
    unlike those of ``withColumn`` they are not copied into every place.
    """
    return df.select("*", F.inline(F.array(F.struct(*[c.alias(n) for n, c in columns.items()]))))


def common_prefix_length(a: Column, b: Column) -> Column:
    """Number of leading characters two strings share.

    The length is found bit by bit, largest power of two first, so two strings of n characters need
    log2(n) substring comparisons and no per-character lambda.
    """
    def search(pair: Column) -> Column:
        def grow(found: Column, bit: Column) -> Column:
            step = F.call_function("shiftleft", F.lit(1), bit)
            start = found + 1
            same = pair["a"].substr(start, step) == pair["b"].substr(start, step)
            return F.when((found + step <= pair["limit"]) & same, found + step).otherwise(found)

        highest = F.floor(F.log2(F.greatest(pair["limit"], F.lit(1)))).cast("int")
        return F.aggregate(F.sequence(highest, F.lit(0), F.lit(-1)), F.lit(0), grow)

    def measured(pair: Column) -> Column:
        limit = F.least(F.length(pair["a"]), F.length(pair["b"]))
        return let(F.struct(pair["a"].alias("a"), pair["b"].alias("b"), limit.alias("limit")), search)

    return let(F.struct(a.alias("a"), b.alias("b")), measured)


def common_suffix_length(a: Column, b: Column) -> Column:
    """Number of trailing characters two strings share."""
    return common_prefix_length(F.reverse(a), F.reverse(b))
