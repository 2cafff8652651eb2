"""Genotype text from integer calls."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def genotype_string(calls: Column, phased: Column) -> Column:
    """``0/1``, ``1|0``, ``./.``: a negative call is ``.``; only phased = true joins with ``|``.

    NULL calls give NULL; a NULL inside the calls is left out of the text.
    """
    alleles = F.transform(calls, lambda call: F.when(call < 0, ".").otherwise(call.cast("string")))
    return F.when(phased, F.array_join(alleles, "|")).otherwise(F.array_join(alleles, "/"))
