"""Joins with aggregated sides in which a hot key can still be split."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dealt_anew(key: str) -> Column:
    """The same long value, as an expression Spark does not know to be the key it grouped by.

    A side that was just grouped by the join key is joined where it lies, and then adaptive
    execution cannot split the other side's rows of a hot key. Dealing out the grouped rows once
    more, one per key, lets it.
    """
    return F.col(key).bitwiseXOR(F.lit(0).cast("bigint"))


def text_dealt_anew(key: str) -> Column:
    """The same for a text."""
    return F.concat(F.col(key), F.lit(""))
