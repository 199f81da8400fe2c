"""Conversions from landed text to warehouse types.

``strict_*`` raise on bad text (the session runs with ANSI casts, Spark's default);
``try_*`` give NULL instead.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text layouts of the timestamps in the source files, as Spark patterns.
# The fraction is optional, so one pattern reads rows with and without it.
TS_SECONDS = "yyyy-MM-dd HH:mm:ss"
TS_NANOS = "yyyy-MM-dd HH:mm:ss[.SSSSSSSSS]"
TS_ISO = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"
DATE_ISO = "yyyy-MM-dd"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strict_number(c: Column | str) -> Column:
    """Text to whole number; a fraction is rounded half up, bad text fails the query."""
    return _col(c).cast("decimal(38,0)").cast("bigint")


def try_number(c: Column | str) -> Column:
    """Text to whole number, NULL for bad text or out-of-range values."""
    return _col(c).try_cast("decimal(38,0)").try_cast("bigint")


def strict_decimal(c: Column | str, precision: int = 10, scale: int = 2) -> Column:
    return _col(c).cast(f"decimal({precision},{scale})")


def try_decimal(c: Column | str, precision: int = 10, scale: int = 2) -> Column:
    """Text to decimal at a declared scale (rounded half up), NULL on failure."""
    return _col(c).try_cast(f"decimal({precision},{scale})")


def try_date(c: Column | str, fmt: str = DATE_ISO) -> Column:
    return F.try_to_timestamp(_col(c), F.lit(fmt)).cast("date")


def strict_timestamp(c: Column | str, fmt: str | None = None) -> Column:
    return F.to_timestamp(_col(c), fmt) if fmt else _col(c).cast("timestamp")


def try_timestamp(c: Column | str, fmt: str | None = None) -> Column:
    """Text to timestamp; without a format any ISO-like text is accepted."""
    return F.try_to_timestamp(_col(c), F.lit(fmt)) if fmt else _col(c).try_cast("timestamp")


def flag(c: Column | str) -> Column:
    """'true'/'false' in any case to boolean, everything else to NULL."""
    low = F.lower(_col(c))
    return F.when(low == "true", F.lit(True)).when(low == "false", F.lit(False))


def whole(c: Column | str, precision: int) -> Column:
    """Narrow a decimal to ``decimal(precision,0)``, rounded half up; overflow fails."""
    return F.round(_col(c), 0).cast(f"decimal({precision},0)")
