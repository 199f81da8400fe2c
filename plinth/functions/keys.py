"""Hash keys and dense surrogate keys."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plinth.session import stored

# Fixed values, as SQL escapes: separator between attributes and the mark that stands for NULL.
SEPARATOR = "\\u001f"
NULL_MARK = "\\u001e"


def _digest_sql(cols: tuple[str, ...]) -> str:
    parts = ", ".join(f"coalesce(cast(`{c}` as string), '{NULL_MARK}')" for c in cols)
    return f"sha1(concat_ws('{SEPARATOR}', {parts}))"


def digest(*cols: str) -> Column:
    """SHA-1 (40 hex digits) over the given columns, safe against shifted or missing values."""
    return F.expr(_digest_sql(cols))


def hash_key(*cols: str) -> Column:
    """BIGINT key from the first 60 bits of :func:`digest`.

    60 bits are comfortable up to some hundred million rows per table; beyond that use
    :func:`digest` as the key. ``check_unique`` on the key column finds a collision.
    """
    return F.expr(f"cast(conv(substring({_digest_sql(cols)}, 1, 15), 16, 10) as bigint)")


def with_key(
    df: DataFrame, name: str, cols: list[str], make_key: Callable[..., Column] = hash_key
) -> DataFrame:
    """Add a key over ``cols``; instants enter as microseconds, so no session time zone shows."""
    micros = {c: f"_micros_{c}" for c in cols if df.schema[c].dataType.typeName() == "timestamp"}
    wide = df.withColumns({m: F.unix_micros(c) for c, m in micros.items()}) if micros else df
    return wide.withColumn(name, make_key(*[micros.get(c, c) for c in cols])).drop(*micros.values())


#: Rows of a surrogate-key bucket, which one task numbers.
ROWS_PER_BUCKET = 1_000_000


def surrogate_key(
    df: DataFrame, key: list[str], name: str = "sk", start: int | Column = 0, buckets: int | None = None
) -> DataFrame:
    """Number the rows ``start+1, start+2, …`` without a gap, by unique natural key.

    Rows are spread over ``buckets`` (default: by the number of rows) by a hash of the key and
    numbered inside their bucket; the only global step is a running sum over one count per bucket.
    The result depends on the data alone, so a recomputed task gives the same numbers again.
    ``start`` may be a scalar subquery, such as the largest number given so far. Without
    ``buckets`` the rows are written once, to be counted and numbered from there.
    """
    df = df if buckets else stored(df, "numbered")
    n = buckets or max(1, -(-df.count() // ROWS_PER_BUCKET))
    first = start if isinstance(start, Column) else F.lit(start)
    bucketed = with_key(df, "_bucket", key).withColumn("_bucket", F.pmod("_bucket", F.lit(n)).cast("int"))
    counts = bucketed.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_rows"))
    # at most `buckets` rows, so the single-partition running sum and the broadcast are bounded
    before = Window.partitionBy(F.lit(0)).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(
        "_bucket", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset")
    )
    inside = Window.partitionBy("_bucket").orderBy(*key)
    return (
        bucketed.withColumn("_pos", F.row_number().over(inside))
        .join(F.broadcast(offsets), "_bucket")
        .withColumn(name, (first + F.col("_offset") + F.col("_pos")).cast("bigint"))
        .select(name, *df.columns)
    )
