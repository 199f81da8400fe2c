"""Neighbour lookups along time that survive a key holding a third of all rows.

A plain window partitioned by key sorts one key in one task. Here a key with more than
``rows_per_slice`` rows is cut into time slices at quantiles of its own times, so slices hold
about equally many rows however uneven time is: the window runs inside (key, slice), and one edge
row per slice carries the value over the cut. All other keys are a single slice and have no edges,
so the usual key pays nothing. There are at most rows / ``rows_per_slice`` big keys, which makes
their list safe to broadcast.

The row order inside a key must be total: callers reduce rows with equal time first.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

ROWS_PER_SLICE = 4_000_000
SLICE = "_slice"


#: Quantiles looked at per big key, hence its slices at most.
QUANTILES = 1024


def _micros(df: DataFrame, ts: str) -> Column:
    """Time as microseconds; zone-free timestamps are read off the wall clock, so no zone shifts them."""
    c = F.col(ts)
    if dict(df.dtypes)[ts] == "timestamp":
        return F.unix_micros(c)
    day = F.unix_date(c.cast("date")).cast("bigint") * 86_400_000_000
    if dict(df.dtypes)[ts] == "date":
        return day
    of_day = (F.hour(c) * 3600 + F.minute(c) * 60).cast("bigint") * 1_000_000
    return day + of_day + (F.extract(F.lit("SECOND"), c) * 1_000_000).cast("bigint")


def big_keys(df: DataFrame, key: list[str], ts: str, rows_per_slice: int = ROWS_PER_SLICE) -> DataFrame:
    """Keys with more than ``rows_per_slice`` rows, and the times ``_cuts`` that part their slices.

    Cuts are quantiles of the key's rows; rows of one instant stay together. A key gets twice as
    many slices as its row count asks for, which leaves room for the sketch's error.
    """
    rows = df.select(*key, _micros(df, ts).alias("_us"))
    counted = rows.groupBy(*key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > rows_per_slice)
    # quantiles are sketched for the few big keys alone
    few = F.broadcast(counted.select(*[F.col(k).alias(f"_big_{k}") for k in key], "_n"))
    on = reduce(lambda a, b: a & b, [F.col(k) == F.col(f"_big_{k}") for k in key])
    shares = [i / QUANTILES for i in range(1, QUANTILES)]
    sketched = rows.join(few, on).groupBy(*key).agg(
        F.max("_n").alias("_n"), F.percentile_approx("_us", shares, F.lit(10 * QUANTILES)).alias("_q")
    )
    slices = F.least(F.ceil(F.col("_n") * 2 / rows_per_slice), F.lit(QUANTILES)).cast("int")
    wanted = F.transform(
        F.sequence(F.lit(1), slices - 1), lambda i: F.element_at("_q", F.ceil(i * QUANTILES / slices).cast("int"))
    )
    return sketched.select(*key, F.array_sort(F.array_distinct(wanted)).alias("_cuts"))


def add_slice(df: DataFrame, key: list[str], ts: str, big: DataFrame) -> DataFrame:
    """Add the slice number: NULL for usual keys, else growing with time."""
    cuts = F.col("_cuts")

    def step(place: Column, width: Column) -> Column:
        """Binary search: go on by ``width`` cuts if the last of them is not later."""
        return F.when((place + width <= F.size(cuts)) & (F.get(cuts, place + width - 1) <= F.col("_us")), place + width).otherwise(place)

    widths = F.array(*[F.lit(1 << k) for k in reversed(range(QUANTILES.bit_length()))])
    place = F.when(cuts.isNotNull(), F.aggregate(widths, F.lit(0), step)).cast("bigint")
    return (
        df.withColumn("_us", _micros(df, ts)).join(F.broadcast(big), key, "left")
        .withColumn(SLICE, place)
        .select(*df.columns, SLICE)
    )


def _carry(edges: DataFrame, key: list[str], value: Column) -> DataFrame:
    """Edge rows with the value carried over from their neighbours.

    The details they are joined to are already partitioned by key and slice, so only edges move.
    """
    return edges.withColumn("_carry", value).select(*key, SLICE, "_carry")


def with_previous(df: DataFrame, key: list[str], ts: str, cols: list[str], name: str = "_prev") -> DataFrame:
    """Struct of ``cols`` from the key's preceding row; NULL on the first row. Needs the slice."""
    row = F.struct(*cols)
    inside = Window.partitionBy(*key, SLICE).orderBy(ts)
    edges = df.where(F.col(SLICE).isNotNull()).groupBy(*key, SLICE).agg(
        F.max_by(row, F.col(ts)).alias("_edge")
    )
    carried = _carry(edges, key, F.lag("_edge").over(Window.partitionBy(*key).orderBy(SLICE)))
    return (
        df.withColumn("_near", F.lag(row).over(inside))
        .join(carried, [*key, SLICE], "left")
        .withColumn(name, F.coalesce("_near", "_carry"))
        .drop("_near", "_carry")
    )


def with_next(df: DataFrame, key: list[str], ts: str, col: str, name: str = "_next") -> DataFrame:
    """``col`` of the key's following row; NULL on the last row. Needs the slice."""
    inside = Window.partitionBy(*key, SLICE).orderBy(ts)
    edges = df.where(F.col(SLICE).isNotNull()).groupBy(*key, SLICE).agg(
        F.min_by(F.struct(col), F.col(ts)).alias("_edge")
    )
    carried = _carry(edges, key, F.lead("_edge").over(Window.partitionBy(*key).orderBy(SLICE)))
    return (
        df.withColumn("_near", F.lead(F.struct(col)).over(inside))
        .join(carried, [*key, SLICE], "left")
        .withColumn(name, F.coalesce("_near", "_carry")[col])
        .drop("_near", "_carry")
    )


def asof_join(
    left: DataFrame, right: DataFrame, key: list[str], left_ts: str, right_ts: str, cols: list[str], *,
    rows_per_slice: int = ROWS_PER_SLICE, big: DataFrame | None = None,
) -> DataFrame:
    """Add to each left row ``cols`` of the newest right row with the key at or before its time.

    Both tables are laid on one timeline and the last known right row is carried forward, so the
    work is linear in the rows and no pairs of a key are formed. ``big`` may be given as the
    :func:`big_keys` of a cheaper table that covers both. Left rows without a key find nothing and
    stay.
    """
    keyed = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in key])
    left, unkeyed, right = left.where(keyed), left.where(~keyed), right.where(keyed)
    seen, whole = F.struct(*cols), F.struct(*left.columns)
    seen_type = right.select(seen.alias("s")).schema["s"].dataType
    left_type = left.select(whole.alias("s")).schema["s"].dataType
    line = left.select(
        *key, F.col(left_ts).alias("_at"), F.lit(1).alias("_side"),
        whole.alias("_left"), F.lit(None).cast(seen_type).alias("_seen"),
    ).unionByName(
        right.select(
            *key, F.col(right_ts).alias("_at"), F.lit(0).alias("_side"),
            F.lit(None).cast(left_type).alias("_left"), seen.alias("_seen"),
        )
    )
    if big is None:
        big = big_keys(line, key, "_at", rows_per_slice)
    line = add_slice(line, key, "_at", big)
    # at equal times the right row (side 0) comes first, so it is visible to the left row
    so_far = (
        Window.partitionBy(*key, SLICE).orderBy("_at", "_side")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    edges = line.where(F.col(SLICE).isNotNull()).groupBy(*key, SLICE).agg(
        F.max_by("_seen", F.when(F.col("_side") == 0, F.col("_at"))).alias("_edge")
    )
    before = Window.partitionBy(*key).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carried = _carry(edges, key, F.last("_edge", ignorenulls=True).over(before))
    found = (
        line.withColumn("_near", F.last("_seen", ignorenulls=True).over(so_far))
        .where(F.col("_side") == 1)
        .join(carried, [*key, SLICE], "left")
        .withColumn("_found", F.coalesce("_near", "_carry"))
        .select("_left.*", *[F.col("_found")[c].alias(c) for c in cols])
    )
    empty = [F.lit(None).cast(right.schema[c].dataType).alias(c) for c in cols]
    return found.unionByName(unkeyed.select("*", *empty))
