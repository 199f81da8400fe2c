"""Revenue by day on a stream of orders."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MICROS_PER_DAY = 86_400_000_000


def business_day(ts: str | Column, zone: str) -> Column:
    """The calendar day of an instant in a time zone, whatever the session's zone is."""
    wall_clock = F.unix_micros(F.from_utc_timestamp(ts, zone))
    return F.date_from_unix_date(F.floor(wall_clock / F.lit(MICROS_PER_DAY)).cast("int"))


def daily_revenue(orders: DataFrame, ts: str, amount: str, *, zone: str = "UTC") -> DataFrame:
    """Revenue and orders per day of ``zone``.

    There is no watermark: state is one row per day, so it stays small, and an order that comes in
    late, by however much, still counts.
    """
    return (
        orders.groupBy(business_day(ts, zone).alias("calendar_date"))
        .agg(F.sum(amount).alias("total_revenue"), F.count(F.lit(1)).alias("total_orders"))
        .select("calendar_date", F.col("total_revenue").cast("decimal(18,2)").alias("total_revenue"), "total_orders")
    )
