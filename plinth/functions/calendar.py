"""Calendar attributes and the date dimension."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.functions.keys import hash_key


def date_parts(c: Column | str) -> list[Column]:
    """Year to day name of a date; weeks are ISO weeks, weekdays run 1=Sunday to 7=Saturday."""
    d = F.col(c) if isinstance(c, str) else c
    return [
        F.year(d).alias("year"),
        F.quarter(d).alias("quarter"),
        F.month(d).alias("month"),
        F.weekofyear(d).alias("week"),
        F.dayofyear(d).alias("day_of_year"),
        F.dayofweek(d).alias("day_of_week"),
        F.dayofmonth(d).alias("day_of_the_month"),
        F.date_format(d, "EEEE").alias("day_name"),
    ]


def month_abbr(month: Column | str) -> Column:
    """1..12 to Jan..Dec."""
    m = F.col(month) if isinstance(month, str) else month
    return F.date_format(F.make_date(F.lit(2000), m.cast("int"), F.lit(1)), "MMM")


def date_dim(
    orders: DataFrame, order_date: str, as_of: Column | None = None, include_first_day: bool = True
) -> DataFrame:
    """One row per day from the earliest order up to ``as_of`` (default: today).

    ``include_first_day=False`` leaves out the earliest order's own day, as a strict ``>`` bound
    on the spine would.
    """
    end = F.current_date() if as_of is None else as_of
    bounds = orders.agg(
        F.min(F.to_date(order_date)).alias("first_day"), F.max(end).alias("last_day")
    )
    first = F.col("first_day") if include_first_day else F.date_add("first_day", 1)
    days = bounds.where(first <= F.col("last_day")).select(
        F.explode(F.sequence(first, F.col("last_day"))).alias("calendar_date")
    )
    return days.select(
        hash_key("calendar_date").alias("date_dim_hk"), "calendar_date", *date_parts("calendar_date")
    )
