"""KPIs kept up to date from the change rows of the fact.

The state has one row per group (day, delivery status and, for the ranking, restaurant name):
revenue, items, orders and the largest line. Change rows are signed: an INSERT image adds, a DELETE
image takes away. Revenue and items add up. Whether an order is new to a group or has left it is
seen from its items there, before and after; the largest line has to be looked for again only where
one as large was taken away. So only the days that a batch touches are read.

An order has one day and, at a time, one status, so coarser views are sums of the state.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plinth.plans import kpi

DAY_GRAIN = ["order_date", "delivery_status"]
RESTAURANT_GRAIN = [*DAY_GRAIN, "restaurant_name"]
_SUMS = ["revenue", "items", "orders", "max_line"]


def state_of(rows: DataFrame, grain: list[str]) -> DataFrame:
    """The state of fact rows, from scratch."""
    per_order = rows.groupBy(*grain, "order_id").agg(
        F.sum("subtotal").alias("revenue"), F.count(F.lit(1)).alias("items"), F.max("subtotal").alias("max_line")
    )
    return _typed(per_order.groupBy(*grain).agg(
        F.sum("revenue").alias("revenue"), F.sum("items").alias("items"), F.count(F.lit(1)).alias("orders"),
        F.max("max_line").alias("max_line"),
    ), grain)


def _typed(state: DataFrame, grain: list[str]) -> DataFrame:
    kinds = {"revenue": "decimal(28,2)", "items": "bigint", "orders": "bigint", "max_line": "decimal(10,2)"}
    return state.select(*grain, *[F.col(c).cast(kinds[c]).alias(c) for c in _SUMS])


def order_deltas(changes: DataFrame, after: DataFrame, grain: list[str]) -> DataFrame:
    """Signed sums of the change rows per group and order, whether the order is new to the group (1) or
    has left it (-1), and the largest line that ``after`` has there. An order without change has no sums."""
    place = [*grain, "order_id"]
    added = F.col("_action") == "INSERT"
    sign, line = F.when(added, 1).otherwise(-1), F.col("subtotal")
    kind, none = changes.schema["subtotal"].dataType, F.lit(None)
    seen = changes.select(
        *place, (sign * line).alias("d_revenue"), sign.alias("d_items"), F.when(added, line).alias("added_max"), F.when(~added, line).alias("lost_max"),
        F.lit(0).alias("_now"), none.cast(kind).alias("largest"),
    )
    held = after.select(
        *place, none.cast(seen.schema["d_revenue"].dataType).alias("d_revenue"), none.cast("int").alias("d_items"), none.cast(kind).alias("added_max"),
        none.cast(kind).alias("lost_max"), F.lit(1).alias("_now"), line.alias("largest"),
    )
    # one shuffle for both: no join by group and order
    summed = seen.unionByName(held).groupBy(*place).agg(
        F.sum("d_revenue").alias("d_revenue"), F.sum("d_items").alias("d_items"), F.max("added_max").alias("added_max"), F.max("lost_max").alias("lost_max"),
        F.sum("_now").alias("_now"), F.max("largest").alias("largest"),
    )
    moved = (F.col("_now") > 0).cast("int") - (F.col("_now") - F.col("d_items") > 0).cast("int")
    return summed.withColumn("d_orders", moved).drop("_now")


def apply_changes(state: DataFrame, changes: DataFrame, after: DataFrame, grain: list[str]) -> DataFrame:
    """The state after a batch of fact change rows.

    ``after`` are fact rows after the batch; it must hold all rows of the touched groups and may
    leave out all others (callers read the touched days alone). A group without items leaves.
    """
    old = state.withColumnsRenamed({c: f"_s_{c}" for c in _SUMS})
    deltas = order_deltas(changes, after, grain)
    found = ["added_max", "lost_max", "largest"]
    # the state has a row per group: its columns come through the sums as they are
    both = old.unionByName(deltas.drop("order_id"), allowMissingColumns=True).groupBy(*grain).agg(
        *[F.sum(f"{p}{c}").alias(f"{p}{c}") for p in ("_s_", "d_") for c in _SUMS[:3]], *[F.max(c).alias(c) for c in ("_s_max_line", *found)]
    )
    # where the largest line was taken away, it is the largest of what is left of the group
    again = F.coalesce(F.col("lost_max") >= F.col("_s_max_line"), F.lit(False))
    return _typed(both.select(
        *grain, *[(F.coalesce(f"_s_{c}", F.lit(0)) + F.coalesce(f"d_{c}", F.lit(0))).alias(c) for c in _SUMS[:3]],
        F.when(again, F.col("largest")).otherwise(F.greatest("_s_max_line", "added_max")).alias("max_line"),
    ).where(F.col("items") > 0), grain)


def touched_days(changes: DataFrame) -> list:
    """Days on which a batch changes something: days of the calendar, so a short list."""
    return sorted(r[0] for r in changes.select("order_date").where("order_date is not null").distinct().collect())


def view(state: DataFrame, dates: DataFrame, by: list[str | Column], status: str | None = None) -> DataFrame:
    """A KPI view: the five measures per ``by``, from the state and the date dimension."""
    rows = state.where(F.col("delivery_status") == status) if status else state
    dated = rows.join(F.broadcast(dates.withColumnRenamed("calendar_date", "order_date")), "order_date")
    summed = dated.groupBy(*by).agg(
        F.sum("revenue").alias("_revenue"), F.sum("orders").alias("total_orders"), F.sum("items").alias("_items"), F.max("max_line").alias("_max"),
    )
    return kpi.measures(summed, [c for c in summed.columns if c not in ("_revenue", "total_orders", "_items", "_max")])


def views(state: DataFrame, by_name: DataFrame, dates: DataFrame) -> dict[str, DataFrame]:
    """The five KPI views, from the state per day and the one per restaurant."""
    day = F.col("day_of_the_month").alias("day")
    return {
        "yearly": view(state, dates, ["year"], kpi.DELIVERED),
        "monthly": view(state, dates, ["year", "month"], kpi.DELIVERED),
        "daily": view(state, dates, ["year", "month", day], kpi.DELIVERED),
        "weekday": view(state, dates, ["year", "month", "day_name"]),
        "restaurant": view(by_name, dates, ["year", "month", "delivery_status", "restaurant_name"]),
    }
