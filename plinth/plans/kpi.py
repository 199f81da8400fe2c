"""Revenue KPI views and the reports built on them.

All views start from one row per order (and restaurant): items are summed per order before any
join, which needs no shuffle by a skewed key and turns the distinct count of orders into a plain
count. An order has one date and one delivery, so nothing is counted twice.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from plinth.functions.calendar import month_abbr
from plinth.functions.casting import whole

DELIVERED = "Delivered"
MEASURES = ["total_revenue", "total_orders", "avg_revenue_per_order", "avg_revenue_per_item", "max_order_value"]
MONEY = "decimal(18,2)"


def order_totals(items: DataFrame, order_key: str = "order_id_fk", by: list[str] = ()) -> DataFrame:
    """Per order (and ``by``): revenue, number of items, largest line."""
    return items.groupBy(F.col(order_key).alias("order_id"), *by).agg(
        F.sum("subtotal").alias("revenue"),
        F.count(F.lit(1)).alias("items"),
        F.max("subtotal").alias("max_line"),
    )


def totals_from_clean(
    items: DataFrame, orders: DataFrame, deliveries: DataFrame, date_dim: DataFrame, *,
    status: str | None = DELIVERED, by: list[str] = (),
) -> DataFrame:
    """Order totals with delivery status and calendar columns, from the clean tables."""
    return totals_from_sums(order_totals(items, by=by), orders, deliveries, date_dim, status=status)


def totals_from_sums(
    sums: DataFrame, orders: DataFrame, deliveries: DataFrame, date_dim: DataFrame, *, status: str | None = DELIVERED
) -> DataFrame:
    """The same from the result of :func:`order_totals`."""
    shipped = deliveries.select(F.col("order_id_fk").alias("order_id"), "delivery_status")
    if status:
        shipped = shipped.where(F.col("delivery_status") == status)
    headers = orders.select("order_id", F.to_date("order_date").alias("calendar_date")).join(shipped, "order_id")
    return sums.join(headers, "order_id").join(F.broadcast(date_dim), "calendar_date")


def sum_again(sums: DataFrame, by: list[str]) -> DataFrame:
    """Sums of :func:`order_totals` per coarser key."""
    return sums.groupBy(*by).agg(
        F.sum("revenue").alias("revenue"), F.sum("items").alias("items"), F.max("max_line").alias("max_line")
    )


def totals_from_fact(
    fact: DataFrame, date_dim: DataFrame, *, status: str | None = DELIVERED, by: list[str] = ()
) -> DataFrame:
    """Order totals with delivery status and calendar columns, from the stored fact."""
    rows = fact.where(F.col("delivery_status") == status) if status else fact
    totals = order_totals(rows, "order_id", ["order_date_dim_key", "delivery_status", *by])
    dated = F.broadcast(date_dim.withColumnRenamed("date_dim_hk", "order_date_dim_key"))
    return totals.join(dated, "order_date_dim_key")


def revenue_kpis(totals: DataFrame, grain: list[str | Column]) -> DataFrame:
    """The five revenue measures per ``grain``; ``max_order_value`` is the largest single line."""
    summed = totals.groupBy(*grain).agg(
        F.sum("revenue").alias("_revenue"), F.count(F.lit(1)).alias("total_orders"),
        F.sum("items").alias("_items"), F.max("max_line").alias("_max"),
    )
    return measures(summed, [c for c in summed.columns if c not in ("_revenue", "total_orders", "_items", "_max")])


def measures(summed: DataFrame, keys: list[str]) -> DataFrame:
    return summed.select(
        *keys,
        F.col("_revenue").cast(MONEY).alias("total_revenue"),
        "total_orders",
        F.round(F.col("_revenue") / F.col("total_orders"), 2).cast(MONEY).alias("avg_revenue_per_order"),
        F.round(F.col("_revenue") / F.col("_items"), 2).cast(MONEY).alias("avg_revenue_per_item"),
        F.col("_max").cast(MONEY).alias("max_order_value"),
    )


def yearly(totals: DataFrame) -> DataFrame:
    return revenue_kpis(totals, ["year"]).orderBy("year")


def monthly(totals: DataFrame) -> DataFrame:
    return revenue_kpis(totals, ["year", "month"]).orderBy("year", "month")


def daily(totals: DataFrame) -> DataFrame:
    return revenue_kpis(totals, ["year", "month", F.col("day_of_the_month").alias("day")]).orderBy("year", "month", "day")


def weekday(totals: DataFrame) -> DataFrame:
    """By year, month and weekday; callers pass totals of all delivery statuses."""
    return revenue_kpis(totals, ["year", "month", "day_name"])


def with_restaurant(items: DataFrame, restaurants: DataFrame, key: str, dim_key: str) -> DataFrame:
    """Order sums per restaurant (or items, or fact rows) with the restaurant's name."""
    names = restaurants.select(F.col(dim_key).alias(key), F.col("name").alias("restaurant_name"))
    return items.join(names, key)


def by_restaurant(totals: DataFrame) -> DataFrame:
    """By month, delivery status and restaurant name, from totals ``by`` the restaurant name.

    Names are not unique: an order that spans two restaurants of one name is one order, which is
    why sums per restaurant are summed again per name.
    """
    return revenue_kpis(totals, ["year", "month", "delivery_status", "restaurant_name"])


def rollup(totals: DataFrame) -> DataFrame:
    """Year, month, day and their subtotals in one pass; days are summed first, so only they expand."""
    days = totals.groupBy("year", "month", F.col("day_of_the_month").alias("day")).agg(
        F.sum("revenue").alias("r"), F.count(F.lit(1)).alias("o"), F.sum("items").alias("i"),
        F.max("max_line").alias("m"),
    )
    levels = days.rollup("year", "month", "day").agg(
        F.grouping_id().cast("int").alias("grouping_level"), F.sum("r").alias("_revenue"),
        F.sum("o").alias("total_orders"), F.sum("i").alias("_items"), F.max("m").alias("_max"),
    )
    return measures(levels, ["year", "month", "day", "grouping_level"])


def restaurant_cube(rows: DataFrame) -> DataFrame:
    """Revenue, distinct orders and largest line by year, month, restaurant, and all their subtotals.

    An order with items of several restaurants counts once wherever it is summed up, so counts do
    not add. Rows are summed per order first. Where a group has a restaurant, its orders are few and
    scattered: the first row of an order in a group is marked, and marks are summed. The groups
    without a restaurant hold most orders of a stretch of numbers, so they are counted by exact
    bitmaps: order numbers are dealt to buckets of 32,768, each worked on by one task, and coarser
    groups are the union of bitmaps.
    """
    grain = ["year", "month", "restaurant_name"]
    per_order = rows.groupBy("order_id", *grain).agg(F.sum("subtotal").alias("_revenue"), F.max("subtotal").alias("_max"))
    known = F.col("order_id").isNotNull()

    def first_of(by: list[str], rest: list[str]) -> Column:
        place = F.row_number().over(Window.partitionBy("order_id", *by).orderBy(*rest))
        return (known & (place == 1)).cast("int")

    marked = (
        per_order.withColumn("_all", known.cast("int"))
        .withColumn("_year", first_of(["restaurant_name", "year"], ["month"]))
        .withColumn("_name", first_of(["restaurant_name"], ["year", "month"]))
        .withColumn("_month", first_of(["restaurant_name", "month"], ["year"]))
    )
    marks = ["_all", "_year", "_month", "_name"]
    fine = marked.groupBy(*grain).agg(F.sum("_revenue").alias("_revenue"), F.max("_max").alias("_max"), *[F.sum(c).alias(c) for c in marks])
    sets = [[c for k, c in enumerate(grain) if level & (4 >> k) == 0] for level in range(8)]
    sums = fine.groupingSets(sets, *grain).agg(
        F.grouping_id().cast("int").alias("_id"), F.sum("_revenue").alias("_revenue"), F.max("_max").alias("_max"), *[F.sum(c).alias(c) for c in marks],
    )
    by_id = F.when(F.col("_id") == 0, F.col("_all")).when(F.col("_id") == 2, F.col("_year")).when(F.col("_id") == 4, F.col("_month")).when(F.col("_id") == 6, F.col("_name"))
    named = sums.select(*grain, "_id", F.coalesce(by_id, F.lit(0)).alias("_n"), "_revenue", "_max")

    # the bucket is part of every level, so the bitmaps of a group stay small and in many groups
    dated = rows.groupBy("order_id", "year", "month").agg(F.bitmap_bucket_number("order_id").alias("_bucket"))
    months = dated.where(known).repartition("_bucket").groupBy("year", "month", "_bucket").agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("order_id")).alias("_orders")
    )
    periods = [["year", "month"], ["year"], ["month"], []]
    counts = months.groupingSets([[*p, "_bucket"] for p in periods], "year", "month", "_bucket").agg(
        F.grouping_id().alias("_period"), F.bitmap_count(F.bitmap_or_agg("_orders")).alias("_n"),
    ).groupBy("year", "month", "_period").agg(F.sum("_n").alias("_n"))
    kinds = dict(named.dtypes)
    # a period's number has the bucket as its last bit, a level's the restaurant, which is summed up here
    unnamed = counts.select(
        "year", "month", F.lit(None).cast(kinds["restaurant_name"]).alias("restaurant_name"), (F.col("_period") + 1).cast("int").alias("_id"), "_n",
        *[F.lit(None).cast(kinds[c]).alias(c) for c in ("_revenue", "_max")],
    )
    return named.unionByName(unnamed).groupBy(*grain, "_id").agg(
        F.sum("_n").alias("total_orders"), F.sum("_revenue").cast(MONEY).alias("total_revenue"), F.max("_max").alias("max_order_value"),
    ).select(*grain, F.col("_id").alias("grouping_level"), "total_revenue", "total_orders", "max_order_value")


def register_views(fact: DataFrame, date_dim: DataFrame, restaurants: DataFrame) -> None:
    """The five KPI views over the stored fact, under the names reports query them by."""
    named = with_restaurant(fact, restaurants, "restaurant_dim_key", "restaurant_hk")
    delivered = totals_from_fact(fact, date_dim)
    views = {
        "vw_yearly_revenue_kpis": yearly(delivered),
        "vw_monthly_revenue_kpis": monthly(delivered),
        "vw_daily_revenue_kpis": daily(delivered),
        "vw_day_revenue_kpis": weekday(totals_from_fact(fact, date_dim, status=None)),
        "vw_monthly_revenue_by_restaurant": by_restaurant(
            totals_from_fact(named, date_dim, status=None, by=["restaurant_name"])
        ),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)


# Reports over the views: all inputs below are a few rows per year, month or restaurant.


def overall(yearly_kpis: DataFrame) -> DataFrame:
    return yearly_kpis.agg(
        F.sum("total_revenue").cast(MONEY).alias("total_revenue"), F.sum("total_orders").alias("total_orders"),
        F.max("max_order_value").alias("max_order_value"),
    )


def for_period(kpis: DataFrame, year: int | None = None, month: int | None = None) -> DataFrame:
    """KPI rows of one year (default: the latest) and, if given, one month."""
    wanted = kpis.agg(F.max("year")).scalar() if year is None else F.lit(year)
    rows = kpis.where(F.col("year") == wanted)
    return rows if month is None else rows.where(F.col("month") == F.lit(month))


def year_over_year(yearly_kpis: DataFrame) -> DataFrame:
    """Each year with its change against the year directly before; NULL where that is missing."""
    before = yearly_kpis.select(
        (F.col("year") + 1).alias("year"), *[F.col(m).alias(f"_prev_{m}") for m in MEASURES]
    )
    joined = yearly_kpis.join(before, "year", "left")
    return joined.select(
        "year", *MEASURES,
        *[(F.col(m) - F.col(f"_prev_{m}")).alias(f"{m}_diff") for m in MEASURES],
    )


def monthly_trend(monthly_kpis: DataFrame, year: int | None = None) -> DataFrame:
    """Month number, month name and revenue in whole units for one year."""
    return for_period(monthly_kpis, year).select(
        F.col("month").cast("int").alias("month"), month_abbr("month").alias("month_name"),
        whole("total_revenue", 10).alias("total_revenue"),
    ).orderBy("month")


def months_with_data(restaurant_kpis: DataFrame, year: int | None = None) -> DataFrame:
    return for_period(restaurant_kpis, year).select("month").distinct().orderBy("month")


def by_restaurant_all_statuses(totals: DataFrame) -> DataFrame:
    """Restaurant view without the status split, for a ranking with one row per restaurant."""
    return by_restaurant(totals.withColumn("delivery_status", F.lit("all")))


def top_restaurants(restaurant_kpis: DataFrame, year: int, month: int, n: int = 10) -> DataFrame:
    """The ``n`` rows with the highest revenue in a month; name and status break ties."""
    rows = for_period(restaurant_kpis, year, month)
    ranked = rows.orderBy(F.desc("total_revenue"), "restaurant_name", "delivery_status").limit(n)
    return ranked.select("restaurant_name", *MEASURES)


# Headings of the restaurant ranking.
RANKING_HEADINGS = [
    "Restaurant Name", "Total Revenue (₹)", "Total Orders", "Avg Revenue per Order (₹)",
    "Avg Revenue per Item (₹)", "Max Order Value (₹)",
]


def ranking_for_display(ranking: DataFrame):
    """The rows of :func:`top_restaurants`, which has the ``n`` rows asked of it, as a pandas frame with readable headings."""
    return ranking.toDF(*RANKING_HEADINGS).toPandas()


def top_per_month(restaurant_kpis: DataFrame, n: int = 10) -> DataFrame:
    """The top ``n`` of every month in one pass; only ``n`` rows per month and task are shuffled."""
    order = [F.desc("total_revenue"), F.col("restaurant_name"), F.col("delivery_status")]
    ranked = restaurant_kpis.withColumn(
        "rank", F.row_number().over(Window.partitionBy("year", "month").orderBy(*order))
    )
    return ranked.where(F.col("rank") <= n)
