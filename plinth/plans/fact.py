"""The order-item fact: a star join at item grain."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from plinth.operators.joins import heavy_keys, lookup_dim, salted_join, splits_skew
from plinth.operators.latest import single_per_key
from plinth.operators.merge import Merged, any_differs, fields, merge, metadata_of

FACT_KEYS = ["order_item_id", "order_id"]
FACT_COLUMNS = [
    *FACT_KEYS, "customer_dim_key", "customer_address_dim_key", "restaurant_dim_key",
    "restaurant_location_dim_key", "menu_dim_key", "delivery_agent_dim_key", "order_date_dim_key",
    "quantity", "price", "subtotal", "delivery_status", "estimated_time",
]


def build_fact(
    items: DataFrame, orders: DataFrame, deliveries: DataFrame, dims: Mapping[str, DataFrame], *,
    as_of: bool = True, salt: bool | None = None, share: float = 0.01, by_order: int | None = None,
) -> DataFrame:
    """Fact rows for the given items.

    ``items`` carry the restaurant they were bought from, else the order's is taken.
    ``as_of`` looks every dimension up at the order date (dimensions need ``valid_from``);
    otherwise they must hold current rows only. An order's address is the one it was delivered to.

    Order-grain dimensions are joined before the items come in, so the item table, several times
    the size, is shuffled for its own keys only. Each join is between two shuffles, which lets
    adaptive execution split the partition of a hot key; where that is switched off (or ``salt`` is
    set) sketches find the hot values of every foreign key and the joins are salted.

    With ``by_order``, as many as a shuffle of the session has, the rows leave in that many partitions
    by ``order_id``, to be written where they are: items look up their own dimensions first, as narrow
    rows that bring the order's date only, and the join with the order is the last one.
    """
    at = "order_date" if as_of else None
    if salt is None:
        salt = not splits_skew(items.sparkSession)
    if "restaurant_id_fk" in items.columns:
        orders = orders.drop("restaurant_id_fk")
    # customers are keyed by text, orders refer to them by number: one side is cast, once
    headers = orders.select(
        "order_id", F.col("customer_id_fk").cast("string").alias("customer_id_fk"), "order_date",
        *[c for c in orders.columns if c == "restaurant_id_fk"],
    )
    shipped = deliveries.select(
        F.col("order_id_fk").alias("order_id"), "delivery_agent_id_fk", "customer_address_id_fk",
        "delivery_status", "estimated_time",
    )
    lines = items.withColumnRenamed("order_id_fk", "order_id")
    heavy: dict[str, list[int]] = {}
    if salt:
        for df in (headers, shipped, lines):
            keys = [c for c in df.columns if c.endswith("_id_fk") or (df is lines and c == "order_id")]
            heavy |= dict(zip(keys, heavy_keys(df, [[c] for c in keys], share)))

    def look_up(df: DataFrame, dim: str, key: str, dim_key: str, hk: str, out: str, extra=()) -> DataFrame:
        return lookup_dim(
            df, dims[dim], key, dim_key, hk, out, at=at, extra=list(extra), heavy=heavy.get(key, [])
        )

    star = look_up(headers, "customer", "customer_id_fk", "customer_id", "customer_hk", "customer_dim_key")
    star = star.join(shipped, "order_id")
    star = look_up(
        star, "customer_address", "customer_address_id_fk", "address_id", "customer_address_hk",
        "customer_address_dim_key",
    )
    star = look_up(
        star, "delivery_agent", "delivery_agent_id_fk", "delivery_agent_id", "delivery_agent_hk",
        "delivery_agent_dim_key",
    )
    # one row per day, so the calendar is always small enough to broadcast
    calendar = F.broadcast(
        dims["date"].select(
            F.col("calendar_date").alias("_day"), F.col("date_dim_hk").alias("order_date_dim_key")
        )
    )
    star = star.join(calendar, F.to_date("order_date") == F.col("_day")).drop("_day")

    def of_item(rows: DataFrame) -> DataFrame:
        rows = look_up(rows, "menu", "menu_id_fk", "menu_id", "menu_dim_hk", "menu_dim_key")
        rows = look_up(
            rows, "restaurant", "restaurant_id_fk", "restaurant_id", "restaurant_hk", "restaurant_dim_key",
            extra=["location_id_fk"],
        )
        return look_up(
            rows, "location", "location_id_fk", "location_id", "restaurant_location_hk",
            "restaurant_location_dim_key",
        )

    if by_order:
        facts = _placed(lines, headers, star, of_item, by_order)
    else:
        facts = of_item(salted_join(lines, star, ["order_id"], heavy=heavy.get("order_id", [])))
    return facts.select(
        "order_item_id", "order_id", *FACT_COLUMNS[2:9],
        F.round("quantity", 0).cast("decimal(10,0)").alias("quantity"), *FACT_COLUMNS[10:],
    )


def _placed(
    lines: DataFrame, headers: DataFrame, star: DataFrame, of_item: Callable[[DataFrame], DataFrame], partitions: int
) -> DataFrame:
    """Items with what ``of_item`` looks up for them and the star row of their order, by order."""
    named = [c for c in headers.columns if c not in ("order_id", "customer_id_fk")]  # order_date, maybe restaurant_id_fk
    of_order = headers.select("order_id", *named).repartition(partitions, "order_id").distinct()
    own = ["order_item_id", "order_id", "menu_id_fk", *[c for c in lines.columns if c == "restaurant_id_fk"], "quantity", "price", "subtotal"]
    narrow = lines.select(*own).join(of_order, "order_id")
    found = of_item(narrow).select(
        "order_item_id", F.col("order_id").alias("_order"), *[F.col(c).alias(f"_{c}") for c in named], "quantity", "price",
        "subtotal", "menu_dim_key", "restaurant_dim_key", "restaurant_location_dim_key",
    )
    # an order that came twice may have two dates: a row keeps the one it was looked up at. Written as bounds, since
    # the date would else be a key of the join, and the rows be dealt by it as well
    same = [(F.col(f"_{c}") <= F.col(c)) & (F.col(f"_{c}") >= F.col(c)) for c in named]
    on = reduce(lambda a, b: a & b, same, F.col("_order") == F.col("order_id"))
    # merged even where one side is small, as a broadcast would leave the rows where the other side's are
    return found.repartition(partitions, "_order").join(star.hint("merge"), on).drop("_order", *[f"_{c}" for c in named])


def touched_orders(changed_orders: list[DataFrame], changed_items: DataFrame | None = None) -> DataFrame:
    """``order_id`` of the orders to rebuild: header, delivery or an item changed, each order once.

    ``changed_orders`` are tables with ``order_id`` (from the change rows of orders and deliveries).
    """
    ids = [df.select("order_id") for df in changed_orders]
    if changed_items is not None:
        ids.append(changed_items.select(F.col("order_id_fk").alias("order_id")))
    return reduce(DataFrame.unionByName, ids).distinct()


def of_orders(rows: DataFrame, ids: DataFrame, key: str = "order_id_fk") -> DataFrame:
    """Rows of a clean table that belong to the orders ``ids``.

    With all three big tables cut down so, a rebuild looks up dimensions for touched orders only.
    """
    return rows.join(ids.select(F.col("order_id").alias(key)), key, "left_semi")


def touched_items(items: DataFrame, changed_orders: list[DataFrame], changed_items: DataFrame) -> DataFrame:
    """Items to rebuild: changed themselves, or part of an order whose header or delivery changed.

    The full clean tables are joined afterwards, so an item that came in earlier than its order is
    not lost.
    """
    return of_orders(items, touched_orders(changed_orders, changed_items))


def orphans(items: DataFrame, rows: DataFrame) -> DataFrame:
    """Items that found no order, delivery or dimension row and so are in no fact row."""
    named = items.withColumnRenamed("order_id_fk", "order_id")
    return named.join(rows.select(*FACT_KEYS), FACT_KEYS, "left_anti")


@dataclass(frozen=True)
class Replaced(Merged):
    """Result of :func:`replace_orders`: a fact row may have no new image."""

    def table(self) -> DataFrame:
        kept = self.rows.where(F.col("_new").isNotNull())
        return kept.select(*fields("_new", self.columns, self.metadata))


def replace_orders(fact: DataFrame, rows: DataFrame, touched: DataFrame) -> Replaced:
    """The fact in which the rows of the ``touched`` orders are exactly ``rows``.

    What an order has lost (a returned item, a deleted order, delivery or dimension row) leaves the
    fact as a true DELETE; equal rows are no change. ``fact`` may be any part of the table that
    holds all rows of these orders.
    """
    ids = touched.select(F.col("order_id").alias("_touched")).distinct()
    flagged = fact.join(ids, F.col("order_id") == F.col("_touched"), "left")
    old = flagged.select(*[F.col(k).alias(f"_old_{k}") for k in FACT_KEYS], F.struct(*fact.columns).alias("_old"), "_touched")
    src = single_per_key(rows.select(*fact.columns), FACT_KEYS).select(
        *[F.col(k).alias(f"_src_{k}") for k in FACT_KEYS], F.struct(*fact.columns).alias("_src")
    )
    on = reduce(lambda a, b: a & b, [F.col(f"_old_{k}") == F.col(f"_src_{k}") for k in FACT_KEYS])
    joined = old.join(src, on, "full_outer")
    compared = [c for c in fact.columns if c not in FACT_KEYS]
    op = (
        F.when(F.col("_old").isNull(), "insert")
        .when(F.col("_src").isNotNull(), F.when(any_differs("_old", "_src", compared), "update").otherwise("keep"))
        .when(F.col("_touched").isNotNull(), "delete").otherwise("keep")
    )
    new = F.when(F.col("_src").isNotNull(), F.col("_src")).when(F.col("_touched").isNull(), F.col("_old"))
    return Replaced(joined.select(op.alias("_op"), "_old", new.alias("_new")), fact.columns, metadata_of(fact, rows))


def merge_fact(fact: DataFrame, rows: DataFrame, order_by: list[str] | None = None) -> Merged:
    """Upsert fact rows on item and order."""
    return merge(fact, rows, FACT_KEYS, order_by=order_by)


def save_bucketed(df: DataFrame, name: str, key: str, buckets: int, path: str) -> DataFrame:
    """The rows as a table of the session's catalog, bucketed and sorted by ``key``.

    Tables with equally many buckets on the same key are joined where they lie. One task writes a
    bucket, so that a bucket is one sorted file.
    """
    placed = df.repartition(buckets, key)
    by_key = placed.write.bucketBy(buckets, key).sortBy(key).option("compression", "zstd")
    by_key.option("path", path).mode("overwrite").saveAsTable(name)
    return df.sparkSession.table(name)


def order_lines(items: DataFrame, orders: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Items with the header and delivery of their order: the large joins of the fact.

    From tables saved by :func:`save_bucketed` on the order's number none of the three moves.
    """
    headers = orders.select(
        "order_id", F.col("customer_id_fk").cast("string").alias("customer_id_fk"), "order_date",
        *[c for c in orders.columns if c == "restaurant_id_fk" and c not in items.columns],
    )
    shipped = deliveries.select("order_id_fk", "delivery_agent_id_fk", "customer_address_id_fk", "delivery_status", "estimated_time")
    # the keys are joined as they are stored: a renamed column is still the bucketed one
    lines = items.join(headers, items["order_id_fk"] == headers["order_id"]).drop("order_id_fk")
    return lines.join(shipped, lines["order_id"] == shipped["order_id_fk"]).drop("order_id_fk")


def fact_of_lines(lines: DataFrame, dims: Mapping[str, DataFrame]) -> DataFrame:
    """The fact from :func:`order_lines`: equal to :func:`build_fact`, with all look-ups at item grain.

    Worth it where the three big tables are stored bucketed and the dimensions are small against
    them: then only dimension look-ups that are too big to broadcast move the items.
    """
    rows = lines
    for dim, key, dim_key, hk, out, extra in (
        ("customer", "customer_id_fk", "customer_id", "customer_hk", "customer_dim_key", []),
        ("customer_address", "customer_address_id_fk", "address_id", "customer_address_hk", "customer_address_dim_key", []),
        ("delivery_agent", "delivery_agent_id_fk", "delivery_agent_id", "delivery_agent_hk", "delivery_agent_dim_key", []),
        ("menu", "menu_id_fk", "menu_id", "menu_dim_hk", "menu_dim_key", []),
        ("restaurant", "restaurant_id_fk", "restaurant_id", "restaurant_hk", "restaurant_dim_key", ["location_id_fk"]),
        ("location", "location_id_fk", "location_id", "restaurant_location_hk", "restaurant_location_dim_key", []),
    ):
        rows = lookup_dim(rows, dims[dim], key, dim_key, hk, out, at="order_date", extra=extra, heavy=[])
    days = dims["date"].select(F.col("calendar_date").alias("_day"), F.col("date_dim_hk").alias("order_date_dim_key"))
    rows = rows.join(F.broadcast(days), F.to_date("order_date") == F.col("_day"))  # one row per day
    return rows.select(
        "order_item_id", "order_id", *FACT_COLUMNS[2:9], F.round("quantity", 0).cast("decimal(10,0)").alias("quantity"), *FACT_COLUMNS[10:],
    )
