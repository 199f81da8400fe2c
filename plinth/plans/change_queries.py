"""Registered queries on changes: deletions, late rows, net changes, and what is kept up to date from them."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.operators import quality
from plinth.operators.cdc import changes_of_log, net_changes
from plinth.operators.merge import GONE, merge_by_digest, merge_with_deletes, with_digest
from plinth.operators.scd2 import empty_dim, new_versions, scd2_late
from plinth.plans import entities as E
from plinth.plans import fact, kpi, kpi_incremental, layers
from plinth.plans.fact_store import FactStore
from plinth.plans.queries import _latest_items, _tasks, dimensions, iso
from plinth.session import new_dir, stored
from plinth.sources import given
from plinth.streaming import ingest, upsert
from plinth.streaming import kpis as live


# --- clean tables and dimensions ----------------------------------------------------------------


def merge_deletes(spark: SparkSession, sf: str) -> DataFrame:
    """Customers of whom the richest leave on day 1; the richest of these come back a year later.

    Rows from before the deletion come in after it and change nothing. The tombstones are shown.
    """
    def at(rows: DataFrame, day: str, gone: bool = False) -> DataFrame:
        return rows.withColumn("modified", F.lit(day)).withColumn(GONE, F.lit(gone))

    people = given.customers(spark, sf)
    rich, richest = people.where("balance > 9500"), people.where("balance > 9800")
    batches = [
        at(rich, given.DAY_1, gone=True),
        at(rich.withColumn("segment", F.lit("LATE")), "1997-01-01 00:00:00"),
        at(richest.withColumn("segment", F.lit("BACK")), "1999-01-01 00:00:00"),
    ]
    table = at(people, given.DAY_0)
    for batch in batches:
        table = merge_with_deletes(table, batch, ["customer_id"], "modified").table()
    return table


def merge_digest(spark: SparkSession, sf: str) -> DataFrame:
    """Change rows of locations that are all sent again; only those that differ travel whole."""
    initial, again = given.location_files(spark, sf)
    clean, batch = (layers.clean_rows(df, E.LOCATION) for df in (initial, again))
    compare = [c for c in clean.columns if c not in E.LOCATION.keys]
    merged = merge_by_digest(with_digest(clean, compare), batch, E.LOCATION.keys, compare)
    return iso(merged.changes().drop("_digest"))


def cdc_net_changes(spark: SparkSession, sf: str) -> DataFrame:
    """What the second half of the month comes to for each user's state; an error deletes the user."""
    log = given.table(spark, sf, "events").select("user_id", "event_type", F.struct("ts", "event_id").alias("_place"))
    changes = changes_of_log(log, ["user_id"], ["_place"], F.col("event_type") == "error")
    late = changes.where(F.col("_place.ts") >= F.lit("2024-01-15 00:00:00").cast("timestamp_ntz"))
    return net_changes(late, ["user_id"], "_place")


def scd2_late_events(spark: SparkSession, sf: str) -> DataFrame:
    """Event log in three batches that come in the wrong order: the last days, the first, those between."""
    events = given.table(spark, sf, "events").select("user_id", "ts", "event_type", "event_id")
    day = F.dayofmonth("ts")
    key, tracked = ["user_id"], ["event_type"]
    dim, log = empty_dim(events, key, tracked), events.limit(0)
    for batch in (events.where(day >= 20), events.where(day < 10), events.where((day >= 10) & (day < 20))):
        dim = scd2_late(dim, log, batch, key, "ts", tracked, ["event_id"])
        log = log.unionByName(batch)
    return iso(dim)


# --- fact and KPIs ------------------------------------------------------------------------------


def _dated(rows: DataFrame, dates: DataFrame) -> DataFrame:
    """Fact rows with their order's day."""
    days = dates.select(F.col("date_dim_hk").alias("order_date_dim_key"), F.col("calendar_date").alias("order_date"))
    return rows.join(F.broadcast(days), "order_date_dim_key").select(*rows.columns, "order_date")


#: Items in a bucket by order: a bucket is a task, and writes a file a month.
ITEMS_PER_BUCKET = 1_000_000


def _order_buckets(spark: SparkSession, sf: str) -> int:
    """Buckets by order of a table of items: as many as its rows ask for, a few for small tables."""
    return max(min(_tasks(spark), 4), -(-given.line_items(spark, sf).count() // ITEMS_PER_BUCKET))


@contextmanager
def _shuffles_of(spark: SparkSession, n: int) -> Iterator[None]:
    """Shuffles have ``n`` partitions, so that stored buckets are taken as their equals."""
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", n)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def fact_delete(spark: SparkSession, sf: str) -> DataFrame:
    """The stored fact after a batch in which unimportant orders in transit are deleted upstream and
    urgent ones arrive. The deletions go from the clean orders by change rows to the fact."""
    n, tag = _order_buckets(spark, sf), uuid.uuid4().hex
    with _shuffles_of(spark, n):
        # the clean tables that both builds read, by order: none of them moves for a join by it
        items, orders, before = (
            fact.save_bucketed(rows, f"plinth_{name}_{tag}", key, n, new_dir(spark, f"fact-{name}"))
            for name, rows, key in (
                ("items", _latest_items(spark, sf, n), "order_id_fk"), ("orders", given.orders(spark, sf), "order_id"),
                ("deliveries", given.deliveries(spark, sf), "order_id_fk"),
            )
        )
        dims = dimensions(spark, sf)
        rows = _dated(fact.build_fact(items, orders, before, dims, by_order=n), dims["date"])
        store = FactStore(new_dir(spark, "fact-months"), rows.schema, n)
        store.create(rows)

        clean = orders.withColumn("modified", F.lit(given.DAY_0)).withColumn(GONE, F.lit(False))
        low = clean.where((F.col("status") == "P") & (F.col("payment_method") == "5-LOW"))
        merged = merge_with_deletes(clean, low.withColumn("modified", F.lit(given.DAY_1)).withColumn(GONE, F.lit(True)), ["order_id"], "modified")
        moving, urgent = F.col("delivery_status") == "In Transit", F.col("estimated_time") == "1-URGENT"
        after = before.withColumn("delivery_status", F.when(moving & urgent, "Delivered").otherwise(F.col("delivery_status")))
        deleted = merged.changes().where("_action = 'DELETE' AND NOT _is_update").select("order_id")
        arrived = before.where(moving & urgent).select(F.col("order_id_fk").alias("order_id"))
        touched = stored(fact.touched_orders([deleted, arrived]), "fact-touched")
        part = [fact.of_orders(rows, touched, key) for rows, key in ((items, "order_id_fk"), (merged.live(), "order_id"), (after, "order_id_fk"))]
        store.replace_orders(spark, _dated(fact.build_fact(*part, dims, by_order=n), dims["date"]), touched)
    return iso(store.read(spark).drop("order_month"))


def _kpi_rows(spark: SparkSession, sf: str) -> DataFrame:
    """Fact rows with what the KPIs need."""
    items = kpi.with_restaurant(_latest_items(spark, sf), given.restaurants(spark, sf), "restaurant_id_fk", "restaurant_id")
    headers = given.orders(spark, sf).select(
        F.col("order_id").alias("order_id_fk"), F.to_date("order_date").alias("order_date"), "payment_method"
    ).join(given.order_status(spark, sf), "order_id_fk")
    return items.join(headers, "order_id_fk").select(
        "order_item_id", F.col("order_id_fk").alias("order_id"), "order_date", "delivery_status", "restaurant_name",
        F.col("subtotal"), "payment_method",
    )


def kpi_batches(rows: DataFrame) -> tuple[DataFrame, list[tuple[DataFrame, DataFrame]]]:
    """Rows at first, and batches of (new rows, touched orders): orders come in, arrive, are deleted."""
    high, low = F.col("payment_method") == "2-HIGH", F.col("payment_method") == "5-LOW"
    moving, done = F.col("delivery_status") == "In Transit", F.col("delivery_status") == kpi.DELIVERED
    arrived = rows.where(moving).withColumn("delivery_status", F.lit(kpi.DELIVERED))
    gone = rows.where(done & low)
    return rows.where(~high), [
        (rows.where(high), rows.where(high).select("order_id")),
        (arrived, arrived.select("order_id").unionByName(gone.select("order_id"))),
    ]


def kpi_incremental_views(spark: SparkSession, sf: str) -> DataFrame:
    """All five KPI views after orders came in, arrived and were deleted, from states that only
    saw the change rows of each batch."""
    rows = stored(_kpi_rows(spark, sf), "kpi-rows")
    first, batches = kpi_batches(rows)
    grains = (kpi_incremental.DAY_GRAIN, kpi_incremental.RESTAURANT_GRAIN)
    store = FactStore(new_dir(spark, "kpi-fact"), rows.schema)
    store.create(first)
    states = [stored(kpi_incremental.state_of(store.read(spark), g), "kpi-state") for g in grains]
    for new, touched in batches:
        changes = store.replace_orders(spark, new, touched)
        after = store.read(spark, kpi_incremental.touched_days(changes))
        states = [stored(kpi_incremental.apply_changes(s, changes, after, g), "kpi-state") for s, g in zip(states, grains)]
    found = kpi_incremental.views(*states, given.calendar(spark, sf))
    out = None
    for name, view in found.items():
        named = view.withColumn("view", F.lit(name))
        out = named if out is None else out.unionByName(named, allowMissingColumns=True)
    return out


def restaurant_cube(spark: SparkSession, sf: str) -> DataFrame:
    """Revenue and distinct orders by year, month and restaurant, and all their subtotals."""
    rows = _kpi_rows(spark, sf)
    dates = given.calendar(spark, sf).select(F.col("calendar_date").alias("order_date"), "year", "month")
    return kpi.restaurant_cube(rows.join(F.broadcast(dates), "order_date"))


def period_report(spark: SparkSession, sf: str) -> DataFrame:
    """Daily KPIs of one month from the stored fact, of which only that month is read."""
    rows = _kpi_rows(spark, sf)
    store = FactStore(new_dir(spark, "period-fact"), rows.schema)
    store.create(rows)
    return period_kpis(store, spark, given.calendar(spark, sf).where("year = 1997 AND month = 3"))


def period_kpis(store: FactStore, spark: SparkSession, dates: DataFrame) -> DataFrame:
    found = store.of_period(spark, dates).where(F.col("delivery_status") == kpi.DELIVERED)
    totals = kpi.order_totals(found, "order_id", ["year", "month", "day_of_the_month"])
    return kpi.revenue_kpis(totals, ["year", "month", F.col("day_of_the_month").alias("day")])


def fact_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """The fact from items, orders and deliveries that are stored bucketed by order."""
    n, tag = _tasks(spark), uuid.uuid4().hex
    tables = [
        fact.save_bucketed(rows, f"plinth_{name}_{tag}", key, n, new_dir(spark, f"bucketed-{name}"))
        for name, rows, key in (
            ("items", given.order_items(spark, sf), "order_id_fk"), ("orders", given.orders(spark, sf), "order_id"),
            ("deliveries", given.deliveries(spark, sf), "order_id_fk"),
        )
    ]
    return fact.fact_of_lines(fact.order_lines(*tables), dimensions(spark, sf))


# --- loads --------------------------------------------------------------------------------------


def checks_on_load(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of all row checks of landed order items, taken by the job that stores them."""
    text = given.order_item_text(spark, sf)
    counts = quality.write_checked(
        text, new_dir(spark, "checked-items"), not_null=["orderid", "menuid"], lengths={"quantity": 4}, castable=E.ORDER_ITEM.must_cast,
        rules={"dear": F.col("price").cast("decimal(10,2)") > 90000},
    )
    return spark.createDataFrame([(k, v) for k, v in counts.items()], "check_name string, row_count bigint")


def reconcile_layers(spark: SparkSession, sf: str) -> DataFrame:
    """Landed customers against the clean table of a load that lost one segment, changed another
    and brought in suppliers of its own, and that table against its dimension."""
    people = given.customers(spark, sf)
    clean = people.where("segment <> 'BUILDING'").withColumn(
        "balance", F.when(F.col("segment") == "MACHINERY", (F.col("balance") + 1).cast("decimal(10,2)")).otherwise(F.col("balance"))
    ).unionByName(given.customers_day_1(spark, sf).where("segment = 'SUPPLIER'"))
    tracked = ["name", "segment", "balance"]
    dim = new_versions(clean.where("balance >= 0"), ["customer_id"], tracked, given.at(given.DAY_0))
    steps = {"stage to clean": (people, clean), "clean to dimension": (clean, dim.where("is_current"))}
    found = [quality.reconcile(*pair, ["customer_id"], tracked).withColumn("step", F.lit(step)) for step, pair in steps.items()]
    return found[0].unionByName(found[1])


def stream_landing(spark: SparkSession, sf: str) -> DataFrame:
    """Order files streamed into a stage table: one lands again under another name, and some rows
    have a field too many. What landed, with its file's key, and what was rejected."""
    root, landing = new_dir(spark, "landing"), new_dir(spark, "landing-files")
    columns = ["orderid", "customerid", "orderdate", "totalamount", "status"]
    text = given.order_text(spark, sf).select(*columns)
    extra = F.when(F.col("customerid").endswith("7"), F.concat("status", F.lit(",surplus")))
    for n, status in enumerate(("F", "O", "P")):
        # written as plain lines below a heading, so that a row can have a surplus field
        line = F.concat_ws(",", "orderid", "customerid", "orderdate", "totalamount", F.coalesce(extra, "status"))
        part = text.where(F.col("status") == status).select(F.lit(1).alias("place"), line.alias("value"))
        heading = spark.range(1).select(F.lit(0).alias("place"), F.lit(",".join(columns)).alias("value"))
        for copy in range(2 if status == "O" else 1):
            lines = heading.unionByName(part).coalesce(1).sortWithinPartitions("place", "value")
            lines.select("value").write.text(f"{landing}/{n}-{copy}")
    stream = ingest.landing_stream(spark, f"{landing}/*", columns, files_per_batch=1)
    batch = ingest.landing_batch(f"{root}/stage", columns)
    upsert.run_available(stream, batch, f"{root}/checkpoint").awaitTermination()
    stage = spark.read.parquet(f"{root}/stage").select(
        *columns, (F.length("_stg_file_md5") == 32).alias("has_key"), F.lit(None).cast("string").alias("reason")
    )
    rejects = spark.read.parquet(f"{root}/stage_rejects").select(
        *[F.split("_corrupt_record", ",")[k].alias(c) for k, c in enumerate(columns)], (F.length("_stg_file_md5") == 32).alias("has_key"),
        F.col("_reason").alias("reason"),
    )
    return stage.unionByName(rejects)


def stream_kpis(spark: SparkSession, sf: str) -> DataFrame:
    """Daily KPIs of delivered items, live: first all items as they are, then those of orders in
    transit again as they arrive, and last, late, a state of them from before."""
    root, landing = new_dir(spark, "live-kpis"), new_dir(spark, "live-items")
    rows = stored(_kpi_rows(spark, sf).withColumn("modified", F.lit(given.DAY_0)), "live-rows")  # all three loads come from it
    moving = rows.where(F.col("delivery_status") == "In Transit")
    arrived = moving.withColumn("delivery_status", F.lit(kpi.DELIVERED)).withColumn("modified", F.lit(given.DAY_1))
    late = moving.withColumn("delivery_status", F.lit("Pending")).withColumn("modified", F.lit("1997-01-01 00:00:00"))
    store = FactStore(f"{root}/fact", rows.schema)
    grain = kpi_incremental.DAY_GRAIN
    empty = kpi_incremental.state_of(rows, grain).schema
    batch = live.kpi_batch(store, root, grain, empty, "modified")
    store.create(rows.limit(0))
    for n, part in enumerate((rows, arrived, late)):
        part.write.parquet(f"{landing}/load={n}")
        stream = ingest.parquet_stream(spark, f"{landing}/load={{{','.join(map(str, range(n + 1)))}}}", rows.schema)
        upsert.run_available(stream, batch, f"{root}/checkpoint").awaitTermination()
    day = F.col("day_of_the_month").alias("day")
    return kpi_incremental.view(live.latest_state(spark, root, empty), given.calendar(spark, sf), ["year", "month", day], kpi.DELIVERED)


QUERIES = {
    "merge_with_deletes": merge_deletes,
    "merge_by_digest": merge_digest,
    "cdc_net_changes": cdc_net_changes,
    "scd2_late": scd2_late_events,
    "fact_delete": fact_delete,
    "kpi_incremental": kpi_incremental_views,
    "restaurant_cube": restaurant_cube,
    "period_report": period_report,
    "fact_bucketed": fact_bucketed,
    "checks_on_load": checks_on_load,
    "reconcile_layers": reconcile_layers,
    "stream_landing": stream_landing,
    "stream_kpis": stream_kpis,
}
