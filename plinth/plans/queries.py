"""The registered queries: every operator over the whole given tables.

Dates and timestamps leave as ISO text, so results of two engines compare value by value.
"""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plinth.functions import casting as C
from plinth.functions.calendar import date_parts
from plinth.functions.keys import digest, hash_key, surrogate_key
from plinth.operators import masking, quality
from plinth.operators.cdc import appended_since, inserts_only, snapshot_diff
from plinth.operators.enrich import enrich_location
from plinth.operators.latest import latest_by, latest_per_key
from plinth.operators.masking import mask_by_tag
from plinth.operators.merge import merge
from plinth.operators.ordered import asof_join, big_keys
from plinth.operators.scd2 import (
    dim_current, empty_dim, new_versions, scd2_apply, scd2_from_log, scd2_match_on, valid_from,
)
from plinth.plans import entities as E
from plinth.plans import fact, kpi, layers
from plinth import session
from plinth.session import new_dir
from plinth.sources import csv_drop, given
from plinth.sources.bucketed import BucketedTable
from plinth.streaming import ingest, revenue, upsert


def iso(df: DataFrame) -> DataFrame:
    """Render date and time columns as text."""
    return df.select(
        *[
            F.col(c).cast("string").alias(c) if t in ("date", "timestamp", "timestamp_ntz") else F.col(c)
            for c, t in df.dtypes
        ]
    )


# --- files ------------------------------------------------------------------------------------


def _customer_drop(spark: SparkSession, sf: str) -> str:
    """Customers as a CSV drop; header names differ from the target's on purpose."""
    path = new_dir(spark, "customer-drop")
    rows = given.customer_text(spark, sf).drop("c_acctbal")
    csv_drop.write_csv(rows.toDF(*[f"field {i}" for i in range(len(rows.columns))]), path)
    return path


def csv_positional_read(spark: SparkSession, sf: str) -> DataFrame:
    return csv_drop.read_positional(spark, _customer_drop(spark, sf), E.CUSTOMER.stage, glob="*.csv")


def ingest_with_lineage(spark: SparkSession, sf: str) -> DataFrame:
    stage = new_dir(spark, "customer-stage")
    csv_drop.copy_into(spark, _customer_drop(spark, sf), E.CUSTOMER.stage, stage)
    rows = spark.read.parquet(stage)
    return rows.select(
        "customerid", "name", "email",
        F.col("_stg_file_name").endswith(".csv").alias("has_file_name"),
        F.col("_stg_file_load_ts").isNotNull().alias("has_file_time"),
        F.length("_stg_file_md5").alias("md5_length"),
        F.col("_copy_data_ts").isNotNull().alias("has_load_time"),
    )


def delta_append(spark: SparkSession, sf: str) -> DataFrame:
    """An initial drop and two delta drops, copied to one stage table; the last once more, in vain."""
    drop, stage = new_dir(spark, "order-drop"), new_dir(spark, "order-stage")
    loads = given.order_text(spark, sf).withColumn(
        "load", F.when(F.col("status") == "F", "initial").when(F.col("status") == "O", "delta-1").otherwise("delta-2")
    )
    csv_drop.write_csv(loads, drop, partition_by=["load"])
    for load in ("initial", "delta-1", "delta-2", "delta-2"):
        csv_drop.copy_into(spark, f"{drop}/load={load}", E.ORDERS.stage, stage)
    return spark.read.parquet(stage).select(
        "orderid", "orderdate", "totalamount", "status",
        F.regexp_extract("_stg_file_name", "load=([a-z0-9-]+)/", 1).alias("load"),
        F.length("_stg_file_md5").alias("key_length"),
        (F.col("_stg_file_load_ts").isNotNull() & F.col("_copy_data_ts").isNotNull()).alias("has_times"),
    )


def csv_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of one segment come with a field too many, of another with one too few; none is lost."""
    drop, stage = new_dir(spark, "uneven-drop"), new_dir(spark, "uneven-stage")
    fields = ["customerid", "name", "loginbyusing"]
    segment = F.col("loginbyusing")
    given.customer_text(spark, sf).select(
        F.when(segment == "FURNITURE", F.concat_ws(",", *fields, F.lit("more")))
        .when(segment == "BUILDING", F.concat_ws(",", *fields[:2])).otherwise(F.concat_ws(",", *fields)).alias("value")
    ).write.text(drop)
    csv_drop.copy_into(spark, drop, fields, stage, on_error="keep", options={"header": "false"})
    landed = spark.read.parquet(stage).select("customerid", segment.alias("segment"), F.lit("landed").alias("outcome"))
    parts = F.split("_corrupt_record", ",")
    rejected = spark.read.parquet(f"{stage}_rejects").select(parts[0].alias("customerid"), parts[2].alias("segment"), "_reason")
    return landed.unionByName(rejected.withColumnRenamed("_reason", "outcome"))


def list_files(spark: SparkSession, sf: str) -> DataFrame:
    """Bytes per folder of a headerless drop, from the file listing alone."""
    drop = new_dir(spark, "order-files")
    rows = given.order_text(spark, sf).select("orderid", "orderdate", "totalamount", "status")
    csv_drop.write_csv(rows, drop, header=False, partition_by=["status"])
    files = csv_drop.list_files(spark, drop, glob="*.csv")
    return files.groupBy(F.regexp_extract("path", "status=([A-Z])", 1).alias("folder")).agg(
        F.sum("length").alias("total_bytes")
    )


def csv_error_modes(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of one segment are written with pipes: kept in column one, or skipped, by mode."""
    drop = new_dir(spark, "mixed-drop")
    rows = given.customer_text(spark, sf)
    fields = ["customerid", "name", "loginbyusing"]
    rows.select(
        F.when(F.col("loginbyusing") == "FURNITURE", F.concat_ws("|", *fields))
        .otherwise(F.concat_ws(",", *fields)).alias("value")
    ).write.text(drop)
    no_header = {"header": "false"}

    def load(mode: str) -> DataFrame:
        read = csv_drop.read_positional(spark, drop, fields, on_error=mode, options=no_header)
        return read.agg(
            F.count(F.lit(1)).alias("row_count"),
            F.count_if(quality.wrong_delimiter("customerid", "name")).alias("shifted_rows"),
        ).select(F.lit(mode).alias("mode"), "row_count", "shifted_rows")

    return load("keep").unionByName(load("continue"))


def _landed_orders(spark: SparkSession, sf: str) -> DataFrame:
    """Landed orders of which pending ones came with pipes and urgent ones with a junk id."""
    rows = given.order_text(spark, sf).select("orderid", "customerid", "orderdate", "totalamount", "status")
    shifted = F.col("status") == "O"
    junk = F.substring("totalamount", -2, 2) == "00"
    joined = F.concat_ws("|", "orderid", "customerid", "orderdate", "totalamount", "status")
    first = F.when(shifted, joined).when(junk, F.concat(F.lit("junk-"), "orderid")).otherwise(F.col("orderid"))
    others = [F.when(~shifted, F.col(c)).alias(c) for c in rows.columns[1:]]
    return rows.select(first.alias("orderid"), *others)


def quarantine_copy(spark: SparkSession, sf: str) -> DataFrame:
    """Valid and set-aside rows of one landed batch, the latter as they came."""
    landed = _landed_orders(spark, sf)
    valid, bad = quality.split_rows(
        landed,
        {
            "wrong delimiter": quality.wrong_delimiter("orderid", "customerid"),
            "junk id": ~quality.wrong_delimiter("orderid", "customerid")
            & quality.not_castable("orderid", "decimal(38,0)"),
        },
    )
    return valid.withColumn("_reason", F.lit("valid")).unionByName(bad).select("orderid", "customerid", "_reason")


def quarantine_reasons(spark: SparkSession, sf: str) -> DataFrame:
    """All reasons of every line item that the order-item merge cannot take."""
    rows = given.order_item_text(spark, sf).withColumn(
        "subtotal", F.when(F.col("price").cast("decimal(10,2)") > 90000, F.concat("subtotal", F.lit(" INR"))).otherwise(F.col("subtotal"))
    )
    _, bad = layers.split_stage(rows, E.ORDER_ITEM)
    return bad.select("orderid", "orderitemid", "menuid", "quantity", "subtotal", "_reason")


def castability_report(spark: SparkSession, sf: str) -> DataFrame:
    return quality.castability_report(given.order_item_text(spark, sf), E.ORDER_ITEM.must_cast)


def delete_where_like(spark: SparkSession, sf: str) -> DataFrame:
    landed = _landed_orders(spark, sf)
    return quality.delete_where(landed, F.col("orderid").like("%|%") | F.col("orderid").like("%junk%"))


# --- scalar functions and cleaning -------------------------------------------------------------


def cast_strict(spark: SparkSession, sf: str) -> DataFrame:
    rows = given.order_text(spark, sf)
    return rows.select(
        C.strict_number("orderid").alias("order_id"),
        C.strict_number("totalamount").alias("whole_amount"),
        C.strict_decimal("totalamount", 12, 1).alias("amount"),
    )


def cast_try(spark: SparkSession, sf: str) -> DataFrame:
    """Good, fractional, padded and junk text of one column through every lenient cast."""
    rows = given.table(spark, sf, "part").select(
        F.col("p_partkey").alias("part_id"),
        F.when(F.col("p_type") == "PROMO", F.col("p_brand"))
        .when(F.col("p_type") == "ECONOMY", F.lit(""))
        .otherwise(F.concat(F.col("p_size").cast("string"), F.lit("."), F.col("p_partkey").cast("string")))
        .alias("raw"),
    )
    return rows.select(
        "part_id", C.try_number("raw").alias("as_number"), C.try_decimal("raw", 10, 2).alias("as_price"),
        C.try_decimal("raw", 4, 2).alias("as_rating"), C.try_decimal("raw", 12, 0).alias("as_whole"),
    )


def parse_dates(spark: SparkSession, sf: str) -> DataFrame:
    rows = given.customer_text(spark, sf)
    return iso(rows.select("customerid", C.try_date("dob").alias("dob"), C.try_date("anniversary").alias("anniversary")))


def parse_timestamps(spark: SparkSession, sf: str) -> DataFrame:
    """Event times written in four layouts and one that no pattern takes."""
    ts = F.col("ts")
    rows = given.table(spark, sf, "events").select(
        "event_id",
        F.when(F.col("event_type") == "error", F.date_format(ts, "dd.MM.yyyy HH:mm"))
        .otherwise(F.date_format(ts, "yyyy-MM-dd HH:mm:ss")).alias("seconds"),
        F.concat(F.date_format(ts, "yyyy-MM-dd HH:mm:ss.SSSSSS"), F.lit("789")).alias("nanos"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("iso_micros"),
        F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss").alias("iso_seconds"),
    )
    return iso(
        rows.select(
            "event_id",
            C.try_timestamp("seconds", C.TS_SECONDS).alias("from_seconds"),
            C.try_timestamp("nanos", C.TS_NANOS).cast("timestamp_ntz").alias("from_nanos"),
            C.try_timestamp("iso_micros", C.TS_ISO).alias("from_iso_micros"),
            C.strict_timestamp("iso_seconds", C.TS_ISO).alias("from_iso_seconds"),
            C.try_timestamp("seconds").alias("from_any"),
        )
    )


def clean_customer(spark: SparkSession, sf: str) -> DataFrame:
    return iso(layers.clean_rows(given.customer_text(spark, sf), E.CUSTOMER))


def clean_menu(spark: SparkSession, sf: str) -> DataFrame:
    return iso(layers.clean_rows(given.menu_text(spark, sf), E.MENU))


def clean_order_item(spark: SparkSession, sf: str) -> DataFrame:
    valid, _ = layers.split_stage(given.order_item_text(spark, sf), E.ORDER_ITEM)
    return iso(layers.clean_rows(valid, E.ORDER_ITEM))


def date_parts_of_orders(spark: SparkSession, sf: str) -> DataFrame:
    return given.table(spark, sf, "orders").select("o_orderkey", *date_parts(F.to_date("o_orderdate")))


def date_dim(spark: SparkSession, sf: str) -> DataFrame:
    return iso(given.calendar(spark, sf))


def enrich_location_rows(spark: SparkSession, sf: str) -> DataFrame:
    rows = given.location_text(spark, sf, "customer").select("locationid", "city", "state")
    return enrich_location(rows)


def mask_customers(spark: SparkSession, sf: str) -> DataFrame:
    return iso(mask_by_tag(layers.clean_rows(given.customer_text(spark, sf), E.CUSTOMER)))


def check_tags(spark: SparkSession, sf: str) -> DataFrame:
    """Tags of the clean customers, and one that no policy knows."""
    rows = layers.clean_rows(given.customer_text(spark, sf), E.CUSTOMER)
    return masking.check_tags(rows.withMetadata("anniversary", {masking.TAG: "SECRET"}))


def mask_after_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Stage, clean table, change rows and dimension are all masked after an upsert."""
    initial, delta = given.customer_files(spark, sf)
    entity = E.CUSTOMER
    before, batch = (layers.clean_rows(df, entity) for df in (initial, delta))
    merged = layers.merge_clean(before, batch, entity)
    dim = new_versions(before, entity.keys, entity.tracked, given.at(given.DAY_0), entity.hk)
    parts = {
        "stage": layers.tag_stage(initial, entity).withColumnRenamed("customerid", "customer_id"),
        "clean": merged.table(), "changes": merged.changes(),
        "dimension": layers.apply_dim(dim, merged.changes(), entity, given.at(given.DAY_1)),
    }
    shown = ["customer_id", "mobile", "email", "gender", "dob"]
    masked = [
        mask_by_tag(df, expected=entity.tags).select(F.lit(part).alias("part"), *[F.col(c).cast("string").alias(c) for c in shown])
        for part, df in parts.items()
    ]
    return reduce(DataFrame.unionByName, masked)


# --- keys and checks ---------------------------------------------------------------------------


def hash_key_of_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Keys over all attributes and over a subset; a NULL and shifted text give keys of their own."""
    rows = given.customer_text(spark, sf)
    return rows.select(
        "customerid", hash_key("customerid", "name", "anniversary").alias("hk"),
        hash_key("loginbyusing", "gender").alias("subset_hk"), digest("customerid", "anniversary").alias("wide_hk"),
    )


def surrogate_key_of_orders(spark: SparkSession, sf: str) -> DataFrame:
    rows = given.orders(spark, sf).select("order_id", "status")
    return surrogate_key(rows, ["order_id"], "order_sk", start=1000, buckets=16)


def check_not_null(spark: SparkSession, sf: str) -> DataFrame:
    rows = layers.clean_rows(given.location_text(spark, sf, "customer"), E.LOCATION)
    return quality.check_not_null(rows, [*E.LOCATION.not_null, "modified_ts"])


def check_length(spark: SparkSession, sf: str) -> DataFrame:
    rows = layers.clean_rows(given.customer_text(spark, sf), E.CUSTOMER)
    return quality.check_length(rows, {**E.CUSTOMER.lengths, "preferences": 22})


def check_unique(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_unique(given.table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"])


def check_fk(spark: SparkSession, sf: str) -> DataFrame:
    """The seven foreign keys of the fact, against dimensions that each lack some rows."""
    items = given.order_items(spark, sf)
    orders = given.orders(spark, sf).withColumn("order_day", F.to_date("order_date"))
    deliveries, suppliers = given.deliveries(spark, sf), given.restaurants(spark, sf)
    checks = [
        ("menu", items, "menu_id_fk", given.menu_items(spark, sf).where("category <> 'PROMO'"), "menu_id"),
        ("restaurant", items, "restaurant_id_fk", suppliers.where("pricing_for_two >= 0"), "restaurant_id"),
        ("restaurant_location", suppliers, "location_id_fk", given.locations(spark, sf).where("location_id < 20"), "location_id"),
        ("customer", orders, "customer_id_fk", given.customers(spark, sf).where("segment <> 'BUILDING'"), "customer_id"),
        ("customer_address", deliveries, "customer_address_id_fk", given.customer_addresses(spark, sf).where("city <> 'Mumbai'"), "address_id"),
        ("delivery_agent", deliveries, "delivery_agent_id_fk", given.delivery_agents(spark, sf).where("location_id_fk >= 5"), "delivery_agent_id"),
        ("order_date", orders, "order_day", given.calendar(spark, sf).where("year <> 1998"), "calendar_date"),
    ]
    found = [
        quality.check_fk(rows.withColumn(fk, F.col(fk).cast("string")), dim.withColumn(pk, F.col(pk).cast("string")), fk, pk)
        .select(F.lit(name).alias("constraint_name"), F.col(fk).alias("key"), "orphan_rows")
        for name, rows, fk, dim, pk in checks
    ]
    return reduce(DataFrame.unionByName, found)


def layer_counts(spark: SparkSession, sf: str) -> DataFrame:
    stage = given.order_item_text(spark, sf)
    valid, bad = layers.split_stage(stage, E.ORDER_ITEM)
    clean = latest_per_key(layers.clean_rows(valid, E.ORDER_ITEM), E.ORDER_ITEM.keys, [E.ORDER_ITEM.modified])
    return quality.layer_counts({"stage": stage, "quarantine": bad, "clean": clean})


# --- merge -------------------------------------------------------------------------------------


def merge_upsert(spark: SparkSession, sf: str) -> DataFrame:
    initial, delta = given.customer_files(spark, sf)
    clean, batch = (layers.clean_rows(df, E.CUSTOMER) for df in (initial, delta))
    return iso(layers.merge_clean(clean, batch, E.CUSTOMER).table())


def merge_changed_only(spark: SparkSession, sf: str) -> DataFrame:
    """Every location is sent again; only rows that differ take over the new file name."""
    initial, again = given.location_files(spark, sf)
    clean = layers.clean_rows(initial.withColumn("_stg_file_name", F.lit("initial.csv")), E.LOCATION)
    batch = layers.clean_rows(again.withColumn("_stg_file_name", F.lit("day-1.csv")), E.LOCATION)
    return iso(layers.merge_clean(clean, batch, E.LOCATION).table())


def merge_partial_update(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in transit arrive delivered, dearer and under another customer; the last is ignored."""
    text = given.order_text(spark, sf)
    clean = layers.clean_rows(text, E.ORDERS)
    delta = text.where(F.col("status") == "P").select(
        "orderid", F.lit("-1").alias("customerid"), "restaurantid", "orderdate",
        (F.col("totalamount").cast("decimal(10,2)") + 1).cast("decimal(10,2)").cast("string").alias("totalamount"),
        F.lit("F").alias("status"), F.lit("Card").alias("paymentmethod"), "createddate",
        F.lit("2002-01-01 00:00:00").alias("modifieddate"),
    )
    return iso(layers.merge_clean(clean, layers.clean_rows(delta, E.ORDERS), E.ORDERS).table())


def merge_latest_per_key(spark: SparkSession, sf: str) -> DataFrame:
    """The whole menu stage table, with several rows per item, merged into the clean menu."""
    clean = layers.clean_rows(given.menu_text(spark, sf), E.MENU)
    source = layers.clean_rows(given.menu_stage(spark, sf), E.MENU)
    return iso(layers.merge_clean(clean, source, E.MENU).table())


def merge_composite_key(spark: SparkSession, sf: str) -> DataFrame:
    """Lines shipped before 1998 are in place, all later ones come in; key is item, order and menu."""
    rows = given.order_items(spark, sf).drop("restaurant_id_fk")
    early = F.col("modified_dt") < F.lit("1998-01-01 00:00:00").cast("timestamp_ntz")
    keys, order = E.ORDER_ITEM.keys, [E.ORDER_ITEM.modified]
    target = latest_per_key(rows.where(early), keys, order)
    return iso(merge(target, rows.where(~early), keys, order_by=order).table())


def merge_with_sk(spark: SparkSession, sf: str) -> DataFrame:
    """Customers of day 1 merged into numbered customers of day 0; new ones continue the numbers."""
    day_0, day_1 = _customer_days(spark, sf)
    numbered = surrogate_key(day_0, CUSTOMER_KEY, "customer_sk")
    return merge(numbered, day_1, CUSTOMER_KEY, number="customer_sk").table()


# --- change streams and dimensions --------------------------------------------------------------


def _customer_days(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    return given.customers(spark, sf), given.customers_day_1(spark, sf)


def cdc_snapshot_diff(spark: SparkSession, sf: str) -> DataFrame:
    return snapshot_diff(*_customer_days(spark, sf), ["customer_id"])


def cdc_inserts_only(spark: SparkSession, sf: str) -> DataFrame:
    return inserts_only(*_customer_days(spark, sf), ["customer_id"])


def append_since(spark: SparkSession, sf: str) -> DataFrame:
    """Batch form of the append-only stream: events that came in after the consumed position."""
    events = given.table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    return iso(appended_since(events, "ts", F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")))


CUSTOMER_KEY, CUSTOMER_TRACKED = ["customer_id"], ["name", "segment", "balance"]


def _customer_dim(spark: SparkSession, sf: str) -> DataFrame:
    day_0, day_1 = _customer_days(spark, sf)
    dim = new_versions(day_0, CUSTOMER_KEY, CUSTOMER_TRACKED, given.at(given.DAY_0))
    changes = snapshot_diff(day_0, day_1, CUSTOMER_KEY)
    return scd2_apply(dim, changes, CUSTOMER_KEY, CUSTOMER_TRACKED, given.at(given.DAY_1))


def scd2_apply_customers(spark: SparkSession, sf: str) -> DataFrame:
    return iso(_customer_dim(spark, sf))


def dim_current_customers(spark: SparkSession, sf: str) -> DataFrame:
    return iso(dim_current(_customer_dim(spark, sf)))


def scd2_multi_change(spark: SparkSession, sf: str) -> DataFrame:
    """Events in two batches, each with many changes per user, chained at their own times."""
    events = given.table(spark, sf, "events")
    states = events.groupBy("user_id", "ts").agg(F.max_by("event_type", "event_id").alias("event_type"))
    images = states.select(F.lit("INSERT").alias("_action"), F.lit(True).alias("_is_update"), "*")
    early = F.col("ts") < F.lit("2024-01-15 00:00:00").cast("timestamp_ntz")
    key, tracked = ["user_id"], ["event_type"]
    dim = scd2_apply(empty_dim(states, key, tracked), images.where(early), key, tracked, F.lit(None), at="ts")
    return iso(scd2_apply(dim, images.where(~early), key, tracked, F.lit(None), at="ts"))


def scd2_null_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers that come in as customers without an id open no version, in two runs."""
    day_0, day_1 = _customer_days(spark, sf)
    unnamed = F.when(F.col("segment") != "SUPPLIER", F.col("customer_id"))
    day_1 = day_1.withColumn("customer_id", unnamed)
    dim = new_versions(day_0, CUSTOMER_KEY, CUSTOMER_TRACKED, given.at(given.DAY_0))
    for _ in range(2):
        images = snapshot_diff(day_0, day_1, CUSTOMER_KEY).unionByName(
            day_1.where("customer_id IS NULL").select(F.lit("INSERT").alias("_action"), F.lit(False).alias("_is_update"), "*")
        )
        dim = scd2_apply(dim, images, CUSTOMER_KEY, CUSTOMER_TRACKED, given.at(given.DAY_1))
    return iso(dim)


def scd2_match_subset(spark: SparkSession, sf: str) -> DataFrame:
    """Location dimension in the literal merge form, matched on id and active flag."""
    initial, again = given.location_files(spark, sf)
    day_0, day_1 = (layers.clean_rows(df, E.LOCATION) for df in (initial, again))
    key, tracked = E.LOCATION.keys, E.LOCATION.tracked
    dim = new_versions(day_0, key, tracked, given.at(given.DAY_0), E.LOCATION.hk, E.LOCATION.hash_cols)
    return iso(
        scd2_match_on(
            dim, snapshot_diff(day_0, day_1, key), key, tracked, E.LOCATION.match_on,
            given.at(given.DAY_1), hk=E.LOCATION.hk, hash_cols=E.LOCATION.hash_cols,
        )
    )


def scd2_insert_only(spark: SparkSession, sf: str) -> DataFrame:
    """Menu dimension fed by inserts alone: new items appear, new prices of known items do not."""
    day_1 = given.menu_items(spark, sf)
    day_0 = day_1.where(F.col("category") != "PROMO").withColumn("price", (F.col("price") - 1).cast("decimal(10,2)"))
    key, tracked = ["menu_id"], ["item_name", "category", "price"]
    dim = new_versions(day_0, key, tracked, given.at(given.DAY_0), "menu_dim_hk")
    changes = inserts_only(day_0, day_1, key)
    return iso(scd2_apply(dim, changes, key, tracked, given.at(given.DAY_1), hk="menu_dim_hk"))


def scd2_from_events(spark: SparkSession, sf: str) -> DataFrame:
    events = given.table(spark, sf, "events")
    return iso(scd2_from_log(events, ["user_id"], "ts", ["event_type"], ["event_id"]))


def dim_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """State of the user right before each purchase, from the dimension built of all other events."""
    events = given.table(spark, sf, "events")
    bought = F.col("event_type") == "purchase"
    dim = scd2_from_log(events.where(~bought), ["user_id"], "ts", ["event_type"], ["event_id"])
    states = dim.select("user_id", "eff_start", F.col("hk").alias("state_hk"), F.col("event_type").alias("state"))
    purchases = events.where(bought).select("event_id", "user_id", "ts", "value")
    return iso(
        asof_join(
            purchases, states, ["user_id"], "ts", "eff_start", ["state_hk", "state"],
            big=big_keys(events, ["user_id"], "ts"),
        )
    )


# --- fact and KPIs ------------------------------------------------------------------------------


def _two_versions(rows: DataFrame, changed: DataFrame, key: list[str], tracked: list[str], hk: str) -> DataFrame:
    """Dimension of day 0 with the changed rows applied on day 1."""
    dim = new_versions(rows, key, tracked, given.at(given.DAY_0), hk)
    images = changed.select(F.lit("INSERT").alias("_action"), F.lit(True).alias("_is_update"), *key, *tracked)
    return valid_from(scd2_apply(dim, images, key, tracked, given.at(given.DAY_1), hk=hk), key)


def _one_version(rows: DataFrame, key: list[str], tracked: list[str], hk: str) -> DataFrame:
    dim = new_versions(rows, key, tracked, given.at(given.DAY_0), hk)
    return dim.withColumn("valid_from", F.lit(None).cast("timestamp"))


def dimensions(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """All dimensions; debtors (customers) and medium items changed on day 1."""
    people, menu = given.customers(spark, sf), given.menu_items(spark, sf)
    debtors = people.where(F.col("balance") < 0).withColumn("segment", F.lit("DEBT"))
    dearer = menu.where(F.col("category") == "MEDIUM").withColumn("price", (F.col("price") + 5).cast("decimal(10,2)"))
    return {
        "customer": _two_versions(people, debtors, CUSTOMER_KEY, CUSTOMER_TRACKED, "customer_hk"),
        "menu": _two_versions(menu, dearer, ["menu_id"], ["item_name", "category", "price"], "menu_dim_hk"),
        "customer_address": _one_version(
            given.customer_addresses(spark, sf), ["address_id"], ["customer_id_fk", "city", "address_type"],
            "customer_address_hk",
        ),
        "restaurant": _one_version(
            given.restaurants(spark, sf), ["restaurant_id"], ["name", "location_id_fk", "pricing_for_two"],
            "restaurant_hk",
        ),
        "location": _one_version(
            given.locations(spark, sf), ["location_id"], ["city", "state"], "restaurant_location_hk"
        ),
        "delivery_agent": _one_version(
            given.delivery_agents(spark, sf), ["delivery_agent_id"], ["name", "location_id_fk"], "delivery_agent_hk"
        ),
        "date": given.calendar(spark, sf),
    }


def fact_build(spark: SparkSession, sf: str) -> DataFrame:
    return fact.build_fact(
        given.order_items(spark, sf), given.orders(spark, sf), given.deliveries(spark, sf),
        dimensions(spark, sf),
    )


def fact_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Deliveries in transit arrive: the fact rows of their orders are rebuilt with all their keys
    and merged into the stored fact, of which only the buckets they are in are written.

    Clean items, fact and rebuilt rows lie by order, so none of them moves for a join with another."""
    n, tag = _tasks(spark), uuid.uuid4().hex
    # the clean table that both builds read
    items = fact.save_bucketed(_latest_items(spark, sf, n), f"plinth_items_{tag}", "order_id_fk", n, new_dir(spark, "fact-items"))
    orders, dims = given.orders(spark, sf), dimensions(spark, sf)
    before = given.deliveries(spark, sf)
    arrived = F.when(F.col("delivery_status") == "In Transit", "Delivered").otherwise(F.col("delivery_status"))
    after = before.withColumn("delivery_status", arrived)
    dealt = before.repartition(n, "delivery_id")  # one shuffle for both snapshots
    changes = snapshot_diff(dealt, dealt.withColumn("delivery_status", arrived), ["delivery_id"])
    moved = changes.where(F.col("_action") == "INSERT").select(F.col("order_id_fk").alias("order_id"))
    first = fact.build_fact(items, orders, before, dims, by_order=n)
    stored = BucketedTable(new_dir(spark, "fact"), first.schema, ["order_id"], n, placed=True)
    stored.create(first)
    # what the batch touches is written once, and so are its rows: their buckets are read off them before the merge
    touched = session.stored(fact.touched_orders([moved]), "fact-touched")
    part = [fact.of_orders(rows, touched, key) for rows, key in ((items, "order_id_fk"), (orders, "order_id"), (after, "order_id_fk"))]
    rebuilt = fact.save_bucketed(fact.build_fact(*part, dims, by_order=n), f"plinth_delta_{tag}", "order_id", n, new_dir(spark, "fact-delta"))
    stored.upsert(rebuilt, 1, lambda old, new: fact.merge_fact(old, new).table())
    return stored.read(spark)


def _tasks(spark: SparkSession) -> int:
    """Buckets of a table written by a query: as many as a shuffle of the session has partitions."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _latest_items(spark: SparkSession, sf: str, by_order: int | None = None) -> DataFrame:
    """Items, one per item and order number; with ``by_order`` in that many partitions by order."""
    items, keys, newest = given.order_items(spark, sf), ["order_item_id", "order_id_fk"], ["modified_dt"]
    return latest_by(items, keys, newest, "order_id_fk", by_order) if by_order else latest_per_key(items, keys, newest)


def fact_orphans(spark: SparkSession, sf: str) -> DataFrame:
    """Items whose restaurant is missing in its dimension."""
    dims, items = dimensions(spark, sf), _latest_items(spark, sf)
    dims["restaurant"] = dims["restaurant"].where(F.col("pricing_for_two") >= 0)
    rows = fact.build_fact(items, given.orders(spark, sf), given.deliveries(spark, sf), dims)
    return fact.orphans(items, rows).select(*fact.FACT_KEYS, "restaurant_id_fk", "subtotal")


def fact_with_sk(spark: SparkSession, sf: str) -> DataFrame:
    """Fact rows with a surrogate key of their own."""
    rows = fact.build_fact(
        _latest_items(spark, sf), given.orders(spark, sf), given.deliveries(spark, sf), dimensions(spark, sf)
    )
    return surrogate_key(rows, fact.FACT_KEYS, "order_item_fact_sk").select("order_item_fact_sk", *fact.FACT_KEYS, "subtotal")


def _totals(spark: SparkSession, sf: str, status: str | None = kpi.DELIVERED, named: bool = False) -> DataFrame:
    sums = kpi.order_totals(given.order_items(spark, sf), by=["restaurant_id_fk"] if named else [])
    if named:
        sums = kpi.with_restaurant(sums, given.restaurants(spark, sf), "restaurant_id_fk", "restaurant_id")
        sums = kpi.sum_again(sums, ["order_id", "restaurant_name"])
    return kpi.totals_from_sums(
        sums, given.orders(spark, sf), given.order_status(spark, sf), given.calendar(spark, sf), status=status
    )


def yearly_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.yearly(_totals(spark, sf))


def monthly_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.monthly(_totals(spark, sf))


def daily_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.daily(_totals(spark, sf))


def weekday_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.weekday(_totals(spark, sf, status=None))


def restaurant_revenue(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.by_restaurant(_totals(spark, sf, status=None, named=True))


def revenue_rollup(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.rollup(_totals(spark, sf))


def overall_totals(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.overall(yearly_revenue(spark, sf))


def latest_year_kpis(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.for_period(yearly_revenue(spark, sf))


def yoy_delta(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.year_over_year(yearly_revenue(spark, sf))


def monthly_trend(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.monthly_trend(monthly_revenue(spark, sf), 1997)


def distinct_months(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.months_with_data(restaurant_revenue(spark, sf), 2001)


def top10_restaurants(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.top_restaurants(restaurant_revenue(spark, sf), 1998, 3)


def topk_per_month(spark: SparkSession, sf: str) -> DataFrame:
    return kpi.top_per_month(restaurant_revenue(spark, sf), 5)


# --- streaming ----------------------------------------------------------------------------------


def append_stream(spark: SparkSession, sf: str) -> DataFrame:
    """Events streamed into a stage table; a second run finds nothing new."""
    stage, checkpoint = new_dir(spark, "event-stage"), new_dir(spark, "event-checkpoint")
    schema = given.table(spark, sf, "events").schema
    for _ in range(2):
        stream = ingest.parquet_stream(spark, sf, schema, glob="events.parquet")
        ingest.append_new(stream, stage, checkpoint).awaitTermination()
    return iso(spark.read.parquet(stage))


def stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Event files of several days, upserted batch by batch; the newest event of a user stays.

    :func:`stream_entity` adds quarantine, clean step and dimension.
    """
    landing = new_dir(spark, "event-files")
    events = given.table(spark, sf, "events").select("event_id", "ts", "user_id", "event_type")
    events.withColumn("part", F.dayofmonth("ts") % 4).write.partitionBy("part").parquet(landing)
    table = BucketedTable(new_dir(spark, "user-state"), events.schema, ["user_id"], 8)
    table.create(events.limit(0))
    stream = ingest.parquet_stream(spark, f"{landing}/part=*", events.schema, files_per_batch=2)
    batch = upsert.upsert_batch(table, ["ts", "event_id"])
    upsert.run_available(stream, batch, new_dir(spark, "upsert-checkpoint")).awaitTermination()
    return iso(table.read(spark))


def bucket_delete(spark: SparkSession, sf: str) -> DataFrame:
    """Orders in buckets by status and priority, after all orders in transit were taken out, which
    empties the buckets that hold no others."""
    orders = given.orders(spark, sf)
    table = BucketedTable(new_dir(spark, "order-buckets"), orders.schema, ["status", "payment_method"], 64)
    table.create(orders)
    gone = orders.where(F.col("status") == "P")
    table.upsert(gone, 1, lambda old, new: old.join(new.select("order_id"), "order_id", "left_anti").select(*old.columns))
    return iso(table.read(spark))


def stream_entity(spark: SparkSession, sf: str) -> DataFrame:
    """Customer files through quarantine, clean table and dimension, file by file: the current
    versions next to the clean rows, and the rejected rows."""
    entity, root, landing = E.CUSTOMER, new_dir(spark, "customer-stream"), new_dir(spark, "customer-landing")
    initial, delta = given.customer_files(spark, sf)
    # a row of each file has no id
    for n, rows in enumerate((initial, delta)):
        csv_drop.write_csv(rows.unionByName(rows.limit(1).withColumn("customerid", F.lit(None).cast("string"))), f"{landing}/{n}")
    clean_schema = layers.clean_rows(initial, entity).schema
    clean = BucketedTable(f"{root}/clean", clean_schema, entity.keys, _tasks(spark), f"{root}/log")
    opened = empty_dim(spark.createDataFrame([], clean_schema), entity.keys, entity.tracked, entity.hk)
    dim = BucketedTable(f"{root}/dim", opened.schema, entity.keys, _tasks(spark), f"{root}/log")
    clean.create(spark.createDataFrame([], clean_schema))
    dim.create(opened)
    days = [given.DAY_0, given.DAY_1]
    # batches are numbered from 0; both folders hold one load
    batch = upsert.entity_batch(entity, clean, dim, f"{root}/rejects", lambda n: given.at(days[min(n, 1)]))
    for n in range(2):
        stream = ingest.csv_stream(spark, f"{landing}/{{{','.join(map(str, range(n + 1)))}}}", entity.stage)
        upsert.run_available(stream, batch, f"{root}/checkpoint").awaitTermination()
    current = dim_current(dim.read(spark)).select("customer_id", "login_by_using", F.col("eff_start").cast("string").alias("since"))
    rows = clean.read(spark).select("customer_id", F.col("login_by_using").alias("login")).join(current, "customer_id")
    rejected = spark.read.schema("_reason string").parquet(f"{root}/rejects")
    return rows.select("customer_id", "login", "login_by_using", "since", F.lit(None).cast("string").alias("reason")).unionByName(
        rejected.select(*[F.lit(None).cast("string").alias(c) for c in ("customer_id", "login", "login_by_using", "since")], F.col("_reason").alias("reason"))
    )


def stream_daily_revenue(spark: SparkSession, sf: str) -> DataFrame:
    """Order value per day from loads that land newest first, one a batch; late orders count."""
    landing = new_dir(spark, "order-landing")
    rows = given.table(spark, sf, "orders").select(
        F.col("o_orderdate").cast("timestamp").alias("ordered_at"), given.money("o_totalprice").alias("amount")
    )
    schema = revenue.daily_revenue(rows, "ordered_at", "amount").schema
    table = BucketedTable(new_dir(spark, "daily-revenue"), schema, ["calendar_date"], _tasks(spark))
    table.create(spark.createDataFrame([], schema))
    batch, checkpoint = upsert.replace_batch(table), new_dir(spark, "revenue-checkpoint")
    for n, (low, high) in enumerate([(1999, 9999), (1997, 1998), (0, 1996)]):
        rows.where(F.year("ordered_at").between(low, high)).write.parquet(f"{landing}/load={n}")
        # a load has as many files as its table has splits, so a batch takes all that have landed
        orders = ingest.parquet_stream(spark, f"{landing}/load=*", rows.schema)
        days = revenue.daily_revenue(orders, "ordered_at", "amount")
        upsert.run_available(days, batch, checkpoint, "update").awaitTermination()
    return iso(table.read(spark))
