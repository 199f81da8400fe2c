"""Each entity's file layout and cleaning rules on a few written rows."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from plinth.operators.masking import mask_by_tag, tags_of
from plinth.operators.merge import null_keys
from plinth.operators.scd2 import empty_dim
from plinth.plans import layers
from plinth.plans.entities import (
    CUSTOMER, CUSTOMER_ADDRESS, DELIVERY, DELIVERY_AGENT, ENTITIES, MENU, ORDER_ITEM, ORDERS, RESTAURANT,
)
from plinth.sources import csv_drop


def land(spark, tmp_path, entity, *lines):
    path = tmp_path / f"{entity.name}-{len(list(tmp_path.iterdir()))}.csv"
    path.write_text("\n".join([",".join(f"h{i}" for i in range(len(entity.stage))), *lines]) + "\n")
    return csv_drop.read_positional(spark, str(path), entity.stage)


def cleaned(spark, tmp_path, entity, *lines):
    return layers.clean_rows(land(spark, tmp_path, entity, *lines), entity)


def test_restaurant(spark, tmp_path):
    rows = cleaned(
        spark, tmp_path, RESTAURANT,
        '1,Spice Hub,"North Indian, Mughlai",450.555,+91-11-1234,10-22,7,Yes,Open,Saket,"1, Main Rd",28.6139391,77.2,'
        "2024-01-01 10:00:00.123456789,2024-01-02 00:00:00",
        "x,Bad,Thai,n/a,,,z,Yes,Open,,,abc,,never,",
    ).collect()
    good, bad = rows
    assert good.cuisine_type == "North Indian, Mughlai" and good.pricing_for_two == Decimal("450.56")
    assert good.latitude == Decimal("28.613939") and good.created_dt.microsecond == 123456
    assert good.modified_dt is not None  # the fraction may be missing
    assert (bad.restaurant_id, bad.pricing_for_two, bad.latitude, bad.created_dt) == (None,) * 4


def test_null_key_is_not_merged_again_and_again(spark, tmp_path):
    batch = cleaned(spark, tmp_path, RESTAURANT, "x,Bad,,,,,,,,,,,,,", "1,Good,,,,,,,,,,,,,")
    table = layers.merge_clean(batch.limit(0), batch, RESTAURANT).table()
    again = layers.merge_clean(table, batch, RESTAURANT).table()
    assert [r.name for r in again.collect()] == ["Good"]
    assert [r.name for r in null_keys(batch, RESTAURANT.keys).collect()] == ["Bad"]


def test_customer_tags_masks_and_dates(spark, tmp_path):
    rows = cleaned(
        spark, tmp_path, CUSTOMER,
        'C1,Asha,98,a@x.test,Google,F,1990-02-30,2015-06-01,"{""k"":1}",2024-01-01T10:00:00.5,2024-01-02T10:00:00',
    )
    assert tags_of(rows) == {"mobile": "PII", "email": "EMAIL", "gender": "PII", "dob": "PII"}
    r = rows.first()
    assert r.dob is None and str(r.anniversary) == "2015-06-01" and r.preferences == '{"k":1}'
    assert r.created_dt.microsecond == 500000
    m = mask_by_tag(rows).first()
    assert (m.mobile, m.email, m.gender, m.name) == ("** PII **", "** EMAIL **", "** PII **", "Asha")
    # the tag survives parquet
    rows.write.parquet(str(tmp_path / "clean"))
    assert tags_of(spark.read.parquet(str(tmp_path / "clean")))["email"] == "EMAIL"


def test_address_keeps_state_and_pincode_apart_and_its_owner(spark, tmp_path):
    line = "5,{owner},12,B,2,Tower,Mall,Saket,Delhi,DL,110017,28.6;77.2,Yes,Home,2024-01-01T10:00:00,{day}T10:00:00"
    first = cleaned(spark, tmp_path, CUSTOMER_ADDRESS, line.format(owner=1, day="2024-01-01"))
    assert (first.first().state, first.first().pincode) == ("DL", "110017")
    second = cleaned(spark, tmp_path, CUSTOMER_ADDRESS, line.format(owner=2, day="2024-01-05").replace("Home", "Work"))
    r = layers.merge_clean(first, second, CUSTOMER_ADDRESS).table().first()
    assert (r.customer_id_fk, r.address_type) == (1, "Work")


def test_menu_trims_and_reads_flags(spark, tmp_path):
    rows = cleaned(
        spark, tmp_path, MENU,
        "1,9,  Dal  , yellow ,120.5, Main ,TRUE, Veg ,2024-01-01 10:00:00,2024-01-01 10:00:00",
        "2,9,Roti,plain,10,Bread,maybe,Veg,2024-01-01,2024-01-01",
    ).orderBy("menu_id").collect()
    assert (rows[0].item_name, rows[0].category, rows[0].availability) == ("Dal", "Main", True)
    assert rows[0].price == Decimal("120.50") and rows[1].availability is None


def test_agent_keeps_name_and_rating_decimals(spark, tmp_path):
    line = "3,{name},555,Bike,7,Active,M,{rating},2024-01-01 10:00:00,2024-01-0{day} 10:00:00"
    first = cleaned(spark, tmp_path, DELIVERY_AGENT, line.format(name="Ravi", rating="4.25", day=1))
    second = cleaned(spark, tmp_path, DELIVERY_AGENT, line.format(name="Other", rating="4.75", day=2))
    assert first.first().rating == Decimal("4.25")
    r = layers.merge_clean(first, second, DELIVERY_AGENT).table().first()
    assert (r.name, r.rating) == ("Ravi", Decimal("4.75"))


def test_orders_update_only_some_columns_and_keep_cents(spark, tmp_path):
    first = cleaned(spark, tmp_path, ORDERS, "1,10,20,2024-01-01 10:00:00,99.95,New,UPI,2024-01-01 10:00:00,2024-01-01 10:00:00")
    second = cleaned(spark, tmp_path, ORDERS, "1,11,21,2024-02-02 10:00:00,100.05,Paid,Card,2024-02-02 10:00:00,2024-02-02 10:00:00")
    r = layers.merge_clean(first, second, ORDERS).table().first()
    assert (r.customer_id_fk, r.restaurant_id_fk, r.order_date.day) == (10, 20, 1)
    assert (r.total_amount, r.status, r.payment_method, r.modified_dt.month) == (Decimal("100.05"), "Paid", "Card", 2)


@pytest.mark.parametrize(
    "entity, good, bad, reason",
    [
        (ORDER_ITEM, "1,2,3,2,10.50,21.00,2024-01-01 10:00:00,2024-01-01 10:00:00",
         "1,2,3,two,10.50,21.00,2024-01-01 10:00:00,2024-01-01 10:00:00", "quantity is not a decimal"),
        (DELIVERY, "1,2,3,Delivered,30 min,4,2024-01-01 10:00:00,2024-01-01 10:00:00,2024-01-01 10:00:00",
         "1,2,3,Delivered,30 min,home,2024-01-01 10:00:00,2024-01-01 10:00:00,2024-01-01 10:00:00",
         "addressid is not a decimal"),
    ],
)
def test_one_bad_row_does_not_block_the_batch(spark, tmp_path, entity, good, bad, reason):
    valid, quarantine = layers.split_stage(land(spark, tmp_path, entity, good, bad), entity)
    table = layers.merge_clean(*(2 * [layers.clean_rows(valid, entity)]), entity).table()
    assert table.count() == 1
    assert [r._reason for r in quarantine.collect()] == [reason]


def test_every_dimension_entity_opens_and_closes_versions(spark):
    for entity in ENTITIES.values():
        if not entity.hk:
            continue
        stage = spark.createDataFrame([tuple("1" for _ in entity.stage)], csv_drop.text_schema(entity.stage))
        rows = layers.clean_rows(stage, entity)
        dim = empty_dim(rows, entity.keys, entity.tracked, entity.hk)
        first = layers.merge_clean(rows.limit(0), rows, entity)
        dim = layers.apply_dim(dim, first.changes(), entity, F.lit("2024-01-01").cast("timestamp"))
        flag = entity.match_on[1] if entity.name == "location" else entity.tracked[1]
        moved = rows.withColumn(flag, F.lit("2").cast(rows.schema[flag].dataType))
        if entity.name == "customer_address":
            moved = rows.withColumn("city", F.lit("2"))
        changed = layers.merge_clean(rows, moved, entity).changes()
        versions = layers.apply_dim(dim, changed, entity, F.lit("2024-01-02").cast("timestamp")).collect()
        assert len(versions) == 2, entity.name
        assert sum(v.is_current for v in versions) == 1, entity.name
        assert len({v[entity.hk] for v in versions}) == 2, entity.name
