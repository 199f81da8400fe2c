"""Fact, KPI views, files and streams: invariants over the given tables and small fixtures."""

from decimal import Decimal
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from plinth.operators import quality
from plinth.operators.merge import merge
from plinth.operators.scd2 import dim_current, empty_dim
from plinth.plans import fact, kpi, queries as q
from plinth.session import new_dir, scratch_root
from plinth.sources import csv_drop, given
from plinth.sources import manifest
from plinth.sources.bucketed import BucketedTable
from plinth.streaming import ingest, revenue, upsert

SF = "/root/testdata/sf0.001"


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


# --- fact and KPIs --------------------------------------------------------------------------------


def test_fact_has_every_item_once_and_no_orphans(spark):
    rows, dims = q.fact_build(spark, SF).cache(), q.dimensions(spark, SF)
    assert rows.count() == given.line_items(spark, SF).count()
    for key, dim, hk in (
        ("customer_dim_key", "customer", "customer_hk"),
        ("customer_address_dim_key", "customer_address", "customer_address_hk"),
        ("restaurant_dim_key", "restaurant", "restaurant_hk"),
        ("restaurant_location_dim_key", "location", "restaurant_location_hk"),
        ("menu_dim_key", "menu", "menu_dim_hk"),
        ("delivery_agent_dim_key", "delivery_agent", "delivery_agent_hk"),
        ("order_date_dim_key", "date", "date_dim_hk"),
    ):
        assert quality.check_fk(rows, dims[dim], key, hk).count() == 0, key


def test_salted_fact_equals_plain_fact(spark):
    args = (given.order_items(spark, SF), given.orders(spark, SF), given.deliveries(spark, SF), q.dimensions(spark, SF))
    # a low share makes many keys heavy, so every join takes the salted way
    salted = fact.build_fact(*args, salt=True, share=0.002)
    assert rows_of(salted) == rows_of(fact.build_fact(*args, salt=False))


def test_current_mode_uses_open_versions(spark):
    dims = {k: v if k == "date" else dim_current(v) for k, v in q.dimensions(spark, SF).items()}
    rows = fact.build_fact(
        given.order_items(spark, SF), given.orders(spark, SF), given.deliveries(spark, SF), dims, as_of=False
    )
    assert rows.count() == given.line_items(spark, SF).count()
    assert quality.check_fk(rows, dims["menu"], "menu_dim_key", "menu_dim_hk").count() == 0


def test_items_that_came_before_their_order_are_rebuilt(spark):
    items = spark.createDataFrame([(1, 10), (2, 10), (1, 11), (1, 12)], "order_item_id bigint, order_id_fk bigint")
    late_order = spark.createDataFrame([(10,)], "order_id bigint")
    changed_item = items.where("order_id_fk = 12")
    assert rows_of(fact.touched_items(items, [late_order], changed_item)) == [(10, 1), (10, 2), (12, 1)]


def test_rebuild_from_the_touched_part_of_all_tables_equals_their_rows_of_the_fact(spark):
    items, orders, deliveries, dims = (*(f(spark, SF) for f in (given.order_items, given.orders, given.deliveries)), q.dimensions(spark, SF))
    header = orders.where("order_id % 7 = 3").select("order_id")
    item = items.where("order_id_fk % 11 = 5 AND order_item_id = 1")
    ids = fact.touched_orders([header, header], item)
    want = {r[0] for r in header.collect()} | {r["order_id_fk"] for r in item.collect()}
    assert rows_of(ids) == sorted(((i,) for i in want), key=str)
    part = [fact.of_orders(rows, ids, key) for rows, key in ((items, "order_id_fk"), (orders, "order_id"), (deliveries, "order_id_fk"))]
    whole = fact.build_fact(items, orders, deliveries, dims).join(ids, "order_id", "left_semi")
    rebuilt = fact.build_fact(*part, dims)
    assert rows_of(rebuilt.select(*fact.FACT_COLUMNS)) == rows_of(whole.select(*fact.FACT_COLUMNS))
    assert rebuilt.count() > 0


def test_fact_by_order_equals_plain_fact_also_for_orders_that_came_twice(spark):
    """The second row of an order has a date after the dimensions' change, so other versions hold."""
    items, orders, deliveries, dims = (*(f(spark, SF) for f in (given.order_items, given.orders, given.deliveries)), q.dimensions(spark, SF))
    again = orders.where("order_id % 5 = 2").withColumn("order_date", F.expr("timestamp_ntz'1999-03-01 00:00:00'"))
    orders = orders.unionByName(again).unionByName(orders.where("order_id % 7 = 1"))
    deliveries = deliveries.unionByName(deliveries.where("order_id_fk % 3 = 0"))
    items = items.unionByName(items.where("order_item_id = 2")).unionByName(items.limit(3).withColumn("order_id_fk", F.lit(None).cast("bigint")))
    plain = rows_of(fact.build_fact(items, orders, deliveries, dims))
    n = q._tasks(spark)
    got = fact.build_fact(items, orders, deliveries, dims, by_order=n)
    assert len(plain) > items.count() and rows_of(got) == plain
    assert got.where(f"pmod(hash(order_id), {n}) <> spark_partition_id()").count() == 0
    with_restaurant = orders.withColumn("restaurant_id_fk", F.expr("1 + order_id % 5"))
    args = (items.drop("restaurant_id_fk"), with_restaurant, deliveries, dims)
    assert rows_of(fact.build_fact(*args, by_order=n)) == rows_of(fact.build_fact(*args))


def test_views_from_stored_fact_equal_views_from_clean_tables(spark):
    stored, date_dim = q.fact_build(spark, SF), given.calendar(spark, SF)
    totals = kpi.totals_from_fact(stored, date_dim)
    for view, query in ((kpi.yearly, q.yearly_revenue), (kpi.daily, q.daily_revenue)):
        assert rows_of(view(totals)) == rows_of(query(spark, SF))
    restaurants = q.dimensions(spark, SF)["restaurant"]
    named = kpi.with_restaurant(stored, restaurants, "restaurant_dim_key", "restaurant_hk")
    by_name = kpi.by_restaurant(kpi.totals_from_fact(named, date_dim, status=None, by=["restaurant_name"]))
    assert rows_of(by_name) == rows_of(q.restaurant_revenue(spark, SF))


def test_grains_add_up(spark):
    year, month, day = (f(spark, SF) for f in (q.yearly_revenue, q.monthly_revenue, q.daily_revenue))
    sums = [df.groupBy("year").agg(F.sum("total_revenue"), F.sum("total_orders")) for df in (year, month, day)]
    assert rows_of(sums[0]) == rows_of(sums[1]) == rows_of(sums[2])
    all_time = q.revenue_rollup(spark, SF).where("grouping_level = 7").first()
    assert all_time.total_revenue == q.overall_totals(spark, SF).first().total_revenue


def test_year_over_year_needs_the_year_directly_before(spark):
    kpis = spark.createDataFrame(
        [(2020, 10, 1, 1, 1, 1), (2021, 15, 3, 1, 1, 1), (2023, 9, 1, 1, 1, 1)], ["year", *kpi.MEASURES]
    )
    got = {r.year: r.total_revenue_diff for r in kpi.year_over_year(kpis).collect()}
    assert got == {2020: None, 2021: 5, 2023: None}


def test_names_shared_by_restaurants_count_an_order_once(spark):
    items = spark.createDataFrame([(1, 7, 5), (1, 8, 6)], "order_id_fk bigint, rid bigint, cents int")
    items = items.withColumn("subtotal", F.col("cents").cast("decimal(10,2)"))
    restaurants = spark.createDataFrame([(7, "Same"), (8, "Same")], "restaurant_id bigint, name string")
    orders = spark.createDataFrame([(1, "2024-01-05")], "order_id bigint, order_date string")
    status = spark.createDataFrame([(1, "Delivered")], "order_id_fk bigint, delivery_status string")
    days = spark.sql("select date'2024-01-05' calendar_date, 2024 year, 1 month, 5 day_of_the_month, 'Friday' day_name")
    named = kpi.with_restaurant(items, restaurants, "rid", "restaurant_id")
    totals = kpi.totals_from_clean(named, orders, status, days, status=None, by=["restaurant_name"])
    (row,) = kpi.by_restaurant(totals).collect()
    assert (row.total_orders, row.total_revenue, row.avg_revenue_per_item) == (1, Decimal(11), Decimal("5.50"))


def test_ranking_by_restaurant_or_by_restaurant_and_status(spark):
    totals = q._totals(spark, SF, status=None, named=True)
    split = kpi.top_restaurants(kpi.by_restaurant(totals), 1998, 3)
    whole = kpi.top_restaurants(kpi.by_restaurant_all_statuses(totals), 1998, 3)
    names = [r.restaurant_name for r in whole.collect()]
    assert split.count() == 10 and len(names) == len(set(names))


def test_reports_can_query_the_views_by_name(spark):
    kpi.register_views(q.fact_build(spark, SF), given.calendar(spark, SF), q.dimensions(spark, SF)["restaurant"])
    got = spark.sql("""SELECT restaurant_name, total_revenue, total_orders, avg_revenue_per_order, avg_revenue_per_item,
        max_order_value FROM vw_monthly_revenue_by_restaurant WHERE year = 1998 AND month = 3
        ORDER BY total_revenue DESC, restaurant_name, delivery_status LIMIT 10""")
    assert rows_of(got) == rows_of(q.top10_restaurants(spark, SF))
    shown = kpi.ranking_for_display(got)
    assert list(shown.columns)[:2] == ["Restaurant Name", "Total Revenue (₹)"] and len(shown) == 10
    assert rows_of(spark.table("vw_yearly_revenue_kpis")) == rows_of(q.yearly_revenue(spark, SF))


# --- files ----------------------------------------------------------------------------------------


def test_content_keys_see_the_order_of_lines_and_not_the_splits(spark, tmp_path):
    lines = [f"{i},{i % 7}\n" for i in range(400)]
    swapped = [lines[1], lines[0], *lines[2:]]
    for name, text in {"a": lines, "b": swapped, "c": lines}.items():
        (tmp_path / f"{name}.csv").write_text("".join(text))

    def keys() -> dict:
        return {r.path[-5]: r.content_key for r in csv_drop.file_digests(spark, str(tmp_path)).collect()}

    whole = keys()
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200b")
    try:
        assert keys() == whole
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert whole["a"] == whole["c"] and whole["a"] != whole["b"] and len(whole["a"]) == 32


def test_copy_loses_no_row_and_loads_a_file_once(spark, tmp_path):
    drop, stage = tmp_path / "drop", str(tmp_path / "stage")
    drop.mkdir()
    (drop / "a.csv").write_text("x,y,z\n1,a,b,c\n2,a\n3,a,b\n")
    for _ in range(2):
        csv_drop.copy_into(spark, str(drop), ["x", "y", "z"], stage, on_error="keep")
    assert rows_of(spark.read.parquet(stage).select("x", "y", "z")) == [("2", "a", None), ("3", "a", "b")]
    (bad,) = spark.read.parquet(f"{stage}_rejects").collect()
    assert (bad._corrupt_record, bad._reason) == ("1,a,b,c", "more fields than columns") and bad._stg_file_name.endswith("a.csv")
    (drop / "b.csv").write_text("x,y,z\n9,a,b\n8\n")
    csv_drop.copy_into(spark, str(drop), ["x", "y", "z"], stage, on_error="continue")
    assert spark.read.parquet(stage).count() == 3
    reasons = {r._corrupt_record: r._reason for r in spark.read.parquet(f"{stage}_rejects").collect()}
    assert reasons == {"1,a,b,c": "more fields than columns", "8": "fewer fields than columns"}


def test_corrupt_rows_can_be_kept_as_text(spark, tmp_path):
    (tmp_path / "a.csv").write_text('x,y\n1,2\n3\n4,5,6\n"7, seven",\\N\n')
    rows = csv_drop.read_positional(spark, str(tmp_path), ["a", "b"], corrupt_record=True).collect()
    assert [(r.a, r.b) for r in rows] == [("1", "2"), ("3", None), ("4", "5"), ("7, seven", None)]
    assert [r._corrupt_record for r in rows] == [None, "3", "4,5,6", None]


def test_listing_shows_sizes(spark, tmp_path):
    (tmp_path / "day").mkdir()
    (tmp_path / "day" / "a.csv").write_text("12345")
    (row,) = csv_drop.list_files(spark, str(tmp_path)).collect()
    assert row.path.endswith("day/a.csv") and row.length == 5


def session_stub(folder, master):
    return SimpleNamespace(
        conf=SimpleNamespace(get=lambda key, default: folder or default),
        sparkContext=SimpleNamespace(master=master, applicationId="app"),
    )


def test_scratch_folder_is_the_shared_one():
    assert scratch_root(session_stub("s3a://shared/x/", "yarn")) == "s3a://shared/x"
    with pytest.raises(ValueError):
        scratch_root(session_stub(None, "yarn"))
    local = session_stub(None, "local[2]")
    assert scratch_root(local) == scratch_root(local)
    assert new_dir(local, "a") != new_dir(local, "a")


# --- bucketed tables and streams ------------------------------------------------------------------


def state(spark, *rows):
    return spark.createDataFrame(list(rows), "id bigint, t bigint, a string")


def test_upsert_writes_only_touched_buckets_and_can_be_repeated(spark, tmp_path):
    table = BucketedTable(str(tmp_path / "t"), state(spark).schema, ["id"], 8)
    table.create(state(spark, *[(i, 0, "old") for i in range(100)]))
    apply = lambda old, new: upsert.newest_wins(old, new, ["id"], ["t"])
    delta = state(spark, (5, 1, "new"), (500, 1, "new"))
    table.upsert(delta, 1, apply)
    first = rows_of(table.read(spark))
    assert len(list((tmp_path / "t" / "v=1").glob("_bucket=*"))) <= 2
    table.upsert(delta, 1, apply)
    assert rows_of(table.read(spark)) == first and len(first) == 101
    assert rows_of(table.read(spark, 0)) == rows_of(state(spark, *[(i, 0, "old") for i in range(100)]))


def test_placed_table_is_merged_where_it_lies(spark, tmp_path):
    """No row of the table or the batch moves; the result is that of a plain merge, also over several versions."""
    schema, plans, confs = "item bigint, id bigint, a string", [], "spark.sql.requireAllClusterKeysForCoPartition"
    rows = [(i % 3, i // 3, "old") for i in range(300)]
    table = BucketedTable(str(tmp_path / "t's"), spark.createDataFrame([], schema).schema, ["id"], 8, placed=True)
    table.create(spark.createDataFrame(rows, schema))
    assert {len(list(b.glob("*.parquet"))) for b in (tmp_path / "t's" / "v=0").glob("_bucket=*")} == {1}

    def apply(old, new):
        merged = merge(old, new, ["item", "id"]).table()
        plans.append(merged._jdf.queryExecution().executedPlan().toString())
        return merged

    change = spark.createDataFrame([(i % 3, i // 3, "new") for i in range(0, 300, 4)] + [(7, 1000, "new")], schema)
    delta = fact.save_bucketed(change, "plinth_test_delta", "id", 8, str(tmp_path / "delta"))
    want = rows_of(merge(spark.createDataFrame(rows, schema), change, ["item", "id"]).table())
    for _ in range(2):  # a version can be written again
        table.upsert(delta, 1, apply)
        assert rows_of(table.read(spark)) == want and rows_of(table.read(spark, 0)) == sorted(rows, key=str)
    assert all("Exchange" not in plan for plan in plans)
    assert spark.conf.get(confs) == "true"
    few = spark.createDataFrame([(0, 5, "newest"), (9, 5, "newest")], schema)
    table.upsert(few, 2, apply)
    assert len(list((tmp_path / "t's" / "v=2").glob("_bucket=*"))) == 1
    want = [(0, 5, "newest") if r[:2] == (0, 5) else r for r in want] + [(9, 5, "newest")]
    assert rows_of(table.read(spark)) == sorted(want, key=str)
    table.upsert(change, 3, apply)  # buckets of two versions
    last = {r[:2]: r for r in want} | {tuple(r)[:2]: tuple(r) for r in change.collect()}
    assert rows_of(table.read(spark)) == sorted(last.values(), key=str)
    table.upsert(table.read(spark), 4, lambda old, new: old.join(new, ["item", "id"], "left_anti").select(*old.columns))
    assert table.read(spark).count() == 0
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("plinth_") and len(t.name) == 39]


def test_buckets_that_become_empty_stay_empty_and_drafts_are_not_read(spark, tmp_path):
    table = BucketedTable(str(tmp_path / "t"), state(spark).schema, ["id"], 4)
    table.create(state(spark, *[(i, 0, "old") for i in range(6)]))
    everything = table.read(spark)
    remove = lambda old, new: old.join(new, ["id"], "left_anti").select(*old.columns)
    table.stage(everything, 1, remove)  # written, but its version is never published
    assert table.read(spark).count() == 6
    table.upsert(everything, 1, remove)
    assert table.read(spark).count() == 0 and table.read(spark, 0).count() == 6
    table.upsert(state(spark, (7, 1, "new")), 2, lambda old, new: new)
    manifest.prune(spark, table._log, keep=1)
    assert rows_of(table.read(spark)) == [(7, 1, "new")]
    assert not list((tmp_path / "t" / "v=0").glob("_bucket=*"))


def test_stream_keeps_clean_table_and_dimension(spark, tmp_path):
    """Three files, the second with a late row: the clean table keeps the newest, versions follow."""
    landing = tmp_path / "landing"
    landing.mkdir()
    log = str(tmp_path / "log")
    clean = BucketedTable(str(tmp_path / "clean"), state(spark).schema, ["id"], 4, log)
    clean.create(state(spark))
    dim_schema = empty_dim(state(spark), ["id"], ["a"]).schema
    dim = BucketedTable(str(tmp_path / "dim"), dim_schema, ["id"], 4, log)
    dim.create(spark.createDataFrame([], dim_schema))
    as_of = lambda batch_id: F.timestamp_seconds(F.lit(1_700_000_000 + batch_id))
    batch = upsert.dimension_batch(clean, dim, ["a"], ["t"], as_of, transform=lambda df: df.select(
        F.col("id").cast("bigint").alias("id"), F.col("t").cast("bigint").alias("t"), "a"
    ))
    for n, text in enumerate(["1,10,A\n2,10,A\n", "1,20,B\n2,5,late\n", "1,30,B\n3,10,A\n"]):
        (landing / f"{n}.csv").write_text("id,t,a\n" + text)
        stream = ingest.csv_stream(spark, str(landing), ["id", "t", "a"])
        upsert.run_available(stream, batch, str(tmp_path / "checkpoint")).awaitTermination()
    assert rows_of(clean.read(spark)) == [(1, 30, "B"), (2, 10, "A"), (3, 10, "A")]
    versions = {(r.id, r.a, r.is_current) for r in dim.read(spark).collect()}
    assert versions == {(1, "A", False), (1, "B", True), (2, "A", True), (3, "A", True)}
    # the last batch once more, as after a failure: both tables stay as they are
    before = rows_of(clean.read(spark)), rows_of(dim.read(spark))
    again = csv_drop.read_positional(spark, str(landing / "2.csv"), ["id", "t", "a"])
    batch(again, 2)
    assert (rows_of(clean.read(spark)), rows_of(dim.read(spark))) == before


def test_append_stream_takes_each_file_once(spark, tmp_path):
    landing = tmp_path / "landing"
    landing.mkdir()
    counts = []
    for n in range(3):
        if n < 2:
            (landing / f"{n}.csv").write_text(f"h\nrow{n}\n")
        stream = ingest.csv_stream(spark, str(landing), ["a"])
        ingest.append_new(stream, str(tmp_path / "stage"), str(tmp_path / "cp")).awaitTermination()
        counts.append(spark.read.parquet(str(tmp_path / "stage")).count())
    assert counts == [1, 2, 2]


def test_streamed_daily_revenue_equals_batch(spark, tmp_path):
    orders = spark.range(200).select(
        F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id") * 3600).alias("at"), F.lit(Decimal("1.25")).alias("v")
    )
    orders.repartition(4).write.parquet(str(tmp_path / "in"))
    stream = ingest.parquet_stream(spark, str(tmp_path / "in"), orders.schema, files_per_batch=1)
    days = revenue.daily_revenue(stream, "at", "v")
    table = BucketedTable(str(tmp_path / "out"), days.schema, ["calendar_date"], 2)
    table.create(spark.createDataFrame([], days.schema))
    upsert.run_available(days, upsert.replace_batch(table), str(tmp_path / "cp"), "update").awaitTermination()
    batch = orders.groupBy(F.to_date("at").alias("d")).agg(F.sum("v"), F.count("*"))
    assert rows_of(table.read(spark)) == rows_of(batch)


def test_an_order_far_too_late_counts_and_days_follow_the_given_zone(spark, tmp_path):
    landing, day = tmp_path / "in", 86_400
    table = None
    for n, seconds in enumerate([400 * day, 399 * day, 5 * day, 19.5 / 24 * day]):
        spark.range(1).select(F.timestamp_seconds(F.lit(seconds)).alias("at"), F.lit(Decimal("1.00")).alias("v")).write.parquet(f"{landing}/{n}")
        stream = ingest.parquet_stream(spark, f"{landing}/*", spark.read.parquet(f"{landing}/{n}").schema, files_per_batch=1)
        days = revenue.daily_revenue(stream, "at", "v", zone="Asia/Kolkata")
        table = table or BucketedTable(str(tmp_path / "out"), days.schema, ["calendar_date"], 2)
        if not n:
            table.create(spark.createDataFrame([], days.schema))
        upsert.run_available(days, upsert.replace_batch(table), str(tmp_path / "cp"), "update").awaitTermination()
    assert [str(r[0]) for r in rows_of(table.read(spark))] == ["1970-01-02", "1970-01-06", "1971-02-04", "1971-02-05"]
