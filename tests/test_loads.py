"""Checks in the pass that loads, reconciliation, bucketed joins, streamed drops and live KPIs."""

import os
import random
from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from plinth.operators import quality
from plinth.plans import fact, kpi_incremental
from plinth.plans import queries as q
from plinth.plans.fact_store import FactStore
from plinth.sources import given, manifest
from plinth.streaming import ingest, upsert
from plinth.streaming import kpis as live
from test_changes import FACT, plan, rows_of, some_fact

SF = "/root/testdata/sf0.001"


def jobs_of(spark, run):
    """How many jobs a call starts."""
    tag = f"count-{random.random()}"
    spark.sparkContext.setJobGroup(tag, tag)
    try:
        run()
        return len(spark.sparkContext.statusTracker().getJobIdsForGroup(tag))
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


# --- checks --------------------------------------------------------------------------------------


def test_checks_are_counted_by_the_job_that_writes(spark, tmp_path):
    df = spark.createDataFrame([("1", "abc", None), (None, "ab", "x"), ("z", "abcdef", "y")], "n string, t string, u string")
    found = {}

    def load():
        found.update(quality.write_checked(
            df, f"{tmp_path}/t", not_null=["n", "u"], lengths={"t": 3}, castable={"n": "int"}, rules={"odd": F.col("u") == "x"},
        ))

    assert jobs_of(spark, load) == 1
    assert found == {"rows": 3, "null n": 1, "null u": 1, "too long t": 1, "not castable n": 1, "odd": 1}
    assert spark.read.parquet(f"{tmp_path}/t").count() == 3
    empty = quality.write_checked(df.limit(0), f"{tmp_path}/none", not_null=["n"])
    assert empty == {"rows": 0, "null n": 0}


def brute_difference(left, right):
    out = set()
    for key in {r[0] for r in left + right}:
        a, b = (sorted((r[1:] for r in side if r[0] == key), key=str) for side in (left, right))
        if a != b:
            out.add((key, "lost" if not b else "added" if not a else "changed"))
    return sorted(out, key=str)


@pytest.mark.parametrize("buckets", [1, 7, 4096])
def test_reconcile(spark, buckets):
    rng = random.Random(8)
    left = [(rng.choice([*range(30), None]), rng.choice("xy"), rng.choice([1, None])) for _ in range(50)]
    right = [r for r in left if rng.random() < 0.8] + [(rng.randrange(25, 40), "x", 1) for _ in range(6)]
    rng.shuffle(right)
    kind = "id bigint, a string, b bigint"
    got = quality.reconcile(spark.createDataFrame(left, kind), spark.createDataFrame(right, kind), ["id"], ["a", "b"], buckets)
    assert rows_of(got) == brute_difference(left, right)


def test_equal_layers_have_no_difference_and_rows_meet_in_buckets_that_differ(spark):
    df = spark.range(500).select("id", (F.col("id") * 3).alias("a"))
    assert quality.reconcile(df, df.repartition(5), ["id"], ["a"], 16).collect() == []
    changed = df.withColumn("a", F.when(F.col("id") == 77, 0).otherwise(F.col("a")))
    assert rows_of(quality.reconcile(df, changed, ["id"], ["a"], 16)) == [(77, "changed")]


# --- bucketed joins ------------------------------------------------------------------------------


def test_large_joins_of_bucketed_tables_do_not_shuffle(spark, tmp_path):
    tables = [
        fact.save_bucketed(rows, f"t_{name}_{os.getpid()}", key, 4, f"{tmp_path}/{name}")
        for name, rows, key in (
            ("items", given.order_items(spark, SF), "order_id_fk"), ("orders", given.orders(spark, SF), "order_id"),
            ("deliveries", given.deliveries(spark, SF), "order_id_fk"),
        )
    ]
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        lines = fact.order_lines(*tables)
        text = plan(lines)
        assert "SortMergeJoin" in text and "Exchange" not in text and "Bucketed: true" in text
        assert lines.count() == given.order_items(spark, SF).count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    dims = q.dimensions(spark, SF)
    assert rows_of(fact.fact_of_lines(lines, dims)) == rows_of(q.fact_build(spark, SF))


# --- streamed drops ------------------------------------------------------------------------------


def drop(folder, name, *lines):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w") as f:
        f.write("\n".join(["h1,h2", *lines]) + "\n")


def land(spark, root, columns=("a", "b"), files_per_batch=None):
    stream = ingest.landing_stream(spark, f"{root}/in", list(columns), files_per_batch=files_per_batch)
    upsert.run_available(stream, ingest.landing_batch(f"{root}/stage", list(columns)), f"{root}/checkpoint").awaitTermination()


def test_a_file_that_lands_twice_counts_once_and_surplus_fields_are_rejected(spark, tmp_path):
    root = str(tmp_path)
    drop(f"{root}/in", "1.csv", "1,x", "2,y,surplus", "3")
    drop(f"{root}/in", "2.csv", "1,x", "2,y,surplus", "3")
    land(spark, root)
    drop(f"{root}/in", "3.csv", "1,x", "2,y,surplus", "3")
    drop(f"{root}/in", "4.csv", "1,x")
    land(spark, root, files_per_batch=1)
    stage = spark.read.parquet(f"{root}/stage")
    got = rows_of(stage.select("a", "b", F.regexp_extract("_stg_file_name", r"(\d)\.csv$", 1).alias("file")))
    assert got == [("1", "x", "1"), ("1", "x", "4"), ("3", None, "1")]
    assert stage.where("_stg_file_md5 is null or _stg_file_load_ts is null or _copy_data_ts is null").count() == 0
    rejects = spark.read.parquet(f"{root}/stage_rejects")
    assert rows_of(rejects.select("_corrupt_record", "_reason")) == [("2,y,surplus", "more fields than columns")]
    files = spark.read.parquet(f"{root}/stage_files")
    assert files.count() == 4 and files.where("loaded").count() == 2


def test_a_repeated_landing_batch_changes_nothing(spark, tmp_path):
    root = str(tmp_path)
    drop(f"{root}/in", "1.csv", "1,x", "2,y,surplus")
    land(spark, root)
    before = rows_of(spark.read.parquet(f"{root}/stage").drop("_copy_data_ts"))
    # the batch was done but its commit was lost
    for name in os.listdir(f"{root}/checkpoint/commits"):
        os.remove(f"{root}/checkpoint/commits/{name}")
    land(spark, root)
    assert rows_of(spark.read.parquet(f"{root}/stage").drop("_copy_data_ts")) == before
    assert spark.read.parquet(f"{root}/stage_rejects").count() == 1


# --- live KPIs -----------------------------------------------------------------------------------


def test_a_live_batch_can_die_after_each_step_and_be_repeated(spark, tmp_path, monkeypatch):
    rng = random.Random(21)
    kind = FACT + ", modified int"
    first = [(*r, 1) for r in some_fact(rng, range(12))]
    second = [(*r[:3], "Delivered", r[4], r[5] + 1, 2) for r in first if r[1] % 3 == 0] + [(*r, 2) for r in some_fact(rng, [50])]
    late = [(*r[:3], "Pending", r[4], Decimal(1), 0) for r in first if r[1] % 2 == 0]
    schema = spark.createDataFrame([], kind).schema
    store, grain = FactStore(f"{tmp_path}/fact", schema), kpi_incremental.DAY_GRAIN
    store.create(spark.createDataFrame([], kind))
    empty = kpi_incremental.state_of(spark.createDataFrame([], kind), grain).schema
    run = live.kpi_batch(store, f"{tmp_path}/live", grain, empty, "modified")
    state, want = [], {}
    for n, rows in enumerate((first, second, late)):
        for r in rows:
            if r[:2] not in want or want[r[:2]][6] <= r[6]:
                want[r[:2]] = r
        batch = spark.createDataFrame(rows, kind)
        for broken in ((FactStore, "_write"), (kpi_incremental, "apply_changes")):
            with monkeypatch.context() as m:
                m.setattr(*broken, lambda *a, **k: (_ for _ in ()).throw(OSError("lost")))
                with pytest.raises(OSError):
                    run(batch, n)
        run(batch, n)
        run(batch, n)  # done, but Spark did not hear of it
        got = live.latest_state(spark, f"{tmp_path}/live", empty)
        assert rows_of(got) == rows_of(kpi_incremental.state_of(spark.createDataFrame(list(want.values()), kind), grain))
    assert rows_of(store.read(spark).drop("order_month")) == sorted(want.values(), key=str)


# --- versions ------------------------------------------------------------------------------------


def test_a_version_published_again_is_there_at_every_moment(spark, tmp_path, monkeypatch):
    log = f"{tmp_path}/log"
    manifest.publish(spark, log, 0, {"t": {0: 0}})
    manifest.publish(spark, log, 1, {"t": {0: 1}})
    with monkeypatch.context() as m:
        m.setattr(manifest, "remove", lambda *a: pytest.fail("nothing may be deleted"))
        manifest.publish(spark, log, 1, {"t": {0: 1, 1: 1}})
    assert manifest.versions(spark, log) == [0, 1]
    assert manifest.latest(spark, log) == {"t": {0: 1, 1: 1}} and manifest.latest(spark, log, 0) == {"t": {0: 0}}
    manifest.prune(spark, log, keep=1)
    assert manifest.versions(spark, log) == [1] and manifest.latest(spark, log) == {"t": {0: 1, 1: 1}}
    assert len([n for n in os.listdir(log) if n.endswith(".json")]) == 1


def test_seven_foreign_keys_are_checked(spark):
    names = {r["constraint_name"] for r in q.check_fk(spark, "/root/testdata/sf0.01").collect()}
    assert len(names) == 7




def test_day_lists_are_days(spark):
    df = spark.createDataFrame([(date(2024, 1, 2),), (None,), (date(2024, 1, 2),)], "order_date date")
    assert kpi_incremental.touched_days(df) == [date(2024, 1, 2)]


def test_daily_revenue_takes_a_load_a_batch_however_many_files_it_has(spark, tmp_path, monkeypatch):
    days = [f"{1995 + k % 8}-03-{1 + k % 28:02d}" for k in range(64)]
    rows = [(k, k, "F", float(k), datetime.fromisoformat(f"{d} 10:00:00"), "5-LOW") for k, d in enumerate(days)]
    spark.createDataFrame(rows, given.SCHEMAS["orders"]).repartition(16).write.parquet(f"{tmp_path}/orders.parquet")
    batches, real = [], upsert.replace_batch

    def counted(table):
        run = real(table)
        return lambda batch, n: (batches.append(n), run(batch, n))

    monkeypatch.setattr(upsert, "replace_batch", counted)
    monkeypatch.setattr(q, "_tasks", lambda spark: 2)
    before = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.openCostInBytes", "128m")  # a split and so a file for each part
    try:
        got = {r["calendar_date"]: (r["total_revenue"], r["total_orders"]) for r in q.stream_daily_revenue(spark, str(tmp_path)).collect()}
    finally:
        spark.conf.set("spark.sql.files.openCostInBytes", before)
    assert sorted(batches) == [0, 1, 2]
    want = {}
    for k, d in enumerate(days):
        want[d] = (want.get(d, (0, 0))[0] + Decimal(k), want.get(d, (0, 0))[1] + 1)
    assert got == want
