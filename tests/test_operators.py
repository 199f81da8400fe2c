"""Operators on small fixtures, against brute force where it says more than an example."""

import random
from datetime import datetime
from decimal import Decimal

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from plinth.functions.casting import strict_number, try_decimal, try_number, whole
from plinth.functions.calendar import date_dim, month_abbr
from plinth.functions.keys import digest, hash_key, surrogate_key
from plinth.operators import quality
from plinth.operators.cdc import inserts_only, replay, snapshot_diff
from plinth.operators.joins import heavy_keys, lookup_dim, salted_join
from plinth.operators.latest import latest_by, latest_per_key
from plinth.operators.masking import mask_by_tag, tag_columns
from plinth.operators.merge import merge
from plinth.operators.ordered import add_slice, asof_join, big_keys
from plinth.operators.scd2 import dim_current, new_versions, scd2_apply, scd2_from_log, scd2_match_on, valid_from


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def ts(text):
    return F.lit(text).cast("timestamp")


def dim_of(spark, rows, day="2024-01-01"):
    return new_versions(spark.createDataFrame(rows, "id bigint, a string, b string"), ["id"], ["a", "b"], ts(day))


def step(dim, before, after, day, **kw):
    return scd2_apply(dim, snapshot_diff(before, after, ["id"]), ["id"], ["a", "b"], ts(day), **kw)


def state(spark, *rows):
    return spark.createDataFrame(list(rows), "id bigint, a string, b string")


# --- functions ---------------------------------------------------------------------------------


def test_casts(spark):
    df = spark.createDataFrame([("12.5",), (" 7 ",), ("x",), ("",), (None,)], "t string")
    assert [r[0] for r in df.select(try_number("t")).collect()] == [13, 7, None, None, None]
    got = [r[0] for r in df.select(try_decimal("t", 4, 2)).collect()]
    assert got[:3] == [Decimal("12.50"), Decimal("7.00"), None]
    with pytest.raises(PySparkException):
        df.select(strict_number("t")).collect()
    with pytest.raises(PySparkException):
        spark.range(1).select(whole(F.lit(123456).cast("decimal(10,2)"), 2)).collect()


def test_months_keep_calendar_order(spark):
    names = [r[0] for r in spark.range(1, 13).orderBy("id").select(month_abbr("id")).collect()]
    assert names[0] == "Jan" and names[8] == "Sep" and names[11] == "Dec"


def test_date_dim_bounds(spark):
    orders = spark.createDataFrame([("2024-02-27 23:00:00",), ("2024-02-28 01:00:00",)], "d string").select(
        F.col("d").cast("timestamp_ntz").alias("d")
    )
    end = F.lit("2024-03-01").cast("date")
    days = [str(r.calendar_date) for r in date_dim(orders, "d", end).orderBy("calendar_date").collect()]
    assert days == ["2024-02-27", "2024-02-28", "2024-02-29", "2024-03-01"]
    assert date_dim(orders, "d", end, include_first_day=False).count() == 3
    assert date_dim(orders.limit(0), "d", end).count() == 0


def test_hash_key_separates_shifted_and_missing_values(spark):
    df = spark.createDataFrame([("ab", "c"), ("a", "bc"), ("a", None), (None, "a")], "x string, y string")
    assert df.select(hash_key("x", "y")).distinct().count() == 4
    assert df.where(hash_key("x", "y").isNull()).count() == 0


def test_surrogate_keys_are_dense_and_repeatable(spark):
    df = spark.range(500).select((F.col("id") * 7).alias("k"))
    one = rows_of(surrogate_key(df, ["k"], buckets=9))
    two = rows_of(surrogate_key(df.repartition(5), ["k"], buckets=9))
    assert one == two and sorted(r[0] for r in one) == list(range(1, 501))


# --- merge and change rows ----------------------------------------------------------------------


def test_merge_needs_one_source_row_per_key(spark):
    target, source = state(spark, (1, "x", "y")), state(spark, (1, "p", "q"), (1, "r", "s"))
    with pytest.raises(PySparkException, match="several source rows"):
        merge(target, source, ["id"]).table().collect()
    assert rows_of(merge(target, source, ["id"], order_by=["a"]).table()) == [(1, "r", "s")]


def test_merge_sees_changes_from_and_to_null(spark):
    target = state(spark, (1, None, "y"), (2, "x", "y"), (3, "x", "y"))
    source = state(spark, (1, "new", "y"), (2, None, "y"), (3, "x", "y"), (4, "z", "z"))
    merged = merge(target, source, ["id"], only_if_changed=["a", "b"])
    assert rows_of(merged.table()) == rows_of(source)
    assert {(r._action, r.id) for r in merged.changes().collect()} == {
        ("DELETE", 1), ("INSERT", 1), ("DELETE", 2), ("INSERT", 2), ("INSERT", 4)
    }


def test_merge_is_idempotent(spark):
    target, source = state(spark, (1, "x", "y")), state(spark, (1, "p", "q"), (2, "r", "s"))
    once = merge(target, source, ["id"]).table()
    assert rows_of(merge(once, source, ["id"]).table()) == rows_of(once)


def test_diff_replays_to_the_next_snapshot(spark):
    rng = random.Random(3)

    def snapshot():
        return {k: (rng.choice("abc"), rng.choice(["x", None])) for k in range(60) if rng.random() < 0.7}

    old, new = snapshot(), snapshot()
    prev, curr = (state(spark, *[(k, *v) for k, v in s.items()]) for s in (old, new))
    changes = snapshot_diff(prev, curr, ["id"])
    assert rows_of(replay(prev, changes, ["id"])) == rows_of(curr)
    expected = {("INSERT", False, k) for k in new.keys() - old.keys()}
    expected |= {("DELETE", False, k) for k in old.keys() - new.keys()}
    expected |= {(a, True, k) for k in old.keys() & new.keys() if old[k] != new[k] for a in ("DELETE", "INSERT")}
    assert {(r._action, r._is_update, r.id) for r in changes.collect()} == expected
    assert {r.id for r in inserts_only(prev, curr, ["id"]).collect()} == new.keys() - old.keys()


def test_latest_per_key_with_a_hot_key_and_copies(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id")).alias("k"), (F.col("id") % 100).alias("t"), F.lit("c").alias("c")
    )
    latest = latest_per_key(df, ["k"], ["t"])
    assert latest.count() == df.select("k").distinct().count()
    assert latest.where("k = 0").first().t == 99


# --- type-2 dimensions --------------------------------------------------------------------------


def test_going_back_to_an_earlier_state_opens_a_third_version(spark):
    a, b = state(spark, (1, "A", "x")), state(spark, (1, "B", "x"))
    dim = step(step(dim_of(spark, [(1, "A", "x")]), a, b, "2024-01-02"), b, a, "2024-01-03")
    versions = dim.orderBy("eff_start").collect()
    assert [v.a for v in versions] == ["A", "B", "A"] and [v.is_current for v in versions] == [False, False, True]
    assert len({v.hk for v in versions}) == 3
    assert versions[0].eff_end == versions[1].eff_start and versions[1].eff_end == versions[2].eff_start


def test_wide_keys_for_very_large_dimensions(spark):
    a, b = state(spark, (1, "A", "x")), state(spark, (1, "B", "x"))
    dim = new_versions(a, ["id"], ["a", "b"], ts("2024-01-01"), make_key=digest)
    dim = scd2_apply(dim, snapshot_diff(a, b, ["id"]), ["id"], ["a", "b"], ts("2024-01-02"), make_key=digest)
    keys = {r.hk for r in dim.collect()}
    assert len(keys) == 2 and {len(k) for k in keys} == {40}


def test_null_attributes_still_close_the_old_version(spark):
    before, after = state(spark, (1, None, "x")), state(spark, (1, "A", "x"))
    dim = step(dim_of(spark, [(1, None, "x")]), before, after, "2024-01-02")
    assert dim.count() == 2 and dim_current(dim).first().a == "A"


def test_delete_closes_and_a_return_opens_again(spark):
    live, gone = state(spark, (1, "A", "x"), (2, "A", "x")), state(spark, (2, "A", "x"))
    dim = step(dim_of(spark, [(1, "A", "x"), (2, "A", "x")]), live, gone, "2024-01-02")
    assert [r.id for r in dim_current(dim).collect()] == [2]
    kept = step(dim_of(spark, [(1, "A", "x"), (2, "A", "x")]), live, gone, "2024-01-02", close_on_delete=False)
    assert dim_current(kept).count() == 2
    back = step(dim, gone, live, "2024-01-03")
    assert dim_current(back).count() == 2 and back.where("id = 1").count() == 2


def test_applying_a_batch_twice_changes_nothing(spark):
    a, b = state(spark, (1, "A", "x")), state(spark, (1, "B", "x"), (2, "N", "x"))
    once = step(dim_of(spark, [(1, "A", "x")]), a, b, "2024-01-02")
    assert rows_of(step(once, a, b, "2024-01-02")) == rows_of(once)


def test_literal_merge_form_loses_the_current_row(spark):
    """Matched on id and flag: a change of another column closes the row and opens none."""
    before, after = state(spark, (1, "A", "Yes")), state(spark, (1, "B", "Yes"))
    changes = snapshot_diff(before, after, ["id"])
    dim = dim_of(spark, [(1, "A", "Yes")])
    literal = scd2_match_on(dim, changes, ["id"], ["a", "b"], ["id", "b"], ts("2024-01-02"))
    assert dim_current(literal).count() == 0
    assert dim_current(scd2_apply(dim, changes, ["id"], ["a", "b"], ts("2024-01-02"))).count() == 1
    # matched on all attributes: A -> B -> A finds the closed A row and adds nothing
    full = scd2_match_on(dim, changes, ["id"], ["a", "b"], ["id", "a", "b"], ts("2024-01-02"))
    back = snapshot_diff(after, before, ["id"])
    assert dim_current(scd2_match_on(full, back, ["id"], ["a", "b"], ["id", "a", "b"], ts("2024-01-03"))).count() == 0


def history(rows):
    """Versions per key by plain iteration; several rows at one instant: the last counts."""
    out = []
    for k in {r[0] for r in rows}:
        instants = {}
        for _, t, n, s in sorted((r for r in rows if r[0] == k), key=lambda r: (r[1], r[2])):
            instants[t] = s
        starts = []
        for t, s in sorted(instants.items()):
            if not starts or starts[-1][1] != s:
                starts.append((t, s))
        for i, (t, s) in enumerate(starts):
            out.append((k, s, t, starts[i + 1][0] if i + 1 < len(starts) else None))
    return sorted(out, key=str)


def log_rows(seed, n=400):
    """A change log in which key 0 holds a third of all rows and many rows share an instant."""
    rng = random.Random(seed)
    return [
        (0 if i % 3 == 0 else rng.randrange(1, 15), 1_700_000_000 + rng.randrange(250), i, rng.choice(["a", "b", None]))
        for i in range(n)
    ]


def log_frame(spark, rows):
    df = spark.createDataFrame(rows, "k bigint, t bigint, n bigint, s string")
    return df.withColumn("at", F.timestamp_seconds("t"))


@pytest.mark.parametrize("rows_per_slice", [1_000_000, 20, 3])
@pytest.mark.parametrize("ntz", [False, True])
def test_history_from_log_in_slices(spark, rows_per_slice, ntz):
    rows = log_rows(rows_per_slice)
    log = log_frame(spark, rows)
    if ntz:
        log = log.withColumn("at", F.col("at").cast("timestamp_ntz"))
    dim = scd2_from_log(log, ["k"], "at", ["s"], ["n"], rows_per_slice=rows_per_slice)
    sec = [F.unix_seconds(F.col(c).cast("timestamp")) for c in ("eff_start", "eff_end")]
    assert rows_of(dim.select("k", "s", *sec)) == history(rows)
    assert dim_current(dim).count() == len({r[0] for r in rows})


@pytest.mark.parametrize("rows_per_slice", [1_000_000, 20, 3])
def test_asof_join_in_slices(spark, rows_per_slice):
    facts = [(k, t, n) for k, t, n, _ in log_rows(7)]
    states = {(k, t): f"s{n}" for k, t, n, _ in log_rows(8, 150)}
    left = spark.createDataFrame(facts, "k bigint, t bigint, n bigint").withColumn("at", F.timestamp_seconds("t"))
    right = spark.createDataFrame([(k, t, s) for (k, t), s in states.items()], "k bigint, t bigint, s string")
    right = right.select("k", F.timestamp_seconds("t").alias("since"), "s")
    got = asof_join(left, right, ["k"], "at", "since", ["s"], rows_per_slice=rows_per_slice)

    def known(k, t):
        seen = [(since, s) for (key, since), s in states.items() if key == k and since <= t]
        return max(seen)[1] if seen else None

    assert rows_of(got.select("k", "t", "n", "s")) == sorted([(*f, known(f[0], f[1])) for f in facts], key=str)


def test_rows_without_a_key_open_no_version_and_stay_in_an_asof_join(spark):
    log = log_frame(spark, [(None, 1, 1, "a"), (1, 1, 2, "a")])
    assert scd2_from_log(log, ["k"], "at", ["s"], ["n"]).count() == 1
    facts = spark.createDataFrame([(None, 5), (1, 5)], "k bigint, t bigint").withColumn("now", F.timestamp_seconds("t"))
    got = asof_join(facts, log, ["k"], "now", "at", ["s"])
    assert rows_of(got.select("k", "s")) == [(1, "a"), (None, None)]


def test_lookup_takes_the_version_of_the_day_and_reaches_back(spark):
    a, b = state(spark, (1, "A", "x")), state(spark, (1, "B", "x"))
    dim = valid_from(step(dim_of(spark, [(1, "A", "x")]), a, b, "2024-02-01"), ["id"])
    facts = spark.createDataFrame([(1, "2023-06-01"), (1, "2024-01-15"), (1, "2024-02-01")], "fk bigint, d string")
    facts = facts.withColumn("d", F.col("d").cast("timestamp"))
    got = lookup_dim(facts, dim, "fk", "id", "hk", "key", at="d", extra=["a"]).orderBy("d").collect()
    assert [r.a for r in got] == ["A", "A", "B"]


# --- joins --------------------------------------------------------------------------------------


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    left = spark.range(900).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("k"), F.lit("copy").alias("v")
    )
    right = spark.range(0, 30).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    (heavy,) = heavy_keys(left, [["k"]], share=0.2)
    assert len(heavy) == 1
    got = salted_join(left, right, ["k"], how, heavy=heavy, salts=7)
    assert rows_of(got) == rows_of(left.join(right, ["k"], how))


def test_salted_join_refuses_to_repeat_outer_rows(spark):
    df = spark.range(3)
    with pytest.raises(ValueError):
        salted_join(df, df, ["id"], "full", heavy=[1])


# --- checks, quarantine, masks --------------------------------------------------------------------


def test_checks(spark):
    df = spark.createDataFrame([(1, "abc", None), (1, "a", 5), (2, None, 7)], "k int, s string, f int")
    assert rows_of(quality.check_not_null(df, ["k", "s", "f"])) == [("f", 1), ("k", 0), ("s", 1)]
    assert rows_of(quality.check_unique(df, ["k"])) == [(1, 2)]
    assert rows_of(quality.check_length(df, {"s": 2})) == [("s", 1)]
    dim = spark.createDataFrame([(5,)], "pk int")
    assert rows_of(quality.check_fk(df, dim, "f", "pk")) == [(7, 1)]  # a NULL key is no orphan


def test_delete_where_keeps_unknown_rows(spark):
    df = spark.createDataFrame([("a|b",), ("x",), (None,)], "s string")
    assert rows_of(quality.delete_where(df, F.col("s").like("%|%"))) == [("x",), (None,)]


def test_split_rows_keeps_everything(spark):
    df = spark.createDataFrame([("1", "a"), ("x", "a"), ("1|a", None), (None, "a")], "id string, v string")
    rules = {"shifted": quality.wrong_delimiter("id", "v"), "junk": quality.not_castable("id", "bigint")}
    valid, bad = quality.split_rows(df, rules)
    assert valid.count() + bad.count() == 4
    assert {r.id: r._reason for r in bad.collect()} == {"x": "junk", "1|a": "shifted;junk"}


def test_tags_are_checked_and_unmasked_tags_stay(spark):
    df = spark.createDataFrame([("a", "b")], "x string, y string")
    with pytest.raises(ValueError):
        tag_columns(df, {"x": "SECRET"})
    tagged = tag_columns(df, {"x": "PRICE", "y": "SENSITIVE"})
    assert tuple(mask_by_tag(tagged).first()) == ("a", "** Phone **")
    joined = tagged.join(df.select("x"), "x")
    assert tuple(mask_by_tag(joined).first()) == ("a", "** Phone **")


# --- batches of any shape -------------------------------------------------------------------------


def image(action, update, k, a, at=None):
    return (action, update, k, a, at)


def images(spark, *rows):
    return spark.createDataFrame([(*r[:4], None if r[4] is None else datetime(2024, 1, r[4])) for r in rows], "_action string, _is_update boolean, k bigint, a string, at timestamp")


def open_dim(spark, *rows):
    base = spark.createDataFrame(list(rows), "k bigint, a string")
    return new_versions(base, ["k"], ["a"], F.lit("2024-01-01").cast("timestamp"))


def test_several_changes_of_a_key_are_chained(spark):
    dim = open_dim(spark, (1, "A"), (2, "X"))
    batch = images(
        spark, image("INSERT", True, 1, "B", 5), image("INSERT", True, 1, "C", 9), image("DELETE", False, 2, "X", 4),
        image("INSERT", False, 2, "Y", 6), image("INSERT", False, None, "Z", 6), image("INSERT", False, 3, "N", 7),
    )
    after = scd2_apply(dim, batch, ["k"], ["a"], F.lit(None), at="at")
    got = {(r.k, r.a, r.eff_start.day, r.eff_end and r.eff_end.day, r.is_current) for r in after.collect()}
    assert got == {
        (1, "A", 1, 5, False), (1, "B", 5, 9, False), (1, "C", 9, None, True), (2, "X", 1, 4, False), (2, "Y", 6, None, True),
        (3, "N", 7, None, True),
    }
    with pytest.raises(Exception, match="older"):
        scd2_apply(after, images(spark, image("INSERT", True, 1, "D", 8)), ["k"], ["a"], F.lit(None), at="at").collect()


def test_without_times_several_images_or_an_old_batch_fail(spark):
    dim, day = open_dim(spark, (1, "A")), F.lit("2024-01-05").cast("timestamp")
    two = images(spark, image("INSERT", True, 1, "B"), image("INSERT", True, 1, "C"))
    with pytest.raises(Exception, match="several changes"):
        scd2_apply(dim, two, ["k"], ["a"], day).collect()
    with pytest.raises(Exception, match="older"):
        scd2_apply(dim, images(spark, image("INSERT", True, 1, "B")), ["k"], ["a"], F.lit("2023-01-01").cast("timestamp")).collect()


def test_a_null_key_opens_no_version_and_is_no_change(spark):
    rows = spark.createDataFrame([(None, "Q"), (1, "A")], "k bigint, a string")
    assert snapshot_diff(rows, rows, ["k"]).collect() == []
    dim = open_dim(spark, (1, "A"))
    for _ in range(2):
        dim = scd2_apply(dim, images(spark, image("INSERT", False, None, "Q")), ["k"], ["a"], F.lit("2024-01-05").cast("timestamp"))
    assert dim.count() == 1


def test_deleted_and_back_in_one_batch_is_one_change(spark):
    dim = open_dim(spark, (1, "A"))
    batch = images(spark, image("DELETE", False, 1, "A"), image("INSERT", False, 1, "B"))
    after = scd2_apply(dim, batch, ["k"], ["a"], F.lit("2024-01-05").cast("timestamp"))
    assert {(r.a, r.is_current) for r in after.collect()} == {("A", False), ("B", True)}


def test_keys_do_not_depend_on_the_session_zone(spark):
    keys = []
    for zone in ("UTC", "Asia/Kolkata"):
        spark.conf.set("spark.sql.session.timeZone", zone)
        rows = spark.range(3).select(F.col("id").alias("k"), F.lit("A").alias("a"))
        dim = new_versions(rows, ["k"], ["a"], F.timestamp_seconds(F.lit(1_700_000_000)))
        keys.append(sorted(r.hk for r in dim.collect()))
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert keys[0] == keys[1]


def test_tags_stay_through_merge_diff_and_dimension(spark):
    rows = tag_columns(spark.createDataFrame([(1, "x")], "k bigint, a string"), {"a": "PII"})
    new = tag_columns(spark.createDataFrame([(1, "y"), (2, "z")], "k bigint, a string"), {"a": "PII"})
    merged = merge(rows, new, ["k"])
    dim = scd2_apply(new_versions(rows, ["k"], ["a"], F.lit("2024-01-01").cast("timestamp")), merged.changes(), ["k"], ["a"], F.lit("2024-01-05").cast("timestamp"))
    for df in (merged.table(), merged.changes(), snapshot_diff(rows, new, ["k"]), dim):
        assert {r.a for r in mask_by_tag(df, expected={"a": "PII"}).collect()} == {"** PII **"}
    with pytest.raises(ValueError, match="missing"):
        mask_by_tag(spark.createDataFrame([(1, "x")], "k bigint, a string"), expected={"a": "PII"})


def test_inserted_rows_continue_the_surrogate_keys(spark):
    rows = surrogate_key(spark.createDataFrame([(3, "x"), (5, "y")], "k bigint, a string"), ["k"], "sk", start=10)
    new = spark.createDataFrame([(5, "Y"), (1, "z"), (9, "w")], "k bigint, a string")
    after = {(r.k, r.a): r.sk for r in merge(rows, new, ["k"], number="sk").table().collect()}
    assert after == {(3, "x"): 11, (5, "Y"): 12, (1, "z"): 13, (9, "w"): 14}


def test_default_surrogate_keys_do_not_depend_on_the_session(spark):
    rows, found = spark.range(50).select((F.col("id") * 7).alias("k")), []
    for n in ("3", "8"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        found.append(rows_of(surrogate_key(rows, ["k"])))
    assert found[0] == found[1]


def test_late_rows_are_ignored_on_request(spark):
    old = spark.createDataFrame([(1, 20, "new"), (2, None, "first")], "k bigint, t bigint, a string")
    late = spark.createDataFrame([(1, 10, "late"), (2, 5, "second")], "k bigint, t bigint, a string")
    assert rows_of(merge(old, late, ["k"], newer_than="t").table()) == [(1, 20, "new"), (2, 5, "second")]


def test_a_stray_timestamp_does_not_undo_the_slices(spark):
    line = spark.range(20_000).select(F.lit(1).alias("k"), F.timestamp_micros(F.lit(1_700_000_000_000_000) + F.col("id") * 1000).alias("t"))
    line = line.unionByName(spark.createDataFrame([(1, datetime(1970, 1, 2))], "k int, t timestamp"))
    sliced = add_slice(line, ["k"], "t", big_keys(line, ["k"], "t", 1000))
    sizes = [r["count"] for r in sliced.groupBy("_slice").count().collect()]
    assert sum(sizes) == 20_001 and max(sizes) < 2000


def test_latest_by_one_key_equals_latest_per_key(spark):
    """Also with a key that holds a third of the rows, which is ranked before it moves, and NULL keys."""
    rows = [(i % 7, i // 7, i % 5, f"a{i % 3}") for i in range(600)] + [(1, 2, i, "hot") for i in range(300)]
    rows += [(None, 1, 1, "x"), (None, 1, 2, "y"), (1, None, 1, "z")]
    df = spark.createDataFrame(rows, "item bigint, id bigint, t bigint, a string").repartition(4)
    got = latest_by(df, ["item", "id"], ["t"], "id", 5)
    assert rows_of(got) == rows_of(latest_per_key(df, ["item", "id"], ["t"]))
    assert got.where("pmod(hash(id), 5) <> spark_partition_id()").count() == 0
    assert got._jdf.queryExecution().executedPlan().toString().count("WindowGroupLimit") > 1  # the hot key's own
    cool = latest_by(df.where("a <> 'hot'"), ["item", "id"], ["t"], "id", 5)
    assert cool._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
