"""Location files of five days: load, add, update, wrong delimiter, junk ids."""

import pytest
from pyspark.sql import functions as F

from plinth.functions.keys import surrogate_key
from plinth.operators.cdc import snapshot_diff
from plinth.operators.scd2 import dim_current, empty_dim
from plinth.plans import layers
from plinth.plans.entities import LOCATION
from plinth.sources import csv_drop

HEADER = "LocationID,City,State,ZipCode,ActiveFlag,CreatedDate,ModifiedDate\n"
DAYS = {
    "day0": """1,New Delhi,Delhi,110001,Yes,2024-01-01 10:00:00,\\N
2,Mumbai,Maharashtra,400001,Yes,2024-01-01 10:00:00,\\N
3,"Bengaluru",Karnataka,560001,Yes,2024-01-01 10:00:00,\\N
4,Jaipur,Rajasthan,302001,Yes,2024-01-01 10:00:00,\\N
5,Panaji,Goa,403001,Yes,2024-01-01 10:00:00,\\N
""",
    "day1": """6,Patna,Bihar,800001,Yes,2024-01-02 10:00:00,\\N
7,Chandigarh,Chandigarh,160001,Yes,2024-01-02 10:00:00,\\N
""",
    "day2": """2,Mumbai,Maharashtra,400001,No,2024-01-01 10:00:00,2024-01-03 10:00:00
6,Patna,Bihar,800001,Yes,2024-01-02 10:00:00,\\N
""",
    "day3": """8|Agra|Uttar Pradesh|282001|Yes|2024-01-04 10:00:00|
9|Nashik|Maharashtra|422001|Yes|2024-01-04 10:00:00|
""",
    "day4": """junk-1,Agra,Uttar Pradesh,282001,Yes,2024-01-05 10:00:00,\\N
10,Ranchi,Jharkhand,834001,Yes,2024-01-05 10:00:00,\\N
""",
}


@pytest.fixture(scope="module")
def drop(tmp_path_factory):
    root = tmp_path_factory.mktemp("location")
    for day, text in DAYS.items():
        (root / f"{day}.csv").write_text(HEADER + text)
    return str(root)


def stage_of(spark, drop, day):
    rows = csv_drop.read_positional(spark, drop, LOCATION.stage, glob=f"{day}.csv")
    return csv_drop.with_lineage(spark, rows, drop, glob=f"{day}.csv", load_ts=F.lit("2024-02-01").cast("timestamp"))


def at(day):
    return F.lit(f"2024-02-0{day + 1} 00:00:00").cast("timestamp")


@pytest.fixture(scope="module")
def story(spark, drop, tmp_path_factory):
    """Clean table and dimension after each day, with the day's change rows and quarantine."""
    root, result = tmp_path_factory.mktemp("tables"), []
    clean = layers.clean_rows(stage_of(spark, drop, "day0").limit(0), LOCATION)
    dim = empty_dim(clean, LOCATION.keys, LOCATION.tracked, LOCATION.hk)
    for n, day in enumerate(DAYS):
        valid, bad = layers.split_stage(stage_of(spark, drop, day), LOCATION)
        merged = layers.merge_clean(clean, layers.clean_rows(valid, LOCATION), LOCATION)
        merged.table().write.parquet(f"{root}/clean{n}")
        merged.changes().write.parquet(f"{root}/changes{n}")
        before, clean = clean, spark.read.parquet(f"{root}/clean{n}")
        changes = spark.read.parquet(f"{root}/changes{n}")
        layers.apply_dim(dim, changes, LOCATION, at(n)).write.parquet(f"{root}/dim{n}")
        dim = spark.read.parquet(f"{root}/dim{n}")
        result.append({"before": before, "clean": clean, "changes": changes, "dim": dim, "bad": bad})
    return result


def test_initial_load_types_and_enriches(story):
    rows = {r.location_id: r for r in story[0]["clean"].collect()}
    assert len(rows) == 5 and story[0]["dim"].count() == 5
    delhi = rows[1]
    assert (delhi.state, delhi.state_code, delhi.is_union_territory) == ("New Delhi", "DL", True)
    assert delhi.capital_city_flag and delhi.city_tier == "Tier-3"  # tiers list 'Delhi', not 'New Delhi'
    assert rows[2].capital_city_flag and rows[2].city_tier == "Tier-1"
    assert rows[4].city_tier == "Tier-2" and rows[5].state_code == "GA"
    assert len(rows[1]._stg_file_md5) == 32 and rows[1]._stg_file_name.endswith("day0.csv")


def test_added_rows_are_insert_changes(story):
    changes = story[1]["changes"].collect()
    assert {(r._action, r._is_update, r.location_id) for r in changes} == {
        ("INSERT", False, 6), ("INSERT", False, 7)
    }
    assert story[1]["dim"].count() == 7


def test_update_gives_old_and_new_row_and_a_new_version(story):
    changes = {(r._action, r._is_update, r.location_id, r.active_flag) for r in story[2]["changes"].collect()}
    # the file repeats location 6 unchanged, which is no change
    assert changes == {("DELETE", True, 2, "Yes"), ("INSERT", True, 2, "No")}
    versions = sorted(
        (r.active_flag, r.is_current, r.eff_end is None) for r in story[2]["dim"].where("location_id = 2").collect()
    )
    assert versions == [("No", True, True), ("Yes", False, False)]
    assert story[2]["clean"].count() == 7 and story[2]["dim"].count() == 8


def test_wrong_delimiter_goes_to_quarantine(story):
    bad = story[3]["bad"].collect()
    assert len(bad) == 2 and all("wrong delimiter" in r._reason for r in bad)
    assert story[3]["changes"].count() == 0 and story[3]["clean"].count() == 7


def test_junk_id_goes_to_quarantine_and_the_rest_goes_on(story):
    assert [r._reason for r in story[4]["bad"].collect()] == ["locationid is not a decimal"]
    assert story[4]["clean"].where("location_id = 10").count() == 1


def test_merge_changes_equal_snapshot_diff(story):
    for step in story:
        diff = snapshot_diff(step["before"], step["clean"], LOCATION.keys)
        assert sorted(map(str, diff.collect())) == sorted(map(str, step["changes"].select(diff.columns).collect()))


def test_one_current_row_per_live_key(story):
    for step in story:
        current = dim_current(step["dim"]).groupBy("location_id").count()
        assert current.where("count > 1").count() == 0
        assert current.count() == step["clean"].count()


def test_abort_mode_fails_on_wrong_delimiter(spark, drop, tmp_path):
    with pytest.raises(Exception, match="MALFORMED"):
        csv_drop.copy_into(spark, drop, LOCATION.stage, str(tmp_path / "stage"), glob="day3.csv")


def test_stage_appends_loads_and_clean_gets_surrogate_keys(spark, drop, tmp_path):
    stage = str(tmp_path / "stage")
    for day in ("day0", "day1"):
        csv_drop.copy_into(spark, drop, LOCATION.stage, stage, glob=f"{day}.csv")
    rows = layers.clean_rows(spark.read.parquet(stage), LOCATION)
    keyed = surrogate_key(rows, ["location_id"], "restaurant_location_sk", start=100, buckets=3)
    assert sorted(r.restaurant_location_sk for r in keyed.collect()) == list(range(101, 108))
