"""Cleansing, enrichment, dedup and their accounting."""

from datetime import datetime, timedelta

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from layerwright.config import SilverSpec
from layerwright.functions import scalars
from layerwright.operators import silver
from rows import VALID, raw

START = VALID["tpep_pickup_datetime"]


def value(spark, expression):
    return spark.range(1).selectExpr(f"{expression} AS v").first().v


def test_silver_columns_and_types(spark):
    types = dict(silver.to_silver(raw(spark, copies=1)).dtypes)
    assert types["pickup_datetime"] == "timestamp_ntz" and types["passenger_count"] == "int"
    assert types["trip_duration_mins"] == "double" and types["is_weekend"] == "boolean"
    assert types["_ingested_at"] == "timestamp" and types["_source"] == "string"
    assert not {"tpep_pickup_datetime", "VendorID", "PULocationID"} & set(types)


def test_derived_values(spark):
    row = silver.to_silver(raw(spark, copies=1)).first()
    assert (row.trip_duration_mins, row.pickup_hour, row.pickup_day_of_week) == (25.0, 9, 2)
    assert (row.pickup_year, row.pickup_month, str(row.pickup_date)) == (2024, 1, "2024-01-22")
    assert (row.payment_type_desc, row.vendor_name) == ("Credit card", "Creative Mobile Technologies")
    assert (row.time_segment, row.is_weekend) == ("Morning Rush", False)


@pytest.mark.parametrize("seconds,minutes", [(1, 0.02), (59, 0.98), (90, 1.5), (3601, 60.02), (-3600, -60.0), (100, 1.67)])
def test_duration_rounds_to_hundredths(spark, seconds, minutes):
    end = f"TIMESTAMP_NTZ'{START + timedelta(seconds=seconds)}'"
    assert value(spark, scalars.duration_minutes(f"TIMESTAMP_NTZ'{START}'", end)) == minutes


def test_duration_ignores_fractions_of_seconds(spark):
    times = "TIMESTAMP_NTZ'2024-01-01 00:00:00.9'", "TIMESTAMP_NTZ'2024-01-01 00:01:00.1'"
    assert value(spark, scalars.duration_minutes(*times)) == 1.0


def test_wall_clock_results_do_not_depend_on_the_session_zone(spark):
    spring = {"tpep_pickup_datetime": datetime(2024, 3, 10, 1, 30), "tpep_dropoff_datetime": datetime(2024, 3, 10, 3, 30)}
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        row = silver.to_silver(raw(spark, spring)).first()
        assert (row.trip_duration_mins, row.pickup_hour) == (120.0, 1)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


@pytest.mark.parametrize("hour,label", [
    (0, "Late Night"), (5, "Late Night"), (6, "Morning Rush"), (9, "Morning Rush"), (10, "Midday"), (15, "Midday"),
    (16, "Evening Rush"), (19, "Evening Rush"), (20, "Night"), (23, "Night"), ("NULL", "Late Night")])
def test_time_segments(spark, hour, label):
    assert value(spark, scalars.time_segment(f"CAST({hour} AS INT)")) == label


@pytest.mark.parametrize("day,weekend", [("2024-01-13", True), ("2024-01-14", True), ("2024-01-15", False)])
def test_weekend(spark, day, weekend):
    assert value(spark, scalars.is_weekend(f"DATE'{day}'")) is weekend


def test_labels_of_unlisted_and_missing_codes(spark):
    assert value(spark, scalars.decode("6", {1: "it's"})) == "Unknown"
    assert value(spark, scalars.decode("CAST(NULL AS INT)", {1: "a"})) == "Unknown"
    assert value(spark, scalars.decode("1", {1: "it's"})) == "it's"


BAD = {
    "pickup_present": {"tpep_pickup_datetime": None},
    "dropoff_present": {"tpep_dropoff_datetime": None},
    "pickup_before_dropoff": {"tpep_dropoff_datetime": START},
    "distance_not_negative": {"trip_distance": -0.1},
    "fare_not_negative": {"fare_amount": -0.1},
    "duration_below_limit": {"tpep_dropoff_datetime": START + timedelta(days=1)},
    "distance_below_limit": {"trip_distance": 500.0},
    "year_in_range": {"tpep_pickup_datetime": datetime(2002, 1, 1), "tpep_dropoff_datetime": datetime(2002, 1, 1, 1)},
}


@pytest.mark.parametrize("rule", sorted(BAD))
def test_each_rule_drops_and_counts_its_rows(spark, rule):
    df = raw(spark, BAD[rule], copies=2)
    assert silver.clean(df).count() == 2
    counts = {r.rule: r.rows for r in silver.filter_reject_counts(df).collect()}
    assert counts[rule] == 1 and counts["any_rule"] == 1


def test_missing_distance_or_fare_drops_the_trip(spark):
    assert silver.clean(raw(spark, {"trip_distance": None}, {"fare_amount": None}, {})).count() == 1


def test_borders_that_stay(spark):
    stay = [
        {"trip_distance": 0.0, "fare_amount": 0.0},
        {"trip_distance": 499.99},
        {"tpep_dropoff_datetime": START + timedelta(seconds=86399)},
        {"tpep_pickup_datetime": datetime(2023, 1, 1), "tpep_dropoff_datetime": datetime(2023, 1, 1, 1)},
        {"tpep_pickup_datetime": datetime(2025, 12, 31, 23, 59, 59), "tpep_dropoff_datetime": datetime(2026, 1, 1)},
    ]
    assert silver.clean(raw(spark, *stay)).count() == len(stay)


def test_latest_file_wins(spark):
    rows = raw(spark, {"tip_amount": 1.0}, {"tip_amount": 2.0}, {"tip_amount": 3.0}).coalesce(1)
    files = rows.withColumns({
        "_file_modified_at": F.expr("timestamp_seconds(CAST(IF(tip_amount = 2, 9, 5) AS INT))"),
        "_file_path": F.lit("f"),
    })
    kept = silver.to_silver(files).collect()
    assert [r.tip_amount for r in kept] == [2.0]
    assert not set(silver.FILE_COLUMNS) & set(kept[0].asDict())


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(1, 3), st.sampled_from([1.0, 2.0]), st.sampled_from([0.5, 1.5, 2.5])),
                min_size=1, max_size=15), st.randoms(use_true_random=False))
def test_dedup_is_idempotent_and_ignores_row_order(spark, trips, random):
    def records(items):
        return raw(spark, *[{"PULocationID": z, "fare_amount": f, "tip_amount": t} for z, f, t in items])

    shuffled = list(trips)
    random.shuffle(shuffled)
    once = silver.keep_newest(silver.typed(records(trips)))
    other = silver.keep_newest(silver.typed(records(shuffled).repartition(3)))
    assert once.exceptAll(other).count() == 0 and other.exceptAll(once).count() == 0
    twice = silver.keep_newest(once)
    assert twice.count() == once.count() == len({(z, f) for z, f, _ in trips})
    counts = silver.dedup_counts(silver.typed(records(trips)), SilverSpec().dedup_key).first()
    assert (counts.rows_in, counts.rows_out) == (len(trips), once.count())
    assert counts.duplicates == len(trips) - once.count()


def test_null_key_parts_are_one_key(spark):
    df = raw(spark, {"VendorID": None}, {"VendorID": None}, {"VendorID": 2})
    assert silver.to_silver(df).count() == 2


def test_values_that_do_not_fit_become_null(spark):
    df = raw(spark, {"passenger_count": float("nan")}, {"PULocationID": 1}).withColumn("payment_type", F.lit("cash"))
    rows = silver.to_silver(df).orderBy("pickup_location_id").collect()
    assert [r.passenger_count for r in rows] == [1, None]
    assert {r.payment_type_desc for r in rows} == {"Unknown"}


def test_sample_takes_the_same_keys_everywhere(spark):
    from layerwright.operators.silver import sampled_by_key

    keys = spark.range(4000).selectExpr("id AS a", "IF(id % 7 = 0, NULL, CAST(id % 50 AS STRING)) AS b")
    once = {tuple(r) for r in sampled_by_key(keys, ("a", "b"), 10).collect()}
    again = [tuple(r) for r in sampled_by_key(keys.unionAll(keys).repartition(5), ("a", "b"), 10).collect()]
    assert set(again) == once and len(again) == 2 * len(once) and 320 < len(once) < 480
    assert sampled_by_key(keys, ("a",), 0).count() == 0 and sampled_by_key(keys, ("a",), 100).count() == 4000
    assert {tuple(r) for r in sampled_by_key(keys, ("a", "b"), 10, seed=1).collect()} != once
