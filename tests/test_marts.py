"""Marts: definitions, rounding, shares, tiers and hot keys."""

import math
import random
from datetime import datetime, timedelta
from decimal import ROUND_HALF_UP, Decimal

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from layerwright.config import TierSpec
from layerwright.functions import measures as m
from layerwright.functions import scalars
from layerwright.operators import marts, silver
from rows import raw

AT = datetime(2024, 1, 13, 12)


def trips(spark, *changes):
    """Silver trips without the dedup step, so that equal fixture rows all count."""
    return silver.clean(raw(spark, *changes))


def value(spark, expression):
    return spark.range(1).selectExpr(f"{expression} AS v").first().v


@pytest.mark.parametrize("num,den,result", [(5, 2, 3), (-5, 2, -3), (4, 3, 1), (-4, 3, -1), (0, 7, 0)])
def test_half_up(spark, num, den, result):
    assert value(spark, m.half_up(f"{num}L", f"{den}L")) == result


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(-10**7, 10**7), min_size=1, max_size=20))
def test_mean_and_total_are_exact(spark, cents):
    df = spark.createDataFrame([(c / 100,) for c in cents], "x double")
    row = marts.grouped(df, (), total=m.total("x"), mean=m.mean("x")).first()
    exact = Decimal(sum(cents)) / 100
    assert row.total == float(exact)
    mean = (Decimal(sum(cents)) / len(cents)).quantize(Decimal(1), ROUND_HALF_UP) / 100
    assert row.mean == float(mean)


def sum_and_mean(spark, *values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    return tuple(marts.grouped(df, (), total=m.total("x", 4), mean=m.mean("x", 5)).first())


def test_missing_values_are_skipped_and_none_give_null(spark):
    assert sum_and_mean(spark, 1.0, None, 2.0) == (3.0, 1.5)
    assert sum_and_mean(spark, None) == (None, None)


@pytest.mark.parametrize("odd", [math.nan, math.inf, -math.inf])
def test_values_without_a_decimal_show_in_the_result(spark, odd):
    for values in ((1.0, odd, 2.0), (odd,)):
        assert all(v == odd or math.isnan(v) and math.isnan(odd) for v in sum_and_mean(spark, *values))


def test_small_values_are_rounded_after_the_sum(spark):
    assert sum_and_mean(spark, 0.00004, 0.00004) == (0.0001, 0.00004)


@pytest.mark.parametrize("large", [1e15, 1e17, 1e18, 1e30])
def test_large_values_stop_nothing(spark, large):
    assert sum_and_mean(spark, large, large) == (2 * large, large)


def test_total_beyond_a_bigint_of_steps(spark):
    row = marts.grouped(spark.range(3000).selectExpr("9e17 + 0D AS x"), (), t=m.total("x"), m=m.mean("x")).first()
    assert (row.t, row.m) == (2.7e21, 9e17)


def test_one_corrupt_fare_stops_no_mart(spark):
    df = trips(spark, {"fare_amount": 1e15, "tip_amount": 0.0}, {"fare_amount": 3.0, "tip_amount": 0.0})
    assert marts.daily_vendor_revenue(df).first().total_fare_revenue == 1e15 + 3
    assert marts.pipeline_health(df).first().total_fare_volume == 1e15 + 3
    assert marts.monthly_payment_mix(df).first().total_fare == 1e15 + 3


@pytest.mark.parametrize("a,b,digits,result", [("5D", "8L", 2, 0.63), ("-5D", "8L", 2, -0.63), ("1D", "0D", 3, None),
                                               ("CAST(NULL AS DOUBLE)", "2L", 2, None), ("1e20D", "2L", 2, 5e19)])
def test_quotient(spark, a, b, digits, result):
    assert value(spark, m.quotient(a, b, digits)) == result


def test_result_does_not_depend_on_the_layout(spark):
    generator = random.Random(3)
    values = [(generator.randrange(10**6) / 100, generator.randrange(1, 10**5) / 100) for _ in range(3000)]
    df = spark.createDataFrame(values, "a double, b double")
    outputs = dict(t=m.total("a"), m=m.mean("a"), r=m.mean_ratio_pct("a", "b"))
    results = {tuple(marts.grouped(df.repartition(n), (), **outputs).first()) for n in (1, 3, 7)}
    assert len(results) == 1


def test_hourly_zone_demand(spark):
    row = marts.hourly_zone_demand(
        trips(spark, {"fare_amount": 10.0, "tip_amount": 1.0, "VendorID": 1},
              {"fare_amount": 10.01, "tip_amount": 0.0, "VendorID": 2},
              {"fare_amount": 20.0, "tip_amount": 0.0, "VendorID": 2})).first()
    assert (row.trip_count, row.vendor_count, row.total_fare_amount) == (3, 2, 40.01)
    assert (row.avg_fare_amount, row.avg_tip_amount, row.avg_trip_duration_mins) == (13.34, 0.33, 25.0)
    assert (row.pickup_year, row.pickup_month, row.pickup_hour, row.time_segment) == (2024, 1, 9, "Morning Rush")
    assert (row.is_weekend, row.demand_tier) == (False, "LOW")


@pytest.mark.parametrize("count,tier", [(0, "LOW"), (3, "LOW"), (100, "LOW"), (101, "MEDIUM"), (238, "MEDIUM"),
                                        (477, "MEDIUM"), (500, "MEDIUM"), (501, "HIGH")])
def test_default_tiers(spark, count, tier):
    assert value(spark, scalars.demand_tier(str(count))) == tier


def test_tiers_rise_with_the_count(spark):
    order = {"LOW": 0, "MEDIUM": 1, "HIGH": 2}
    rows = spark.range(0, 700).selectExpr("id", f"{scalars.demand_tier('id')} AS t").orderBy("id").collect()
    levels = [order[r.t] for r in rows]
    assert levels == sorted(levels)


def test_daily_vendor_revenue(spark):
    changes = [{"VendorID": 6, "fare_amount": 54.0 + i, "tip_amount": 0.0, "passenger_count": None} for i in range(2)]
    rows = marts.daily_vendor_revenue(trips(spark, *changes, {"VendorID": None})).collect()
    assert len(rows) == 1
    row = rows[0]
    assert (row.vendor_id, row.vendor_name, row.total_trips) == (6, "Unknown", 2)
    assert (row.total_fare_revenue, row.avg_fare_per_trip, row.tip_rate_pct, row.avg_passengers) == (109.0, 54.5, 0.0, None)


def test_tip_rate_is_the_mean_of_ratios_and_skips_zero_fares(spark):
    changes = [{"fare_amount": 10.0, "tip_amount": 1.0}, {"fare_amount": 100.0, "tip_amount": 50.0},
               {"fare_amount": 0.0, "tip_amount": 5.0}]
    assert marts.daily_vendor_revenue(trips(spark, *changes)).first().tip_rate_pct == 30.0


def test_tip_rate_of_free_trips_is_null(spark):
    assert marts.daily_vendor_revenue(trips(spark, {"fare_amount": 0.0})).first().tip_rate_pct is None


def test_payment_mix_shares_count_trips_not_groups(spark):
    changes = [{"payment_type": 1}] * 3 + [{"payment_type": 2}, {"payment_type": None}]
    rows = {r.payment_type: r for r in marts.monthly_payment_mix(trips(spark, *changes)).collect()}
    assert set(rows) == {1, 2}
    assert [rows[1].monthly_total_trips, rows[2].monthly_total_trips] == [4, 4]
    assert [rows[1].market_share_pct, rows[2].market_share_pct] == [75.0, 25.0]
    grouped = marts.rows_by(trips(spark, *changes).where("payment_type IS NOT NULL"), ("pickup_month", "payment_type"))
    assert {r.group_count for r in marts.groups_per(grouped, ("pickup_month",)).collect()} == {2}


def test_shares_of_a_month_sum_to_hundred(spark):
    changes = [{"payment_type": 1 + i % 4} for i in range(7)]
    total = sum(r.market_share_pct for r in marts.monthly_payment_mix(trips(spark, *changes)).collect())
    assert abs(total - 100) <= 0.02


def test_pipeline_health(spark):
    changes = [{"fare_amount": 0.0, "PULocationID": 1}, {"passenger_count": None, "PULocationID": 2, "VendorID": 2},
               {"PULocationID": 2, "tpep_pickup_datetime": AT, "tpep_dropoff_datetime": AT + timedelta(minutes=5)}]
    row = marts.stamped_health(trips(spark, *changes)).first()
    assert (row.total_rows, row.distinct_pickup_zones, row.distinct_vendors) == (3, 2, 2)
    assert (row.zero_fare_rows, row.null_passenger_rows, row.total_fare_volume) == (1, 1, 25.6)
    assert (row.avg_fare, row.avg_duration_mins) == (8.53, 18.33)
    assert (row.earliest_pickup, row.latest_pickup) == (AT, datetime(2024, 1, 22, 9, 4))
    assert row.health_run_at is not None


def test_both_health_plans_agree(spark):
    df = spark.range(500).selectExpr("id % 3 AS g", "id % 7 AS a", "IF(id % 5 = 0, NULL, id % 11) AS b", "id / 100D AS x")
    options = dict(by=("g",), distinct={"da": "a", "db": "b"}, sums={"s": "x"}, means={"m": "x"},
                   span=("x", "lo", "hi"), flags={"odd": "a % 2 = 1"})
    plain = marts.health_by(df, **options)
    folded = marts.health_by(df, **options, few_combinations=True)
    assert sorted(plain.collect()) == sorted(folded.select(*plain.columns).collect())


def test_distinct_counts_exact_and_approximate(spark):
    df = spark.range(200).selectExpr("id % 2 AS g", "id % 10 AS a", "IF(id < 100, NULL, id % 3) AS b")
    exact = {tuple(r) for r in marts.distinct_counts(df, ("g",), {"a": "a", "b": "b"}).collect()}
    assert exact == {(0, 5, 3), (1, 5, 3)}
    assert marts.distinct_counts(df, ("g",), {"a": "a"}, approximate=True).count() == 2


def test_null_trend_and_buckets(spark):
    df = trips(spark, {"passenger_count": None, "trip_distance": 0.99}, {"trip_distance": 1.0}, {"trip_distance": 2.5})
    row = marts.null_trend(df, ("pickup_year", "pickup_month"), "passenger_count").first()
    assert (row.total_rows, row.null_rows, row.null_pct) == (3, 1, 33.33)
    assert sorted(r.distance_from for r in marts.distance_distribution(df).collect()) == [0.0, 1.0, 2.0]
    assert sorted(r.distance_from for r in marts.distance_distribution(df, 2.0).collect()) == [0.0, 2.0]


def test_demand_by_hour_sums_the_mart(spark):
    changes = [{"PULocationID": z} for z in (1, 1, 2)]
    demand = marts.hourly_zone_demand(trips(spark, *changes), TierSpec(medium=0, high=1))
    assert {(r.pickup_hour, r.demand_tier, r.trip_count) for r in marts.demand_by_hour(demand).collect()} == {
        (9, "HIGH", 2), (9, "MEDIUM", 1)}
