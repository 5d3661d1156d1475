"""Mart queries over the silver trips."""

from __future__ import annotations

from ..config import TierSpec
from ..functions import measures, scalars
from ..operators import marts
from .oracle_base import DEMAND, RAW, SILVER, half_up, mean, tip_rate_pct, total
from .trips import raw_trips, silver_trips

# The derived table has one or two trips in a busy zone-hour, so the limits are set to match.
TIERS = TierSpec(medium=0, high=1)
MONTH = ("pickup_year", "pickup_month")


def hourly_zone_demand(spark, sf):
    return marts.hourly_zone_demand(silver_trips(spark, sf), TIERS)


def daily_vendor_revenue(spark, sf):
    return marts.daily_vendor_revenue(silver_trips(spark, sf))


def monthly_payment_mix(spark, sf):
    return marts.monthly_payment_mix(silver_trips(spark, sf))


def pipeline_health(spark, sf):
    return marts.pipeline_health(silver_trips(spark, sf))


def demand_tier(spark, sf):
    zones = marts.rows_by(silver_trips(spark, sf), ("pickup_location_id",))
    return zones.selectExpr("*", f"{scalars.demand_tier('row_count', TierSpec(medium=60, high=70))} AS demand_tier")


def conditional_counts(spark, sf):
    flags = {"zero_fare_rows": "fare_amount <= 0", "null_passenger_rows": "passenger_count IS NULL"}
    return marts.conditional_counts(silver_trips(spark, sf), MONTH, flags)


def distinct_counts(spark, sf):
    counted = {"distinct_pickup_zones": "pickup_location_id", "distinct_vendors": "vendor_id"}
    return marts.distinct_counts(silver_trips(spark, sf), MONTH, counted)


def tip_rate(spark, sf):
    rate = measures.mean_ratio_pct("tip_amount", "fare_amount")
    return marts.grouped(silver_trips(spark, sf), ("pickup_date",), tip_rate_pct=rate)


def null_trend(spark, sf):
    return marts.null_trend(silver_trips(spark, sf), MONTH, "passenger_count")


def _payment_groups(spark, sf):
    return marts.rows_by(silver_trips(spark, sf), (*MONTH, "payment_type"), "trip_count")


def month_totals(spark, sf):
    return marts.with_share(
        _payment_groups(spark, sf), MONTH, "trip_count", "monthly_total_trips", "market_share_pct"
    )


def groups_per_month(spark, sf):
    return marts.groups_per(_payment_groups(spark, sf), MONTH)


def panel_demand_by_hour(spark, sf):
    return marts.demand_by_hour(hourly_zone_demand(spark, sf))


def distance_distribution(spark, sf):
    return marts.distance_distribution(silver_trips(spark, sf))


def raw_distance_distribution(spark, sf):
    """Distance buckets of the undeduplicated deliveries, negative and implausible distances included."""
    raw = raw_trips(spark, sf).selectExpr(
        "year(tpep_pickup_datetime) AS pickup_year", "month(tpep_pickup_datetime) AS pickup_month", "trip_distance"
    )
    return marts.distance_distribution(raw, 2.5)


QUERIES = {
    "hourly_zone_demand": hourly_zone_demand,
    "daily_vendor_revenue": daily_vendor_revenue,
    "monthly_payment_mix": monthly_payment_mix,
    "pipeline_health": pipeline_health,
    "demand_tier": demand_tier,
    "conditional_counts": conditional_counts,
    "distinct_counts": distinct_counts,
    "tip_rate_pct": tip_rate,
    "null_trend": null_trend,
    "month_totals": month_totals,
    "groups_per_month": groups_per_month,
    "panel_demand_by_hour": panel_demand_by_hour,
    "distance_distribution": distance_distribution,
    "raw_distance_distribution": raw_distance_distribution,
}

_GROUPS = SILVER + """,
groups AS (
  SELECT pickup_year, pickup_month, payment_type, count(*) AS trip_count FROM silver GROUP BY ALL)"""
_MONTH_TOTAL = "CAST(sum(trip_count) OVER (PARTITION BY pickup_year, pickup_month) AS BIGINT)"


def _share(count: str, whole: str) -> str:
    return f"CAST({half_up(f'{count} * 10000', whole)} AS DOUBLE) / 100"


ORACLES = {
    "hourly_zone_demand": f"WITH {DEMAND} SELECT * FROM demand",
    "daily_vendor_revenue": f"""WITH {SILVER}
      SELECT pickup_date, pickup_year, pickup_month, vendor_id, vendor_name, count(*) AS total_trips,
        {total('fare_amount')} AS total_fare_revenue, {total('tip_amount')} AS total_tip_revenue,
        {total('total_amount')} AS gross_revenue, {mean('fare_amount')} AS avg_fare_per_trip,
        {tip_rate_pct()} AS tip_rate_pct, {mean('trip_distance')} AS avg_distance_miles,
        {mean('passenger_count')} AS avg_passengers
      FROM silver WHERE vendor_id IS NOT NULL GROUP BY ALL""",
    "monthly_payment_mix": f"""WITH {SILVER}, grouped AS (
      SELECT pickup_year, pickup_month, payment_type, payment_type_desc, count(*) AS trip_count,
        {total('fare_amount')} AS total_fare, {total('tip_amount')} AS total_tips, {mean('tip_amount')} AS avg_tip
      FROM silver WHERE payment_type IS NOT NULL GROUP BY ALL), totalled AS (
      SELECT *, {_MONTH_TOTAL} AS monthly_total_trips FROM grouped)
      SELECT *, {_share('trip_count', 'monthly_total_trips')} AS market_share_pct FROM totalled""",
    "pipeline_health": f"""WITH {SILVER}
      SELECT pickup_year, pickup_month, count(*) AS total_rows, {total('fare_amount')} AS total_fare_volume,
        {mean('trip_distance')} AS avg_trip_distance, {mean('fare_amount')} AS avg_fare,
        {mean('trip_duration_mins')} AS avg_duration_mins, min(pickup_datetime) AS earliest_pickup,
        max(pickup_datetime) AS latest_pickup, count(DISTINCT pickup_location_id) AS distinct_pickup_zones,
        count(DISTINCT vendor_id) AS distinct_vendors, count(*) FILTER (fare_amount = 0) AS zero_fare_rows,
        count(*) FILTER (passenger_count IS NULL) AS null_passenger_rows
      FROM silver GROUP BY pickup_year, pickup_month""",
    "demand_tier": f"""WITH {SILVER}
      SELECT pickup_location_id, count(*) AS row_count,
        CASE WHEN count(*) > 70 THEN 'HIGH' WHEN count(*) > 60 THEN 'MEDIUM' ELSE 'LOW' END AS demand_tier
      FROM silver GROUP BY pickup_location_id""",
    "conditional_counts": f"""WITH {SILVER}
      SELECT pickup_year, pickup_month, count(*) AS total_rows, count(*) FILTER (fare_amount <= 0) AS zero_fare_rows,
        count(*) FILTER (passenger_count IS NULL) AS null_passenger_rows
      FROM silver GROUP BY ALL""",
    "distinct_counts": f"""WITH {SILVER}
      SELECT pickup_year, pickup_month, count(DISTINCT pickup_location_id) AS distinct_pickup_zones,
        count(DISTINCT vendor_id) AS distinct_vendors
      FROM silver GROUP BY ALL""",
    "tip_rate_pct": f"WITH {SILVER} SELECT pickup_date, {tip_rate_pct()} AS tip_rate_pct FROM silver GROUP BY pickup_date",
    "null_trend": f"""WITH {SILVER}, counted AS (
      SELECT pickup_year, pickup_month, count(*) AS total_rows, count(*) FILTER (passenger_count IS NULL) AS null_rows
      FROM silver GROUP BY ALL)
      SELECT *, {_share('null_rows', 'total_rows')} AS null_pct FROM counted""",
    "month_totals": f"""WITH {_GROUPS}, totalled AS (
      SELECT *, {_MONTH_TOTAL} AS monthly_total_trips FROM groups)
      SELECT *, {_share('trip_count', 'monthly_total_trips')} AS market_share_pct FROM totalled""",
    "groups_per_month": f"""WITH {_GROUPS}
      SELECT *, count(*) OVER (PARTITION BY pickup_year, pickup_month) AS group_count FROM groups""",
    "panel_demand_by_hour": f"""WITH {DEMAND}
      SELECT pickup_hour, demand_tier, CAST(sum(trip_count) AS BIGINT) AS trip_count FROM demand GROUP BY ALL""",
    "distance_distribution": f"""WITH {SILVER}
      SELECT pickup_year, pickup_month, CAST(floor(trip_distance) AS DOUBLE) AS distance_from, count(*) AS trip_count
      FROM silver GROUP BY ALL""",
    "raw_distance_distribution": f"""WITH {RAW}
      SELECT CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year,
        CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month,
        CAST(floor(trip_distance / 2.5::DOUBLE) * 2.5::DOUBLE AS DOUBLE) AS distance_from, count(*) AS trip_count
      FROM raw GROUP BY ALL""",
}
