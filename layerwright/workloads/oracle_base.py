"""SQL restating the derived trips and silver rows for the result checks."""

RAW = """
raw_events AS (
  SELECT event_id, ts, user_id, value,
         unnest(range(1, CASE WHEN event_id % 50 = 7 THEN 3 ELSE 2 END)) AS copy_no
  FROM events),
raw_parts AS (
  SELECT *,
    ts + to_days(CAST((event_id % 3) * 30 - CASE WHEN event_id % 499 = 0 THEN 5479 ELSE 0 END AS INTEGER)) AS pu,
    CASE WHEN event_id % 103 = 0 THEN -3600 WHEN event_id % 101 = 0 THEN 0
         ELSE 60 + (event_id * 37) % 5400 END AS secs,
    CAST(floor(value * 100 + 0.5) AS BIGINT) AS cents,
    CASE WHEN event_id % 17 <> 0 THEN CAST(event_id % 5 AS INTEGER) END AS payment
  FROM raw_events),
raw_money AS (
  SELECT *,
    CASE WHEN event_id % 89 = 0 THEN 0 WHEN event_id % 97 = 0 THEN -cents ELSE cents END AS fare_c,
    CASE WHEN payment = 1 THEN cents // 5 ELSE 0 END AS tip_c
  FROM raw_parts),
raw AS (
  SELECT
    CASE WHEN event_id % 10 < 4 THEN 1 WHEN event_id % 10 < 9 THEN 2 ELSE 6 END AS VendorID,
    pu AS tpep_pickup_datetime,
    pu + to_seconds(secs) AS tpep_dropoff_datetime,
    CASE WHEN event_id % 13 <> 0 THEN CAST(event_id % 6 + 1 AS DOUBLE) END AS passenger_count,
    CASE WHEN event_id % 107 = 0 THEN CAST(-1.5 AS DOUBLE) WHEN event_id % 211 = 0 THEN CAST(600 AS DOUBLE)
         ELSE CAST((event_id * 53) % 2500 AS DOUBLE) / 100 END AS trip_distance,
    CASE WHEN event_id % 13 <> 0 THEN CAST(event_id % 6 + 1 AS INTEGER) END AS RatecodeID,
    CASE WHEN event_id % 13 <> 0 THEN CASE WHEN event_id % 40 = 0 THEN 'Y' ELSE 'N' END END AS store_and_fwd_flag,
    CAST(user_id % 265 + 1 AS INTEGER) AS PULocationID,
    CAST((event_id * 7) % 265 + 1 AS INTEGER) AS DOLocationID,
    payment AS payment_type,
    CAST(fare_c AS DOUBLE) / 100 AS fare_amount,
    CAST(event_id % 3 AS DOUBLE) / 2 AS extra,
    CAST(0.5 AS DOUBLE) AS mta_tax,
    CAST(tip_c AS DOUBLE) / 100 AS tip_amount,
    CASE WHEN event_id % 20 = 0 THEN CAST(6.94 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS tolls_amount,
    CAST(1 AS DOUBLE) AS improvement_surcharge,
    CAST(fare_c + tip_c + 250 AS DOUBLE) / 100 AS total_amount,
    CASE WHEN event_id % 13 <> 0 THEN CAST(2.5 AS DOUBLE) END AS congestion_surcharge,
    CASE WHEN event_id % 13 <> 0 THEN
      CASE WHEN event_id % 25 = 0 THEN CAST(1.75 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END END AS airport_fee,
    event_id, CAST(copy_no AS INTEGER) AS copy_no, CAST(event_id % 3 + 1 AS INTEGER) AS file_month
  FROM raw_money)"""

DERIVED = (
    RAW
    + """,
derived AS (
  SELECT VendorID AS vendor_id, tpep_pickup_datetime AS pickup_datetime,
    tpep_dropoff_datetime AS dropoff_datetime, CAST(passenger_count AS INTEGER) AS passenger_count,
    trip_distance, RatecodeID AS rate_code_id, store_and_fwd_flag, PULocationID AS pickup_location_id,
    DOLocationID AS dropoff_location_id, payment_type, fare_amount, extra, mta_tax, tip_amount, tolls_amount,
    improvement_surcharge, total_amount, congestion_surcharge, airport_fee, event_id, copy_no, file_month,
    round(date_diff('second', tpep_pickup_datetime, tpep_dropoff_datetime) / 60.0::DOUBLE, 2) AS trip_duration_mins,
    CAST(hour(tpep_pickup_datetime) AS INTEGER) AS pickup_hour,
    CAST(dayofweek(tpep_pickup_datetime) + 1 AS INTEGER) AS pickup_day_of_week,
    CAST(tpep_pickup_datetime AS DATE) AS pickup_date,
    CAST(year(tpep_pickup_datetime) AS INTEGER) AS pickup_year,
    CAST(month(tpep_pickup_datetime) AS INTEGER) AS pickup_month,
    CASE payment_type WHEN 1 THEN 'Credit card' WHEN 2 THEN 'Cash' WHEN 3 THEN 'No charge'
         WHEN 4 THEN 'Dispute' ELSE 'Unknown' END AS payment_type_desc,
    CASE VendorID WHEN 1 THEN 'Creative Mobile Technologies' WHEN 2 THEN 'VeriFone' ELSE 'Unknown' END AS vendor_name,
    CASE WHEN hour(tpep_pickup_datetime) BETWEEN 6 AND 9 THEN 'Morning Rush'
         WHEN hour(tpep_pickup_datetime) BETWEEN 10 AND 15 THEN 'Midday'
         WHEN hour(tpep_pickup_datetime) BETWEEN 16 AND 19 THEN 'Evening Rush'
         WHEN hour(tpep_pickup_datetime) BETWEEN 20 AND 23 THEN 'Night' ELSE 'Late Night' END AS time_segment,
    dayofweek(tpep_pickup_datetime) IN (0, 6) AS is_weekend
  FROM raw)"""
)

CLEAN = (
    DERIVED
    + """,
clean AS (
  SELECT * FROM derived
  WHERE pickup_datetime IS NOT NULL AND dropoff_datetime IS NOT NULL AND pickup_datetime < dropoff_datetime
    AND trip_distance >= 0 AND fare_amount >= 0 AND trip_duration_mins > 0 AND trip_duration_mins < 1440
    AND trip_distance < 500 AND pickup_year BETWEEN 2023 AND 2025)"""
)

SILVER = (
    CLEAN
    + """,
silver AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY vendor_id, pickup_datetime, pickup_location_id, fare_amount
                                 ORDER BY copy_no DESC, event_id DESC) AS rn
    FROM clean) WHERE rn = 1)"""
)


def cents(column: str) -> str:
    return f"CAST(round({column} * 100) AS BIGINT)"


def half_up(num: str, den: str) -> str:
    """Integer quotient of non-negative or negative ``num`` by positive ``den``, halves away from zero."""
    return f"(sign({num}) * ((2 * abs({num}) + ({den})) // (2 * ({den}))))"


def exact_sum(value: str) -> str:
    return f"sum(CAST({value} AS DECIMAL(28, 10)))"


def steps(value: str) -> str:
    """The decimal sum in whole steps of 10^-10."""
    return f"CAST({exact_sum(value)} * 10000000000 AS HUGEINT)"


def total(column: str) -> str:
    return f"CAST(round({exact_sum(column)}, 2) AS DOUBLE)"


def mean(column: str) -> str:
    return f"CAST({half_up(steps(column), f'nullif(count({column}), 0) * 100000000')} AS DOUBLE) / 100"


def tip_rate_pct() -> str:
    ratio = "(tip_amount / nullif(fare_amount, 0))"
    return f"CAST({half_up(steps(ratio), f'nullif(count({ratio}), 0) * 1000000')} AS DOUBLE) / 100"


DEMAND_COLUMNS = f"""pickup_date, pickup_hour, pickup_year, pickup_month, pickup_location_id, time_segment, is_weekend,
    count(*) AS trip_count, {mean('trip_distance')} AS avg_trip_distance_miles,
    {mean('trip_duration_mins')} AS avg_trip_duration_mins, {mean('fare_amount')} AS avg_fare_amount,
    {total('fare_amount')} AS total_fare_amount, {mean('tip_amount')} AS avg_tip_amount,
    count(DISTINCT vendor_id) AS vendor_count,
    CASE WHEN count(*) > 1 THEN 'HIGH' WHEN count(*) > 0 THEN 'MEDIUM' ELSE 'LOW' END AS demand_tier"""


def demand(source: str = "silver", where: str = "true") -> str:
    return f"SELECT {DEMAND_COLUMNS} FROM {source} WHERE {where} GROUP BY ALL"


DEMAND = SILVER + f",\ndemand AS ({demand()})"
LOADED = (
    DEMAND
    + """,
loaded AS (SELECT *, CAST(pickup_date AS TIMESTAMP) + to_hours(pickup_hour + 26) AS _loaded_at FROM demand)"""
)
ENRICHED_COLUMNS = f"""* EXCLUDE (_loaded_at, vendor_count), _loaded_at AS loaded_at,
    CAST({half_up(cents('total_fare_amount'), 'trip_count')} AS DOUBLE) / 100 AS revenue_per_trip,
    CAST({half_up(f"{cents('avg_tip_amount')} * 1000", f"nullif({cents('avg_fare_amount')}, 0)")} AS DOUBLE) / 1000
      AS tip_rate,
    coalesce(is_weekend, false) AS is_weekend_flag"""
