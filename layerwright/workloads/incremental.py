"""Load, staging, incremental mart and join queries."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import functions as F

from ..config import DEMAND_KEY, PARTITIONS
from ..operators import incremental, joins, marts, typed
from ..plans.landing import month_spine as spine
from .aggregates import TIERS, hourly_zone_demand
from .oracle_base import DEMAND, ENRICHED_COLUMNS, LOADED, RAW, SILVER, demand
from .trips import ID_COLUMNS, raw_trips, silver_trips

AS_OF = datetime(2024, 3, 2, 12, 0, 0)
NOW = f"TIMESTAMP_NTZ'{AS_OF}'"


def loaded_demand(spark, sf):
    """Hourly demand as if loaded two hours after the end of each trip day."""
    rows = hourly_zone_demand(spark, sf)
    return rows.selectExpr(
        "*", "CAST(pickup_date AS TIMESTAMP_NTZ) + make_dt_interval(0, pickup_hour + 26) AS _loaded_at"
    )


def staged_demand(spark, sf):
    return incremental.staging_demand(loaded_demand(spark, sf))


def mart_rows(spark, sf):
    return incremental.enriched_demand(staged_demand(spark, sf))


def pending_rows(spark, sf):
    """Staged rows of the months without a row loaded in the two days before the refresh."""
    staged = staged_demand(spark, sf)
    return incremental.pending_months(staged, staged.where(f"loaded_at < {NOW}"), NOW)


def incremental_refresh(spark, sf):
    """The mart after a refresh: it held the rows loaded so far, pending months are merged over them."""
    staged = staged_demand(spark, sf)
    target = incremental.enriched_demand(staged.where(f"loaded_at < {NOW}")).withColumn("refreshed", F.lit(False))
    pending = incremental.pending_months(staged, target, NOW)
    return joins.upsert(
        target, incremental.enriched_demand(pending).withColumn("refreshed", F.lit(True)), DEMAND_KEY
    )


def _implausible(spark, sf):
    return raw_trips(spark, sf).where("trip_distance >= 500")


def not_in_nullaware(spark, sf):
    """Trips whose zone and payment pair is not among those of implausibly long trips, under SQL's null rules."""
    key = ("PULocationID", "payment_type")
    kept = joins.not_in(raw_trips(spark, sf), _implausible(spark, sf), key)
    return kept.select(*ID_COLUMNS, *key)


def anti_join_nullsafe(spark, sf):
    key = ("PULocationID", "payment_type")
    kept = joins.anti_join_nullsafe(raw_trips(spark, sf), _implausible(spark, sf), key)
    return kept.select(*ID_COLUMNS, *key)


def merge_upsert(spark, sf):
    """Hourly demand with the zone-hours paid by card replaced by their card trips alone."""
    trips = silver_trips(spark, sf)
    card = marts.hourly_zone_demand(trips.where("payment_type = 1"), TIERS)
    # Grouping makes the keys unique, so the keys-only check is not needed.
    return joins.upsert(hourly_zone_demand(spark, sf), card, DEMAND_KEY, check=False)


def _as_delivered(spark, sf):
    """Raw trips as untyped text, some distances in a notation no number has."""
    return raw_trips(spark, sf).selectExpr(
        *ID_COLUMNS,
        "CAST(VendorID AS STRING) AS vendor_id",
        "date_format(tpep_pickup_datetime, 'yyyy-MM-dd') AS pickup_date",
        "IF(trip_distance < 0, 'n/a', CAST(trip_distance AS STRING)) AS trip_distance",
        "IF(fare_amount < 0, 'refund', CAST(payment_type AS STRING)) AS payment_type",
    )


DELIVERED = {
    "event_id": "bigint",
    "copy_no": "int",
    "vendor_id": "int",
    "pickup_date": "date",
    "trip_distance": "double",
    "payment_type": "int",
    "rate_code_id": "int",
}


def typed_load(spark, sf):
    return typed.typed_load(_as_delivered(spark, sf), DELIVERED)


def typed_load_rejects(spark, sf):
    rejects = typed.typed_load_rejects(_as_delivered(spark, sf), DELIVERED)
    return rejects.withColumn("_unreadable", F.array_join("_unreadable", ","))


def json_load(spark, sf):
    """Values taken out of the JSON rows of ``events`` by path and cast."""
    rows = spark.read.parquet(f"{sf}/events.parquet")
    opened = rows.select("event_id", F.get_json_object("props", "$.k").alias("k"))
    return typed.typed_load(opened, {"event_id": "bigint", "k": "int"})


def schema_evolve(spark, sf):
    """Trips of the first file month lack the airport fee; later months bring the column."""
    raw = raw_trips(spark, sf).select(*ID_COLUMNS, "file_month", "VendorID", "airport_fee")
    early = raw.where(F.col("file_month") == 1).drop("airport_fee")
    return typed.evolve(early, raw.where(F.col("file_month") > 1))


def _data_end(spark, sf):
    return raw_trips(spark, sf).agg(F.max("tpep_pickup_datetime").cast("date").alias("as_of"))


def month_spine(spark, sf):
    """The three months before the newest pickup's month, with the trips each one has."""
    months = spine(_data_end(spark, sf), "as_of", 3)
    counted = raw_trips(spark, sf).groupBy(
        F.year("tpep_pickup_datetime").alias("year"), F.month("tpep_pickup_datetime").alias("month")
    ).agg(F.count(F.lit(1)).alias("trips"))
    return months.join(counted, ["year", "month"], "left").withColumn("trips", F.coalesce("trips", F.lit(0)))


def skip_landed(spark, sf):
    """Target months that no trip file of the table was landed for."""
    landed = raw_trips(spark, sf).select(
        F.year("tpep_pickup_datetime").alias("year"), F.month("tpep_pickup_datetime").alias("month")
    )
    return joins.not_yet_landed(spine(_data_end(spark, sf), "as_of", 6), landed, ("year", "month"))


QUERIES = {
    "staging_demand": staged_demand,
    "mart_enriched": mart_rows,
    "pending_rows": pending_rows,
    "incremental_refresh": incremental_refresh,
    "not_in_nullaware": not_in_nullaware,
    "anti_join_nullsafe": anti_join_nullsafe,
    "merge_upsert": merge_upsert,
    "typed_load": typed_load,
    "typed_load_rejects": typed_load_rejects,
    "json_load": json_load,
    "schema_evolve": schema_evolve,
    "month_spine": month_spine,
    "skip_landed": skip_landed,
}

_AS_OF = f"TIMESTAMP '{AS_OF}'"
_KEY = ", ".join(DEMAND_KEY)
_STAGED = LOADED + """,
staged AS (SELECT * EXCLUDE (_loaded_at, vendor_count), _loaded_at AS loaded_at FROM loaded)"""
_PENDING = _STAGED + f""",
pending AS (
  SELECT * FROM staged s WHERE NOT EXISTS (
    SELECT 1 FROM staged t WHERE t.loaded_at < {_AS_OF} AND t.loaded_at >= {_AS_OF} - INTERVAL 2 DAYS
      AND t.pickup_year = s.pickup_year AND t.pickup_month = s.pickup_month))"""
_ENRICHED = ENRICHED_COLUMNS.replace("* EXCLUDE (_loaded_at, vendor_count), _loaded_at AS loaded_at", "*")
_DELIVERED = RAW + """,
delivered AS (
  SELECT event_id, copy_no, CAST(VendorID AS VARCHAR) AS vendor_id,
    strftime(tpep_pickup_datetime, '%Y-%m-%d') AS pickup_date,
    CASE WHEN trip_distance < 0 THEN 'n/a' ELSE CAST(trip_distance AS VARCHAR) END AS trip_distance,
    CASE WHEN fare_amount < 0 THEN 'refund' ELSE CAST(payment_type AS VARCHAR) END AS payment_type
  FROM raw),
marked AS (
  SELECT *, trip_distance = 'n/a' AS bad_distance, coalesce(payment_type = 'refund', false) AS bad_payment
  FROM delivered)"""
_SPINE = RAW + """,
data_end AS (SELECT date_trunc('month', max(tpep_pickup_datetime)) AS last_month FROM raw),
landed AS (
  SELECT CAST(year(tpep_pickup_datetime) AS INTEGER) AS year, CAST(month(tpep_pickup_datetime) AS INTEGER) AS month,
         count(*) AS trips FROM raw GROUP BY ALL)"""


def _spine(months: int) -> str:
    return f"""{_SPINE},
      days AS (SELECT unnest(generate_series(last_month - INTERVAL {months} MONTHS, last_month - INTERVAL 1 MONTH,
                                             INTERVAL 1 MONTH)) AS day FROM data_end),
      spine AS (SELECT CAST(year(day) AS INTEGER) AS year, CAST(month(day) AS INTEGER) AS month FROM days)"""


ORACLES = {
    "staging_demand": f"WITH {_STAGED} SELECT * FROM staged WHERE pickup_date IS NOT NULL AND trip_count > 0",
    "mart_enriched": f"WITH {LOADED} SELECT {ENRICHED_COLUMNS} FROM loaded",
    "pending_rows": f"WITH {_PENDING} SELECT * FROM pending",
    "incremental_refresh": f"""WITH {_PENDING}
      SELECT {_ENRICHED}, false AS refreshed FROM staged s WHERE loaded_at < {_AS_OF}
        AND NOT EXISTS (SELECT 1 FROM pending p WHERE p.pickup_date = s.pickup_date
          AND p.pickup_hour = s.pickup_hour AND p.pickup_location_id = s.pickup_location_id)
      UNION ALL SELECT {_ENRICHED}, true FROM pending""",
    "not_in_nullaware": f"""WITH {RAW}, seen AS (
      SELECT DISTINCT PULocationID AS zone, payment_type AS pay FROM raw WHERE trip_distance >= 500)
      SELECT event_id, copy_no, PULocationID, payment_type FROM raw r WHERE NOT EXISTS (
        SELECT 1 FROM seen WHERE (r.PULocationID = zone OR r.PULocationID IS NULL OR zone IS NULL)
          AND (r.payment_type = pay OR r.payment_type IS NULL OR pay IS NULL))""",
    "anti_join_nullsafe": f"""WITH {RAW}, seen AS (
      SELECT DISTINCT PULocationID AS zone, payment_type AS pay FROM raw WHERE trip_distance >= 500)
      SELECT event_id, copy_no, PULocationID, payment_type FROM raw r WHERE NOT EXISTS (
        SELECT 1 FROM seen WHERE r.PULocationID IS NOT DISTINCT FROM zone
          AND r.payment_type IS NOT DISTINCT FROM pay)""",
    "merge_upsert": f"""WITH {DEMAND}, card AS ({demand(where='payment_type = 1')})
      SELECT * FROM demand WHERE ({_KEY}) NOT IN (SELECT ({_KEY}) FROM card)
      UNION ALL SELECT * FROM card""",
    "typed_load": f"""WITH {_DELIVERED}
      SELECT event_id, copy_no, CAST(vendor_id AS INTEGER) AS vendor_id, CAST(pickup_date AS DATE) AS pickup_date,
        CAST(trip_distance AS DOUBLE) AS trip_distance, CAST(payment_type AS INTEGER) AS payment_type,
        CAST(NULL AS INTEGER) AS rate_code_id
      FROM marked WHERE NOT bad_distance AND NOT bad_payment""",
    "typed_load_rejects": f"""WITH {_DELIVERED}
      SELECT * EXCLUDE (bad_distance, bad_payment),
        CASE WHEN bad_distance AND bad_payment THEN 'trip_distance,payment_type'
             WHEN bad_distance THEN 'trip_distance' ELSE 'payment_type' END AS _unreadable
      FROM marked WHERE bad_distance OR bad_payment""",
    "json_load": "SELECT event_id, CAST(props ->> '$.k' AS INTEGER) AS k FROM events",
    "schema_evolve": f"""WITH {RAW}
      SELECT event_id, copy_no, file_month, VendorID, CASE WHEN file_month > 1 THEN airport_fee END AS airport_fee
      FROM raw""",
    "month_spine": f"""WITH {_spine(3)}
      SELECT year, month, coalesce(trips, 0) AS trips FROM spine LEFT JOIN landed USING (year, month)""",
    "skip_landed": f"""WITH {_spine(6)}
      SELECT year, month FROM spine ANTI JOIN landed USING (year, month)""",
}
