"""Bronze to silver queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import PAYMENT_LABELS, VENDOR_LABELS, SilverSpec
from ..functions import scalars
from ..operators import marts, silver
from .oracle_base import CLEAN, DERIVED, RAW, SILVER
from .trips import clean_trips, raw_trips, silver_trips

ID = ("event_id", "copy_no")
DERIVED_COLUMNS = (
    "trip_duration_mins",
    "pickup_hour",
    "pickup_day_of_week",
    "pickup_date",
    "pickup_year",
    "pickup_month",
    "payment_type_desc",
    "vendor_name",
    "time_segment",
    "is_weekend",
)
TYPED_COLUMNS = (
    "vendor_id, pickup_datetime, dropoff_datetime, passenger_count, trip_distance, rate_code_id, "
    "store_and_fwd_flag, pickup_location_id, dropoff_location_id, payment_type, fare_amount, extra, mta_tax, "
    "tip_amount, tolls_amount, improvement_surcharge, total_amount, congestion_surcharge, airport_fee, "
    "event_id, copy_no, file_month"
)


def silver_typed(spark, sf):
    return silver.typed(raw_trips(spark, sf))


def silver_rows(spark, sf):
    return silver_trips(spark, sf)


def trip_duration(spark, sf):
    minutes = scalars.duration_minutes("tpep_pickup_datetime", "tpep_dropoff_datetime")
    return raw_trips(spark, sf).selectExpr(*ID, f"{minutes} AS trip_duration_mins")


def calendar_parts(spark, sf):
    return raw_trips(spark, sf).selectExpr(*ID, *scalars.calendar_parts("tpep_pickup_datetime"))


def decode_labels(spark, sf):
    return raw_trips(spark, sf).selectExpr(
        *ID,
        f"{scalars.decode('payment_type', PAYMENT_LABELS)} AS payment_type_desc",
        f"{scalars.decode('VendorID', VENDOR_LABELS)} AS vendor_name",
    )


def time_segment(spark, sf):
    return raw_trips(spark, sf).selectExpr(*ID, f"{scalars.time_segment('hour(tpep_pickup_datetime)')} AS time_segment")


def weekend_flag(spark, sf):
    return raw_trips(spark, sf).selectExpr(*ID, f"{scalars.is_weekend('tpep_pickup_datetime')} AS is_weekend")


def quality_filter(spark, sf):
    return clean_trips(spark, sf).select(*ID, "pickup_datetime", "trip_distance", "fare_amount", "trip_duration_mins")


def filter_reject_counts(spark, sf):
    return silver.filter_reject_counts(raw_trips(spark, sf))


def year_range_filter(spark, sf):
    return silver.typed(raw_trips(spark, sf)).where(silver.year_window()).select(*ID, "pickup_datetime")


def dedup_latest(spark, sf):
    kept = silver.keep_newest(silver.typed(raw_trips(spark, sf)), newest_by=("copy_no", "event_id"))
    return kept.select(*ID, *SilverSpec().dedup_key)


def dedup_counts(spark, sf):
    return silver.dedup_counts(clean_trips(spark, sf), SilverSpec().dedup_key)


def row_counts(spark, sf):
    """Rows of raw, filtered and deduplicated trips side by side."""
    counts = silver.run_counts(raw_trips(spark, sf))
    return counts.selectExpr(
        "stack(3, 'raw', rows_in, 'clean', rows_in - rows_filtered, 'silver', rows_out) AS (stage, row_count)"
    )


def rows_by_month(spark, sf):
    return marts.rows_by(silver_trips(spark, sf), ("pickup_year", "pickup_month"))


def topn_preview(spark, sf):
    shown = silver_trips(spark, sf).select(
        "pickup_datetime", "dropoff_datetime", "trip_duration_mins", "trip_distance", "fare_amount",
        "payment_type_desc", "vendor_name", "time_segment", "is_weekend", "event_id",
    )
    return shown.orderBy("pickup_datetime", "event_id").limit(5)


def sample_rows(spark, sf):
    return raw_trips(spark, sf).sample(0.1, seed=7)


QUERIES = {
    "silver_typed": silver_typed,
    "silver_rows": silver_rows,
    "trip_duration": trip_duration,
    "calendar_parts": calendar_parts,
    "decode_labels": decode_labels,
    "time_segment": time_segment,
    "weekend_flag": weekend_flag,
    "quality_filter": quality_filter,
    "filter_reject_counts": filter_reject_counts,
    "year_range_filter": year_range_filter,
    "dedup_latest": dedup_latest,
    "dedup_counts": dedup_counts,
    "row_counts": row_counts,
    "rows_by_month": rows_by_month,
    "topn_preview": topn_preview,
    "sample_rows": sample_rows,
}


def _columns(names: str) -> str:
    return f"WITH {DERIVED} SELECT event_id, copy_no, {names} FROM derived"


_RULES = {
    "pickup_present": "pickup_datetime IS NOT NULL",
    "dropoff_present": "dropoff_datetime IS NOT NULL",
    "pickup_before_dropoff": "pickup_datetime < dropoff_datetime",
    "distance_not_negative": "trip_distance >= 0",
    "fare_not_negative": "fare_amount >= 0",
    "duration_positive": "trip_duration_mins > 0",
    "duration_below_limit": "trip_duration_mins < 1440",
    "distance_below_limit": "trip_distance < 500",
    "year_in_range": "pickup_year BETWEEN 2023 AND 2025",
}

ORACLES = {
    "silver_typed": f"WITH {DERIVED} SELECT {TYPED_COLUMNS} FROM derived",
    "silver_rows": f"WITH {SILVER} SELECT {TYPED_COLUMNS}, {', '.join(DERIVED_COLUMNS)} FROM silver",
    "trip_duration": _columns("trip_duration_mins"),
    "calendar_parts": _columns("pickup_hour, pickup_day_of_week, pickup_date, pickup_year, pickup_month"),
    "decode_labels": _columns("payment_type_desc, vendor_name"),
    "time_segment": _columns("time_segment"),
    "weekend_flag": _columns("is_weekend"),
    "quality_filter": f"""WITH {CLEAN}
      SELECT event_id, copy_no, pickup_datetime, trip_distance, fare_amount, trip_duration_mins FROM clean""",
    "filter_reject_counts": f"WITH {DERIVED} "
    + " UNION ALL ".join(
        f"SELECT '{n}' AS rule, count(*) FILTER (NOT coalesce({c}, false)) AS rows FROM derived"
        for n, c in [*_RULES.items(), ("any_rule", " AND ".join(f"({c})" for c in _RULES.values()))]
    ),
    "year_range_filter": f"""WITH {DERIVED}
      SELECT event_id, copy_no, pickup_datetime FROM derived WHERE pickup_year BETWEEN 2023 AND 2025""",
    "dedup_latest": f"""WITH {DERIVED}
      SELECT event_id, copy_no, vendor_id, pickup_datetime, pickup_location_id, fare_amount FROM (
        SELECT *, row_number() OVER (PARTITION BY vendor_id, pickup_datetime, pickup_location_id, fare_amount
          ORDER BY copy_no DESC, event_id DESC) AS rn FROM derived) WHERE rn = 1""",
    "dedup_counts": f"""WITH {CLEAN}, keys AS (
      SELECT count(*) AS copies FROM clean GROUP BY vendor_id, pickup_datetime, pickup_location_id, fare_amount)
      SELECT CAST(coalesce(sum(copies), 0) AS BIGINT) AS rows_in, count(*) AS rows_out,
             CAST(coalesce(sum(copies - 1), 0) AS BIGINT) AS duplicates FROM keys""",
    "row_counts": f"""WITH {SILVER}
      SELECT 'raw' AS stage, count(*) AS row_count FROM raw UNION ALL
      SELECT 'clean', count(*) FROM clean UNION ALL SELECT 'silver', count(*) FROM silver""",
    "rows_by_month": f"""WITH {SILVER}
      SELECT pickup_year, pickup_month, count(*) AS row_count FROM silver GROUP BY ALL""",
    "topn_preview": f"""WITH {SILVER}
      SELECT pickup_datetime, dropoff_datetime, trip_duration_mins, trip_distance, fare_amount, payment_type_desc,
             vendor_name, time_segment, is_weekend, event_id
      FROM silver ORDER BY pickup_datetime, event_id LIMIT 5""",
}
