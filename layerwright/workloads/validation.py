"""Validation, quarantine and contract queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..config import IngestSpec
from ..operators import contracts, validate
from ..operators.marts import grouped, rows_by
from .incremental import loaded_demand, mart_rows, staged_demand
from .oracle_base import ENRICHED_COLUMNS, LOADED, RAW
from .trips import LINEAGE, raw_trips

SMALL = IngestSpec(min_rows=1_000)
AS_OF = "2024-04-02 10:30:00"
RAW_COLUMNS = (
    "VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, trip_distance, RatecodeID, "
    "store_and_fwd_flag, PULocationID, DOLocationID, payment_type, fare_amount, extra, mta_tax, tip_amount, "
    "tolls_amount, improvement_surcharge, total_amount, congestion_surcharge, airport_fee"
)

CHECKED = (
    RAW
    + """,
checked AS (
  SELECT *,
    tpep_pickup_datetime IS NULL AS r0, tpep_dropoff_datetime IS NULL AS r1, passenger_count IS NULL AS r2,
    trip_distance IS NULL AS r3, PULocationID IS NULL AS r4, DOLocationID IS NULL AS r5, fare_amount IS NULL AS r6,
    coalesce(trip_distance < 0, false) AS r7, coalesce(fare_amount < 0, false) AS r8,
    coalesce(tpep_pickup_datetime >= tpep_dropoff_datetime, false) AS r9
  FROM raw),
split AS (SELECT *, (r0 OR r1 OR r2 OR r3 OR r4 OR r5 OR r6 OR r7 OR r8 OR r9) AS bad FROM checked)"""
)

RULES = """
rules AS (
  SELECT unnest([
    {'position': 0, 'rule': 'Nulls in tpep_pickup_datetime', 'rows': count(*) FILTER (r0)},
    {'position': 1, 'rule': 'Nulls in tpep_dropoff_datetime', 'rows': count(*) FILTER (r1)},
    {'position': 2, 'rule': 'Nulls in passenger_count', 'rows': count(*) FILTER (r2)},
    {'position': 3, 'rule': 'Nulls in trip_distance', 'rows': count(*) FILTER (r3)},
    {'position': 4, 'rule': 'Nulls in PULocationID', 'rows': count(*) FILTER (r4)},
    {'position': 5, 'rule': 'Nulls in DOLocationID', 'rows': count(*) FILTER (r5)},
    {'position': 6, 'rule': 'Nulls in fare_amount', 'rows': count(*) FILTER (r6)},
    {'position': 7, 'rule': 'Negative trip_distance', 'rows': count(*) FILTER (r7)},
    {'position': 8, 'rule': 'Negative fare_amount', 'rows': count(*) FILTER (r8)},
    {'position': 9, 'rule': 'Pickup >= dropoff', 'rows': count(*) FILTER (r9)}], recursive := true)
  FROM split)"""


def _as_of():
    return f"TIMESTAMP_NTZ'{AS_OF}'"


def broken(rule: str):
    """Query returning the rows that break one rule."""

    def run(spark, sf):
        raw = raw_trips(spark, sf)
        return raw.where(validate.violations(raw)[rule]).select("event_id", "copy_no", *RAW_COLUMNS.split(", "))

    return run


def validate_nulls(spark, sf):
    counts = validate.rule_counts(raw_trips(spark, sf))
    return counts.where(F.col("rule").startswith("Nulls in ")).select("rule", "rows")


def validate_split(spark, sf):
    """Per delivered month: rows on either side of the split."""
    raw = raw_trips(spark, sf)
    bad = validate.any_violation(raw)
    return grouped(raw, ("file_month",), valid_rows=f"count_if(NOT {bad})", quarantine_rows=f"count_if({bad})")


def valid_rows(spark, sf):
    return validate.validate(raw_trips(spark, sf)).valid.drop("file_month")


def quarantine_rows(spark, sf):
    tagged = validate.tag(validate.validate(raw_trips(spark, sf)).quarantine)
    rules = F.array_join(validate.FAILED, "; ").alias("failed_rules")
    return tagged.select("event_id", "copy_no", *RAW_COLUMNS.split(", "), rules)


def issue_report(spark, sf):
    return validate.issue_report(raw_trips(spark, sf), IngestSpec(min_rows=100_000_000))


def rowcount_floor(spark, sf):
    counted = rows_by(raw_trips(spark, sf), ("file_month",))
    return counted.selectExpr("*", f"row_count < {IngestSpec().min_rows} AS below_floor")


def _month_counts(spark, sf):
    raw = raw_trips(spark, sf)
    rejects = f"count_if({validate.any_violation(raw)})"
    return grouped(raw, ("file_month",), total_rows="count(*)", reject_rows=rejects)


def reject_rate(spark, sf):
    return validate.reject_rate(_month_counts(spark, sf), IngestSpec(max_reject_pct=9.0))


def control_record(spark, sf):
    """Control record of each delivered month, the first one already landed."""
    landed = F.col("file_month") == 1
    issues = (F.col("reject_rows") > 0) | (F.col("total_rows") < SMALL.min_rows)
    status = validate.run_status(landed, F.lit(True), F.lit(True), issues)
    rows = F.col("total_rows") - F.col("reject_rows")
    return _month_counts(spark, sf).select(
        F.lit("yellow_trips").alias("pipeline"),
        F.lit("bronze").alias("layer"),
        F.lit(2024).alias("year"),
        F.col("file_month").alias("month"),
        status.alias("status"),
        F.when(landed, F.lit(0)).otherwise(rows).cast("bigint").alias("rows_ingested"),
        F.when(landed, F.lit(0)).otherwise(F.col("reject_rows")).cast("bigint").alias("reject_rows"),
    )


def null_profile(spark, sf):
    return validate.null_profile(raw_trips(spark, sf).drop(*LINEAGE)).orderBy(F.desc("null_pct"), "column_name")


def contract_results(spark, sf):
    """Both contracts over the mart's rows, which hold the staged columns unchanged, in one pass."""
    models = {"staging": contracts.STAGING_CONTRACT, "mart": contracts.MART_CONTRACT + contracts.MART_KEY_CONTRACT}
    return contracts.check_once(mart_rows(spark, sf), models)


def contract_not_null(spark, sf):
    columns = RAW_COLUMNS.split(", ")
    return contracts.check(raw_trips(spark, sf), [contracts.NotNull(c) for c in columns])


def contract_accepted_values(spark, sf):
    accepted = [contracts.Accepted("VendorID", (1, 2)), contracts.Accepted("payment_type", (1, 2, 3, 4))]
    return contracts.unaccepted_by_column(raw_trips(spark, sf), accepted)


def contract_unique(spark, sf):
    key = ("VendorID", "tpep_pickup_datetime", "PULocationID", "fare_amount")
    return contracts.duplicate_keys(raw_trips(spark, sf), key)


def freshness_report(spark, sf):
    return contracts.freshness(loaded_demand(spark, sf), _as_of())


def source_freshness(spark, sf):
    return contracts.source_freshness(loaded_demand(spark, sf), _as_of())


def verify_min_max(spark, sf):
    return contracts.span(loaded_demand(spark, sf), "pickup_date")


QUERIES = {
    "rowcount_floor": rowcount_floor,
    "validate_nulls": validate_nulls,
    "validate_negative_distance": broken("Negative trip_distance"),
    "validate_negative_fare": broken("Negative fare_amount"),
    "validate_time_order": broken("Pickup >= dropoff"),
    "validate_split": validate_split,
    "valid_rows": valid_rows,
    "quarantine_rows": quarantine_rows,
    "issue_report": issue_report,
    "reject_rate": reject_rate,
    "control_record": control_record,
    "null_profile": null_profile,
    "contract_results": contract_results,
    "contract_not_null": contract_not_null,
    "contract_accepted_values": contract_accepted_values,
    "contract_unique": contract_unique,
    "freshness_report": freshness_report,
    "source_freshness": source_freshness,
    "verify_min_max": verify_min_max,
}


def _broken_sql(condition: str) -> str:
    return f"WITH {RAW} SELECT event_id, copy_no, {RAW_COLUMNS} FROM raw WHERE {condition}"


def _not_null_sql(table: str, columns: list[str]) -> str:
    checks = [
        f"SELECT 'not_null' AS check_name, '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS failing_rows FROM {table}"
        for c in columns
    ]
    return " UNION ALL ".join(checks)


MONTHS = CHECKED + """,
months AS (
  SELECT file_month, count(*) AS total_rows, count(*) FILTER (bad) AS reject_rows FROM split GROUP BY file_month)"""

_STAGED = LOADED + """,
staged AS (SELECT * EXCLUDE (_loaded_at), _loaded_at AS loaded_at FROM loaded
  WHERE pickup_date IS NOT NULL AND trip_count > 0),
mart AS (SELECT """ + ENRICHED_COLUMNS + """ FROM loaded)"""

ORACLES = {
    "rowcount_floor": f"""WITH {RAW}
      SELECT file_month, count(*) AS row_count, count(*) < 100000 AS below_floor FROM raw GROUP BY file_month""",
    "validate_nulls": f"WITH {CHECKED}, {RULES} SELECT rule, rows FROM rules WHERE position < 7",
    "validate_negative_distance": _broken_sql("trip_distance < 0"),
    "validate_negative_fare": _broken_sql("fare_amount < 0"),
    "validate_time_order": _broken_sql("tpep_pickup_datetime >= tpep_dropoff_datetime"),
    "validate_split": f"""WITH {CHECKED}
      SELECT file_month, count(*) FILTER (NOT bad) AS valid_rows, count(*) FILTER (bad) AS quarantine_rows
      FROM split GROUP BY file_month""",
    "valid_rows": f"WITH {CHECKED} SELECT event_id, copy_no, {RAW_COLUMNS} FROM split WHERE NOT bad",
    "quarantine_rows": f"""WITH {CHECKED}
      SELECT event_id, copy_no, {RAW_COLUMNS}, array_to_string(list_filter([
        CASE WHEN r0 THEN 'Nulls in tpep_pickup_datetime' END, CASE WHEN r1 THEN 'Nulls in tpep_dropoff_datetime' END,
        CASE WHEN r2 THEN 'Nulls in passenger_count' END, CASE WHEN r3 THEN 'Nulls in trip_distance' END,
        CASE WHEN r4 THEN 'Nulls in PULocationID' END, CASE WHEN r5 THEN 'Nulls in DOLocationID' END,
        CASE WHEN r6 THEN 'Nulls in fare_amount' END, CASE WHEN r7 THEN 'Negative trip_distance' END,
        CASE WHEN r8 THEN 'Negative fare_amount' END, CASE WHEN r9 THEN 'Pickup >= dropoff' END],
        lambda x: x IS NOT NULL), '; ') AS failed_rules
      FROM split WHERE bad""",
    "issue_report": f"""WITH {CHECKED}, {RULES}
      SELECT CAST(position AS INTEGER) AS position, rule, rows, rule || ': ' || format('{{:,}}', rows) || ' rows' AS issue
      FROM rules WHERE rows > 0
      UNION ALL
      SELECT -1, 'Row count', count(*), 'Row count ' || format('{{:,}}', count(*)) || ' below minimum 100,000,000'
      FROM raw HAVING count(*) < 100000000""",
    "reject_rate": f"""WITH {MONTHS}
      SELECT *, coalesce(reject_rows * 100.0::DOUBLE / nullif(total_rows, 0), 0) AS reject_pct,
             coalesce(reject_rows * 100.0::DOUBLE / nullif(total_rows, 0), 0) > 9 AS alert FROM months""",
    "control_record": f"""WITH {MONTHS}
      SELECT 'yellow_trips' AS pipeline, 'bronze' AS layer, CAST(2024 AS INTEGER) AS year, file_month AS month,
        CASE WHEN file_month = 1 THEN 'skipped' WHEN reject_rows > 0 OR total_rows < 1000 THEN 'success_with_warnings'
             ELSE 'success' END AS status,
        CASE WHEN file_month = 1 THEN 0 ELSE total_rows - reject_rows END AS rows_ingested,
        CASE WHEN file_month = 1 THEN 0 ELSE reject_rows END AS reject_rows
      FROM months""",
    "null_profile": f"WITH {RAW} SELECT * FROM ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) * 100.0::DOUBLE / count(*) AS null_pct FROM raw"
        for c in RAW_COLUMNS.split(", ")
    )
    + ") WHERE null_pct > 0",
    "contract_results": f"WITH {_STAGED}, checks AS ("
    + " UNION ALL ".join(
        [
            "SELECT 'staging' AS model, * FROM ("
            + _not_null_sql(
                "staged", ["pickup_date", "pickup_hour", "pickup_location_id", "trip_count", "avg_fare_amount"]
            )
            + ")",
            """SELECT 'staging', 'accepted_values', 'pickup_hour',
                 count(*) FILTER (pickup_hour NOT BETWEEN 0 AND 23) FROM staged""",
            "SELECT 'mart', * FROM ("
            + _not_null_sql(
                "mart",
                ["pickup_date", "pickup_hour", "pickup_location_id", "demand_tier", "time_segment", "revenue_per_trip"],
            )
            + ")",
            """SELECT 'mart', 'accepted_values', 'demand_tier',
                 count(*) FILTER (demand_tier NOT IN ('HIGH', 'MEDIUM', 'LOW')) FROM mart""",
            """SELECT 'mart', 'accepted_values', 'time_segment', count(*) FILTER (time_segment NOT IN
                 ('Morning Rush', 'Midday', 'Evening Rush', 'Night', 'Late Night')) FROM mart""",
            """SELECT 'mart', 'unique', 'pickup_date, pickup_hour, pickup_location_id', count(*) FROM (
                 SELECT 1 FROM mart GROUP BY pickup_date, pickup_hour, pickup_location_id HAVING count(*) > 1)""",
        ]
    )
    + ") SELECT *, failing_rows = 0 AS passed FROM checks",
    "contract_not_null": f"WITH {RAW}, checks AS ({_not_null_sql('raw', RAW_COLUMNS.split(', '))}) "
    "SELECT *, failing_rows = 0 AS passed FROM checks",
    "contract_accepted_values": f"""WITH {RAW}
      SELECT 'VendorID' AS column_name, VendorID AS value, count(*) AS rows FROM raw
      WHERE VendorID NOT IN (1, 2) GROUP BY VendorID
      UNION ALL
      SELECT 'payment_type', payment_type, count(*) FROM raw
      WHERE payment_type NOT IN (1, 2, 3, 4) GROUP BY payment_type""",
    "contract_unique": f"""WITH {RAW}
      SELECT VendorID, tpep_pickup_datetime, PULocationID, fare_amount, count(*) AS copies FROM raw
      GROUP BY ALL HAVING count(*) > 1""",
    "freshness_report": f"""WITH {LOADED}
      SELECT max(pickup_date) AS last_data_date,
        CAST(date_diff('day', max(pickup_date), DATE '{AS_OF[:10]}') AS INTEGER) AS days_since_last_data,
        max(_loaded_at) AS last_load_time,
        date_diff('hour', max(_loaded_at), TIMESTAMP '{AS_OF}') AS hours_since_load,
        CASE WHEN max(_loaded_at) IS NULL THEN 'NO_DATA'
             WHEN date_diff('hour', max(_loaded_at), TIMESTAMP '{AS_OF}') > 48 THEN 'STALE' ELSE 'FRESH' END
          AS freshness_status
      FROM loaded""",
    "source_freshness": f"""WITH {LOADED}, newest AS (
      SELECT max(_loaded_at) AS last_load_time, date_diff('second', max(_loaded_at), TIMESTAMP '{AS_OF}') AS age_seconds
      FROM loaded)
      SELECT *, CASE WHEN age_seconds > 172800 THEN 'error' WHEN age_seconds > 86400 THEN 'warn' ELSE 'pass' END AS status
      FROM newest""",
    "verify_min_max": f"""WITH {LOADED}
      SELECT count(*) AS row_count, min(pickup_date) AS min_value, max(pickup_date) AS max_value FROM loaded""",
}
