"""The layers run over deliveries, their tables read back: landing, quarantine, silver, load tables, mart, export.

The deliveries are the raw trips written as monthly files.  Each query lands, loads or refreshes in folders of its own and
returns what the tables then hold.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import functions as F

from ..config import PARTITIONS, FreshnessSpec, IngestSpec
from ..operators import contracts, marts, silver, validate
from ..plans import landing, medallion
from ..plans.landing import Layout, month_folders
from ..session import scratch_path
from ..sources import files, tables
from ..streaming.file_load import load_new_files, rejected
from .aggregates import ORACLES as MARTS_SQL
from .aggregates import hourly_zone_demand
from .incremental import loaded_demand
from .oracle_base import DEMAND, ENRICHED_COLUMNS, LOADED, RAW, SILVER
from .trips import raw_trips
from .validation import CHECKED, RAW_COLUMNS

SPEC = IngestSpec(min_rows=10)
GATE_TIME, GATE_LIMITS = "2024-03-31 23:30:00", (2, 10_000)
FIRST_RUN, SECOND_RUN = datetime(2024, 4, 1, 6, tzinfo=timezone.utc), datetime(2024, 5, 1, 6, tzinfo=timezone.utc)


def deliver(rows, root):
    """Write raw trips as monthly files below ``root``, replacing the months delivered there before."""
    dated = rows.withColumns({"year": F.lit(2024), "month": F.col("file_month")}).drop("copy_no", "file_month")
    tables.overwrite_partitions(month_folders(dated), root, ("year", "month"))


_logged: dict[tuple[str, str], Layout] = {}


def landed_twice(spark, sf):
    """A lake after two landing runs, once per session and input.

    Months 1 to 3 are delivered as they come, month 4 has only valid rows, month 5 holds a file that is no Parquet
    and month 6 is not there.  The first run lands month 1, the second is asked for all six.
    """
    key = (spark.sparkContext.applicationId, sf)
    if key not in _logged:
        root, layout = scratch_path(spark, "deliveries"), Layout(scratch_path(spark, "lake"))
        rows = raw_trips(spark, sf)
        clean = validate.validate(rows.where("file_month = 3"), SPEC).valid
        deliver(rows.unionByName(clean.withColumn("file_month", F.lit(4))), root)
        # A checksum file beside the files of month 1, which is none of them.
        for name in ("month=05/trips.parquet", "month=01/trips.md5"):
            text = scratch_path(spark, "text")
            rows.limit(1).selectExpr("to_json(struct(*)) AS value").coalesce(1).write.text(text)
            (file,) = spark.read.text(text).select("_metadata.file_path").distinct().collect()
            tables.move_file(spark, file.file_path, f"{root}/year=2024/{name}")
        landing.land(spark, root, layout, [(2024, 1)], spec=SPEC, run_time=FIRST_RUN)
        landing.land(spark, root, layout, [(2024, m) for m in range(1, 7)], spec=SPEC, run_time=SECOND_RUN)
        _logged[key] = layout
    return _logged[key]


def control_log(spark, sf):
    """Every record the two runs wrote, read with the declared schema; of an unreadable file, only that it has a reason."""
    log = tables.read_control(spark, landed_twice(spark, sf).path("control", "bronze_runs"))
    reason = F.when(F.col("status") == "failed", F.when(F.col("error_message") != "", "unreadable")).otherwise(F.col("error_message"))
    return log.withColumns({"error_message": reason, "has_bytes": F.col("file_size_bytes") > 0}).drop("file_size_bytes")


def run_history(spark, sf):
    """The newest five records of that log."""
    log = tables.read_control(spark, landed_twice(spark, sf).path("control", "bronze_runs"))
    newest = tables.run_history(log, order=("run_timestamp", "month"), limit=5)
    return newest.select("pipeline", "year", "month", "status", "rows_ingested", "reject_rows", "run_timestamp")


def landed_files(spark, sf):
    """The manifest of landed files per month: rows, rejects, and whether sizes and md5 are those of the files there."""
    layout = landed_twice(spark, sf)
    manifest = tables.read_table(spark, layout.path("control", "bronze_files"))
    there = files.checksum_manifest(spark, layout.path("bronze"))
    there = there.select("md5", F.col("size").alias("there"), F.element_at(F.split("path", "/"), -1).alias("name"))
    named = manifest.withColumn("name", F.element_at(F.split("path", "/"), -1))
    same = named.join(there.distinct(), ["name", "md5"], "left").groupBy("year", "month")
    return same.agg(
        F.max("row_count").alias("row_count"),
        F.max("reject_rows").alias("reject_rows"),
        F.max("valid_rows").alias("valid_rows"),
        F.bool_and(F.coalesce(F.col("there") == F.col("size"), F.lit(False))).alias("unchanged"),
    )


def quarantine_table(spark, sf):
    """Rejected rows after a correction: month 1 comes again without any, month 2 without negative fares."""
    root, layout = scratch_path(spark, "deliveries"), Layout(scratch_path(spark, "lake"))
    rows, months = raw_trips(spark, sf), [(2024, m) for m in (1, 2, 3)]
    deliver(rows, root)
    landing.land(spark, root, layout, months, spec=SPEC, run_time=FIRST_RUN)
    corrected = validate.validate(rows.where("file_month = 1"), SPEC).valid
    deliver(corrected.unionByName(rows.where("file_month = 2 AND NOT fare_amount < 0")), root)
    landing.land(spark, root, layout, months[:2], force=True, spec=SPEC, run_time=SECOND_RUN)
    return landing.read_quarantine(spark, layout).select("event_id", *RAW_COLUMNS.split(", "), "year", "month")


def _corrected_silver(spark, sf):
    """Silver built from bronze, then February written again with its card trips only; returns the layout."""
    root, layout = scratch_path(spark, "deliveries"), Layout(scratch_path(spark, "lake"))
    deliver(raw_trips(spark, sf), root)
    landing.land(spark, root, layout, [(2024, m) for m in (1, 2, 3)], spec=SPEC, run_time=FIRST_RUN)
    medallion.build_silver(spark, layout)
    path = layout.path("silver")
    february = tables.read_table(spark, path).where("pickup_year = 2024 AND pickup_month = 2 AND payment_type = 1")
    tables.replace_read_partitions(february, path, PARTITIONS)
    return layout


SILVER_COLUMNS = (
    "vendor_id", "pickup_datetime", "dropoff_datetime", "pickup_location_id", "payment_type", "fare_amount",
    "trip_distance", "trip_duration_mins", "time_segment", "pickup_year", "pickup_month",
)


def silver_table(spark, sf):
    """The silver table's snapshot after the second run over one month."""
    return tables.read_table(spark, _corrected_silver(spark, sf).path("silver")).select(*SILVER_COLUMNS)


def health_table(spark, sf):
    """The unpartitioned health mart, replaced whole by a second run over a view of the corrected silver table."""
    layout = _corrected_silver(spark, sf)
    path = layout.path("gold", "pipeline_health")
    tables.read_table(spark, layout.path("silver"), view="silver_trips")
    trips = spark.table("silver_trips")
    for rows in (trips.where("pickup_month = 1"), trips):
        tables.overwrite_all(marts.pipeline_health(rows), path)
    return tables.read_table(spark, path)


FIRST_REFRESH, SECOND_REFRESH = datetime(2024, 3, 1, 12, tzinfo=timezone.utc), datetime(2024, 3, 2, 12, tzinfo=timezone.utc)


def mart_after_refresh(spark, sf):
    """The stored mart after January's hours before 20 o'clock came again, each a trip more and with a new column."""
    layout = Layout(scratch_path(spark, "lake"))
    loads, path = loaded_demand(spark, sf), layout.path("raw", "hourly_zone_demand")
    tables.overwrite_partitions(loads, path, PARTITIONS)
    medallion.refresh_mart(spark, layout, FIRST_REFRESH)
    january = loads.where("pickup_year = 2024 AND pickup_month = 1 AND pickup_hour < 20")
    again = january.withColumns({"trip_count": F.col("trip_count") + 1, "surge": F.col("pickup_hour") / 4})
    tables.overwrite_partitions(again, path, PARTITIONS)
    mart = medallion.refresh_mart(spark, layout, SECOND_REFRESH)
    refreshed = F.col("updated_at") == F.lit(SECOND_REFRESH)
    return mart.withColumn("refreshed", refreshed).drop("updated_at")


def _loaded_lake(spark, sf):
    """A load table after a mart with unreadable values was loaded, and loaded again when the load log was lost."""
    layout, table = Layout(scratch_path(spark, "lake")), "hourly_zone_demand"
    count = F.expr("IF(pickup_hour = 13, 'n/a', CAST(trip_count AS STRING))")
    zone = F.expr("IF(pickup_hour IN (13, 14), 'zone ' || pickup_location_id, CAST(pickup_location_id AS STRING))")
    mart = hourly_zone_demand(spark, sf).withColumns({"trip_count": count, "pickup_location_id": zone})
    tables.overwrite_partitions(mart, layout.path("gold", table), PARTITIONS)
    medallion.load_table(spark, layout, table)
    tables.delete_path(spark, layout.path("control", f"loaded_{table}"))
    medallion.load_table(spark, layout, table)
    return layout


def load_table_rows(spark, sf):
    """The declared load table: rows whose every value fits."""
    return tables.read_table(spark, _loaded_lake(spark, sf).path("raw", "hourly_zone_demand")).drop("_loaded_at")


def load_table_rejects(spark, sf):
    """The load's rejects, each once, with the columns that could not be read."""
    rows = tables.read_table(spark, medallion.rejects_path(_loaded_lake(spark, sf), "hourly_zone_demand"))
    return rows.select(
        *PARTITIONS,
        F.get_json_object("row", "$.pickup_date").alias("pickup_date"),
        F.get_json_object("row", "$.pickup_hour").cast("int").alias("pickup_hour"),
        F.get_json_object("row", "$.pickup_location_id").alias("pickup_location_id"),
        F.array_join("_unreadable", ",").alias("unreadable"),
    )


def stream_rejects(spark, sf):
    """Delivered files taken by the file stream as text; the rows that did not fit, with their values."""
    root, target, checkpoint = (scratch_path(spark, n) for n in ("deliveries", "loaded", "stream"))
    rows = raw_trips(spark, sf).selectExpr("event_id", "file_month", "IF(fare_amount < 0, 'refund', CAST(fare_amount AS STRING)) AS fare")
    tables.overwrite_partitions(rows, root, ("file_month",))
    declared = {"event_id": "bigint", "fare": "double", "file_month": "int"}
    load_new_files(spark, root, rows.schema, declared, target, checkpoint)
    bad = rejected(spark, target)
    return bad.select(
        F.get_json_object("row", "$.event_id").cast("bigint").alias("event_id"),
        F.get_json_object("row", "$.fare").alias("fare"),
        F.array_join("_unreadable", ",").alias("unreadable"),
    )


def sample_by_hash(spark, sf):
    """A tenth of the trips' events, with all copies of each."""
    chosen = silver.sampled_by_key(raw_trips(spark, sf), ("event_id",), 10, seed=7)
    return chosen.select("event_id", "copy_no", "fare_amount")


def gate_result(spark, sf):
    """The load gate at the end of March, with a limit the newest load keeps and one it misses."""
    gates = [
        contracts.gate_result(loaded_demand(spark, sf), f"TIMESTAMP_NTZ'{GATE_TIME}'", limits=FreshnessSpec(gate=limit))
        for limit in GATE_LIMITS
    ]
    return gates[0].unionByName(gates[1])


def csv_export(spark, sf):
    """Trips with awkward texts, exported as CSV and read back."""
    rows = raw_trips(spark, sf).selectExpr(
        "event_id",
        "copy_no",
        "tpep_pickup_datetime",
        "trip_distance",
        "CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' \"' || store_and_fwd_flag || '\", '"
        " WHEN 3 THEN 'line ' || event_id || chr(10) || chr(92) || 'n' ELSE store_and_fwd_flag END AS remark",
    )
    path = scratch_path(spark, "csv")
    tables.export_csv(rows, path)
    return tables.read_csv(spark, path, rows.schema)


QUERIES = {
    f.__name__: f
    for f in (
        control_log,
        run_history,
        landed_files,
        quarantine_table,
        silver_table,
        health_table,
        mart_after_refresh,
        load_table_rows,
        load_table_rejects,
        stream_rejects,
        sample_by_hash,
        gate_result,
        csv_export,
    )
}

_DELIVERED = CHECKED + """,
delivered AS (
  SELECT *, file_month AS month FROM split
  UNION ALL SELECT *, 4 FROM split WHERE file_month = 3 AND NOT bad),
months AS (SELECT month, count(*) AS total_rows, count(*) FILTER (bad) AS rejects FROM delivered GROUP BY month),
broken AS (
  SELECT month, rule.position AS position, rule.name AS name, count(*) AS rows FROM (
    SELECT month, unnest([
      {'position': 0, 'name': 'Nulls in tpep_pickup_datetime', 'hit': r0},
      {'position': 1, 'name': 'Nulls in tpep_dropoff_datetime', 'hit': r1},
      {'position': 2, 'name': 'Nulls in passenger_count', 'hit': r2},
      {'position': 3, 'name': 'Nulls in trip_distance', 'hit': r3},
      {'position': 4, 'name': 'Nulls in PULocationID', 'hit': r4},
      {'position': 5, 'name': 'Nulls in DOLocationID', 'hit': r5},
      {'position': 6, 'name': 'Nulls in fare_amount', 'hit': r6},
      {'position': 7, 'name': 'Negative trip_distance', 'hit': r7},
      {'position': 8, 'name': 'Negative fare_amount', 'hit': r8},
      {'position': 9, 'name': 'Pickup >= dropoff', 'hit': r9}]) AS rule FROM delivered)
  WHERE rule.hit GROUP BY ALL),
issues AS (
  SELECT month, string_agg(name || ': ' || format('{:,}', rows) || ' rows', '; ' ORDER BY position) AS issues
  FROM broken GROUP BY month),
asked AS (
  SELECT '2024-04-01T06:00:00Z' AS run_timestamp, 1 AS month
  UNION ALL SELECT '2024-05-01T06:00:00Z', unnest(range(1, 7))),
judged AS (
  SELECT *, CASE WHEN month = 1 AND run_timestamp > '2024-04-02' THEN 'skipped' WHEN month = 6 THEN 'not_published'
      WHEN month = 5 THEN 'failed' WHEN issues IS NOT NULL THEN 'success_with_warnings' ELSE 'success' END AS status
  FROM asked LEFT JOIN months USING (month) LEFT JOIN issues USING (month)),
log AS (
  SELECT 'yellow_trips' AS pipeline, 'bronze' AS layer, CAST(2024 AS INTEGER) AS year, CAST(month AS INTEGER) AS month, status,
    CASE WHEN status LIKE 'success%' THEN total_rows - rejects ELSE 0 END AS rows_ingested,
    CASE WHEN status LIKE 'success%' THEN rejects ELSE 0 END AS reject_rows, run_timestamp,
    CASE WHEN status LIKE 'success%' THEN coalesce(issues, '') WHEN status = 'failed' THEN 'unreadable' ELSE '' END
      AS error_message,
    status LIKE 'success%' AS has_bytes
  FROM judged)"""
_CORRECTED = SILVER + """,
corrected AS (SELECT * FROM silver WHERE NOT (pickup_year = 2024 AND pickup_month = 2) OR payment_type = 1)"""
_ENRICHED = ENRICHED_COLUMNS.replace("vendor_count)", "vendor_count, surge)")

ORACLES = {
    "control_log": f"WITH {_DELIVERED} SELECT * FROM log",
    "run_history": f"""WITH {_DELIVERED}
      SELECT pipeline, year, month, status, rows_ingested, reject_rows, run_timestamp FROM log
      ORDER BY run_timestamp DESC, month DESC LIMIT 5""",
    "landed_files": f"""WITH {_DELIVERED}
      SELECT CAST(2024 AS INTEGER) AS year, CAST(month AS INTEGER) AS month, total_rows AS row_count, rejects AS reject_rows,
        total_rows - rejects AS valid_rows, true AS unchanged FROM months""",
    "quarantine_table": f"""WITH {CHECKED}
      SELECT event_id, {RAW_COLUMNS}, CAST(2024 AS INTEGER) AS year, file_month AS month FROM split
      WHERE bad AND (file_month = 3 OR file_month = 2 AND NOT fare_amount < 0)""",
    "silver_table": f"WITH {_CORRECTED} SELECT {', '.join(SILVER_COLUMNS)} FROM corrected",
    "health_table": MARTS_SQL["pipeline_health"].replace(SILVER, _CORRECTED).replace("FROM silver GROUP", "FROM corrected GROUP"),
    "mart_after_refresh": f"""WITH {LOADED},
      first AS (SELECT {ENRICHED_COLUMNS}, CAST(NULL AS DOUBLE) AS surge FROM loaded),
      again AS (
        SELECT * REPLACE (trip_count + 1 AS trip_count), CAST(pickup_hour AS DOUBLE) / 4 AS surge FROM loaded
        WHERE pickup_year = 2024 AND pickup_month = 1 AND pickup_hour < 20
        UNION ALL SELECT *, NULL FROM loaded WHERE NOT (pickup_year = 2024 AND pickup_month = 1)),
      pending AS (
        SELECT {_ENRICHED}, surge FROM again AS a WHERE NOT EXISTS (
          SELECT 1 FROM first AS f WHERE f.loaded_at >= TIMESTAMP '2024-02-29 12:00:00'
            AND f.pickup_year = a.pickup_year AND f.pickup_month = a.pickup_month))
      SELECT *, true AS refreshed FROM pending
      UNION ALL
      SELECT *, false FROM first ANTI JOIN pending USING (pickup_date, pickup_hour, pickup_location_id)""",
    "load_table_rows": f"""WITH {DEMAND}
      SELECT * REPLACE (CAST(vendor_count AS INTEGER) AS vendor_count) FROM demand WHERE pickup_hour NOT IN (13, 14)""",
    "load_table_rejects": f"""WITH {DEMAND}
      SELECT pickup_year, pickup_month, CAST(pickup_date AS VARCHAR) AS pickup_date, pickup_hour,
        'zone ' || pickup_location_id AS pickup_location_id,
        CASE pickup_hour WHEN 13 THEN 'pickup_location_id,trip_count' ELSE 'pickup_location_id' END AS unreadable
      FROM demand WHERE pickup_hour IN (13, 14)""",
    "stream_rejects": f"WITH {RAW} SELECT event_id, 'refund' AS fare, 'fare' AS unreadable FROM raw WHERE fare_amount < 0",
    "sample_by_hash": f"""WITH {RAW}
      SELECT event_id, copy_no, fare_amount FROM raw
      WHERE CAST('0x' || substr(md5('7:' || event_id), 1, 8) AS BIGINT) < 429496730""",
    "gate_result": f"WITH {LOADED}, newest AS (SELECT max(_loaded_at) AS last_load_time FROM loaded) "
    + " UNION ALL ".join(
        f"""SELECT last_load_time, date_diff('hour', last_load_time, TIMESTAMP '{GATE_TIME}') AS hours_since_load,
        CAST({limit} AS INTEGER) AS limit_hours,
        CASE WHEN date_diff('hour', last_load_time, TIMESTAMP '{GATE_TIME}') <= {limit} THEN 'pass' ELSE 'fail' END AS status
        FROM newest"""
        for limit in GATE_LIMITS
    ),
    "csv_export": f"""WITH {RAW}
      SELECT event_id, copy_no, tpep_pickup_datetime, trip_distance,
        CASE event_id % 5 WHEN 0 THEN NULL WHEN 1 THEN '' WHEN 2 THEN ' "' || store_and_fwd_flag || '", '
          WHEN 3 THEN 'line ' || event_id || chr(10) || chr(92) || 'n' ELSE store_and_fwd_flag END AS remark
      FROM raw""",
}
