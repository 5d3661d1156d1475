"""Raw trips derived from the ``events`` table, one delivery row per event copy.

Every event becomes one trip row, and some are delivered twice, so the derived table grows with
``events``.  The formulas put nulls, negatives, equal and swapped times, corrupt years, unlisted codes and
duplicates into it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..config import SilverSpec
from ..operators import silver
from ..session import scratch_path

ID_COLUMNS = ("event_id", "copy_no")
LINEAGE = (*ID_COLUMNS, "file_month")


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 19 raw trip columns plus event, copy number and month of the file a row is delivered in."""
    parts = spark.read.parquet(f"{sf_dir}/events.parquet").selectExpr(
        "event_id",
        "user_id",
        "ts + make_dt_interval(CAST((event_id % 3) * 30 - IF(event_id % 499 = 0, 5479, 0) AS INT)) AS pickup",
        "CASE WHEN event_id % 103 = 0 THEN -3600 WHEN event_id % 101 = 0 THEN 0"
        " ELSE 60 + (event_id * 37) % 5400 END AS seconds",
        "floor(value * 100 + 0.5D) AS cents",
        "IF(event_id % 17 <> 0, CAST(event_id % 5 AS INT), NULL) AS payment_type",
        "event_id % 13 <> 0 AS complete",
        "explode(sequence(1, IF(event_id % 50 = 7, 2, 1))) AS copy_no",
    )
    fare = "CASE WHEN event_id % 89 = 0 THEN 0L WHEN event_id % 97 = 0 THEN -cents ELSE cents END"
    priced = parts.selectExpr("*", f"{fare} AS fare", "IF(payment_type = 1, cents div 5, 0L) AS tip")
    return priced.selectExpr(
        "CASE WHEN event_id % 10 < 4 THEN 1 WHEN event_id % 10 < 9 THEN 2 ELSE 6 END AS VendorID",
        "pickup AS tpep_pickup_datetime",
        "pickup + make_dt_interval(0, 0, 0, seconds) AS tpep_dropoff_datetime",
        "IF(complete, CAST(event_id % 6 + 1 AS DOUBLE), NULL) AS passenger_count",
        "CASE WHEN event_id % 107 = 0 THEN -1.5D WHEN event_id % 211 = 0 THEN 600D"
        " ELSE (event_id * 53) % 2500 / 100D END AS trip_distance",
        "IF(complete, CAST(event_id % 6 + 1 AS INT), NULL) AS RatecodeID",
        "IF(complete, IF(event_id % 40 = 0, 'Y', 'N'), NULL) AS store_and_fwd_flag",
        "CAST(user_id % 265 + 1 AS INT) AS PULocationID",
        "CAST((event_id * 7) % 265 + 1 AS INT) AS DOLocationID",
        "payment_type",
        "fare / 100D AS fare_amount",
        "(event_id % 3) * 0.5D AS extra",
        "0.5D AS mta_tax",
        "tip / 100D AS tip_amount",
        "IF(event_id % 20 = 0, 6.94D, 0D) AS tolls_amount",
        "1D AS improvement_surcharge",
        "(fare + tip + 250) / 100D AS total_amount",
        "IF(complete, 2.5D, NULL) AS congestion_surcharge",
        "IF(complete, IF(event_id % 25 = 0, 1.75D, 0D), NULL) AS airport_fee",
        "event_id",
        "copy_no",
        "CAST(event_id % 3 + 1 AS INT) AS file_month",
    )


def clean_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed, derived and filtered trips with duplicates."""
    return silver.clean(raw_trips(spark, sf_dir))


def silver_trips(spark: SparkSession, sf_dir: str, spec: SilverSpec = SilverSpec()) -> DataFrame:
    """Silver trips; of two copies the later one stays."""
    return silver.derived(silver.distinct_clean(raw_trips(spark, sf_dir), spec, ("copy_no", "event_id")))


_landed: dict[tuple[str, str], str] = {}


def landed_bronze(spark: SparkSession, sf_dir: str) -> str:
    """Folder with the raw trips written as ``year=/month=`` files, once per session and input.

    The second month stores passenger counts as integers, as real deliveries have done, so the monthly
    schemas cannot be merged.
    """
    key = (spark.sparkContext.applicationId, sf_dir)
    if key not in _landed:
        root = scratch_path(spark, "bronze")
        raw = raw_trips(spark, sf_dir).drop("copy_no")
        dated = raw.withColumns({"year": F.lit("2024"), "month": F.format_string("%02d", "file_month")}).drop("file_month")
        second = dated.where("month = '02'").withColumn("passenger_count", F.col("passenger_count").cast("bigint"))
        for rows in (dated.where("month <> '02'"), second):
            rows.write.mode("append").partitionBy("year", "month").parquet(root)
        _landed[key] = root
    return _landed[key]
