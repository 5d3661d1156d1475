"""Queries over files: listings, checksums, partitioned bronze, file-tracked loading."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources import bronze, files
from ..streaming.file_load import load_new_files, loaded
from .oracle_base import RAW
from .trips import landed_bronze
from .validation import RAW_COLUMNS


def scan_bronze(spark, sf):
    """Every landed row, read through months whose schemas differ."""
    rows = bronze.read_bronze(spark, landed_bronze(spark, sf), file_columns=False)
    return rows.select("event_id", *RAW_COLUMNS.split(", "), "year", "month")


def partition_prune(spark, sf):
    """Rows and fares of one month; the other months' folders are not read."""
    rows = bronze.read_bronze(spark, landed_bronze(spark, sf), file_columns=False)
    return rows.where(F.col("month") == 3).select("event_id", "tpep_pickup_datetime", "fare_amount", "month")


def file_manifest(spark, sf):
    listed = files.file_manifest(spark, sf)
    return listed.select(files.file_name(F.col("path")).alias("file_name"), "size")


def checksum_manifest(spark, sf):
    return files.checksum_manifest(spark, sf).select(files.file_name(F.col("path")).alias("file_name"), "size", "md5")


def _scan(spark, sf, columns):
    """Landed files with their common columns, whatever else differs."""
    reader = spark.read.schema(columns).option("pathGlobFilter", files.PARQUET_ONLY)
    return reader.option("recursiveFileLookup", "true").parquet(landed_bronze(spark, sf))


def path_partition(spark, sf):
    """Rows per month, the month taken from each file's path."""
    rows = files.with_path_values(_scan(spark, sf, "event_id bigint"), ["year", "month"])
    return rows.groupBy("year", "month").agg(F.count(F.lit(1)).alias("row_count"))


def skip_loaded_files(spark, sf):
    """Rows per month in the files a load log of the first two months does not list."""
    per_file = files.rows_per_file(_scan(spark, sf, "event_id bigint"))
    listed = per_file.withColumns({n: files.path_value(F.col("path"), n) for n in ("year", "month")})
    log = listed.where(F.col("month") <= 2)
    return files.not_yet_loaded(listed, log).groupBy("year", "month").agg(F.sum("row_count").alias("row_count"))


def stream_file_load(spark, sf):
    """Landed files taken by the file stream, run twice: the second run finds nothing new."""
    schema = "event_id bigint, VendorID int, fare_amount double, year int, month int"
    target, checkpoint = (scratch_path(spark, n) for n in ("loaded", "stream"))
    declared = {"event_id": "bigint", "VendorID": "int", "fare_amount": "double", "year": "int", "month": "int"}
    for _ in range(2):
        load_new_files(
            spark, landed_bronze(spark, sf), spark.createDataFrame([], schema).schema, declared, target, checkpoint
        )
    return loaded(spark, target).drop("_loaded_at", "load_batch")


QUERIES = {
    "scan_bronze": scan_bronze,
    "partition_prune": partition_prune,
    "file_manifest": file_manifest,
    "checksum_manifest": checksum_manifest,
    "path_partition": path_partition,
    "skip_loaded_files": skip_loaded_files,
    "stream_file_load": stream_file_load,
}

_YEAR = "CAST(2024 AS INTEGER) AS year"

ORACLES = {
    "scan_bronze": f"WITH {RAW} SELECT event_id, {RAW_COLUMNS}, {_YEAR}, file_month AS month FROM raw",
    "partition_prune": f"""WITH {RAW}
      SELECT event_id, tpep_pickup_datetime, fare_amount, file_month AS month FROM raw WHERE file_month = 3""",
    "path_partition": f"""WITH {RAW}
      SELECT {_YEAR}, file_month AS month, count(*) AS row_count FROM raw GROUP BY file_month""",
    "skip_loaded_files": f"""WITH {RAW}
      SELECT {_YEAR}, file_month AS month, count(*) AS row_count FROM raw WHERE file_month > 2 GROUP BY file_month""",
    "stream_file_load": f"""WITH {RAW}
      SELECT event_id, VendorID, fare_amount, {_YEAR}, file_month AS month FROM raw""",
}
