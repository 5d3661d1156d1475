"""Tables written to the shared folder between jobs, so that a lost executor costs a task and not the lineage."""

from __future__ import annotations

import gc
from contextlib import suppress

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path


def stored(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """Write ``df`` below the shared folder and read it back; also returns its path."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def removed(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that no later job reads."""
    for path in paths:
        where = spark._jvm.org.apache.hadoop.fs.Path(path)
        with suppress(Exception):
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def text_bytes(df: DataFrame, column: str = "text") -> int:
    """Bytes of a text column, over all rows."""
    return int(df.agg(F.coalesce(F.sum(F.octet_length(column)), F.lit(0))).first()[0])


def small_batches(spark: SparkSession, rows: int = 2000) -> None:
    """Smaller Arrow batches for texts: one of the default size would hold long texts by the thousand."""
    if int(spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")) > rows:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def released(spark: SparkSession) -> None:
    """Let Spark delete shuffle files of steps that are over: it does so when both sides have collected garbage."""
    gc.collect()
    spark._jvm.System.gc()
