"""Reading and writing the layer tables.

Tables are Parquet by default; pass ``fmt="delta"`` (or another installed source) to use a
transactional format.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import scratch_path
from .files import PARQUET_ONLY

CONTROL_SCHEMA = T.StructType(
    [
        T.StructField("pipeline", T.StringType()),
        T.StructField("layer", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("month", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("rows_ingested", T.LongType()),
        T.StructField("reject_rows", T.LongType()),
        T.StructField("file_size_bytes", T.LongType()),
        T.StructField("run_timestamp", T.StringType()),
        T.StructField("error_message", T.StringType()),
    ]
)

# A silver run also says how many rows it read and how many of them were copies.
SILVER_RUN_SCHEMA = T.StructType(
    CONTROL_SCHEMA.fields + [T.StructField("rows_in", T.LongType()), T.StructField("rows_duplicate", T.LongType())]
)


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", view: str | None = None, merge: bool = False
) -> DataFrame:
    """A table snapshot, registered as a temporary view when a name is given.

    ``merge`` shows columns that only some files have, at the price of reading every footer; for marts.
    """
    reader = spark.read.format(fmt).option("mergeSchema", merge)
    if fmt == "parquet":
        reader = reader.option("pathGlobFilter", PARQUET_ONLY)
    df = reader.load(path)
    if view:
        df.createOrReplaceTempView(view)
    return df


def _located(spark: SparkSession, path: str):
    """The Hadoop file system of ``path`` and the path in it."""
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def path_exists(spark: SparkSession, path: str) -> bool:
    filesystem, target = _located(spark, path)
    return filesystem.exists(target)


def path_bytes(spark: SparkSession, path: str) -> int:
    """Total size of the files below ``path``."""
    filesystem, target = _located(spark, path)
    return filesystem.getContentSummary(target).getLength()


def delete_path(spark: SparkSession, path: str) -> None:
    filesystem, target = _located(spark, path)
    filesystem.delete(target, True)


def move_file(spark: SparkSession, source: str, target: str) -> None:
    """Move a file, making the folders above ``target``; raises when it can't be moved."""
    filesystem, to = _located(spark, target)
    _, origin = _located(spark, source)
    filesystem.mkdirs(to.getParent())
    if not filesystem.rename(origin, to):
        raise OSError(f"{source} could not be moved to {target}")


def gathered(df: DataFrame, partitions: Sequence[str]) -> DataFrame:
    """``df`` with the rows of each table partition brought together for writing.

    Few open writers and no small files; AQE splits a partition larger than the advisory size over several
    tasks, so a month holding a third of the rows is not written by one.  Without AQE nothing would split
    it, and the rows stay where they are.
    """
    if not partitions or df.sparkSession.conf.get("spark.sql.adaptive.enabled") != "true":
        return df
    return df.hint("rebalance", *[F.col(p) for p in partitions])


def overwrite_partitions(df: DataFrame, path: str, partitions: Sequence[str], fmt: str = "parquet") -> None:
    """Replace the partitions present in ``df`` and leave the others alone."""
    writer = gathered(df, partitions).write.format(fmt).mode("overwrite").partitionBy(*partitions)
    writer.option("partitionOverwriteMode", "dynamic").save(path)


def overwrite_all(
    df: DataFrame, path: str, partitions: Sequence[str] = (), fmt: str = "parquet", gather: bool = True
) -> None:
    """Replace the whole table, schema included; ``gather=False`` for rows that are gathered already."""
    rows = gathered(df, partitions) if gather else df
    writer = rows.write.format(fmt).mode("overwrite").option("partitionOverwriteMode", "static")
    if fmt == "delta":
        writer = writer.option("overwriteSchema", "true")
    if partitions:
        writer = writer.partitionBy(*partitions)
    writer.save(path)


def replace_read_partitions(df: DataFrame, path: str, partitions: Sequence[str], fmt: str = "parquet") -> None:
    """:func:`overwrite_partitions` for a ``df`` computed from the table at ``path`` itself.

    A plain overwrite would delete files it still reads, so the rows are written to the shared scratch
    folder first.  The final step is not atomic for plain Parquet, but running the refresh again gives the
    same table.
    """
    spark = df.sparkSession
    staged = scratch_path(spark, "staged")
    df.write.parquet(staged)
    overwrite_partitions(spark.read.schema(df.schema).parquet(staged), path, partitions, fmt)
    delete_path(spark, staged)


def append_rows(df: DataFrame, path: str, fmt: str = "parquet") -> None:
    """Add rows to a table or log."""
    df.write.format(fmt).mode("append").save(path)


def append_json(spark: SparkSession, record: Mapping, path: str, schema: T.StructType = CONTROL_SCHEMA) -> None:
    """Append one record to a JSON log."""
    row = tuple(record.get(f.name) for f in schema.fields)
    spark.createDataFrame([row], schema).coalesce(1).write.mode("append").json(path)


def append_control(control: DataFrame, path: str) -> None:
    """Append control records, one per delivered month, to the JSON log."""
    records = control.select(*[F.col(f.name).cast(f.dataType) for f in CONTROL_SCHEMA.fields])
    records.coalesce(1).write.mode("append").json(path)


def read_control(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(CONTROL_SCHEMA).json(path)


def run_history(control: DataFrame, order: Sequence[str] = ("run_timestamp",), limit: int = 5) -> DataFrame:
    """The newest runs of a log."""
    return control.orderBy(*[F.col(c).desc() for c in order]).limit(limit)


# A null is nothing between two commas, an empty text two quotes; quotes inside a text are doubled.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "",
    "emptyValue": '""',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def export_csv(df: DataFrame, path: str) -> None:
    """Write a mart as CSV files with a header each."""
    df.write.mode("overwrite").options(**CSV_OPTIONS).csv(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An exported mart as it was; a value that does not fit ``schema`` is an error.

    Texts may hold line feeds, so Spark reads each file by one task; the export has one file per partition of the mart.
    """
    # Spark's reader takes what it reads for an empty text as null when that is empty itself.
    empty = f"empty-{uuid.uuid4().hex}"
    options = {**CSV_OPTIONS, "emptyValue": empty, "multiLine": "true", "mode": "FAILFAST"}
    read = spark.read.schema(schema).options(**options).csv(path)
    texts = [f.name for f in schema.fields if isinstance(f.dataType, T.StringType)]
    return read.withColumns({c: F.when(F.col(f"`{c}`") == empty, "").otherwise(F.col(f"`{c}`")) for c in texts})
