"""Reading raw monthly files, alike or not in schema."""

from __future__ import annotations

from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..config import IngestSpec
from .files import PARQUET_ONLY, path_value

MONTH_COLUMNS = ("year", "month")
EPOCH = "1970-01-01 00:00:00"

# Schema inference reports bad files by either of these, depending on where it notices.
READ_ERRORS = (PySparkException, Py4JJavaError)


def month_dirs(spark: SparkSession, root: str, holding: str = "") -> dict[tuple[int, int], str]:
    """``(year, month) -> folder`` of the ``year=/month=`` layout below ``root``, in order.

    One driver-side listing of the partition folders, the same that partition discovery does; it grows
    with the number of months, not with files or rows.  ``holding`` leaves out folders without such a file;
    folders of null or malformed months are none of the layout.
    """
    jvm = spark.sparkContext._jvm
    base = jvm.org.apache.hadoop.fs.Path(root)
    filesystem = base.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = filesystem.globStatus(jvm.org.apache.hadoop.fs.Path(base, f"year=*/month=*/{holding}".rstrip("/")))
    folders = {}
    for status in found or []:
        path = status.getPath().getParent() if holding else status.getPath()
        year, month = path.getParent().getName().removeprefix("year="), path.getName().removeprefix("month=")
        if year.isdecimal() and month.isdecimal():
            folders[int(year), int(month)] = path.toString()
    return dict(sorted(folders.items()))


def parquet_schema(spark: SparkSession, path: str, merge: bool = False) -> T.StructType:
    """The schema of the Parquet files below ``path``; times in nanoseconds show as ``bigint``.

    Spark has no type for such times and refuses them.  The schema is read in a session of its own that is told to take
    the stored numbers; with it, the caller's session reads them too.
    """
    own = spark.newSession()
    own.conf.set("spark.sql.legacy.parquet.nanosAsLong", "true")
    return own.read.option("pathGlobFilter", PARQUET_ONLY).option("mergeSchema", merge).parquet(path).schema


def read_parquet(spark: SparkSession, path: str, merge: bool = False) -> DataFrame:
    """Parquet files below ``path``, skipping checksum and log files beside them."""
    schema = parquet_schema(spark, path, merge)
    return spark.read.schema(schema).option("pathGlobFilter", PARQUET_ONLY).parquet(path)


def _fitting(column: Column, kind: str, declared: str) -> Column:
    """``column`` in its declared type; an integer in place of a time counts nanoseconds since 1970."""
    if kind == "bigint" and declared == "timestamp_ntz":
        micros = (column - F.pmod(column, F.lit(1000))) / F.lit(1000).cast("decimal(4,0)")
        seconds = micros.cast("decimal(18,0)") / 1_000_000
        return F.lit(EPOCH).cast("timestamp_ntz") + F.make_dt_interval(secs=seconds)
    if kind == "bigint" and declared == "timestamp":
        return F.timestamp_micros(((column - F.pmod(column, F.lit(1000))) / F.lit(1000).cast("decimal(4,0)")).cast("bigint"))
    return column.try_cast(declared)


def as_declared(df: DataFrame, declared: dict[str, str]) -> DataFrame:
    """``df`` with declared columns in their declared names and types; names match in any case.

    A value that does not fit its type becomes null, to be counted and quarantined as a missing one, rather
    than failing the whole delivery.
    """
    names = {c.lower(): c for c in declared}
    return df.select(
        *[
            _fitting(F.col(f"`{c}`"), kind, declared[names[c.lower()]]).alias(names[c.lower()])
            if c.lower() in names
            else F.col(f"`{c}`")
            for c, kind in df.dtypes
        ]
    )


def _with_file_columns(df: DataFrame) -> DataFrame:
    path = F.col("_metadata.file_path")
    return df.select(
        "*",
        (path_value(path, "year") * 12 + path_value(path, "month")).alias("_delivered_month"),
        F.col("_metadata.file_modification_time").alias("_file_modified_at"),
        F.col("_metadata.file_path").alias("_file_path"),
    )


def read_bronze(
    spark: SparkSession,
    root: str,
    spec: IngestSpec = IngestSpec(),
    file_columns: bool = True,
) -> DataFrame:
    """All raw rows below ``root`` with ``year`` and ``month`` from the folders.

    One scan with a merged schema where the monthly schemas agree.  Where a column's type changed between
    months, Parquet schemas cannot be merged: months that agree are then read together, one scan per set of them,
    cast to the declared types, and joined by column name.  With ``file_columns`` each row also says which file
    it came from and when that was delivered, which decides between copies of a trip.
    """
    try:
        return _shaped(read_parquet(spark, root, merge=True), spec, file_columns)
    except READ_ERRORS as error:
        if "CANNOT_MERGE" not in str(error):
            raise
    months = month_dirs(spark, root)
    if not months:
        raise ValueError(f"schemas below {root} differ and there are no year=/month= folders to read one by one")
    parts = []
    for fields, folders in agreeing({f: parquet_schema(spark, f, merge=True) for f in months.values()}):
        schema = T.StructType([*fields, *[T.StructField(c, T.IntegerType()) for c in MONTH_COLUMNS]])
        reader = spark.read.schema(schema).option("pathGlobFilter", PARQUET_ONLY).option("basePath", root)
        parts.append(_shaped(reader.parquet(*folders), spec, file_columns))
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def agreeing(schemas: dict[str, T.StructType]) -> list[tuple[list[T.StructField], list[str]]]:
    """Folders whose columns of one name have one type, put together: the columns of all of them, and the folders."""
    groups: list[tuple[dict[str, T.StructField], list[str]]] = []
    for folder, schema in schemas.items():
        own = {f.name.lower(): f for f in schema.fields if f.name.lower() not in MONTH_COLUMNS}
        for fields, folders in groups:
            if all(fields[c].dataType == f.dataType for c, f in own.items() if c in fields):
                break
        else:
            fields, folders = {}, []
            groups.append((fields, folders))
        fields.update({c: f for c, f in own.items() if c not in fields})
        folders.append(folder)
    return [(list(fields.values()), folders) for fields, folders in groups]


def _shaped(df: DataFrame, spec: IngestSpec, file_columns: bool) -> DataFrame:
    return as_declared(_with_file_columns(df) if file_columns else df, spec.raw_types)
