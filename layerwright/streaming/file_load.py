"""File-tracked loading as a stream: each file is loaded once, whatever is run again.

The checkpoint remembers the files already taken, so a re-run over an unchanged folder loads nothing, and
neither the file list nor the load log passes through user code on the driver.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import name
from ..operators.typed import readable, unreadable
from ..sources.files import PARQUET_ONLY
from ..sources.tables import read_table

REJECT_COLUMNS = ("_unreadable", "row")


def split_rows(rows: DataFrame, declared: Mapping[str, str]) -> DataFrame:
    """Every row once, in the declared types, or with ``outcome`` rejected, its bad columns and its values as JSON."""
    bad = f"NOT ({readable(rows, declared)})"
    typed = [
        f"IF({bad}, NULL, try_cast({name(c) if c in rows.columns else 'CAST(NULL AS STRING)'} AS {t})) AS {name(c)}"
        for c, t in declared.items()
    ]
    values = ", ".join(name(c) for c in rows.columns)
    return rows.selectExpr(
        *typed, f"IF({bad}, {unreadable(rows, declared)}, NULL) AS _unreadable",
        f"IF({bad}, to_json(struct({values})), NULL) AS row", f"IF({bad}, 'rejected', 'loaded') AS outcome",
    )


def load_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    declared: Mapping[str, str],
    target: str,
    checkpoint: str,
    max_files: int = 10_000,
) -> int:
    """Load the files below ``source`` that were not loaded before; returns the number of batches run.

    Files are taken ``max_files`` at a time until none are left.  A batch reads its files once and writes its own
    ``load_batch`` partitions of good and rejected rows, so a batch repeated after a failure replaces itself.  Read them
    with :func:`loaded` and :func:`rejected`.
    """
    stream = (
        spark.readStream.schema(schema)
        .option("pathGlobFilter", PARQUET_ONLY)
        .option("maxFilesPerTrigger", max_files)
        .parquet(source)
    )

    written: set[int] = set()

    def write(rows: DataFrame, batch: int) -> None:
        written.add(batch)
        marked = split_rows(rows, declared).withColumns({"_loaded_at": F.current_timestamp(), "load_batch": F.lit(batch)})
        out = marked.write.mode("overwrite").partitionBy("outcome", "load_batch")
        out.option("partitionOverwriteMode", "dynamic").parquet(target)

    query = (
        stream.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return len(written)


def loaded(spark: SparkSession, target: str) -> DataFrame:
    """The rows that fitted the declared types."""
    return read_table(spark, target).where("outcome = 'loaded'").drop("outcome", *REJECT_COLUMNS)


def rejected(spark: SparkSession, target: str) -> DataFrame:
    """The rows that did not fit: their unreadable columns, their values as JSON, their load."""
    return read_table(spark, target).where("outcome = 'rejected'").select(*REJECT_COLUMNS, "_loaded_at", "load_batch")
