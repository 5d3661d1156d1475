"""Places of rows in an order, counted without bringing a group into one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .tables import stored

# Rows of one range: few enough to sort in a task; small tables are cut finer to use more cores.
RANGE_ROWS, LEAST_ROWS = 1 << 20, 1 << 12


def ranged_sums(df: DataFrame, group: Sequence[str], order: Sequence[Column], weight: str, label: str) -> DataFrame:
    """Add ``before``: the sum of ``weight`` over the rows of the same group that come earlier in ``order``.

    ``df`` should be a stored table: it is read for its size, for the borders of the ranges and once more.  Rows are
    dealt to ranges of group and order, so a group of any size spans many tasks; each task sums its own range, and the
    sums of whole ranges are added.  Needs positive weights and columns ``range`` and ``before`` to be free.  Rows that
    tie in ``order`` get places in no particular order.  Nulls in ``group`` are a group; no rows give no rows.
    """
    spark = df.sparkSession
    rows = df.count()
    wanted = min(rows // LEAST_ROWS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cut = df.repartitionByRange(max(rows // RANGE_ROWS, wanted) + 1, *[F.col(g).asc() for g in group], *order)
    cut, _ = stored(cut.withColumn("range", F.spark_partition_id()), label)
    earlier = F.sum("n").over(Window.partitionBy(*group).orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    sums = cut.groupBy(*group, "range").agg(F.sum(weight).alias("n")).withColumn("base", earlier)
    # A group has a base only in the ranges it enters from the one before: fewer rows than there are ranges.
    bases = sums.where("base > 0").select(*[F.col(g).alias(f"base_{g}") for g in group], F.col("range").alias("r"), "base")
    inside = F.sum(weight).over(
        Window.partitionBy(*group, "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    same = F.col("range") == F.col("r")
    for g in group:
        same = same & F.col(g).eqNullSafe(F.col(f"base_{g}"))
    placed = cut.withColumn("inside", inside).join(F.broadcast(bases), same, "left")
    before = F.col("inside") - F.col(weight) + F.coalesce("base", F.lit(0))
    return placed.select(*df.columns, before.cast("bigint").alias("before"))
