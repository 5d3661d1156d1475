"""Set-difference joins and keyed upsert."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _all(conditions: Sequence[Column]) -> Column:
    return reduce(Column.__and__, conditions, F.lit(True))


def anti_join_nullsafe(outer: DataFrame, inner: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows of ``outer`` whose key is not in ``inner``; two nulls count as equal.

    Null-safe equality is an equi-join key in Spark, so this hashes or sort-merges at any size.
    """
    o, i = outer.alias("o"), inner.select(*key).distinct().alias("i")
    return o.join(i, _all([F.col(f"o.`{k}`").eqNullSafe(F.col(f"i.`{k}`")) for k in key]), "left_anti")


def not_in(outer: DataFrame, inner: DataFrame, key: Sequence[str]) -> DataFrame:
    """``WHERE (key) NOT IN (SELECT key FROM inner)`` with SQL's null rules.

    A row stays only if it certainly differs from every inner row, so an inner row removes it when each
    key column is either equal or null on one of the two sides.  Planned directly, that condition has no
    join key and compares every pair of rows.  Here the cases are split by the set of columns compared by
    equality: for each set, the inner side shrinks to the distinct values of those columns plus a null
    flag per remaining column, and the rest is an ordinary equi anti join.  Only the empty set has no
    equality; its inner side is the distinct null flags, at most ``2 ** len(key)`` rows, hence broadcast.
    All sides come from the distinct inner keys, which Spark works out once: their count stands in every expression, so
    no side's own condition is moved below that step and makes it another one.
    """
    null_possible = {k: outer.schema[k].nullable or inner.schema[k].nullable for k in key}
    result = outer
    keys = inner.groupBy(*key).agg(F.count(F.lit(1)).alias("_n"))

    def of_keys(value: Column) -> Column:
        return F.when(F.col("_n") > 0, value)

    for size in range(len(key), -1, -1):
        for compared in combinations(key, size):
            flagged = [k for k in key if k not in compared]
            if not all(null_possible[k] for k in flagged):
                continue
            side = keys.where(of_keys(_all([F.col(f"`{k}`").isNotNull() for k in compared]))).select(
                *[of_keys(F.col(f"`{k}`")).alias(f"_v_{k}") for k in compared],
                *[of_keys(F.col(f"`{k}`").isNull()).alias(f"_n_{k}") for k in flagged],
            ).distinct()
            condition = _all(
                [F.col(f"`{k}`") == F.col(f"`_v_{k}`") for k in compared]
                + [F.col(f"`{k}`").isNull() | F.col(f"`_n_{k}`") for k in flagged]
            )
            result = result.join(side if compared else F.broadcast(side), condition, "left_anti")
    return result


def upsert(target: DataFrame, source: DataFrame, key: Sequence[str], check: bool = True) -> DataFrame:
    """``target`` with the rows of ``source`` replacing those of equal key and new keys added.

    Columns missing on one side are filled with null.  Two source rows with one key would have no defined
    winner; with ``check`` the query then fails when it runs.  A null in the key equals nothing, as in a SQL MERGE, so
    such rows are all kept; they are dealt by their content, not by the null.  Both sides are read once and meet in one
    shuffle by key.
    """
    null_key = reduce(Column.__or__, [F.col(f"`{k}`").isNull() for k in key], F.lit(False))
    both = target.withColumn("_from_source", F.lit(False)).unionByName(
        source.withColumn("_from_source", F.lit(True)), allowMissingColumns=True
    )
    hashed = [F.col(f"`{f.name}`") for f in both.schema if not any(t in f.dataType.simpleString() for t in ("map<", "variant"))]
    both = both.withColumn("_spread", F.when(null_key, F.xxhash64(*hashed)))
    same_key = Window.partitionBy(*[F.col(f"`{k}`") for k in key], "_spread")
    newest = F.max("_from_source").over(same_key)
    if check:
        several = F.lit(f"several source rows share one key {tuple(key)}")
        copies = F.count_if(F.col("_from_source")).over(same_key)
        newest = F.when((copies > 1) & ~null_key, F.raise_error(several).cast("boolean")).otherwise(newest)
    kept = both.withColumn("_newest", newest).where(null_key | (F.col("_from_source") == F.col("_newest")))
    return kept.drop("_from_source", "_spread", "_newest")


def not_yet_landed(candidates: DataFrame, landed: DataFrame, key: Sequence[str]) -> DataFrame:
    """Candidates without a landed counterpart."""
    return candidates.join(landed.select(*key).distinct(), list(key), "left_anti")
