"""Staging view, enriched demand mart and its incremental refresh."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from ..config import DEMAND_KEY, PARTITIONS
from ..functions import measures as m
from ..functions.scalars import name
from .joins import anti_join_nullsafe, not_in, upsert

STAGED = (
    "pickup_date",
    "pickup_hour",
    "pickup_year",
    "pickup_month",
    "pickup_location_id",
    "time_segment",
    "is_weekend",
    "trip_count",
    "avg_trip_distance_miles",
    "avg_trip_duration_mins",
    "avg_fare_amount",
    "total_fare_amount",
    "avg_tip_amount",
    "demand_tier",
)


def staging_demand(loaded: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
    """Staged columns, and ``extra`` ones, of the loaded demand rows that have a date and at least one trip."""
    usable = loaded.where("pickup_date IS NOT NULL AND trip_count > 0")
    return usable.selectExpr(*STAGED, "_loaded_at AS loaded_at", *map(name, extra))


def enriched_demand(staged: DataFrame) -> DataFrame:
    """Add revenue per trip, tip rate and a weekend flag that is never null."""
    return staged.selectExpr(
        "*",
        f"{m.quotient('total_fare_amount', 'trip_count', 2)} AS revenue_per_trip",
        f"{m.quotient('avg_tip_amount', 'avg_fare_amount', 3)} AS tip_rate",
        "coalesce(is_weekend, false) AS is_weekend_flag",
    )


def pending_months(
    staged: DataFrame, target: DataFrame, as_of: str, days: int = 2, null_aware: bool = False
) -> DataFrame:
    """Staged rows of months without a target row loaded in the ``days`` days before ``as_of``.

    The default treats two null months as equal; ``null_aware`` follows SQL's ``NOT IN``, where one null
    month in the target holds back every row.
    """
    recent = target.where(f"loaded_at >= {as_of} - INTERVAL {days} DAYS")
    exclude = not_in if null_aware else anti_join_nullsafe
    return exclude(staged, recent.select(*PARTITIONS), PARTITIONS)


def demand_mart(
    staged: DataFrame, target: DataFrame | None, as_of: str, null_aware: bool = False
) -> DataFrame:
    """The demand mart after a refresh at ``as_of``: everything on the first run, else pending months merged."""
    if target is None:
        return enriched_demand(staged).selectExpr("*", f"{as_of} AS updated_at")
    pending = pending_months(staged, target, as_of, null_aware=null_aware)
    return upsert(target, enriched_demand(pending).selectExpr("*", f"{as_of} AS updated_at"), DEMAND_KEY)
