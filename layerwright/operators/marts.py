"""Silver trips to aggregate marts.

Columns that follow from a grouping column (year and month from the date, labels from their codes) are
computed after the aggregation, which keeps grouping keys and shuffled rows narrow.  Files carry no row
order, so no mart sorts its output; sort when showing it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import PAYMENT_LABELS, VENDOR_LABELS, TierSpec
from ..functions import measures as m
from ..functions import scalars as s


def grouped(df: DataFrame, by: Sequence[str], **outputs: str) -> DataFrame:
    """``GROUP BY by`` with the named aggregate expressions."""
    return df.groupBy(*by).agg(*[F.expr(f"{expression} AS {name}") for name, expression in outputs.items()])


def hourly_zone_demand(silver: DataFrame, tiers: TierSpec = TierSpec()) -> DataFrame:
    """Trips, averages, distinct vendors and demand tier per date, hour and pickup zone."""
    per_hour = grouped(
        silver,
        ("pickup_date", "pickup_hour", "pickup_location_id"),
        trip_count="count(*)",
        avg_trip_distance_miles=m.mean("trip_distance"),
        avg_trip_duration_mins=m.mean("trip_duration_mins"),
        avg_fare_amount=m.mean("fare_amount"),
        total_fare_amount=m.total("fare_amount"),
        avg_tip_amount=m.mean("tip_amount"),
        vendor_count="count(DISTINCT vendor_id)",
    )
    return per_hour.selectExpr(
        "pickup_date",
        "pickup_hour",
        "year(pickup_date) AS pickup_year",
        "month(pickup_date) AS pickup_month",
        "pickup_location_id",
        f"{s.time_segment('pickup_hour')} AS time_segment",
        f"{s.is_weekend('pickup_date')} AS is_weekend",
        "trip_count",
        "avg_trip_distance_miles",
        "avg_trip_duration_mins",
        "avg_fare_amount",
        "total_fare_amount",
        "avg_tip_amount",
        "vendor_count",
        f"{s.demand_tier('trip_count', tiers)} AS demand_tier",
    )


def daily_vendor_revenue(silver: DataFrame) -> DataFrame:
    """Trips, revenue and averages per date and known vendor."""
    outputs = {
        "total_trips": "count(*)",
        "total_fare_revenue": m.total("fare_amount"),
        "total_tip_revenue": m.total("tip_amount"),
        "gross_revenue": m.total("total_amount"),
        "avg_fare_per_trip": m.mean("fare_amount"),
        "tip_rate_pct": m.mean_ratio_pct("tip_amount", "fare_amount"),
        "avg_distance_miles": m.mean("trip_distance"),
        "avg_passengers": m.mean("passenger_count"),
    }
    per_day = grouped(silver.where("vendor_id IS NOT NULL"), ("pickup_date", "vendor_id"), **outputs)
    return per_day.selectExpr(
        "pickup_date",
        "year(pickup_date) AS pickup_year",
        "month(pickup_date) AS pickup_month",
        "vendor_id",
        f"{s.decode('vendor_id', VENDOR_LABELS)} AS vendor_name",
        *outputs,
    )


def with_share(
    counts: DataFrame, within: Sequence[str], count: str, total_name: str, share_name: str
) -> DataFrame:
    """Add the total of ``count`` over ``within`` and each row's share of it in percent.

    Meant for aggregated rows: a window partition then holds one row per group, not one per record.
    """
    totalled = counts.withColumn(total_name, F.sum(count).over(Window.partitionBy(*within)))
    return totalled.selectExpr("*", f"{m.share_pct(count, total_name)} AS {share_name}")


def monthly_payment_mix(silver: DataFrame) -> DataFrame:
    """Trips and money per month and known payment type, with the type's share of the month."""
    month = ("pickup_year", "pickup_month")
    outputs = {
        "trip_count": "count(*)",
        "total_fare": m.total("fare_amount"),
        "total_tips": m.total("tip_amount"),
        "avg_tip": m.mean("tip_amount"),
    }
    per_type = grouped(silver.where("payment_type IS NOT NULL"), (*month, "payment_type"), **outputs).selectExpr(
        *month, "payment_type", f"{s.decode('payment_type', PAYMENT_LABELS)} AS payment_type_desc", *outputs
    )
    return with_share(per_type, month, "trip_count", "monthly_total_trips", "market_share_pct")


def health_by(
    df: DataFrame,
    by: Sequence[str],
    distinct: Mapping[str, str],
    sums: Mapping[str, str],
    means: Mapping[str, str],
    span: tuple[str, str, str],
    flags: Mapping[str, str],
    few_combinations: bool = False,
) -> DataFrame:
    """Row count, sums, means, first and last value, distinct counts and flag counts per ``by`` group.

    ``distinct``, ``sums``, ``means`` and ``flags`` map output names to columns or conditions; ``span`` is
    the column whose extremes are taken and their two names.

    For several distinct counts Spark copies every row once per count.  Where the counted columns have
    ``few_combinations`` per group, folding the rows to one per combination first avoids that; where
    combinations are nearly as many as rows the fold would only add a shuffle.
    """
    column, first, last = span
    if not few_combinations:
        return grouped(
            df,
            by,
            total_rows="count(*)",
            **{n: m.total(c) for n, c in sums.items()},
            **{n: m.mean(c) for n, c in means.items()},
            **{first: f"min({column})", last: f"max({column})"},
            **{n: f"count(DISTINCT {c})" for n, c in distinct.items()},
            **{n: f"count_if({c})" for n, c in flags.items()},
        )
    measured = dict.fromkeys([*sums.values(), *means.values()])
    folded = grouped(
        df,
        (*by, *dict.fromkeys(distinct.values())),
        _rows="count(*)",
        **{f"_sum_{c}": f"sum({m.exact(c)})" for c in measured},
        **{f"_beyond_{c}": f"sum({m.beyond(c)})" for c in measured},
        **{f"_n_{c}": f"count({c})" for c in measured},
        _first=f"min({column})",
        _last=f"max({column})",
        **{f"_flag_{n}": f"count_if({c})" for n, c in flags.items()},
    )
    return grouped(
        folded,
        by,
        total_rows="sum(_rows)",
        **{n: m.as_total(f"sum(_sum_{c})", f"sum(_beyond_{c})") for n, c in sums.items()},
        **{n: m.as_mean(f"sum(_sum_{c})", f"sum(_beyond_{c})", f"sum(_n_{c})") for n, c in means.items()},
        **{first: "min(_first)", last: "max(_last)"},
        **{n: f"count(DISTINCT {c})" for n, c in distinct.items()},
        **{n: f"sum(_flag_{n})" for n in flags},
    )


def pipeline_health(silver: DataFrame) -> DataFrame:
    """Volume and data quality per month, without the run time (see :func:`stamped_health`)."""
    return health_by(
        silver,
        by=("pickup_year", "pickup_month"),
        distinct={"distinct_pickup_zones": "pickup_location_id", "distinct_vendors": "vendor_id"},
        sums={"total_fare_volume": "fare_amount"},
        means={
            "avg_trip_distance": "trip_distance",
            "avg_fare": "fare_amount",
            "avg_duration_mins": "trip_duration_mins",
        },
        span=("pickup_datetime", "earliest_pickup", "latest_pickup"),
        flags={"zero_fare_rows": "fare_amount = 0", "null_passenger_rows": "passenger_count IS NULL"},
        few_combinations=True,
    )


def stamped_health(silver: DataFrame) -> DataFrame:
    return pipeline_health(silver).withColumn("health_run_at", F.current_timestamp())


def conditional_counts(df: DataFrame, by: Sequence[str], flags: Mapping[str, str]) -> DataFrame:
    """Rows meeting each condition per group, next to all rows."""
    return grouped(df, by, total_rows="count(*)", **{n: f"count_if({c})" for n, c in flags.items()})


def distinct_counts(
    df: DataFrame, by: Sequence[str], columns: Mapping[str, str], approximate: bool = False
) -> DataFrame:
    """Distinct values of several columns per group.

    Exact by default, over one row per value combination; ``approximate`` uses one sketch per column in a
    single pass instead.
    """
    if approximate:
        return grouped(df, by, **{n: f"approx_count_distinct({c})" for n, c in columns.items()})
    combinations = df.select(*by, *dict.fromkeys(columns.values())).distinct()
    return grouped(combinations, by, **{n: f"count(DISTINCT {c})" for n, c in columns.items()})


def null_trend(df: DataFrame, by: Sequence[str], column: str) -> DataFrame:
    """Missing values of ``column`` and their percentage per group."""
    counted = conditional_counts(df, by, {"null_rows": f"{column} IS NULL"})
    return counted.selectExpr("*", f"{m.share_pct('null_rows', 'total_rows')} AS null_pct")


def rows_by(df: DataFrame, by: Sequence[str], count: str = "row_count") -> DataFrame:
    return grouped(df, by, **{count: "count(*)"})


def groups_per(aggregated: DataFrame, within: Sequence[str], count: str = "group_count") -> DataFrame:
    """Number of aggregated rows in each window partition: it counts groups, not the records in them."""
    return aggregated.withColumn(count, F.count("*").over(Window.partitionBy(*within)))


def demand_by_hour(demand: DataFrame) -> DataFrame:
    """Serving view: trips per hour of day and demand tier."""
    return grouped(demand, ("pickup_hour", "demand_tier"), trip_count="sum(trip_count)")


def distance_distribution(silver: DataFrame, width: float = 1.0) -> DataFrame:
    """Trips per month and fixed-width distance bucket; the bucket is named by its lower edge."""
    edges = silver.selectExpr(
        "pickup_year", "pickup_month", f"floor(trip_distance / {width}D) * {width}D AS distance_from"
    )
    return rows_by(edges, ("pickup_year", "pickup_month", "distance_from"), "trip_count")


MARTS = {
    "hourly_zone_demand": hourly_zone_demand,
    "daily_vendor_revenue": daily_vendor_revenue,
    "monthly_payment_mix": monthly_payment_mix,
    "pipeline_health": stamped_health,
}
