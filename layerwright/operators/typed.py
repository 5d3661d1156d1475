"""Typed loading: declared tables, tolerant casts with rejects, schema evolution."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import conjunction, name, quoted

# Declared columns of the load tables.
HOURLY_ZONE_DEMAND = {
    "pickup_date": "date",
    "pickup_hour": "int",
    "pickup_year": "int",
    "pickup_month": "int",
    "pickup_location_id": "int",
    "time_segment": "string",
    "is_weekend": "boolean",
    "trip_count": "bigint",
    "avg_trip_distance_miles": "double",
    "avg_trip_duration_mins": "double",
    "avg_fare_amount": "double",
    "total_fare_amount": "double",
    "avg_tip_amount": "double",
    "vendor_count": "int",
    "demand_tier": "string",
}
DAILY_VENDOR_REVENUE = {
    "pickup_date": "date",
    "pickup_year": "int",
    "pickup_month": "int",
    "vendor_id": "int",
    "vendor_name": "string",
    "total_trips": "bigint",
    "total_fare_revenue": "double",
    "total_tip_revenue": "double",
    "gross_revenue": "double",
    "avg_fare_per_trip": "double",
    "tip_rate_pct": "double",
    "avg_distance_miles": "double",
    "avg_passengers": "double",
}
MONTHLY_PAYMENT_MIX = {
    "pickup_year": "int",
    "pickup_month": "int",
    "payment_type": "int",
    "payment_type_desc": "string",
    "trip_count": "bigint",
    "total_fare": "double",
    "total_tips": "double",
    "avg_tip": "double",
    "monthly_total_trips": "bigint",
    "market_share_pct": "double",
}
PIPELINE_HEALTH = {
    "pickup_year": "int",
    "pickup_month": "int",
    "total_rows_in_silver": "bigint",
    "total_fare_volume": "double",
    "avg_trip_distance": "double",
    "avg_fare": "double",
    "avg_duration_mins": "double",
    "earliest_pickup": "timestamp_ntz",
    "latest_pickup": "timestamp_ntz",
    "distinct_pickup_zones": "int",
    "distinct_vendors": "int",
    "zero_fare_rows": "bigint",
    "null_passenger_rows": "bigint",
    "health_run_at": "timestamp",
}
LOAD_TABLES = {
    "hourly_zone_demand": HOURLY_ZONE_DEMAND,
    "daily_vendor_revenue": DAILY_VENDOR_REVENUE,
    "monthly_payment_mix": MONTHLY_PAYMENT_MIX,
    "pipeline_health_log": PIPELINE_HEALTH,
}
# Mart column -> load table column.
LOAD_RENAMES = {"pipeline_health_log": {"total_rows": "total_rows_in_silver"}}


def _source(df: DataFrame, column: str) -> str:
    return name(column) if column in df.columns else "CAST(NULL AS STRING)"


def unreadable(df: DataFrame, declared: Mapping[str, str]) -> str:
    """Names of the declared columns whose value is present but does not fit the type."""
    marks = [
        f"IF({_source(df, c)} IS NOT NULL AND try_cast({_source(df, c)} AS {t}) IS NULL, {quoted(c)}, NULL)"
        for c, t in declared.items()
    ]
    return f"array_compact(array({', '.join(marks)}))"


def readable(df: DataFrame, declared: Mapping[str, str]) -> str:
    return conjunction(
        f"{_source(df, c)} IS NULL OR try_cast({_source(df, c)} AS {t}) IS NOT NULL" for c, t in declared.items()
    )


def typed_load(df: DataFrame, declared: Mapping[str, str]) -> DataFrame:
    """Rows whose every declared value fits, in the declared types; an absent column loads as null."""
    good = df.where(readable(df, declared))
    return good.selectExpr(*[f"try_cast({_source(df, c)} AS {t}) AS {name(c)}" for c, t in declared.items()])


def typed_load_rejects(df: DataFrame, declared: Mapping[str, str]) -> DataFrame:
    """The rows :func:`typed_load` leaves out, unchanged, with the names of the unreadable columns."""
    rejects = df.where(f"NOT ({readable(df, declared)})")
    return rejects.selectExpr("*", f"{unreadable(df, declared)} AS _unreadable")


def with_load_time(df: DataFrame) -> DataFrame:
    return df.withColumn("_loaded_at", F.current_timestamp())


def mart_to_load_table(mart: DataFrame, table: str) -> DataFrame:
    """A mart's rows as the named load table declares them, load time included."""
    return with_load_time(typed_load(mart.withColumnsRenamed(LOAD_RENAMES.get(table, {})), LOAD_TABLES[table]))


def mart_load_rejects(mart: DataFrame, table: str) -> DataFrame:
    """The rows :func:`mart_to_load_table` leaves out, their file, their unreadable columns and the load time.

    Values are kept as JSON, so that the log has one schema whatever the mart's was.  Needs a file-based ``mart``.
    """
    renamed = mart.selectExpr("*", "_metadata.file_path AS _file_path")
    renamed = renamed.withColumnsRenamed(LOAD_RENAMES.get(table, {}))
    rejects = typed_load_rejects(renamed, LOAD_TABLES[table])
    values = ", ".join(name(c) for c in renamed.columns if c != "_file_path")
    return with_load_time(rejects.selectExpr("_file_path", "_unreadable", f"to_json(struct({values})) AS row"))


def undeclared(df: DataFrame, table: str) -> list[str]:
    """Columns that ``df`` has beside those the load table declares and its load time."""
    known = {c.lower() for c in (*LOAD_TABLES[table], "_loaded_at")}
    return [c for c in df.columns if c.lower() not in known]


def evolve(existing: DataFrame, incoming: DataFrame) -> DataFrame:
    """Append ``incoming`` to ``existing``; columns only one side has are null on the other."""
    return existing.unionByName(incoming, allowMissingColumns=True)


def new_columns(existing: DataFrame, incoming: DataFrame) -> list[str]:
    known = {c.lower() for c in existing.columns}
    return [c for c in incoming.columns if c.lower() not in known]
