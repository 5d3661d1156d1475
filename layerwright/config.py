"""Thresholds, column specifications and code tables used across the layers."""

from __future__ import annotations

from dataclasses import dataclass, field

# Column names of the raw monthly trip file that must be present and non-null.
REQUIRED_COLUMNS = (
    "tpep_pickup_datetime",
    "tpep_dropoff_datetime",
    "passenger_count",
    "trip_distance",
    "PULocationID",
    "DOLocationID",
    "fare_amount",
)

# Raw name -> silver name.
RENAMES = {
    "tpep_pickup_datetime": "pickup_datetime",
    "tpep_dropoff_datetime": "dropoff_datetime",
    "PULocationID": "pickup_location_id",
    "DOLocationID": "dropoff_location_id",
    "RatecodeID": "rate_code_id",
    "VendorID": "vendor_id",
}

# Silver name -> type.  Pickup and dropoff are wall-clock times without a zone, so
# TIMESTAMP_NTZ keeps hours and durations independent of the session time zone.
CASTS = {
    "pickup_datetime": "timestamp_ntz",
    "dropoff_datetime": "timestamp_ntz",
    "passenger_count": "int",
    "trip_distance": "double",
    "fare_amount": "double",
    "tip_amount": "double",
    "total_amount": "double",
    "pickup_location_id": "int",
    "dropoff_location_id": "int",
    "payment_type": "int",
}

# The raw file's declared types, used when monthly files disagree.
RAW_TYPES = {
    "VendorID": "int",
    "tpep_pickup_datetime": "timestamp_ntz",
    "tpep_dropoff_datetime": "timestamp_ntz",
    "passenger_count": "double",
    "trip_distance": "double",
    "RatecodeID": "int",
    "store_and_fwd_flag": "string",
    "PULocationID": "int",
    "DOLocationID": "int",
    "payment_type": "int",
    "fare_amount": "double",
    "extra": "double",
    "mta_tax": "double",
    "tip_amount": "double",
    "tolls_amount": "double",
    "improvement_surcharge": "double",
    "total_amount": "double",
    "congestion_surcharge": "double",
    "airport_fee": "double",
}

# Code -> label.
PAYMENT_LABELS = {1: "Credit card", 2: "Cash", 3: "No charge", 4: "Dispute"}
VENDOR_LABELS = {1: "Creative Mobile Technologies", 2: "VeriFone"}
UNKNOWN_LABEL = "Unknown"

# Inclusive hour ranges; every other hour (and a null hour) is OTHER_SEGMENT.
TIME_SEGMENTS = (
    (6, 9, "Morning Rush"),
    (10, 15, "Midday"),
    (16, 19, "Evening Rush"),
    (20, 23, "Night"),
)
OTHER_SEGMENT = "Late Night"

# Spark's dayofweek numbers Sunday as 1 and Saturday as 7.
WEEKEND_DAYS = (1, 7)

# Accepted values of the published contracts.
HOURS = tuple(range(24))
TIERS = ("HIGH", "MEDIUM", "LOW")
SEGMENTS = ("Morning Rush", "Midday", "Evening Rush", "Night", "Late Night")

# The pickup time comes first: sorts compare an eight-byte prefix of the first key column, and times rarely tie.
DEDUP_KEY = ("pickup_datetime", "pickup_location_id", "fare_amount", "vendor_id")
PARTITIONS = ("pickup_year", "pickup_month")
DEMAND_KEY = ("pickup_date", "pickup_hour", "pickup_location_id")


@dataclass(frozen=True)
class IngestSpec:
    """What a raw monthly delivery must satisfy."""

    required: tuple[str, ...] = REQUIRED_COLUMNS
    raw_types: dict[str, str] = field(default_factory=lambda: dict(RAW_TYPES))
    pickup: str = "tpep_pickup_datetime"
    dropoff: str = "tpep_dropoff_datetime"
    distance: str = "trip_distance"
    fare: str = "fare_amount"
    min_rows: int = 100_000
    max_reject_pct: float = 5.0
    backfill_months: int = 3
    dataset: str = "yellow_trips"


@dataclass(frozen=True)
class SilverSpec:
    """How raw trips become silver trips."""

    renames: dict[str, str] = field(default_factory=lambda: dict(RENAMES))
    casts: dict[str, str] = field(default_factory=lambda: dict(CASTS))
    first_year: int = 2023
    last_year: int = 2025
    max_distance: float = 500.0
    max_minutes: float = 1440.0
    dedup_key: tuple[str, ...] = DEDUP_KEY
    source: str = "yellow_trips"


@dataclass(frozen=True)
class TierSpec:
    """Demand tier limits; a count must exceed the limit to reach the tier."""

    medium: int = 100
    high: int = 500


@dataclass(frozen=True)
class FreshnessSpec:
    """Age limits in hours."""

    stale: int = 48
    warn: int = 24
    error: int = 48
    gate: int = 2
