"""Raw trips to silver trips: rename, cast, derive, filter, keep the newest of each key.

Each step is one projection over the whole column list, so the analysed plan stays flat however many
columns a step touches.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..config import PAYMENT_LABELS, VENDOR_LABELS, SilverSpec
from ..functions import scalars as s

# Columns a bronze read adds so that the newest delivery of a trip can be told apart.
FILE_COLUMNS = ("_delivered_month", "_file_modified_at", "_file_path")


def typed(raw: DataFrame, spec: SilverSpec = SilverSpec()) -> DataFrame:
    """Silver names and declared types; columns outside the spec pass through unchanged.

    A value that does not fit its type becomes null.
    """

    def column(source: str) -> str:
        target = spec.renames.get(source, source)
        value = s.name(source)
        if target in spec.casts:
            value = f"try_cast({value} AS {spec.casts[target]})"
        return f"{value} AS {s.name(target)}"

    return raw.selectExpr(*[column(c) for c in raw.columns])


def derived(trips: DataFrame) -> DataFrame:
    """Add duration, calendar parts, labels, time segment and weekend flag."""
    return trips.selectExpr(
        "*",
        f"{s.duration_minutes('pickup_datetime', 'dropoff_datetime')} AS trip_duration_mins",
        *s.calendar_parts("pickup_datetime"),
        f"{s.decode('payment_type', PAYMENT_LABELS)} AS payment_type_desc",
        f"{s.decode('vendor_id', VENDOR_LABELS)} AS vendor_name",
        f"{s.time_segment('hour(pickup_datetime)')} AS time_segment",
        f"{s.is_weekend('pickup_datetime')} AS is_weekend",
    )


def quality_rules(spec: SilverSpec = SilverSpec()) -> dict[str, str]:
    """Named conditions a silver trip meets; an unknown result drops the trip."""
    return {
        "pickup_present": "pickup_datetime IS NOT NULL",
        "dropoff_present": "dropoff_datetime IS NOT NULL",
        "pickup_before_dropoff": "pickup_datetime < dropoff_datetime",
        "distance_not_negative": "trip_distance >= 0",
        "fare_not_negative": "fare_amount >= 0",
        "duration_positive": "trip_duration_mins > 0",
        "duration_below_limit": f"trip_duration_mins < {spec.max_minutes}D",
        "distance_below_limit": f"trip_distance < {spec.max_distance}D",
        "year_in_range": f"pickup_year BETWEEN {spec.first_year} AND {spec.last_year}",
    }


def year_window(spec: SilverSpec = SilverSpec(), column: str = "pickup_datetime") -> str:
    """The year rule restated on the time itself, the form a Parquet scan can skip row groups with."""
    first = f"TIMESTAMP_NTZ'{spec.first_year}-01-01 00:00:00'"
    after = f"TIMESTAMP_NTZ'{spec.last_year + 1}-01-01 00:00:00'"
    return f"{column} >= {first} AND {column} < {after}"


def quality_filter(trips: DataFrame, spec: SilverSpec = SilverSpec()) -> DataFrame:
    return trips.where(s.conjunction([year_window(spec), *quality_rules(spec).values()]))


def keep_first(df: DataFrame, key: Sequence[str], descending: Sequence[str]) -> DataFrame:
    """The first row of each key in the descending order of the given columns.

    Spark limits each key to one row per map task before the shuffle (``WindowGroupLimit``), so a key
    holding a large share of the table reaches its reducer as one row per map task.
    """
    order = [F.desc(s.name(c)) for c in descending]
    rank = F.row_number().over(Window.partitionBy(*[s.name(c) for c in key]).orderBy(*order))
    return df.withColumn("_rank", rank).where("_rank = 1").drop("_rank")


def keep_newest(
    trips: DataFrame, spec: SilverSpec = SilverSpec(), newest_by: Sequence[str] | None = None
) -> DataFrame:
    """One trip per dedup key.

    By default the one of the latest delivered month stays, then the one written last, for months need not land in
    their order; among trips of one file the remaining columns decide, so that
    only exact copies are interchangeable and reruns agree.  ``newest_by`` replaces that order; columns
    that tell all trips apart make it a total one, and then no other column has to be read for it.
    """
    if newest_by is None:
        delivered = [c for c in FILE_COLUMNS if c in trips.columns]
        newest_by = [*delivered, *[c for c in trips.columns if c not in (*delivered, *spec.dedup_key)]]
    return keep_first(trips, spec.dedup_key, newest_by)


def clean(raw: DataFrame, spec: SilverSpec = SilverSpec()) -> DataFrame:
    """Typed, derived and filtered trips, duplicates still in."""
    return quality_filter(derived(typed(raw, spec)), spec)


def distinct_clean(
    raw: DataFrame, spec: SilverSpec = SilverSpec(), newest_by: Sequence[str] | None = None
) -> DataFrame:
    """Clean trips, one per key, without their derived columns.

    Derived columns only serve the filter here: computing them again after the shuffles costs less than
    shuffling them.
    """
    base = typed(raw, spec)
    passed = quality_filter(derived(base), spec).select(*[s.name(c) for c in base.columns])
    return keep_newest(passed, spec, newest_by).drop(*FILE_COLUMNS)


def stamped(trips: DataFrame, spec: SilverSpec = SilverSpec()) -> DataFrame:
    """Add load time and source name."""
    return trips.selectExpr("*", "current_timestamp() AS _ingested_at", f"{s.quoted(spec.source)} AS _source")


def to_silver(
    raw: DataFrame, spec: SilverSpec = SilverSpec(), newest_by: Sequence[str] | None = None
) -> DataFrame:
    """The silver table: clean trips, one per key, with derived columns, load time and source name."""
    return stamped(derived(distinct_clean(raw, spec, newest_by)), spec)


def filter_reject_counts(raw: DataFrame, spec: SilverSpec = SilverSpec()) -> DataFrame:
    """Rows failing each quality rule, in one pass; a row can count under several rules.

    The extra row ``any_rule`` counts the rows that are dropped.
    """
    rules = quality_rules(spec)
    rules["any_rule"] = s.conjunction(rules.values())
    counted = derived(typed(raw, spec)).agg(
        *[F.expr(f"count_if(NOT {s.holds(rule)}) AS {label}") for label, rule in rules.items()]
    )
    return counted.unpivot([], list(rules), "rule", "rows")


def run_counts(raw: DataFrame, spec: SilverSpec = SilverSpec()) -> DataFrame:
    """One row of accounting for a silver run: rows in, filtered, duplicate and out, and failures per rule.

    One pass that reads the columns of the rules and the key; rows are counted per key before the shuffle.
    """
    rules = quality_rules(spec)
    failed = {f"failed_{label}": f"count_if(NOT {s.holds(rule)})" for label, rule in rules.items()}
    passed = s.holds(s.conjunction([year_window(spec), *rules.values()]))
    per_key = derived(typed(raw, spec)).groupBy(*spec.dedup_key).agg(
        F.expr("count(*) AS copies"),
        F.expr(f"count_if({passed}) AS clean"),
        *[F.expr(f"{count} AS {label}") for label, count in failed.items()],
    )
    totals = {
        "rows_in": "sum(copies)",
        **{label: f"sum({label})" for label in failed},
        "rows_filtered": "sum(copies - clean)",
        "rows_duplicate": "sum(greatest(clean - 1, 0))",
        "rows_out": "count_if(clean > 0)",
    }
    return per_key.agg(*[F.expr(f"coalesce({total}, 0) AS {label}") for label, total in totals.items()])


def dedup_counts(trips: DataFrame, key: Sequence[str]) -> DataFrame:
    """Rows in, rows kept and duplicates under ``key``; only the key columns are read and shuffled."""
    per_key = trips.groupBy(*key).agg(F.expr("count(*) AS copies"))
    return per_key.agg(
        F.expr("coalesce(sum(copies), 0) AS rows_in"),
        F.expr("count(*) AS rows_out"),
        F.expr("coalesce(sum(copies - 1), 0) AS duplicates"),
    )


def sampled_by_key(df: DataFrame, key: Sequence[str], percent: float, seed: int = 0) -> DataFrame:
    """About ``percent`` % of the keys, with all their rows: those whose hash falls below that share.

    The same keys are chosen in any table, order and layout, so samples of two tables join, and a repeated task takes
    the same rows.  A null counts as a value of its own.
    """
    parts = ", ':', ".join(f"coalesce(CAST({s.name(k)} AS STRING), 'null')" for k in key)
    mark = f"CAST(conv(substr(md5(concat('{seed}', ':', {parts})), 1, 8), 16, 10) AS BIGINT)"
    return df.where(f"{mark} < {round(percent / 100 * (1 << 32))}")
