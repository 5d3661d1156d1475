"""Row-level expressions as SQL text: durations, calendar parts, labels and flags."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from datetime import datetime, timezone

from ..config import OTHER_SEGMENT, TIME_SEGMENTS, UNKNOWN_LABEL, WEEKEND_DAYS, TierSpec


def quoted(text: str) -> str:
    """A SQL string literal."""
    escaped = text.replace("\\", "\\\\").replace("'", "\\'")
    return f"'{escaped}'"


def name(column: str) -> str:
    """A column name in backquotes."""
    return f"`{column}`"


def literal(value) -> str:
    return quoted(value) if isinstance(value, str) else str(value)


def time_literal(time: datetime) -> str:
    """A point in time; one without a zone is refused, for machine and session may differ in theirs."""
    if time.tzinfo is None:
        raise ValueError("a point in time needs a zone")
    return f"TIMESTAMP'{time.astimezone(timezone.utc):%Y-%m-%d %H:%M:%S}+00:00'"


def conjunction(conditions: Iterable[str]) -> str:
    return " AND ".join(f"({c})" for c in conditions) or "true"


def disjunction(conditions: Iterable[str]) -> str:
    return " OR ".join(f"({c})" for c in conditions) or "false"


def duration_minutes(start: str, end: str) -> str:
    """Whole elapsed seconds as minutes with two digits.

    Whole seconds never fall on half a hundredth of a minute, so flooring after adding a half is exact
    and avoids the per-row decimal that ``round`` builds for doubles.
    """
    return f"floor((unix_timestamp({end}) - unix_timestamp({start})) * 100 / 60 + 0.5D) / 100D"


def calendar_parts(time: str, prefix: str = "pickup") -> list[str]:
    return [
        f"hour({time}) AS {prefix}_hour",
        f"dayofweek({time}) AS {prefix}_day_of_week",
        f"to_date({time}) AS {prefix}_date",
        f"year({time}) AS {prefix}_year",
        f"month({time}) AS {prefix}_month",
    ]


def decode(code: str, labels: Mapping[int, str], other: str = UNKNOWN_LABEL) -> str:
    """Label of ``code``; unlisted codes and null get ``other``."""
    cases = " ".join(f"WHEN {literal(key)} THEN {quoted(label)}" for key, label in labels.items())
    return f"CASE {code} {cases} ELSE {quoted(other)} END"


def time_segment(hour: str) -> str:
    cases = " ".join(
        f"WHEN {hour} BETWEEN {first} AND {last} THEN {quoted(label)}" for first, last, label in TIME_SEGMENTS
    )
    return f"CASE {cases} ELSE {quoted(OTHER_SEGMENT)} END"


def is_weekend(day: str) -> str:
    return f"coalesce(dayofweek({day}) IN ({', '.join(map(str, WEEKEND_DAYS))}), false)"


def demand_tier(count: str, tiers: TierSpec = TierSpec()) -> str:
    return f"CASE WHEN {count} > {tiers.high} THEN 'HIGH' WHEN {count} > {tiers.medium} THEN 'MEDIUM' ELSE 'LOW' END"


def hour_boundaries(start: str, end: str) -> str:
    """Number of full-hour marks passed between two times, as warehouses count hour differences."""
    # Truncated by the clock: hours begin at another second where the zone is off by half an hour.
    first, last = (f"unix_timestamp(date_trunc('hour', {time}))" for time in (start, end))
    return f"floor(({last} - {first}) / 3600)"


def holds(condition: str) -> str:
    """``condition`` with unknown counted as false: a missing value breaks no range rule."""
    return f"coalesce({condition}, false)"


def is_missing(column: str, dtype: str) -> str:
    """Null, or NaN for floating columns."""
    c = name(column)
    return f"{c} IS NULL OR isnan({c})" if dtype in ("double", "float") else f"{c} IS NULL"
