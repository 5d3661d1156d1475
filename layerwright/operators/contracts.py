"""Data contracts, freshness and load checks on published tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import HOURS, SEGMENTS, TIERS, FreshnessSpec
from ..functions.scalars import holds, hour_boundaries, literal, name, quoted


@dataclass(frozen=True)
class NotNull:
    column: str


@dataclass(frozen=True)
class Accepted:
    """Only the listed values; null passes."""

    column: str
    values: tuple


@dataclass(frozen=True)
class Unique:
    columns: tuple[str, ...]


# The checks published for the staging view and the demand mart.
STAGING_CONTRACT = (
    NotNull("pickup_date"),
    NotNull("pickup_hour"),
    Accepted("pickup_hour", HOURS),
    NotNull("pickup_location_id"),
    NotNull("trip_count"),
    NotNull("avg_fare_amount"),
)
MART_CONTRACT = (
    NotNull("pickup_date"),
    NotNull("pickup_hour"),
    NotNull("pickup_location_id"),
    NotNull("demand_tier"),
    Accepted("demand_tier", TIERS),
    NotNull("time_segment"),
    Accepted("time_segment", SEGMENTS),
    NotNull("revenue_per_trip"),
)
MART_KEY_CONTRACT = (Unique(("pickup_date", "pickup_hour", "pickup_location_id")),)


class ContractError(Exception):
    """A published table breaks its contract."""


def unaccepted(contract: Accepted) -> str:
    values = ", ".join(literal(v) for v in contract.values)
    return holds(f"{name(contract.column)} NOT IN ({values})")


def broken_rows(contract: NotNull | Accepted) -> tuple[str, str]:
    """The name of a single-column check and the condition that a failing row meets."""
    if isinstance(contract, NotNull):
        return "not_null", f"{name(contract.column)} IS NULL"
    return "accepted_values", unaccepted(contract)


def check_once(df: DataFrame, models: Mapping[str, Sequence[NotNull | Accepted | Unique]]) -> DataFrame:
    """:func:`check` of several models that are columns of the same rows, with the ``model`` each contract belongs to.

    Rows are folded to one per key where keys are to be unique, with the failing rows of every other check beside, so
    ``df`` is worked out once.  All unique contracts must be on one key.
    """
    listed = [(model, c) for model, contracts in models.items() for c in contracts]
    keys = {c.columns for _, c in listed if isinstance(c, Unique)}
    if len(keys) > 1:
        raise ValueError(f"one key at a time, not {sorted(keys)}")
    counts, entries = ["count(*) AS _copies"], []
    for i, (model, c) in enumerate(listed):
        if isinstance(c, Unique):
            label, column, failing = "unique", ", ".join(c.columns), "count_if(_copies > 1)"
        else:
            (label, condition), column, failing = broken_rows(c), c.column, f"coalesce(sum(_failing_{i}), 0L)"
            counts.append(f"count_if({condition}) AS _failing_{i}")
        entries.append(
            f"named_struct('model', {quoted(model)}, 'check_name', '{label}', 'column_name', {quoted(column)}, "
            f"'failing_rows', {failing})"
        )
    folded = df.groupBy(*[name(k) for key in keys for k in key]).agg(*map(F.expr, counts))
    checks = folded.agg(F.expr(f"array({', '.join(entries)}) AS checks")).selectExpr("inline(checks)")
    return checks.selectExpr("*", "failing_rows = 0 AS passed")


def check_columns(df: DataFrame, contracts: Sequence[NotNull | Accepted]) -> DataFrame:
    """(check_name, column_name, failing_rows) of all single-column checks in one pass."""
    checks = []
    for contract in contracts:
        label, broken = broken_rows(contract)
        checks.append(
            f"named_struct('check_name', '{label}', 'column_name', {quoted(contract.column)}, "
            f"'failing_rows', count_if({broken}))"
        )
    return df.agg(F.expr(f"array({', '.join(checks)}) AS checks")).selectExpr("inline(checks)")


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return df.groupBy(*key).agg(F.expr("count(*) AS copies")).where("copies > 1")


def check_unique(df: DataFrame, contract: Unique) -> DataFrame:
    columns = quoted(", ".join(contract.columns))
    failing = duplicate_keys(df, contract.columns).agg(F.expr("count(*) AS failing_rows"))
    return failing.selectExpr("'unique' AS check_name", f"{columns} AS column_name", "failing_rows")


def check(df: DataFrame, contracts: Sequence[NotNull | Accepted | Unique]) -> DataFrame:
    """One row per contract with its failing rows (keys, for uniqueness) and outcome."""
    single = [c for c in contracts if not isinstance(c, Unique)]
    parts = [check_columns(df, single)] if single else []
    parts += [check_unique(df, c) for c in contracts if isinstance(c, Unique)]
    return reduce(DataFrame.unionByName, parts).selectExpr("*", "failing_rows = 0 AS passed")


def assert_contract(df: DataFrame, contracts: Sequence[NotNull | Accepted | Unique]) -> None:
    """Raise when a check fails; the result has one row per check."""
    failed = check(df, contracts).where("NOT passed").collect()
    if failed:
        raise ContractError(
            "; ".join(f"{r.check_name}({r.column_name}): {r.failing_rows} failing" for r in failed)
        )


def unaccepted_values(df: DataFrame, contract: Accepted) -> DataFrame:
    """Each value outside the accepted list, with its rows."""
    value = F.col(name(contract.column)).alias("value")
    return df.where(unaccepted(contract)).groupBy(value).agg(F.expr("count(*) AS rows"))


def unaccepted_by_column(df: DataFrame, contracts: Sequence[Accepted]) -> DataFrame:
    """(column_name, value, rows) of the values outside each accepted list, in one pass; the columns share a type."""
    pairs = [
        f"named_struct('column_name', {quoted(c.column)}, 'value', {name(c.column)}, 'broken', {unaccepted(c)})"
        for c in contracts
    ]
    found = df.selectExpr(f"inline(array({', '.join(pairs)}))").where("broken")
    return found.groupBy("column_name", "value").agg(F.expr("count(*) AS rows"))


def freshness(
    df: DataFrame, as_of: str, date: str = "pickup_date", loaded: str = "_loaded_at", stale_hours: int = 48
) -> DataFrame:
    """Newest data date and load time, their ages at ``as_of`` (a time expression) and a verdict.

    An empty table has no age to compare; it is reported as ``NO_DATA``, not as fresh.
    """
    newest = df.agg(F.max(date).alias("last_data_date"), F.max(loaded).alias("last_load_time"))
    hours = hour_boundaries("last_load_time", as_of)
    verdict = f"CASE WHEN last_load_time IS NULL THEN 'NO_DATA' WHEN {hours} > {stale_hours} THEN 'STALE' ELSE 'FRESH' END"
    return newest.selectExpr(
        "last_data_date",
        f"datediff({as_of}, last_data_date) AS days_since_last_data",
        "last_load_time",
        f"{hours} AS hours_since_load",
        f"{verdict} AS freshness_status",
    )


def source_freshness(
    df: DataFrame, as_of: str, loaded: str = "_loaded_at", limits: FreshnessSpec = FreshnessSpec()
) -> DataFrame:
    """Age of the newest load in elapsed seconds, judged against the warn and error limits."""
    newest = df.agg(F.max(loaded).alias("last_load_time"))
    aged = newest.selectExpr("*", f"unix_timestamp({as_of}) - unix_timestamp(last_load_time) AS age_seconds")
    return aged.selectExpr(
        "*",
        f"""CASE WHEN age_seconds IS NULL OR age_seconds > {limits.error * 3600} THEN 'error'
                 WHEN age_seconds > {limits.warn * 3600} THEN 'warn' ELSE 'pass' END AS status""",
    )


def gate_result(
    df: DataFrame, as_of: str, loaded: str = "_loaded_at", limits: FreshnessSpec = FreshnessSpec()
) -> DataFrame:
    """One row: the newest load, its age in hour marks, the gate's limit, and ``pass`` or ``fail``.

    Nothing loaded has no age and fails.
    """
    newest = df.agg(F.max(loaded).alias("last_load_time"))
    return newest.selectExpr(
        "last_load_time",
        f"CAST({hour_boundaries('last_load_time', as_of)} AS BIGINT) AS hours_since_load",
        f"{limits.gate} AS limit_hours",
        f"IF({hour_boundaries('last_load_time', as_of)} <= {limits.gate}, 'pass', 'fail') AS status",
    )


def freshness_gate(
    df: DataFrame, as_of: str, loaded: str = "_loaded_at", limits: FreshnessSpec = FreshnessSpec()
) -> None:
    """Raise when the newest load is older than the gate, or nothing was loaded."""
    gate = gate_result(df, as_of, loaded, limits).first()
    if gate.status == "fail":
        raise ContractError(f"newest load is {gate.hours_since_load} hours old, limit {gate.limit_hours}")


def span(df: DataFrame, column: str) -> DataFrame:
    """Row count and extremes of ``column``, the usual check after a load."""
    return df.agg(
        F.expr("count(*) AS row_count"), F.min(column).alias("min_value"), F.max(column).alias("max_value")
    )


def verify_rows(df: DataFrame, expected: int) -> int:
    """Count a table read back after a write and raise when rows are missing or extra."""
    found = df.count()
    if found != expected:
        raise ContractError(f"read back {found} rows, expected {expected}")
    return found
