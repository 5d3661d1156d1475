"""Declarative row validation: named violations, a valid/quarantine split and counted issues.

Rules are SQL conditions, so one projection tags every row and one aggregate counts every rule, however
many files or months the input spans.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import IngestSpec
from ..functions import scalars as s

FAILED = "_failed_rules"


def missing_columns(columns: Iterable[str], spec: IngestSpec = IngestSpec()) -> list[str]:
    """Required columns that are absent, in the order they are declared."""
    present = set(columns)
    return [c for c in spec.required if c not in present]


def missing_column_issue(names: Sequence[str]) -> str:
    return f"Missing required columns: {list(names)}"


def violations(df: DataFrame, spec: IngestSpec = IngestSpec()) -> dict[str, str]:
    """Issue label -> condition a bad row meets, in reporting order.

    Missing values break the null rules only; a range rule on a missing value is not broken.
    """
    types = dict(df.dtypes)
    rules = {f"Nulls in {c}": s.is_missing(c, types[c]) for c in spec.required}
    # NaN sorts above every number in Spark, so only true negatives meet these.
    for column in (spec.distance, spec.fare):
        if column in types:
            rules[f"Negative {column}"] = s.holds(f"{s.name(column)} < 0")
    if spec.pickup in types and spec.dropoff in types:
        rules["Pickup >= dropoff"] = s.holds(f"{s.name(spec.pickup)} >= {s.name(spec.dropoff)}")
    return rules


def tag(df: DataFrame, spec: IngestSpec = IngestSpec()) -> DataFrame:
    """Add the array of labels of the rules each row breaks."""
    labels = [f"IF({broken}, {s.quoted(label)}, NULL)" for label, broken in violations(df, spec).items()]
    return df.selectExpr("*", f"array_compact(array({', '.join(labels)})) AS {FAILED}")


def any_violation(df: DataFrame, spec: IngestSpec = IngestSpec()) -> str:
    return f"({s.disjunction(violations(df, spec).values())})"


@dataclass(frozen=True)
class ValidationResult:
    """Lazy outcome of :func:`validate`."""

    valid: DataFrame
    quarantine: DataFrame
    report: DataFrame

    def issues(self) -> list[str]:
        """The report as text; one row per rule at most, so collecting it is safe."""
        return [row["issue"] for row in self.report.orderBy("position").collect()]


def _count_entry(position: int, label: str, rows: str) -> str:
    return f"named_struct('position', {position}, 'rule', {s.quoted(label)}, 'rows', {rows})"


def _rule_entries(df: DataFrame, spec: IngestSpec) -> list[str]:
    rules = violations(df, spec).items()
    return [_count_entry(i, label, f"count_if({broken})") for i, (label, broken) in enumerate(rules)]


def rule_counts(df: DataFrame, spec: IngestSpec = IngestSpec(), by: Sequence[str] = ()) -> DataFrame:
    """One row per group and rule with the rows breaking it, rules without hits included.

    Also carries the group's row count (``total_rows``) and distinct rejected rows (``reject_rows``).
    """
    counted = df.groupBy(*by).agg(
        F.expr("count(*) AS total_rows"),
        F.expr(f"count_if({any_violation(df, spec)}) AS reject_rows"),
        F.expr(f"array({', '.join(_rule_entries(df, spec))}) AS _rules"),
    )
    return counted.selectExpr(*by, "total_rows", "reject_rows", "inline(_rules)")


def issue_report(df: DataFrame, spec: IngestSpec = IngestSpec()) -> DataFrame:
    """(position, rule, rows, issue) for every rule with hits, in one pass.

    Fewer rows than the floor are reported first; that is a warning and rejects nothing.
    """
    entries = [_count_entry(-1, "Row count", "count(*)"), *_rule_entries(df, spec)]
    counts = df.agg(F.expr(f"array({', '.join(entries)}) AS _counts")).selectExpr("inline(_counts)")
    due = counts.where(f"IF(position < 0, rows < {spec.min_rows}, rows > 0)")
    return due.selectExpr(
        "*",
        f"""IF(position < 0, 'Row count ' || format_number(rows, 0) || ' below minimum {spec.min_rows:,}',
               rule || ': ' || format_number(rows, 0) || ' rows') AS issue""",
    )


def validate(df: DataFrame, spec: IngestSpec = IngestSpec()) -> ValidationResult:
    """Split ``df`` into valid rows and quarantined rows and report the issues.

    A missing required column quarantines the whole input and stops further checks.
    """
    missing = missing_columns(df.columns, spec)
    if missing:
        report = df.agg(F.expr("count(*) AS rows")).selectExpr(
            "0 AS position",
            "'Missing required columns' AS rule",
            "rows",
            f"{s.quoted(missing_column_issue(missing))} AS issue",
        )
        return ValidationResult(df.limit(0), df, report)
    bad = any_violation(df, spec)
    return ValidationResult(df.where(f"NOT {bad}"), df.where(bad), issue_report(df, spec))


def reject_rate(counts: DataFrame, spec: IngestSpec = IngestSpec()) -> DataFrame:
    """Add the rejected share in percent (0 for no rows) and whether it exceeds the alert limit."""
    rated = counts.selectExpr("*", "coalesce(try_divide(reject_rows * 100D, total_rows), 0D) AS reject_pct")
    return rated.selectExpr("*", f"reject_pct > {spec.max_reject_pct}D AS alert")


def run_status(landed: Column, published: Column, readable: Column, has_issues: Column) -> Column:
    """Status of one delivery; the first that applies."""
    return (
        F.when(landed, "skipped")
        .when(~published, "not_published")
        .when(~readable, "failed")
        .when(has_issues, "success_with_warnings")
        .otherwise("success")
    )


def null_profile(df: DataFrame) -> DataFrame:
    """(column_name, null_pct) for each column with nulls, in one pass over the table."""
    rates = df.agg(
        *[F.expr(f"count_if({s.name(c)} IS NULL) * 100D / nullif(count(*), 0) AS {s.name(c)}") for c in df.columns]
    )
    return rates.unpivot([], [s.name(c) for c in df.columns], "column_name", "null_pct").where("null_pct > 0")
