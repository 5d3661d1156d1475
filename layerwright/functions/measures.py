"""Sums and means that do not depend on the order in which rows arrive.

Adding doubles gives other last digits for every task layout, and a retried task can then flip a
rounded cent.  Measures are therefore added as decimals with ten digits after the point: decimal
addition is associative, so every run, partitioning and retry gives the same result, and only the
result is rounded.  Sums hold up to 10^28, more than 10^12 rows of 10^15 each.  Values that have no such
decimal (NaN, infinite, 10^18 and beyond) are added beside it as doubles, so they show in the result
instead of being dropped or stopping the job.  Missing values are skipped.

Like all expressions of this package these are SQL text: a whole projection then crosses from Python to
the JVM in one call.
"""

from __future__ import annotations

# Spark adds these as DECIMAL(38, 10).
EXACT = "DECIMAL(28, 10)"
LIMIT = "1e18D"


def exact(value: str) -> str:
    """``value`` as a decimal; null where it has none."""
    return f"CAST(IF(abs({value}) < {LIMIT}, {value}, NULL) AS {EXACT})"


def beyond(value: str) -> str:
    """What :func:`exact` leaves out: 0 for values it holds, the value itself for others."""
    return f"IF(abs({value}) < {LIMIT}, 0D, {value})"


def half_up(numerator: str, denominator: str) -> str:
    """Integer quotient, halves rounded away from zero."""
    step = f"IF({numerator} < 0, -({denominator}), {denominator})"
    return f"((({numerator}) * 2 + {step}) div (({denominator}) * 2))"


def as_total(exact_sum: str, beyond_sum: str, digits: int = 2) -> str:
    """The two sums of a measure as one double rounded to ``digits``."""
    return f"coalesce(CAST(round({exact_sum}, {digits}) AS DOUBLE), 0D) + {beyond_sum}"


def as_mean(exact_sum: str, beyond_sum: str, count: str, digits: int = 2) -> str:
    """The two sums over ``count`` values as a double rounded to ``digits``; null for no values."""
    rows = f"nullif({count}, 0)"
    return f"coalesce(CAST(round({exact_sum} / {rows}, {digits}) AS DOUBLE), 0D) + {beyond_sum} / {rows}"


def total(value: str, digits: int = 2) -> str:
    return as_total(f"sum({exact(value)})", f"sum({beyond(value)})", digits)


def mean(value: str, digits: int = 2) -> str:
    return as_mean(f"sum({exact(value)})", f"sum({beyond(value)})", f"count({value})", digits)


def quotient(numerator: str, denominator: str, digits: int) -> str:
    """``numerator / denominator`` of one row, halves rounded away from zero; null for a zero denominator.

    Operands without a decimal are divided as doubles.
    """
    rounded = f"CAST(round({exact(numerator)} / nullif({exact(denominator)}, 0), {digits}) AS DOUBLE)"
    held = f"abs({numerator}) < {LIMIT} AND abs({denominator}) < {LIMIT}"
    return f"IF({held}, {rounded}, {numerator} / nullif(CAST({denominator} AS DOUBLE), 0D))"


def share_pct(part: str, whole: str) -> str:
    """``part`` of ``whole`` (counts) in percent with two digits; null when the whole is zero."""
    return f"{half_up(f'{part} * 10000', f'nullif({whole}, 0)')} / 100D"


def ratio(numerator: str, denominator: str) -> str:
    """``numerator / denominator``, null where the denominator is zero or missing."""
    return f"({numerator} / nullif({denominator}, 0D))"


def mean_ratio_pct(numerator: str, denominator: str, digits: int = 2) -> str:
    """Mean of the row ratios in percent; rows with a zero denominator are skipped."""
    each = ratio(numerator, denominator)
    rows = f"nullif(count({each}), 0)"
    rounded = f"CAST(round(sum({exact(each)}) / {rows}, {digits + 2}) * 100 AS DOUBLE)"
    return f"coalesce({rounded}, 0D) + sum({beyond(each)}) * 100D / {rows}"
