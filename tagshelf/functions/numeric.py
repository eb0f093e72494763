"""Exact ratios and rounding, as SQL expressions for `selectExpr` and `F.expr`.

Every function takes and returns the text of an expression. Rounding is done on decimals (half away from
zero), results are doubles.
"""

from __future__ import annotations

from tagshelf.fixed_values import WILSON_Z


def whole(x: str) -> str:
    """An integer as a wide decimal, so that sums and products cannot overflow a bigint."""
    return f"CAST({x} AS DECIMAL(38,0))"


def exact_ratio(numerator: str, denominator: str) -> str:
    """Ratio of two integers with ten exact decimal places; NULL for a zero denominator."""
    return f"(CAST({numerator} AS DECIMAL(28,0)) / nullif(CAST({denominator} AS DECIMAL(20,0)), 0))"


def rounded(x: str, digits: int) -> str:
    """Round half away from zero; doubles lose their binary noise beyond ten places first."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def rounded_ratio(numerator: str, denominator: str, digits: int) -> str:
    return rounded(exact_ratio(numerator, denominator), digits)


def hours(minutes: str) -> str:
    """Minutes (double) to hours with one decimal place."""
    return rounded(f"{minutes} / 60", 1)


def average_hours(total_minutes: str, n: str) -> str:
    """Average of whole minutes in hours, one decimal place, from its exact total and count."""
    return rounded_ratio(total_minutes, f"({n}) * 60", 1)


def approval(positive: str, negative: str) -> str:
    """Share of positive reviews; NULL without reviews."""
    return f"(CAST({positive} AS DOUBLE) / nullif({positive} + {negative}, 0))"


def approval_pct(total_approval: str, n: str) -> str:
    """Average approval in percent, one decimal place, from the sum and count of `approval` values."""
    return rounded(f"{total_approval} / nullif({n}, 0) * 100", 1)


def pearson(sxx: str, syy: str, sxy: str, varies: str) -> str:
    """Pearson correlation from the sums of squares and products about the means; NULL unless both sides vary.

    The built-in `corr` divides by zero on constant groups under ANSI rules.
    """
    return f"CASE WHEN {varies} THEN {sxy} / nullif(sqrt({sxx}) * sqrt({syy}), 0D) END"


def wilson_lower_bound(positive: str, n: str, z: float = WILSON_Z) -> str:
    """Lower end of the one-sided Wilson score interval, in percent; NULL for n = 0."""
    n = f"nullif(CAST({n} AS DOUBLE), 0D)"
    p = f"(CAST({positive} AS DOUBLE) / {n})"
    z, z2 = f"{float(z)!r}D", f"{float(z) * float(z)!r}D"
    margin = f"{z} * sqrt(greatest({p} * (1 - {p}) / {n} + {z2} / (4 * {n} * {n}), 0D))"
    return f"(({p} + {z2} / (2 * {n}) - {margin}) / (1 + {z2} / {n}) * 100)"
