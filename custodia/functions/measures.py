"""Exact rounded measures.

Rates and averages are built from integer sums and one single division, then
rounded half away from zero. Sums of whole cents do not depend on the order in
which tasks finish, so a re-run after a lost executor gives the same digits.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def rows() -> Column:
    return F.count(F.lit(1))


def ratio(numerator, denominator, digits: int, factor: float = 1.0) -> Column:
    """``factor * numerator / denominator`` rounded to ``digits``; null when undefined."""
    scale = float(10**digits)
    quotient = F.try_divide(numerator * F.lit(factor * scale), denominator)
    return F.round(quotient) / F.lit(scale)


def pct(part, whole, digits: int = 1) -> Column:
    return ratio(part, whole, digits, factor=100.0)


def hundredths(amount: Column) -> Column:
    """A money or day amount (at most two decimals) as a whole number of hundredths."""
    return F.rint(amount * 100).cast("long")


def from_hundredths(value: Column, digits: int) -> Column:
    """Round a value counted in hundredths (such as a percentile of them) to ``digits``."""
    steadied = F.round(value, 4)
    return F.round(steadied / F.lit(float(10 ** (2 - digits)))) / F.lit(float(10**digits))


def averaged(name: str, amount: Column) -> dict[str, Column]:
    """The two additive parts of an average of ``amount``; see :func:`average`."""
    return {f"{name}_sum": F.sum(hundredths(amount)), f"{name}_n": F.count(amount)}


def average(name: str, digits: int) -> Column:
    return ratio(F.col(f"{name}_sum"), F.col(f"{name}_n") * 100, digits)


def mean(amount: Column, digits: int) -> Column:
    """Rounded average as one aggregate expression (no second grouping step needed)."""
    return ratio(F.sum(hundredths(amount)), F.count(amount) * 100, digits)


def share(condition: Column, digits: int = 1) -> Column:
    """Percentage of the group's rows that meet ``condition``."""
    return pct(F.count_if(condition), rows(), digits)


def where(condition: Column, value: Column) -> Column:
    """``value`` on rows that meet ``condition``, null elsewhere."""
    return F.when(condition, value)


def work_days_to_bail(bail: Column, daily_income: Column) -> Column:
    """Days of the home ZIP's daily income that the bail costs, to one decimal."""
    return ratio(hundredths(bail), hundredths(daily_income), 1)
