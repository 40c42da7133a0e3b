from __future__ import annotations

from functools import reduce
from operator import and_, or_

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_null(*names: str) -> Column:
    return reduce(or_, (F.col(name).isNull() for name in names))


def none_null(*names: str) -> Column:
    return reduce(and_, (F.col(name).isNotNull() for name in names))


def ratio(numerator: Column, denominator: Column) -> Column:
    """Division that is NULL, not an error, when the divisor is 0 or NULL."""
    return F.try_divide(numerator, denominator)


def capped(name: str, cap: int) -> Column:
    return F.least(F.col(name), F.lit(cap))


def flag(condition: Column) -> Column:
    return condition.cast("int")


def outside_domain(name: str, *allowed: int) -> Column:
    """NULL for a NULL value, so missing values pass the check."""
    return ~F.col(name).isin(*allowed)


def outside_range(name: str, low: float, high: float) -> Column:
    """NULL passes; NaN sorts above every number and therefore fails."""
    return (F.col(name) < low) | (F.col(name) > high)
