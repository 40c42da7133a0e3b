"""Column expressions used by the plans."""

from basket_marts.functions.columns import (
    any_null,
    capped,
    flag,
    none_null,
    outside_domain,
    outside_range,
    ratio,
)

__all__ = [
    "any_null",
    "capped",
    "flag",
    "none_null",
    "outside_domain",
    "outside_range",
    "ratio",
]
