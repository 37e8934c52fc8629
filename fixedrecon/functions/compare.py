"""Field comparison expressions. Each returns a boolean column, never NULL
unless stated, so they can be filtered, counted and tagged alike."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def text_differs(legacy: Column, modern: Column) -> Column:
    """Text comparison in which NULL and '' are the same."""
    return F.coalesce(legacy, F.lit("")) != F.coalesce(modern, F.lit(""))


def text_differs_strict(legacy: Column, modern: Column) -> Column:
    """Plain comparison: NULL on either side gives NULL, not a mismatch."""
    return legacy != modern


def as_number(text: Column, decimals: int = 0) -> Column:
    """Number in the text or NULL; ``decimals`` places an implied point."""
    number = F.when(text != "", text.try_cast("double"))
    return number / F.lit(float(10**decimals)) if decimals else number


def beyond_tolerance(
    legacy: Column,
    modern: Column,
    tolerance: float,
    both_present: Column,
    decimals: int = 0,
) -> Column:
    """Numeric comparison. Where either side is not a number the text decides;
    a record without partner is never beyond a tolerance."""
    left, right = as_number(legacy, decimals), as_number(modern, decimals)
    return (
        F.when(left.isNotNull() & right.isNotNull(), F.abs(left - right) > F.lit(float(tolerance)))
        .when(both_present, text_differs(legacy, modern))
        .otherwise(F.lit(False))
    )


def describe_difference(field: str, legacy: Column, modern: Column) -> Column:
    """``FIELD:L[x]!=M[y]`` with NULL spelled out."""
    return F.concat(
        F.lit(f"{field}:L["),
        F.coalesce(legacy, F.lit("NULL")),
        F.lit("]!=M["),
        F.coalesce(modern, F.lit("NULL")),
        F.lit("]"),
    )


def any_of(conditions: list[Column]) -> Column:
    """Balanced OR, so that wide layouts do not make a deep expression."""
    if not conditions:
        return F.lit(False)
    while len(conditions) > 2:
        conditions = [
            reduce(lambda a, b: a | b, conditions[i : i + 2]) for i in range(0, len(conditions), 2)
        ]
    return reduce(lambda a, b: a | b, conditions)
