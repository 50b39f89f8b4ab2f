"""Conditionals and predicates that treat missing values the way the study does.

A missing condition gives a missing result in ``if_else``; membership is never
missing; a missing value counts as one more distinct value; missing sorts last.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _lit(v) -> Column:
    return v if isinstance(v, Column) else F.lit(v)


def if_else(condition: Column, yes, no) -> Column:
    """``yes`` when true, ``no`` when false, null when the condition is null."""
    return F.when(condition, _lit(yes)).when(~condition, _lit(no))


def isin_(c, values) -> Column:
    """Membership that is false, not null, for a missing value."""
    return F.coalesce(_col(c).isin(list(values)), F.lit(False))


def not_in_(c, values) -> Column:
    """Negated membership that keeps rows with a missing value."""
    return ~isin_(c, values)


def n_distinct(c, count_null: bool = True) -> Column:
    """Distinct values; a missing value counts as one unless told otherwise."""
    col = _col(c)
    n = F.count_distinct(col)
    if count_null:
        n = n + F.coalesce(F.max(col.isNull().cast("long")), F.lit(0))
    return n.cast("long")


def sum_or_null(c) -> Column:
    """A sum that is null as soon as one input is null."""
    col = _col(c)
    return F.when(F.count(F.lit(1)) == F.count(col), F.sum(col))


def ratio(numerator, denominator) -> Column:
    """Division that gives an infinity or NaN, not an error, for a zero divisor."""
    a, b = _col(numerator).cast("double"), _col(denominator).cast("double")
    return F.when(b == 0, a * F.lit(float("inf"))).otherwise(a / b)


def row_sum(*cols) -> Column:
    """Sum across columns of one row, missing values counted as zero."""
    return reduce(lambda a, b: a + b, [F.coalesce(_col(c), F.lit(0)) for c in cols])


def blank_to_null(c) -> Column:
    return F.nullif(_col(c), F.lit(""))


def coalesce_blank(c, *others) -> Column:
    """First of the given values that is neither missing nor empty text."""
    return F.coalesce(blank_to_null(c), *[_lit(o) for o in others])


def nulls_last(*cols, descending: bool = False) -> list[Column]:
    """Sort keys with missing values last in both directions."""
    return [
        _col(c).desc_nulls_last() if descending else _col(c).asc_nulls_last() for c in cols
    ]
