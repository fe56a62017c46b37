"""Missing-value rules of spreadsheet-style data, as column expressions.

Spark drops a row whose filter is NULL and raises on division by zero; finance extracts
need both handled the same way everywhere, so every plan goes through these helpers.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def as_col(value: ColumnOrName) -> Column:
    return F.col(value) if isinstance(value, str) else value


def matches(text: ColumnOrName, pattern: str) -> Column:
    """Regex test that is FALSE, not NULL, for missing text."""
    return F.coalesce(as_col(text).rlike(pattern), F.lit(False))


def lacks(text: ColumnOrName, pattern: str) -> Column:
    """Negative regex test; rows with missing text are kept."""
    return ~matches(text, pattern)


def holds(text: ColumnOrName, needle: str) -> Column:
    """Literal substring test that is FALSE for missing text."""
    return F.coalesce(as_col(text).contains(needle), F.lit(False))


def one_of(value: ColumnOrName, members: Iterable) -> Column:
    """Membership that is FALSE for a missing value."""
    return F.coalesce(as_col(value).isin(list(members)), F.lit(False))


def none_of(value: ColumnOrName, members: Iterable) -> Column:
    """Negative membership; rows with a missing value are kept."""
    return ~one_of(value, members)


def if_else(condition: Column, yes, no) -> Column:
    """Two-way choice that is NULL where the condition is NULL."""
    return F.when(condition, yes).when(~condition, no)


def strict_sum(value: ColumnOrName) -> Column:
    """Sum that is NULL as soon as one input is NULL."""
    value = as_col(value)
    return F.when(F.count(value) == F.count(F.lit(1)), F.sum(value))


def strict_sum_where(value: ColumnOrName, condition: Column) -> Column:
    """Strict sum over the rows that satisfy a condition; NULL when there are none."""
    value = as_col(value)
    missing = F.count_if(condition & value.isNull())
    return F.when(missing == 0, F.sum(F.when(condition, value)))


def loose_sum(value: ColumnOrName) -> Column:
    """Sum that skips NULL and is 0 for an all-NULL group."""
    return F.coalesce(F.sum(as_col(value)), F.lit(0.0))


def mean_over_rows(value: ColumnOrName) -> Column:
    """Sum divided by the row count, so rows with NULL count in the denominator."""
    return F.sum(as_col(value)) / F.count(F.lit(1))


def ratio(top: ColumnOrName, bottom: ColumnOrName) -> Column:
    """Division that is 0 where it is undefined."""
    return F.coalesce(F.try_divide(as_col(top), as_col(bottom)), F.lit(0.0))


def ratio_or_null(top: ColumnOrName, bottom: ColumnOrName) -> Column:
    """Division that stays NULL where it is undefined, for use inside longer formulas."""
    return F.try_divide(as_col(top), as_col(bottom))


def zero(value: ColumnOrName) -> Column:
    return F.coalesce(as_col(value), F.lit(0.0))


def to_number(text: ColumnOrName) -> Column:
    """Text to double; NULL where the text is no number."""
    return as_col(text).try_cast("double")


def half_even(value: ColumnOrName, digits: int = 0) -> Column:
    """Rounding with ties to the even digit; negative digits round left of the point."""
    return F.bround(as_col(value), digits)


def basis_points(share: ColumnOrName, digits: int = -1) -> Column:
    return half_even(as_col(share) * 10000, digits)
