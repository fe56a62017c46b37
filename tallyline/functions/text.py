"""Text pieces, padding and month/day parsing as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyline.functions.nulls import ColumnOrName, as_col


def slice_text(text: ColumnOrName, start: int, stop: int) -> Column:
    """Characters start..stop, both inclusive and counted from 1; a start of 0 means 1."""
    first = max(start, 1)
    return F.substring(as_col(text), first, max(stop - first + 1, 0))


def piece(text: ColumnOrName, separator: str, position: int) -> Column:
    """The piece at a position (from 0) after a regex split; NULL when there are fewer."""
    return F.get(F.split(as_col(text), separator), F.lit(position))


def extract_or_null(text: ColumnOrName, pattern: str, group: int = 0) -> Column:
    """First regex match, NULL instead of '' where nothing matches."""
    return F.when(as_col(text).rlike(pattern), F.regexp_extract(as_col(text), pattern, group))


def digits_only(text: ColumnOrName) -> Column:
    return F.regexp_replace(as_col(text), r"\D", "")


def pad_code(code: ColumnOrName, full_width: int, prefix: str, short_prefix: str) -> Column:
    """Prefix a code; codes that are not full width take the longer prefix. NULL stays NULL."""
    code = as_col(code)
    return F.when(F.length(code) == full_width, F.concat(F.lit(prefix), code)).when(
        F.length(code) != full_width, F.concat(F.lit(short_prefix), code)
    )


def grams(text: ColumnOrName, length: Column) -> Column:
    """All distinct substrings of a text that have the given length.

    Their number is bounded by the text itself, so a containment test against a code list
    becomes an equality join instead of a comparison of every text with every code.
    """
    text = as_col(text)
    starts = F.sequence(F.lit(1), F.length(text) - length + 1)
    cut = F.array_distinct(F.transform(starts, lambda i: F.substring(text, i, length)))
    return F.when(F.length(text) >= length, cut)
