"""Header cleaning and selection by name; all of it works on the schema, never on rows."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.nulls import as_col
from tallyline.functions.nulls import to_number as number_of


def snake_case(header: str) -> str:
    """Lower snake case; signs are spelled out and a leading digit gets an 'x'."""
    spelled = header.replace("%", "_percent_").replace("#", "_number_")
    split_words = re.sub(r"([a-z0-9])([A-Z])", r"\1_\2", spelled)
    split_words = re.sub(r"([A-Z]+)([A-Z][a-z])", r"\1_\2", split_words)
    name = re.sub(r"[^0-9A-Za-z]+", "_", split_words).strip("_").lower()
    if not name:
        return "x"
    return f"x{name}" if name[0].isdigit() else name


def clean_headers(headers: Iterable[str]) -> list[str]:
    """Snake case for all headers; repeats get a running number from 2 on."""
    seen: dict[str, int] = {}
    taken: list[str] = []
    for header in headers:
        name = snake_case(header)
        free = name
        while free in taken:
            seen[name] = seen.get(name, 1) + 1
            free = f"{name}_{seen[name]}"
        taken.append(free)
    return taken


def clean_names(df: DataFrame) -> DataFrame:
    return df.toDF(*clean_headers(df.columns))


def pick_names(
    names: Iterable[str],
    contains: Iterable[str] = (),
    starts_with: Iterable[str] = (),
    ends_with: Iterable[str] = (),
) -> list[str]:
    """Names that satisfy any of the patterns; case is ignored."""
    def hit(name: str) -> bool:
        low = name.lower()
        return (
            any(c.lower() in low for c in contains)
            or any(low.startswith(s.lower()) for s in starts_with)
            or any(low.endswith(e.lower()) for e in ends_with)
        )

    return [name for name in names if hit(name)]


def keep_matching(df: DataFrame, **patterns) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in pick_names(df.columns, **patterns)])


def drop_matching(df: DataFrame, **patterns) -> DataFrame:
    return df.drop(*pick_names(df.columns, **patterns))


def numeric_columns(df: DataFrame, besides: Iterable[str] = ()) -> list[str]:
    kinds = ("double", "float", "int", "bigint", "smallint", "tinyint", "decimal")
    return [c for c, kind in df.dtypes if kind.split("(")[0] in kinds and c not in set(besides)]


def rename_all(df: DataFrame, rename: Callable[[str], str], besides: Iterable[str] = ()) -> DataFrame:
    """Rename every column but some through a function."""
    fixed = set(besides)
    return df.withColumnsRenamed({c: rename(c) for c in df.columns if c not in fixed})


def relocate(df: DataFrame, moved: Iterable[str], before: str | None = None, after: str | None = None) -> DataFrame:
    """Move columns in front of (or behind) another one; without an anchor they go first."""
    moved = list(moved)
    others = [c for c in df.columns if c not in moved]
    spot = 0
    if before is not None:
        spot = others.index(before)
    elif after is not None:
        spot = others.index(after) + 1
    return df.select(*[F.col(f"`{c}`") for c in others[:spot] + moved + others[spot:]])


def drop_empty_columns(df: DataFrame) -> DataFrame:
    """Drop columns that hold no value at all. One aggregate over the table yields one row of counts."""
    filled = df.agg(*[F.max(F.col(f"`{c}`").isNotNull()).alias(c) for c in df.columns]).first()
    return df.select(*[F.col(f"`{c}`") for c in df.columns if filled[c]])


def coerce_numbers(df: DataFrame, names: Iterable[str]) -> DataFrame:
    return df.withColumns({c: number_of(c) for c in names})


def keep_any_present(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Keep rows in which at least one of the columns is filled."""
    return df.filter(F.coalesce(*[as_col(c).cast("string") for c in names]).isNotNull())


def keep_complete(df: DataFrame, names: Iterable[str] | None = None) -> DataFrame:
    return df.dropna("any", subset=list(names) if names else None)


def fill_missing(df: DataFrame, labels: dict | None = None, numbers: float | None = None) -> DataFrame:
    """Fill named columns with labels and, on request, all remaining numeric columns with one number."""
    labels = labels or {}
    out = df.fillna(labels) if labels else df
    if numbers is not None:
        out = out.fillna(numbers, subset=numeric_columns(df, besides=labels))
    return out


def restore_label(df: DataFrame, name: str, label: str) -> DataFrame:
    """Put back a label (such as 'NA') that a reader took for a missing value."""
    return df.withColumn(name, F.coalesce(F.col(name), F.lit(label)))


def row_total(names: Iterable[str]) -> Column:
    """Sum across columns; a missing cell makes the total missing."""
    cells = [as_col(c) for c in names]
    total = cells[0]
    for cell in cells[1:]:
        total = total + cell
    return total


def drop_zero_rows(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drop rows whose cells add up to exactly 0."""
    return df.filter(row_total(names) != 0)


def scale(df: DataFrame, names: Iterable[str], divisor: float, digits: int | None = None) -> DataFrame:
    """Divide columns and, on request, round ties to even."""
    def scaled(name: str) -> Column:
        value = F.col(name) / F.lit(divisor)
        return value if digits is None else F.bround(value, digits)

    return df.withColumns({c: scaled(c) for c in names})
