"""Rule lists applied as one CASE expression per column."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from tallyline.functions.nulls import as_col, if_else, one_of

Rules = Sequence[tuple[str, str]]


def categorise(text, rules: Rules, default: str | None = None, regex: bool = False) -> Column:
    """Label of the first rule whose keyword occurs in the text.

    Without a match the default applies; without a default the text itself is kept.
    Missing text matches no rule.
    """
    text = as_col(text)
    fallback = F.lit(default) if default is not None else text
    chain = None
    for keyword, label in rules:
        test = text.rlike(keyword) if regex else text.contains(keyword)
        chain = F.when(test, F.lit(label)) if chain is None else chain.when(test, F.lit(label))
    return fallback if chain is None else chain.otherwise(fallback)


def relabel(value, mapping: dict, default=None) -> Column:
    """Exact-value relabelling; other values are kept unless a default is given."""
    value = as_col(value)
    fallback = value if default is None else F.lit(default)
    chain = None
    for old, new in mapping.items():
        test = value == F.lit(old)
        chain = F.when(test, F.lit(new)) if chain is None else chain.when(test, F.lit(new))
    return fallback if chain is None else chain.otherwise(fallback)


def rank_of(value, order: Iterable) -> Column:
    """Position of a value in a presentation order, from 1; NULL when it is not listed."""
    listed = F.array(*[F.lit(v) for v in order])
    return F.nullif(F.array_position(listed, as_col(value)).cast("int"), F.lit(0))


def override_name(name, value, instead, watched: str, above: float, below: float | None = None) -> Column:
    """Replace a watched name by another column when the amount passes a threshold."""
    name, value, instead = as_col(name), as_col(value), as_col(instead)
    out = if_else((name == watched) & (value > above), instead, name)
    if below is not None:
        out = if_else((name == watched) & (value < below), instead, out)
    return out


def split_measure(account, value, counted: str, booked_as: str) -> tuple[Column, Column, Column]:
    """Split one measure into (account, count, amount): rows of the counted account carry
    a head count, all others an amount; the counted account is re-booked under another one."""
    account, value = as_col(account), as_col(value)
    is_count = account == counted
    return (
        if_else(is_count, F.lit(booked_as), account),
        if_else(is_count, value, F.lit(0.0)),
        if_else(is_count, F.lit(0.0), value),
    )


def flag(condition: Column) -> Column:
    """1 or 0; a missing condition counts as 0."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def flag_in(value, members: Iterable) -> Column:
    return one_of(value, members).cast("int")


def convert(amount, rate: float) -> Column:
    return as_col(amount) * F.lit(float(rate))


def remainder_to_target(rate, amount, target: float, paid: float) -> Column:
    """What is left of a converted amount after the open part of a target."""
    return as_col(rate) * as_col(amount) - F.lit(float(target) - float(paid))


def signed(amount, kind, negative_kind: str) -> Column:
    """Flip the sign of one transaction kind."""
    return if_else(as_col(kind) == negative_kind, -as_col(amount), as_col(amount))
