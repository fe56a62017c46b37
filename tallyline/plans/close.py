"""Monthly close: ledger actuals, plan and forecast facts, variances over date windows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.nulls import if_else, lacks, matches, none_of, strict_sum, strict_sum_where, zero
from tallyline.functions.periods import (
    MONTH_ABBREVIATIONS, SPREADSHEET_ORIGIN, from_serial, month_of, month_start, quarter_label,
)
from tallyline.functions.text import piece
from tallyline.operators.reshape import gather, union_all
from tallyline.operators.rules import Rules, categorise, override_name
from tallyline.operators.totals import sum_numeric

TYPES = {"actuals": "actuals", "forecast": "fcast", "op": "op"}


def first_of_year(day: date) -> date:
    return date(day.year, 1, 1)


def first_of_quarter(day: date) -> date:
    return date(day.year, (day.month - 1) // 3 * 3 + 1, 1)


def statement_windows(as_of: date) -> dict[str, tuple[date, date]]:
    """Month, quarter and year to date, each bounded by the year of the statement month."""
    month = date(as_of.year, as_of.month, 1)
    return {"YTD": (first_of_year(month), month), "QTD": (first_of_quarter(month), month), "MTD": (month, month)}


def as_facts(detail: DataFrame, kind: str) -> DataFrame:
    return detail.select("category", "period", quarter_label("period").alias("quarter"), F.lit(kind).alias("type"), "value")


# ---------------------------------------------------------------- ledger actuals

def close_lines(
    ledger: DataFrame,
    rules: Rules,
    excluded: Sequence[str] = (),
    clearing: str | None = None,
    watched: str | None = None,
    above: float = 0.0,
    below: float | None = None,
    default: str = "Others",
    as_of: date | None = None,
) -> DataFrame:
    """Postings per cost element, name and month with clearing amounts and category, up to the month of `as_of` if given.

    `ledger` has cost_element, cost_element_name, offset_account, year, period (month), value.
    A watched name is replaced by its offset account beyond the thresholds. Clearing amounts are
    the postings whose offset account matches a pattern; they are found under the name as posted.

    The clearing amounts need no join: every posting is emitted under its final name and, if it is
    a clearing posting, under its posted name, and both meet in one aggregation.
    """
    if as_of is not None:
        # On the columns as posted, so that the range reaches the scan of the ledger.
        ledger = ledger.filter((F.col("year") < as_of.year) | ((F.col("year") == as_of.year) & (F.col("period") <= as_of.month)))
    name = F.col("cost_element_name")
    final = name if watched is None else override_name(name, "value", "offset_account", watched, above, below)
    counts = none_of("cost_element", excluded)
    clears = matches("offset_account", clearing) if clearing else F.lit(False)

    def entry(label: Column, own: Column, cleared: Column) -> Column:
        return F.struct(
            label.alias("cost_element_name"),
            own.alias("own"),
            F.when(own, F.col("value")).alias("actual"),
            F.when(cleared, F.col("value")).alias("clearing"),
        )

    if clearing is None:
        entries = F.array(entry(final, counts, F.lit(False)))
    else:
        same = final.eqNullSafe(name)
        entries = F.when(same, F.array(entry(name, counts, clears))).otherwise(
            F.array(entry(final, counts, F.lit(False)), entry(name, F.lit(False), clears))
        )
    keys = ["cost_element", "cost_element_name", "year", "period"]
    posted = ledger.select("cost_element", "year", "period", "value", F.explode(entries).alias("e")).select(
        "cost_element", F.col("e.cost_element_name"), "year", "period", "e.own", "e.actual", "e.clearing"
    )
    summed = posted.groupBy(*keys).agg(
        F.count_if("own").alias("__rows"),
        F.when(F.count_if("own") == F.count("actual"), F.sum("actual")).alias("actual"),
        F.sum("clearing").alias("clearing_account"),
    )
    kept = summed.filter(F.col("__rows") > 0).drop("__rows")
    amounts = kept.withColumns({"actual": zero("actual"), "clearing_account": zero("clearing_account")})
    return amounts.select(
        categorise("cost_element_name", rules, default).alias("category"),
        "cost_element",
        "cost_element_name",
        month_of("year", "period").alias("period"),
        "actual",
        "clearing_account",
        (F.col("actual") - F.col("clearing_account")).alias("gross"),
    )


def up_to(lines: DataFrame, as_of: date, origin: str) -> DataFrame:
    """Lines whose serial date lies in the month of `as_of` or before; the bound is a literal on the serial as stored."""
    following = date(as_of.year + as_of.month // 12, as_of.month % 12 + 1, 1)
    return lines.filter(F.col("period") < F.lit((following - date.fromisoformat(origin)).days))


def amortization_split(
    lines: DataFrame, rules: Rules, as_of: date, prefix: str, default: str = "Other projects", origin: str = SPREADSHEET_ORIGIN
) -> DataFrame:
    """Amortization per project and month: description to project, amounts made positive."""
    project = F.concat_ws("/", F.lit(prefix), categorise("description", rules, default))
    split = up_to(lines, as_of, origin).select(project.alias("category"), month_start(from_serial("period", origin)).alias("period"), F.abs("value").alias("value"))
    return split.groupBy("category", "period").agg(strict_sum("value").alias("value"))


def ledger_actuals(
    lines: DataFrame, as_of: date, amortization: DataFrame | None = None, replaced: str | None = None, capitalized: str | None = None
) -> DataFrame:
    """Actuals facts from close lines.

    Categories matching `replaced` give way to the amortization lines; `capitalized` names the extra
    line that holds all clearing amounts of a month.
    """
    upto = lines.filter(F.col("period") <= F.lit(as_of))
    own = F.struct(F.col("category"), F.col("gross").alias("value"))
    if replaced:
        own = F.when(lacks("category", replaced), own)
    entries = [own]
    if capitalized:
        entries.append(F.struct(F.lit(capitalized).alias("category"), F.col("clearing_account").alias("value")))
    # Both lines of a posting go through the same aggregation, so the close lines are built once.
    booked = upto.select("period", F.explode(F.array_compact(F.array(*entries))).alias("e")).select("e.category", "period", "e.value")
    actuals = booked.groupBy("category", "period").agg(strict_sum("value").alias("value"))
    if amortization is not None:
        actuals = union_all(actuals, amortization.filter(F.col("period") <= F.lit(as_of)))
    return as_facts(actuals, "actuals")


# ---------------------------------------------------------------- plan and forecast

def planned_facts(lines: DataFrame, kind: str, as_of: date, merged: tuple[str, str] | None = None, origin: str = SPREADSHEET_ORIGIN) -> DataFrame:
    """Plan or forecast lines with a serial date as month facts.

    `merged` is (keyword, label): categories containing the keyword are booked under the label.
    """
    category = F.col("category")
    if merged:
        category = if_else(category.contains(merged[0]), F.lit(merged[1]), category)
    months = up_to(lines, as_of, origin).select(category.alias("category"), month_start(from_serial("period", origin)).alias("period"), "value")
    summed = months.groupBy("category", "period").agg(strict_sum("value").alias("value"))
    return as_facts(summed, kind)


# ---------------------------------------------------------------- variances

def window_variances(facts: DataFrame, windows: dict[str, tuple[date, date]], by: Sequence[str] = ("category",)) -> DataFrame:
    """Actuals, forecast and plan per window with the variances VF and VOP, in one aggregation.

    A category without rows in a window has NULLs there; a type without rows counts as 0.
    Rows outside all windows are filtered before the shuffle.
    """
    first = min(lo for lo, _ in windows.values())
    last = max(hi for _, hi in windows.values())
    period = F.col("period")
    inside = facts.filter(period.between(F.lit(first), F.lit(last)))
    cells = []
    for name, (lo, hi) in windows.items():
        here = period.between(F.lit(lo), F.lit(hi))
        cells.append(F.count_if(here).alias(f"{name}__rows"))
        for title, kind in TYPES.items():
            cells.append(zero(strict_sum_where("value", here & (F.col("type") == kind))).alias(f"{name}_{title}_sum"))
    summed = inside.groupBy(*by).agg(*cells)
    out = [F.col(c) for c in by]
    for name in windows:
        seen = F.col(f"{name}__rows") > 0
        actual, forecast, plan = (F.col(f"{name}_{title}_sum") for title in TYPES)
        shown = {"actuals": actual, "forecast": forecast, "VF": actual - forecast, "OP": plan, "VOP": actual - plan}
        out += [F.when(seen, value).alias(f"{name}_{title}") for title, value in shown.items()]
    return summed.select(*out)


def window_columns(name: str) -> list[str]:
    return [f"{name}_{title}" for title in ("actuals", "forecast", "VF", "OP", "VOP")]


def statement(facts: DataFrame, as_of: date, name: str, by: Sequence[str] = ("category",)) -> DataFrame:
    """One window of the statement: MTD, QTD or YTD."""
    return window_variances(facts, {name: statement_windows(as_of)[name]}, by)


def in_units(df: DataFrame, unit: float, besides: Sequence[str]) -> DataFrame:
    """Amounts in whole units, ties to even; differences are taken before rounding."""
    return df.select(*[F.col(c) if c in besides else F.bround(F.col(c) / unit, 0).alias(c) for c in df.columns])


def split_category(df: DataFrame, separator: str = "-") -> DataFrame:
    """'category - vendor' into two trimmed columns; '/' in the category becomes '-'."""
    category = F.regexp_replace(F.trim(piece("category", separator, 0)), "/", "-")
    vendor = F.trim(piece("category", separator, 1))
    others = [c for c in df.columns if c != "category"]
    return df.select(category.alias("category"), vendor.alias("vendor"), *others)


def statement_overview(facts: DataFrame, as_of: date, by: Sequence[str] = ("category",)) -> DataFrame:
    """Month, quarter and year to date side by side, split into category and vendor."""
    summed = split_category(window_variances(facts, statement_windows(as_of), by))
    dims = [c for c in by if c != "category"] + ["category", "vendor"]
    return summed.select(*dims, *window_columns("MTD"), *window_columns("QTD"), *window_columns("YTD"))


def consolidate(overviews: Sequence[DataFrame], merged: tuple[str, str] | None = None) -> DataFrame:
    """Units added up by category and vendor; categories with the keyword are merged."""
    stacked = union_all(*overviews)
    if merged:
        category = F.col("category")
        stacked = stacked.withColumn("category", if_else(category.contains(merged[0]), F.lit(merged[1]), category))
    return sum_numeric(stacked, ["category", "vendor"])


def detailed_report(classes: dict[str, DataFrame]) -> DataFrame:
    """Facts of several units with a class label and the category split into category and detail.

    The part behind '/' is the detail, else the part behind '-', else the category itself.
    """
    labelled = union_all(*[facts.withColumn("class", F.lit(name)) for name, facts in classes.items()])
    main = piece("category", "/", 0)
    category = F.trim(piece(main, "-", 0))
    detail = F.coalesce(F.trim(piece("category", "/", 1)), F.trim(piece(main, "-", 1)), category)
    others = [c for c in labelled.columns if c != "category"]
    return labelled.select(category.alias("category"), detail.alias("detail"), *others)


def overview(facts: DataFrame, keys: Sequence[str] = ("category", "type"), fill: float | None = None) -> DataFrame:
    """Months and quarters as columns, one row per keys and year, in one aggregation."""
    cells = [F.sum(F.when(F.month("period") == i, F.col("value"))).alias(n) for i, n in enumerate(MONTH_ABBREVIATIONS, 1)]
    cells += [F.sum(F.when(F.quarter("period") == q, F.col("value"))).alias(f"Q{q}") for q in range(1, 5)]
    wide = facts.groupBy(*keys, F.year("period").alias("year")).agg(*cells)
    return wide if fill is None else wide.fillna(fill, subset=MONTH_ABBREVIATIONS + [f"Q{q}" for q in range(1, 5)])


def consolidated(frames: Sequence[DataFrame], fill: float = 0.0) -> DataFrame:
    """Overviews of all types in one table, missing amounts as 0, months then quarters.

    The facts are stacked first, so all types share one aggregation.
    """
    cells = MONTH_ABBREVIATIONS + [f"Q{q}" for q in range(1, 5)]
    return overview(union_all(*frames), fill=fill).select("category", "type", "year", *cells)


def cross_table(wide: DataFrame, first: str = "actuals", others: Sequence[str] = ("op", "fcast")) -> DataFrame:
    """Amounts of several types side by side for the categories and years of the first type.

    The types are spread in one aggregation instead of one join per type.
    """
    cells = [c for c in wide.columns if c not in ("category", "type", "year")]
    kinds = [first, *others]
    spread_cells = [F.sum(F.when(F.col("type") == k, F.col(c))).alias(f"{c}_{k}") for k in kinds for c in cells]
    folded = wide.groupBy("category", "year").agg(*spread_cells, F.max(F.col("type") == first).alias("__first"))
    return folded.filter("__first").drop("__first")


def refeed(wide: DataFrame, kind: str | None = "actuals", drop: Sequence[str] = ("Q1", "Q2", "Q3", "Q4")) -> DataFrame:
    """Month columns of a wide report back to long rows."""
    kept = wide.filter(F.col("type") == kind).drop("type") if kind else wide
    kept = kept.drop(*drop)
    return gather(kept, ["category", *(["year"] if "year" in kept.columns else [])], "period", "value")


def refeed_serial(wide: DataFrame, origin: str = SPREADSHEET_ORIGIN) -> DataFrame:
    """Columns named by serial dates back to long month rows."""
    long = gather(wide, ["category"], "period", "value")
    return long.withColumn("period", month_start(from_serial(F.col("period").try_cast("int"), origin)))
