"""Headcount and pay."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.nulls import none_of, one_of, strict_sum
from tallyline.functions.periods import month_label, month_of, quarter_label
from tallyline.functions.text import piece, slice_text
from tallyline.operators.joins import join_named, missing_both_ways, without
from tallyline.operators.reshape import spread, spread_found
from tallyline.operators.rules import Rules, categorise, relabel
from tallyline.operators.totals import add_totals


def heads(rosters: DataFrame, centers: dict[str, str]) -> DataFrame:
    """Roster rows of the watched cost centres with the unit and the month taken from 'MM-YYYY'."""
    period = F.col("period")
    watched = rosters.filter(one_of("cost_center", centers))
    date = month_of(slice_text(period, 4, 7), slice_text(period, 0, 2))
    return watched.withColumns({"unit": F.trim(relabel("cost_center", centers)), "date": date}).withColumn("quarter", quarter_label("date")).drop("period")


def head_matrix(rows: DataFrame, months: Sequence[str] | None = None) -> DataFrame:
    """Heads per unit with one column per month label, 0 for a month without heads.

    Without a list of months every month that occurs is a column; with one, `all_months` counts the heads of all.
    """
    counted = rows.select("unit", month_label("date").alias("label"), F.lit(1).alias("n"))
    if months is None:
        return spread_found(counted, ["unit"], "label", "n", fill=0)
    return spread(counted, ["unit"], "label", list(months), "n", fill=0, total="all_months")


def new_heads(rows: DataFrame, month: str, key: str = "name") -> DataFrame:
    """Heads of one month that no other month lists."""
    this = F.col("date") == F.lit(month).cast("date")
    return without(rows.filter(this), rows.filter(~this), [key])


def pay_estimate(rows: DataFrame, payroll: DataFrame, months: int = 12) -> DataFrame:
    """Heads with their monthly pay by earning kind and the estimate for a year."""
    paid = payroll.groupBy("ee_number", "earning_code").agg(strict_sum("earnings").alias("regular"))
    return rows.join(paid, "ee_number", "left").withColumn("year_estimate", F.col("regular") * months)


def split_last_first(rows: DataFrame, name: str) -> DataFrame:
    """'Last,First Middle' into last and first name; the middle name is dropped."""
    rest = piece(name, ",", 1)
    return rows.withColumn("last", piece(name, ",", 0)).withColumn("first", piece(rest, " ", 0)).drop(name)


def split_first_last(rows: DataFrame, name: str) -> DataFrame:
    """'First Last' into two columns; surplus words are dropped."""
    return rows.withColumn("first", piece(name, " ", 0)).withColumn("last", piece(name, " ", 1)).drop(name)


def missing_people(forecast: DataFrame, roster: DataFrame) -> DataFrame:
    """Last names found only in the forecast or only in the roster; missing names are left out."""
    return missing_both_ways(forecast.dropna(subset=["last"]), roster.dropna(subset=["last"]), ["last"], names=("forecast", "roster"))


def payments_of_missing(roster: DataFrame, forecast: DataFrame, payroll: DataFrame) -> DataFrame:
    """Pay lines of people on the roster whose last name the forecast lacks, largest first."""
    absent = without(roster, forecast, ["last"]).dropna()
    return join_named(absent, payroll, {"ee_number": "payroll_number"}).orderBy(F.desc_nulls_last("earnings"), *absent.columns)


def growth_hires(rows: DataFrame, statuses: Sequence[str], blank: Sequence[str] = (), fixed: dict | None = None, layout: Sequence[str] = ()) -> DataFrame:
    """Started hires in a fixed upload layout; the status is compared trimmed and in lower case."""
    normal = rows.withColumn("hiring_status", F.lower(F.trim("hiring_status"))).filter(one_of("hiring_status", statuses))
    out = normal.withColumns({b: F.lit(None).cast("string") for b in blank}).withColumns({k: F.lit(v) for k, v in (fixed or {}).items()})
    return out.select(*layout) if layout else out


def cost_by_category(ledger: DataFrame, rules: Rules, excluded: Sequence[str] = (), header_rule: tuple[str, str] | None = None) -> DataFrame:
    """One month's cost by category and element name with a total.

    A name no rule knows is its own category, unless the document header matches the header rule.
    """
    named = categorise("cost_element_name", rules)
    if header_rule:
        known = categorise("cost_element_name", rules, default="")
        by_header = F.when(F.col("document_header").contains(header_rule[0]), F.lit(header_rule[1])).otherwise(F.col("cost_element_name"))
        named = F.when(known != "", known).otherwise(by_header)
    kept = ledger.filter(none_of("cost_element", excluded)).withColumn("category", named)
    return add_totals(kept.groupBy("category", "cost_element_name").agg(F.sum("value").alias("amount")), "category")


def pay_difference(costs: DataFrame, category: str, forecast: DataFrame, value: str, base: float) -> DataFrame:
    """Actual pay of one category against the forecast total, and the difference as a share of a base."""
    actual = costs.filter(F.col("category") == category).agg(F.sum("amount").alias("actual"))
    planned = forecast.agg(F.sum(value)).scalar()
    return actual.withColumn("forecast", planned).withColumn("difference", F.col("actual") - F.col("forecast")).withColumn(
        "share", F.try_divide(F.col("difference"), F.lit(float(base)))
    )
