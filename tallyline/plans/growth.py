"""Growth-initiative reporting: operating plan, spend, payroll, capital and sales lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.nulls import lacks, matches, strict_sum, to_number, zero
from tallyline.functions.periods import MONTH_NAMES, month_number
from tallyline.operators.columns import keep_any_present, restore_label
from tallyline.operators.reshape import gather, union_all
from tallyline.operators.rules import Rules, categorise, flag, flag_in, split_measure
from tallyline.operators.totals import add_totals, sum_numeric
from tallyline.operators.windows import first_rows

# Roll-up of plan accounts to the two report levels.
LEVEL_2: Rules = [("Non-C&B", "Opex"), ("C&B", "Opex"), ("Sales", "Sales"), ("SGM", "SGM"), ("Capex", "Capex")]
LEVEL_1: Rules = [("Opex", "Investment"), ("Capex", "Investment"), ("Sales", "Sales"), ("SGM", "SGM")]


def month_cells(df: DataFrame) -> list[str]:
    """The month columns of a wide table, under any capitalisation, in calendar order."""
    by_name = {c.lower(): c for c in df.columns}
    return [by_name[m.lower()] for m in MONTH_NAMES if m.lower() in by_name]


def melt_months(wide: DataFrame, ids: Sequence[str], value: str) -> DataFrame:
    """Month columns to rows with month name, number and quarter; other period columns are ignored."""
    long = gather(wide.select(*ids, *month_cells(wide)), ids, "month", value, month_cells(wide))
    number = month_number("month")
    return (
        long.withColumn("month", F.initcap("month"))
        .withColumn("month_num", number)
        .withColumn("quarter", F.concat(F.lit("Q"), F.ceil(F.col("month_num") / 3).cast("string")))
        .withColumn(value, to_number(F.col(value).cast("string")))
    )


def operating_plan(wide: DataFrame) -> DataFrame:
    """Plan lines in long form: head counts apart from amounts, accounts rolled up to two levels."""
    long = melt_months(restore_label(wide, "team", "NA"), ["team", "growth_initiative", "account"], "value")
    account, heads, amount = split_measure("account", "value", "HC", "C&B")
    split = long.select("team", "growth_initiative", "month", "month_num", "quarter", account.alias("account"), heads.alias("ftes_started"), amount.alias("op"))
    leveled = split.withColumn("account_l2", categorise("account", LEVEL_2))
    return leveled.withColumn("account_l1", categorise("account_l2", LEVEL_1))


def plan_summary(plan: DataFrame) -> DataFrame:
    """Plan per account with quarters as columns; the levels are attributes of the account."""
    keys = ["account", "account_l2", "account_l1"]
    volume = F.count(F.lit(1)).alias("volume")
    quarters = [F.sum(F.when(F.col("quarter") == f"Q{q}", F.col("op"))).alias(f"Q{q}") for q in range(1, 5)]
    return plan.groupBy(*keys).agg(volume, *quarters)


def initiative_amounts(
    wide: DataFrame, details: Sequence[str], keys: Sequence[str], account: str, level_2: str, level_1: str, value: str, missing_as_zero: bool = False
) -> DataFrame:
    """Spend or capital lines: rows with any detail filled, months to rows, summed per key and month.

    The sum is missing as soon as one amount is; a forecast takes missing amounts as 0.
    """
    filled = keep_any_present(restore_label(wide, "team", "NA"), details)
    long = melt_months(filled, keys, value)
    amount = zero(value) if missing_as_zero else F.col(value)
    summed = long.withColumn(value, amount).groupBy(*keys, "month", "month_num", "quarter").agg(strict_sum(value).alias(value))
    return summed.withColumns({"account": F.lit(account), "account_l2": F.lit(level_2), "account_l1": F.lit(level_1)})


PAYROLL_KEYS = ("growth_initiative", "team", "country", "hiring_status")


def payroll_actuals(wide: DataFrame, details: Sequence[str], hired: Sequence[str], keys: Sequence[str] = PAYROLL_KEYS) -> DataFrame:
    """Payroll per key and month with hired, started and estimated heads.

    A head counts as hired by its status and as started once it is paid; each line estimates one head.
    """
    filled = keep_any_present(wide, details)
    long = melt_months(filled, keys, "actuals")
    flagged = long.withColumns({"hired": flag_in("hiring_status", hired), "started": F.when(F.col("actuals").isNotNull(), flag(F.col("actuals") > 0))})
    summed = flagged.groupBy(*keys, "month", "month_num", "quarter").agg(
        strict_sum("actuals").alias("actuals"), F.sum("hired").alias("ftes_hired"), strict_sum("started").alias("ftes_started"), F.count(F.lit(1)).alias("fte_estimated")
    )
    return summed.withColumns({"account": F.lit("C&B"), "account_l2": F.lit("Opex"), "account_l1": F.lit("Investment")})


def payroll_forecast(wide: DataFrame, details: Sequence[str], person: Sequence[str], keys: Sequence[str] = PAYROLL_KEYS) -> DataFrame:
    """Payroll forecast in two steps: per person and month, then per key with the heads that are paid."""
    filled = keep_any_present(wide, details).filter(F.col("growth_initiative").isNotNull())
    ids = [*keys, *[p for p in person if p not in keys]]
    long = restore_label(melt_months(filled, ids, "forecast"), "team", "NA").withColumn("forecast", zero("forecast"))
    per_person = long.groupBy(*ids, "month", "month_num", "quarter").agg(F.sum("forecast").alias("forecast"))
    paid = per_person.withColumn("paid", flag(F.col("forecast") > 0))
    summed = paid.groupBy(*keys, "month", "month_num", "quarter").agg(F.sum("forecast").alias("forecast"), F.sum("paid").alias("forecasted_ftes"))
    return summed.withColumns({"account": F.lit("C&B"), "account_l2": F.lit("Opex"), "account_l1": F.lit("Investment")})


def sales_lines(wide: DataFrame, order: Sequence[Column | str], value: str, accounts: Sequence[str] = ("SGM", "Sales"), header: str = "Init", per_key: int = 2) -> DataFrame:
    """Sales and margin lines: the first rows per region and initiative, months to rows."""
    kept = wide.filter(F.col("account").isin(list(accounts)) & F.col("growth_initiative").isNotNull() & lacks("growth_initiative", header))
    first = first_rows(restore_label(kept, "region", "NA"), ["region", "growth_initiative"], order, per_key)
    long = melt_months(first.withColumnRenamed("region", "team"), ["team", "growth_initiative", "account"], value)
    return long.withColumns({"account_l1": F.col("account"), "account_l2": F.col("account")})


def sales_forecast(lines: DataFrame, value: str = "forecast") -> DataFrame:
    keys = ["team", "growth_initiative", "account", "account_l1", "account_l2", "month", "month_num", "quarter"]
    return lines.groupBy(*keys).agg(strict_sum(value).alias(value))


def initiative_matrix(wide: DataFrame, theme: str) -> DataFrame:
    """Initiatives of one theme by month, missing amounts as 0.

    The table is wide already, so the months are summed as they stand.
    """
    chosen = restore_label(wide.filter(matches("growth_initiative", theme)), "team", "NA")
    cells = month_cells(chosen)
    return chosen.groupBy("team", "growth_initiative").agg(*[F.sum(zero(c)).alias(c) for c in cells])


def theme_report(tables: dict[str, DataFrame], theme: str) -> DataFrame:
    """Initiative matrices of several accounts with a totals row."""
    stacked = union_all(*[initiative_matrix(df, theme).withColumn("account", F.lit(name)) for name, df in tables.items()])
    return add_totals(stacked, "team")


def account_totals(report: DataFrame) -> DataFrame:
    return sum_numeric(report.filter(F.col("account") != "-"), ["account"])
