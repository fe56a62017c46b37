"""Exchange rates and the impact of transactional currency amounts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.nulls import lacks, matches, mean_over_rows, none_of, one_of, zero
from tallyline.functions.periods import DAYS_OF_A_YEAR, MONTH_ABBREVIATIONS
from tallyline.operators.columns import drop_zero_rows, rename_all
from tallyline.operators.joins import lookup_with_fallback, missing_both_ways
from tallyline.operators.reshape import spread, stack_measures
from tallyline.operators.totals import add_totals


def daily_rates(sources: Sequence[DataFrame], business_days: DataFrame) -> DataFrame:
    """Rates of all sources on business days, identical rows once, with calendar columns.

    Sources hold from_ccy, date, inverse_spot_rate. Days outside the calendar are dropped before
    the duplicates are removed, so they are not shuffled.
    """
    days = business_days.select(F.col("data_date").alias("__date"), "day", "week", "month")
    stacked = sources[0].select("from_ccy", "date", "inverse_spot_rate")
    for source in sources[1:]:
        stacked = stacked.unionByName(source.select("from_ccy", "date", "inverse_spot_rate"))
    dated = stacked.join(days, F.col("date") == F.col("__date"), "inner").drop("__date")
    return dated.distinct().withColumn("year", F.year("date").cast("string"))


def span(first: str, last: str) -> Column:
    return F.concat_ws(" : ", F.col(first).cast("string"), F.col(last).cast("string"))


def week_number(label: str) -> Column:
    """3 for 'Week 3'. As a number it can be kept in a hash aggregation, which text cannot."""
    return F.trim(F.replace(F.col(label), F.lit("Week"), F.lit(""))).try_cast("int")


def weekly_rates(rates: DataFrame) -> DataFrame:
    """Mean rate per currency and week of a month, with the covered days."""
    weekly = rates.groupBy("from_ccy", "week", "month", "year").agg(
        F.count(F.lit(1)).alias("n_periods_per_week"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        mean_over_rows("inverse_spot_rate").alias("average"),
    )
    return weekly.withColumn("date_range", span("first_date", "last_date")).withColumn("week", week_number("week")).drop("first_date", "last_date")


def monthly_rates(rates: DataFrame, by_year: bool = False) -> DataFrame:
    """Mean rate per currency and month, with the covered days and weeks.

    First and last week follow the date, not the row order. Months of different years fall
    together unless by_year is set.
    """
    keys = ["from_ccy", "month"] + (["year"] if by_year else [])
    number = week_number("week")
    monthly = rates.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_periods"), F.min("date").alias("first_date"), F.max("date").alias("last_date"),
        F.min_by(number, "date").alias("first_week"), F.max_by(number, "date").alias("last_week"),
        mean_over_rows("inverse_spot_rate").alias("avg"),
    )
    return monthly.select(
        *keys, "n_periods", "avg", span("first_date", "last_date").alias("date_range"), F.concat(F.lit("Week "), F.col("first_week").cast("string"), F.lit(" : Week "), F.col("last_week").cast("string")).alias("week_range"),
        F.month("first_date").alias("month_n"),
    )


def rate_matrix(rates: DataFrame, days: Sequence[str] = DAYS_OF_A_YEAR) -> DataFrame:
    """Currencies and years by the days of a year ('03-31'). The days are given, so no job looks for them; one without a rate is empty."""
    labelled = rates.withColumn("day_label", F.date_format("date", "MM-dd"))
    return spread(labelled, ["from_ccy", "year"], "day_label", list(days), "inverse_spot_rate")


def transactional_scope(
    summary: DataFrame, scenario: str, excluded_regions: Sequence[str] = (), excluded_entities: Sequence[str] = ("[none]",)
) -> DataFrame:
    """Rows of one scenario outside the excluded regions and entities, missing amounts as 0."""
    kept = summary.filter(matches("scenario", scenario) & none_of("entity", excluded_entities))
    for pattern in excluded_regions:
        kept = kept.filter(lacks("region", pattern))
    return kept.withColumn("transactional_fx", zero("transactional_fx"))


def transactional_matrix(scope: DataFrame, pnl_rates: DataFrame, keys: Sequence[str], average_cost_markets: Sequence[str], months: Sequence[str] = MONTH_ABBREVIATIONS) -> DataFrame:
    """Amounts by month with the rate of each month beside it; all-zero rows are dropped.

    Markets that run on average cost get the flag 'yes'.
    """
    wide = drop_zero_rows(spread(scope, list(keys), "month", list(months), "transactional_fx", fill=0.0), months)
    rates = rename_all(spread(pnl_rates, ["lc"], "month", list(months), "pnl_rate"), lambda c: f"{c}_pnl_rate", besides=["lc"])
    flagged = wide.withColumn("average_cost", F.when(one_of("market", average_cost_markets), "yes").otherwise("no"))
    beside = [c for m in months for c in (m, f"{m}_pnl_rate")]
    return flagged.join(rates, "lc", "left").select(*keys, "average_cost", *beside)


def transactional_impact(scope: DataFrame, factors: DataFrame, pnl_rates: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Amount x distribution factor, and that x the month's rate, for non-zero impacts.

    Runs on the long form, one row per key and month. The factor is looked up by business and,
    failing that, by market.
    """
    amounts = scope.groupBy(*keys, "month").agg(F.sum("transactional_fx").alias("amount"))
    with_factor = lookup_with_fallback(amounts, factors, "region_market", "factor", "business", "market", on=["month"])
    impact = with_factor.withColumn("impact", F.col("amount") * F.col("factor")).filter(F.col("impact") != 0)
    return impact.join(pnl_rates, ["month", "lc"], "left").withColumn("impact_at_rate", F.col("impact") * F.col("pnl_rate"))


def month_totals(scope: DataFrame) -> DataFrame:
    return add_totals(scope.groupBy("month").agg(F.sum("transactional_fx").alias("transactional_fx")), "month")


def fill_template(template: DataFrame, amounts: DataFrame, key: str, marker: str = "<<") -> DataFrame:
    """Amounts for the lines of an upload template; the marker is stripped from the template key."""
    lines = template.withColumn("entity", F.replace(F.col(key), F.lit(marker), F.lit("")))
    return lines.join(amounts, "entity", "left").fillna(0.0)


def template_gaps(template: DataFrame, amounts: DataFrame, key: str, marker: str = "<<") -> DataFrame:
    """Entities found only in the template or only in the data."""
    lines = template.select(F.replace(F.col(key), F.lit(marker), F.lit("")).alias("entity"))
    return missing_both_ways(lines, amounts, ["entity"], names=("template", "data"))


def tie_out(tracked: DataFrame, reported: DataFrame, tracked_value: str, reported_value: str) -> DataFrame:
    """Difference of the tracked to the reported value per entity; a missing side gives 0."""
    joined = tracked.join(reported, "entity", "left")
    return joined.withColumn("difference", F.col(tracked_value) - F.col(reported_value)).fillna(0.0)


def compress_accounts(tables: dict[str, DataFrame], keys: Sequence[str], months: Sequence[str] = MONTH_ABBREVIATIONS, excluded_segments: Sequence[str] = ()) -> DataFrame:
    """Several account tables (one value column each) wide by month; see compress_long."""
    return compress_long(stack_measures(tables, keys), list(tables), keys, months, excluded_segments)


def compress_long(
    long: DataFrame, accounts: Sequence[str], keys: Sequence[str], months: Sequence[str] = MONTH_ABBREVIATIONS, excluded_segments: Sequence[str] = ()
) -> DataFrame:
    """Accounts (long rows: keys with month, measure, value) wide by month, all-zero rows dropped.

    The first account decides which (key, month) rows exist, as in a chain of left joins. That test
    and the spread over accounts and months run in one wide aggregation instead of one join per account.
    """
    ids = [k for k in keys if k != "month"]

    # One small number stands for account and month, so a cell costs one comparison of numbers.
    position = F.array_position(F.array(*[F.lit(a) for a in accounts]), F.col("measure")) * 100 + F.array_position(F.array(*[F.lit(m) for m in months]), F.col("month"))
    codes = {(a, m): 100 * i + j for i, a in enumerate(accounts, 1) for j, m in enumerate(months, 1)}

    def at(account: str, month: str) -> Column:
        return F.col("cell") == codes[account, month]

    # One row per (ids, month, account) before the wide aggregation, whose every row visits every cell.
    rows = long.filter(none_of("segment", excluded_segments)).groupBy(*ids, position.cast("int").alias("cell")).agg(F.sum("value").alias("value"))
    cells = []
    for account in accounts:
        for month in months:
            total = F.sum(F.when(at(account, month), F.col("value")))
            cells.append(F.coalesce(F.when(F.max(at(accounts[0], month)), total), F.lit(0.0)).alias(f"{account}_{month}"))
    wide = rows.groupBy(*ids).agg(*cells)
    kept = drop_zero_rows(wide, [f"{a}_{m}" for a in accounts for m in months])
    return kept.withColumn("region", F.upper("region"))


def month_columns(compressed: DataFrame, month: str, key: str = "entity") -> DataFrame:
    """The columns of one month of a compressed table."""
    return compressed.select(key, *[c for c in compressed.columns if c.endswith(f"_{month}")])


def categorised_entities(compressed: DataFrame, categories: DataFrame) -> DataFrame:
    """Category columns per entity; currency and region come from the data, not from the lookup."""
    entities = compressed.select("entity", "lc", "region").distinct()
    lookup = categories.select("entity", *[c for c in categories.columns if c not in ("entity", "lc", "region")])
    return entities.join(lookup, "entity", "left")
