"""Order meter, trading results, cash movements, control documents and calendars."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.nulls import matches, one_of, to_number, zero
from tallyline.functions.periods import LATE_ORIGIN, MONTH_ABBREVIATIONS, free_text_day, from_serial, month_number
from tallyline.functions.text import slice_text
from tallyline.operators.reshape import spread
from tallyline.operators.rules import signed
from tallyline.operators.totals import add_totals
from tallyline.operators.windows import fill_down, flatten_text, group_sizes

# Columns of the order meter in report order.
METER = (
    "country", "super_sbu", "gpp_sbu", "super_demand_group", "shipments", "shipments_py", "pd_shipments", "target",
    "total_projection", "new_business", "open_orders", "region", "super_region",
)

# Region codes, shares, status words and labels of the reports, used where the caller gives no others.
HOME_COUNTRIES = ("US", "CAN")
FAR_REGION = ("LATAM", "LAG")
AWAY_REGIONS = ("AMZ", "ANZ")
PRIOR_YEAR_SHARE = 0.7
DAY_LOSS = 0.03
SETTLED = ("Completed", "Approved")
NEGATIVE = "Deposit"
CANCELLED = "Canceled"
NO_DEVIATIONS = "No deviations noted."
NOISE = "Related to"


def home_orders(feed: DataFrame, home: Sequence[str] = HOME_COUNTRIES, far: tuple[str, str] = FAR_REGION) -> DataFrame:
    """The feed that is complete already: regions from countries, open orders under their report name."""
    region = F.when(F.col("country").isin(list(home)), "NA").when(F.col("country") == far[0], far[1]).otherwise(F.col("country"))
    named = feed.withColumnRenamed("unconfirmed", "open_orders").withColumn("region", region)
    place = F.when(F.col("region") == "NA", "North America").otherwise("Rest Of The World")
    return named.withColumn("super_region", place).select(*METER)


def away_orders(feed: DataFrame, place: str, far: Sequence[str] = AWAY_REGIONS, prior_share: float = PRIOR_YEAR_SHARE, day_loss: float = DAY_LOSS) -> DataFrame:
    """The feed without history: projection = shipped + confirmed, placeholders for prior year and prior day."""
    typed = feed.withColumns({c: zero(to_number(c)) for c in ("shipments", "target", "confirmed_today")})
    region = F.when(F.col("region").isin(list(far)), far[-1]).otherwise("EMEA")
    shipped = F.col("shipments")
    return typed.withColumns({
        "total_projection": shipped + F.col("confirmed_today"),
        "shipments_py": shipped * prior_share,
        "pd_shipments": shipped - shipped * day_loss,
        "region": region,
        "super_region": F.lit(place),
        "open_orders": to_number("unconfirmed_today"),
    }).select(*METER)


def order_meter(home: DataFrame, away: DataFrame, run_date: date) -> DataFrame:
    """Both feeds under one layout with the run date; identical rows once."""
    return home.unionByName(away).withColumn("run_date", F.lit(run_date)).distinct()


def trade_days(trades: DataFrame, origin: str = LATE_ORIGIN) -> DataFrame:
    """Trades with amounts as numbers and the closing date in parts."""
    closed = from_serial("closing_serial", origin)
    return trades.withColumn("net_usd", to_number("net_usd")).withColumn("date_close", closed).withColumns(
        {"year": F.year("date_close"), "period": F.month("date_close"), "day": F.dayofmonth("date_close")}
    )


def trade_results(trades: DataFrame, keys: Sequence[str]) -> DataFrame:
    return trades.groupBy(*keys).agg(F.sum("net_usd").alias("net_usd"))


def results_by_direction(trades: DataFrame, symbol: str, years: Sequence[int]) -> DataFrame:
    """Results of one symbol by direction and year."""
    return spread(trades.filter(F.col("symbol") == symbol), ["opening_direction"], "year", list(years), "net_usd")


def results_by_symbol(trades: DataFrame, years: Sequence[int]) -> DataFrame:
    """Results of every symbol by year with the overall result of all years, listed or not."""
    return spread(trades, ["symbol"], "year", list(years), "net_usd", fill=0.0, total="overview")


def cash_movements(moves: DataFrame, statuses: Sequence[str] = SETTLED, negative: str = NEGATIVE) -> DataFrame:
    """Settled movements by kind and account with count and total; deposits count negative."""
    settled = moves.filter(one_of("status", statuses))
    typed = settled.withColumn("amount", signed("amount", "transaction_type", negative))
    summed = typed.groupBy("transaction_type", "trading_account").agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("n"))
    return add_totals(summed, "transaction_type")


def cash_columns(moves: DataFrame, kinds: Sequence[str], keys: Sequence[str], cancelled: str = CANCELLED) -> DataFrame:
    """Amounts of each kind in a column of its own, with a total."""
    kept = moves.filter(F.col("status") != cancelled)
    return add_totals(spread(kept, list(keys), "transaction_type", list(kinds), "amount", fill=0.0), keys[0])


def cash_balance(moves: DataFrame, cancelled: str = CANCELLED) -> DataFrame:
    kept = moves.filter(F.col("status") != cancelled)
    return add_totals(kept.groupBy("transaction_type").agg(F.sum(to_number("amount")).alias("amount")), "transaction_type")


# ---------------------------------------------------------------- control documents

def criteria_descriptions(rows: DataFrame, keys: Sequence[str] = ("criteria",), noise: str = NOISE, part_items: int = 10000) -> DataFrame:
    """Description lines of a criterion joined in document order."""
    known = rows.filter(F.col("description").isNotNull())
    joined = flatten_text(known, list(keys), "description", "criteria_description", separator="", part_items=part_items, order="position")
    return joined.withColumn("criteria", F.trim(F.replace(F.col("criteria"), F.lit(noise), F.lit(""))))


def section_key(text: str, width: int, mark: str):
    """The first characters of a heading, for rows that are headings."""
    head = slice_text(text, 0, width)
    return F.when(matches(head, mark), F.trim(F.replace(head, F.lit(":"), F.lit(""))))


def _sections(rows: DataFrame, doc: str, mark: str, width: int) -> tuple[DataFrame, DataFrame]:
    """Rows with the key of a heading, and the rows of every section under the key that opened it."""
    keyed = rows.withColumn("__key", section_key("control", width, mark))
    filled = fill_down(keyed, [doc], "position", "__key", "policy").filter(F.col("policy").isNotNull())
    return keyed, filled


def _control_lines(filled: DataFrame, doc: str) -> DataFrame:
    """Every control text of a policy once, at its first position."""
    return filled.filter(F.trim("control") != "").groupBy(doc, "policy", F.trim("control").alias("text")).agg(F.min("position").alias("position"))


def policy_table(
    rows: DataFrame, doc: str = "doc", mark: str = "CT", width: int = 9, default: str = NO_DEVIATIONS, noise: str = NOISE
) -> DataFrame:
    """Controls and test results per criterion and policy.

    `rows` has doc, position, criteria, control, test, result. A control text that starts with a policy
    key opens a section; the key is carried down the rows of the document. `n_controls` counts the control
    texts of a policy, which `control_texts` joins; test results are attached by policy.
    """
    keyed, filled = _sections(rows, doc, mark, width)
    criteria = F.trim(F.replace(F.trim("criteria"), F.lit(noise), F.lit("")))
    pairs = keyed.filter(F.col("__key").isNotNull()).select(doc, criteria.alias("criteria"), F.col("__key").alias("policy")).distinct()
    controls = group_sizes(_control_lines(filled, doc), [doc, "policy"], "text", "n_controls")
    tested = filled.filter(F.col("test").isNotNull())
    tests = tested.select(doc, "policy", F.trim("test").alias("test"), F.trim(F.coalesce("result", F.lit(default))).alias("result")).distinct()
    return pairs.join(controls, [doc, "policy"], "inner").join(tests, [doc, "policy"], "left")


def control_texts(rows: DataFrame, doc: str = "doc", mark: str = "CT", width: int = 9, part_items: int = 10000) -> DataFrame:
    """Control texts of every policy joined in document order, in texts of at most `part_items` lines."""
    _, filled = _sections(rows, doc, mark, width)
    return flatten_text(_control_lines(filled, doc), [doc, "policy"], "text", "controls", separator=" ", part_items=part_items, order="position")


def event_calendar(events: DataFrame, text: str) -> DataFrame:
    """Free-text dates parsed to month and day and put in calendar order.

    All columns follow as tie-breakers, so that a day with many events is sorted by several tasks.
    """
    month, day = free_text_day(text)
    parsed = events.withColumn("period", month).withColumn("day", day)
    number = month_number("period", MONTH_ABBREVIATIONS)
    return parsed.filter(F.col("period").isNotNull()).orderBy(number, "day", *events.columns)
