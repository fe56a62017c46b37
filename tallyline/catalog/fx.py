"""Queries for exchange rates and transactional currency impact."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.catalog.registry import Tables, fine, m, ms, query, rounded, s
from tallyline.catalog.views import fx_factors, given, pnl_rates, rates, transactional
from tallyline.functions.periods import DAYS_OF_A_YEAR, MONTH_ABBREVIATIONS, calendar_of
from tallyline.operators import reshape
from tallyline.plans import fx


def sources(t: Tables):
    """Two overlapping extracts of the rates: up to the end of 1998, and from 1998 on."""
    all_rates = rates(t)
    return [all_rates.filter(F.col("date") < F.lit("1999-01-01").cast("date")), all_rates.filter(F.col("date") >= F.lit("1998-01-01").cast("date"))]


def business_rates(t: Tables):
    return fx.daily_rates(sources(t), calendar_of(t.orders, "o_orderdate", business_days_only=True))


DAILY = "SELECT from_ccy, date, inverse_spot_rate, day(date)::INT AS day, 'Week ' || ((day(date) - 1) // 7 + 1) AS week, strftime(date, '%b') AS month, year(date)::VARCHAR AS year FROM rates WHERE isodow(date) <= 5"


@query("X1_daily_rates", given("rates", d=DAILY) + f"SELECT from_ccy, date, {s('inverse_spot_rate', 'inverse_spot_rate', 12)}, day, week, month, year FROM d")
def _(t: Tables):
    return business_rates(t).withColumn("inverse_spot_rate", F.round("inverse_spot_rate", 12))


@query("X2_weekly_rates", given("rates", d=DAILY) + f"""
    SELECT from_ccy, replace(week, 'Week ', '')::INT AS week, month, year, count(*) AS n_periods_per_week, {s('sum(inverse_spot_rate) / count(*)', 'average', 12)}, min(date)::VARCHAR || ' : ' || max(date)::VARCHAR AS date_range
    FROM d GROUP BY 1, week, 2, 3, 4""")
def _(t: Tables):
    return fx.weekly_rates(business_rates(t)).withColumn("average", F.round("average", 12))


@query("X3_monthly_rates", given("rates", d=DAILY) + f"""
    SELECT from_ccy, month, count(*) AS n_periods, {s('sum(inverse_spot_rate) / count(*)', 'avg', 12)}, min(date)::VARCHAR || ' : ' || max(date)::VARCHAR AS date_range,
      arg_min(week, date) || ' : ' || arg_max(week, date) AS week_range, month(min(date))::INT AS month_n FROM d GROUP BY 1, 2""")
def _(t: Tables):
    return fx.monthly_rates(business_rates(t)).withColumn("avg", F.round("avg", 12))


DAY_CELLS = ", ".join(f"""(round(sum(inverse_spot_rate) FILTER (day_label = '{d}'), 12) + 0e0) AS "{d}\"""" for d in DAYS_OF_A_YEAR)


@query("X4_rate_matrix", given("rates", d=DAILY, p="SELECT from_ccy, year, strftime(date, '%m-%d') AS day_label, inverse_spot_rate FROM d") + f"SELECT from_ccy, year, {DAY_CELLS} FROM p GROUP BY from_ccy, year")
def _(t: Tables):
    matrix = fx.rate_matrix(business_rates(t))
    return matrix.select("from_ccy", "year", *[F.round(F.col(f"`{c}`"), 12).alias(c) for c in matrix.columns[2:]])


WATCHED = ["1996-02-29", "1997-07-04", "1999-12-31", "1997-07-05"]


@query("X4_rate_blocks", given("rates", d=DAILY) + "SELECT from_ccy, " + ", ".join(
    f"""{s(f"sum(inverse_spot_rate) FILTER (date = DATE '{day}')", f'"{day}"', 12)}""" for day in WATCHED) + " FROM d WHERE date IN (" + ", ".join(f"DATE '{day}'" for day in WATCHED) + ") GROUP BY from_ccy")
def _(t: Tables):
    """Some days out of the matrix of currencies by all days that occur."""
    daily = business_rates(t).withColumn("label", F.col("date").cast("string"))
    picked = reshape.block_columns(reshape.spread_blocks(daily, ["from_ccy"], "label", "inverse_spot_rate"), ["from_ccy"], WATCHED)
    return picked.select("from_ccy", *[F.round(F.col(f"`{day}`"), 12).alias(day) for day in WATCHED])


KEYS = ["entity", "business", "region", "market", "lc"]
NO_REGIONS = ["ASIA", "MIDDLE"]
AVERAGE_COST = ["NATION_1", "NATION_7", "NATION_23"]


def scope(t: Tables, scenario: str = "ACTUAL"):
    return fx.transactional_scope(transactional(t), scenario, NO_REGIONS, ["Supplier#000000013"])


def scope_sql(scenario: str) -> str:
    return f"SELECT * FROM transactional WHERE scenario = '{scenario}' AND region NOT LIKE '%ASIA%' AND region NOT LIKE '%MIDDLE%' AND entity <> 'Supplier#000000013'"


MONTH_SUM = " + ".join(f"a_{x}" for x in MONTH_ABBREVIATIONS)
MATRIX = {
    "sc": scope_sql("ACTUAL"),
    "w": f"SELECT {', '.join(KEYS)}, " + ", ".join(f"round(sum(CASE WHEN month = '{x}' THEN transactional_fx ELSE 0 END), 2) AS a_{x}" for x in MONTH_ABBREVIATIONS) + " FROM sc GROUP BY 1, 2, 3, 4, 5",
    "pr": "SELECT lc, " + ", ".join(f"max(CASE WHEN month = '{x}' THEN pnl_rate END) AS r_{x}" for x in MONTH_ABBREVIATIONS) + " FROM pnl_rates GROUP BY 1",
}


@query("X5_transactional_matrix", given("transactional", "pnl_rates", **MATRIX) + f"""
    SELECT {', '.join('w.' + k for k in KEYS)}, CASE WHEN market IN ('NATION_1', 'NATION_7', 'NATION_23') THEN 'yes' ELSE 'no' END AS average_cost, """
    + ", ".join(f"{m(f'a_{x}', x)}, {s(f'r_{x}', f'{x}_pnl_rate')}" for x in MONTH_ABBREVIATIONS) + f" FROM w LEFT JOIN pr ON w.lc = pr.lc WHERE {MONTH_SUM} <> 0")
def _(t: Tables):
    matrix = fx.transactional_matrix(scope(t), pnl_rates(t), KEYS, AVERAGE_COST)
    return rounded(matrix, MONTH_ABBREVIATIONS, [f"{x}_pnl_rate" for x in MONTH_ABBREVIATIONS])


@query("X5_month_totals", given("transactional", sc=scope_sql("ACTUAL"), g="SELECT month, sum(transactional_fx) AS v FROM sc GROUP BY 1") + f"SELECT month, {m('v', 'transactional_fx')} FROM g UNION ALL SELECT 'Total', {m('sum(v)')} FROM g")
def _(t: Tables):
    return rounded(fx.month_totals(scope(t)), ["transactional_fx"])


def impact_sql(scenario: str) -> dict[str, str]:
    return {
        "sc": scope_sql(scenario),
        "a": f"SELECT {', '.join(KEYS)}, month, round(sum(transactional_fx), 2) AS amount FROM sc GROUP BY 1, 2, 3, 4, 5, 6",
        "i": """SELECT a.*, coalesce(x.factor, y.factor) AS factor, amount * coalesce(x.factor, y.factor) AS impact FROM a
            LEFT JOIN fx_factors x ON x.region_market = business AND x.month = a.month LEFT JOIN fx_factors y ON y.region_market = market AND y.month = a.month""",
    }


IMPACT_SELECT = f"SELECT {', '.join('i.' + k for k in KEYS)}, i.month, {m('amount', 'amount')}, {s('factor', 'factor')}, {s('impact', 'impact', 8)}, {s('pnl_rate', 'pnl_rate')}, {s('impact * pnl_rate', 'impact_at_rate', 4)} FROM i LEFT JOIN pnl_rates r ON r.month = i.month AND r.lc = i.lc WHERE impact <> 0"


def impact(t: Tables, scenario: str):
    return fx.transactional_impact(scope(t, scenario), fx_factors(t), pnl_rates(t), KEYS)


def shown(df):
    return rounded(df, ["amount"], ["factor", "pnl_rate"]).withColumns(
        {"impact": fine(F.col("impact"), digits=8), "impact_at_rate": fine(F.col("impact_at_rate"), digits=4)}
    )


@query("X6_transactional_impact", given("transactional", "pnl_rates", "fx_factors", **impact_sql("ACTUAL")) + IMPACT_SELECT)
def _(t: Tables):
    return shown(impact(t, "ACTUAL"))


@query("X6_forecast_impact", given("transactional", "pnl_rates", "fx_factors", **impact_sql("FCS")) + IMPACT_SELECT + " AND i.month IN ('Sep', 'Oct', 'Nov', 'Dec')")
def _(t: Tables):
    late = scope(t, "FCS").filter(F.col("month").isin("Sep", "Oct", "Nov", "Dec"))
    return shown(fx.transactional_impact(late, fx_factors(t), pnl_rates(t), KEYS))


UPLOAD = {
    "e": "SELECT entity, sum(transactional_fx) AS amount FROM transactional WHERE scenario = 'ACTUAL' AND region <> 'AFRICA' GROUP BY 1",
    "tp": "SELECT '<<' || s_name AS line, s_name AS entity FROM supplier WHERE s_acctbal > 0",
}


def upload_sides(t: Tables):
    template = t.supplier.filter(F.col("s_acctbal") > 0).select(F.concat(F.lit("<<"), F.col("s_name")).alias("line"))
    amounts = transactional(t).filter((F.col("scenario") == "ACTUAL") & (F.col("region") != "AFRICA")).groupBy("entity").agg(F.sum("transactional_fx").alias("amount"))
    return template, amounts


@query("X7_upload_template", given("transactional", **UPLOAD) + f"SELECT tp.entity, line, {m('coalesce(amount, 0)', 'amount')} FROM tp LEFT JOIN e ON e.entity = tp.entity")
def _(t: Tables):
    return rounded(fx.fill_template(*upload_sides(t), "line"), ["amount"])


@query("X7_template_gaps", given("transactional", **UPLOAD) + """
    SELECT entity, 'template' AS found_in FROM tp WHERE entity NOT IN (SELECT entity FROM e) UNION ALL SELECT entity, 'data' FROM e WHERE entity NOT IN (SELECT entity FROM tp)""")
def _(t: Tables):
    return fx.template_gaps(*upload_sides(t), "line")


@query("X8_entity_tie_out", given("transactional", a="SELECT entity, round(sum(transactional_fx), 2) AS tracked FROM transactional WHERE scenario = 'ACTUAL' GROUP BY 1",
       b="SELECT entity, round(sum(transactional_fx), 2) AS reported FROM transactional WHERE scenario = 'FCS' AND region <> 'ASIA' GROUP BY 1") + f"""
    SELECT a.entity, {m('tracked', 'tracked')}, {m('coalesce(reported, 0)', 'reported')}, {m('coalesce(tracked - reported, 0)', 'difference')} FROM a LEFT JOIN b ON a.entity = b.entity""")
def _(t: Tables):
    rows = transactional(t)
    tracked = rows.filter(F.col("scenario") == "ACTUAL").groupBy("entity").agg(F.sum("transactional_fx").alias("tracked"))
    reported = rows.filter((F.col("scenario") == "FCS") & (F.col("region") != "ASIA")).groupBy("entity").agg(F.sum("transactional_fx").alias("reported"))
    return rounded(fx.tie_out(tracked, reported, "tracked", "reported"), ["tracked", "reported", "difference"])


SEGMENT = "CASE WHEN region = 'EUROPE' THEN 'HQ' ELSE 'Core' END"
ACCOUNT_KEYS = ["segment", "region", "lc", "entity", "month"]
ACCOUNT_FILTERS = {"netsales": "TRUE", "sganda": "business = 'PROMO'", "ocos": "business = 'SMALL'", "sgm": "business = 'LARGE'"}
ACCOUNT_SQL = {a: f"SELECT {SEGMENT} AS segment, lower(region) AS region, lc, entity, month, sum(transactional_fx) AS {a} FROM transactional WHERE {f} GROUP BY 1, 2, 3, 4, 5" for a, f in ACCOUNT_FILTERS.items()}
JOINED = {"j": "SELECT netsales.*, sganda, ocos, sgm FROM netsales " + " ".join(f"LEFT JOIN {a} USING (segment, region, lc, entity, month)" for a in ("sganda", "ocos", "sgm"))}
WIDE_CELLS = [f"{a}_{x}" for a in ACCOUNT_FILTERS for x in MONTH_ABBREVIATIONS]
COMPRESSED = {"cw": "SELECT segment, upper(region) AS region, lc, entity, " + ", ".join(f"coalesce(sum(CASE WHEN month = '{x}' THEN {a} END), 0) AS {a}_{x}" for a in ACCOUNT_FILTERS for x in MONTH_ABBREVIATIONS) + f" FROM j WHERE segment <> 'HQ' GROUP BY 1, 2, 3, 4 HAVING {' + '.join(WIDE_CELLS)} <> 0"}


BUSINESS = {"sganda": "PROMO", "ocos": "SMALL", "sgm": "LARGE"}


def account_rows(t: Tables):
    segment = F.when(F.col("region") == "EUROPE", "HQ").otherwise("Core")
    return transactional(t).withColumn("segment", segment).withColumn("region", F.lower("region"))


def account_tables(t: Tables):
    """One table per account, as they are landed."""
    rows = account_rows(t)
    return {
        a: (rows.filter(F.col("business") == BUSINESS[a]) if a in BUSINESS else rows).groupBy(*ACCOUNT_KEYS).agg(F.sum("transactional_fx").alias(a))
        for a in ACCOUNT_FILTERS
    }


def compressed(t: Tables):
    """The same accounts from long rows, in one pass: a line counts as net sales and for its own account."""
    own = [F.when(F.col("business") == b, F.lit(a)) for a, b in BUSINESS.items()]
    measures = F.array_compact(F.array(F.lit("netsales"), *own))
    long = account_rows(t).select(*ACCOUNT_KEYS, F.col("transactional_fx").alias("value"), F.explode(measures).alias("measure"))
    return fx.compress_long(long, list(ACCOUNT_FILTERS), ACCOUNT_KEYS, excluded_segments=["HQ"])


@query("X9_account_compression", given("transactional", **ACCOUNT_SQL, **JOINED, **COMPRESSED) + f"SELECT segment, region, lc, entity, {ms(*WIDE_CELLS)} FROM cw")
def _(t: Tables):
    return rounded(compressed(t), WIDE_CELLS)


@query("X9_month_of_compression", given("transactional", **ACCOUNT_SQL, **JOINED, **COMPRESSED) + f"SELECT entity, {ms('netsales_Aug', 'sganda_Aug', 'ocos_Aug', 'sgm_Aug')} FROM cw")
def _(t: Tables):
    landed = fx.compress_accounts(account_tables(t), ACCOUNT_KEYS, excluded_segments=["HQ"])
    return rounded(fx.month_columns(landed, "Aug"), ["netsales_Aug", "sganda_Aug", "ocos_Aug", "sgm_Aug"])


@query("X9_categorised_entities", given("transactional", **ACCOUNT_SQL, **JOINED, **COMPRESSED) + """
    SELECT entity, lc, region, s_nationkey AS market, CASE WHEN s_acctbal < 0 THEN 'Debtor' ELSE 'Creditor' END AS business FROM cw LEFT JOIN supplier ON entity = s_name""")
def _(t: Tables):
    categories = t.supplier.select(
        F.col("s_name").alias("entity"), F.col("s_nationkey").alias("market"), F.when(F.col("s_acctbal") < 0, "Debtor").otherwise("Creditor").alias("business"),
        F.lit("old").alias("region"), F.lit("old").alias("lc"),
    )
    return fx.categorised_entities(compressed(t), categories)
