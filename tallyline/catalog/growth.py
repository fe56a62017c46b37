"""Queries for growth initiatives."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.catalog.registry import Tables, m, ms, query, rounded
from tallyline.catalog.views import choose, given, growth_wide, sql_choose
from tallyline.functions.periods import MONTH_NAMES
from tallyline.plans import growth

PLAN_ACCOUNTS = {"AF": "HC", "AO": "C&B", "NF": "Non-C&B", "NO": "Capex", "RF": "Sales", "RO": "SGM"}
STATUSES = {"AF": "Started - External", "AO": "Offer Accepted - Internal", "NF": "Open", "NO": "Started - Internal", "RF": "On hold"}
HIRED = ["Started - External", "Started - Internal", "Offer Accepted - Internal"]


def melt_sql(source: str, ids: str, value: str = "value", cell: str = "{}") -> str:
    return " UNION ALL ".join(
        f"SELECT {ids}, '{n}' AS month, {i}::INT AS month_num, 'Q{(i + 2) // 3}' AS quarter, {cell.format(n)} AS {value} FROM {source}" for i, n in enumerate(MONTH_NAMES, 1))


PLAN = {
    "pw": f"SELECT coalesce(CASE WHEN team <> 'SMALL' THEN team END, 'NA') AS team, growth_initiative, {sql_choose('code', PLAN_ACCOUNTS)} AS account, {', '.join(MONTH_NAMES)} FROM growth_wide",
    "pm": melt_sql("pw", "team, growth_initiative, account"),
    "ps": """SELECT team, growth_initiative, month, month_num, quarter, CASE WHEN account = 'HC' THEN 'C&B' ELSE account END AS account, CASE WHEN account = 'HC' THEN value ELSE 0 END AS ftes_started,
        CASE WHEN account = 'HC' THEN 0 ELSE value END AS op FROM pm""",
    "pl2": "SELECT *, CASE WHEN account IN ('C&B', 'Non-C&B') THEN 'Opex' ELSE account END AS account_l2, CASE WHEN account IN ('C&B', 'Non-C&B', 'Capex') THEN 'Investment' ELSE account END AS account_l1 FROM ps",
}


def plan_wide(t: Tables):
    wide = growth_wide(t).withColumn("account", choose("code", PLAN_ACCOUNTS)).drop("code")
    quarters = {f"Q{q}": F.lit(0.0) for q in range(1, 5)}
    return wide.withColumn("team", F.when(F.col("team") != "SMALL", F.col("team"))).withColumns({**quarters, "FY": F.lit(0.0)})


@query("B1_operating_plan", given("growth_wide", **PLAN) + f"SELECT team, growth_initiative, month, month_num, quarter, account, account_l2, account_l1, {ms('ftes_started', 'op')} FROM pl2")
def _(t: Tables):
    return rounded(growth.operating_plan(plan_wide(t)), ["ftes_started", "op"])


@query("B1_plan_summary", given("growth_wide", **PLAN) + "SELECT account, account_l2, account_l1, count(*) AS volume, " + ", ".join(m(f"sum(CASE WHEN quarter = 'Q{q}' THEN op END)", f"Q{q}") for q in range(1, 5)) + " FROM pl2 GROUP BY 1, 2, 3")
def _(t: Tables):
    return rounded(growth.plan_summary(growth.operating_plan(plan_wide(t))), [f"Q{q}" for q in range(1, 5)])


SPEND = {
    "sw": f"""SELECT coalesce(CASE WHEN team <> 'SMALL' THEN team END, 'NA') AS team, growth_initiative, substring(code, 2, 1) AS forecast_region, CASE WHEN code LIKE 'A%' THEN code END AS vendor,
        CASE WHEN code = 'NF' THEN team END AS contact, {', '.join(MONTH_NAMES)} FROM growth_wide""",
    "sf": "SELECT * FROM sw WHERE vendor IS NOT NULL OR contact IS NOT NULL",
    "sm": melt_sql("sf", "team, growth_initiative, forecast_region"),
    "sn": "SELECT *, CASE WHEN month = 'May' AND team = 'LARGE' THEN NULL ELSE value END AS v FROM sm",
}


def spend_wide(t: Tables):
    wide = growth_wide(t)
    # May is unknown for one team, to leave gaps the strict sum has to see.
    may = F.when((F.col("team") == "LARGE"), F.lit(None).cast("double")).otherwise(F.col("May"))
    return wide.select(
        F.when(F.col("team") != "SMALL", F.col("team")).alias("team"), "growth_initiative", F.substring("code", 2, 1).alias("forecast_region"),
        F.when(F.col("code").startswith("A"), F.col("code")).alias("vendor"), F.when(F.col("code") == "NF", F.col("team")).alias("contact"),
        *[may.alias(n) if n == "May" else F.col(n) for n in MONTH_NAMES],
    )


DETAILS = ["vendor", "contact"]
SPEND_KEYS = ["team", "growth_initiative", "forecast_region"]


def amounts_sql(value: str, account: str, level_2: str, zero: bool) -> str:
    v = "coalesce(v, 0)" if zero else "v"
    return f"""SELECT team, growth_initiative, forecast_region, month, month_num, quarter, {m(f'CASE WHEN count({v}) = count(*) THEN sum({v}) END', value)}, '{account}' AS account, '{level_2}' AS account_l2, 'Investment' AS account_l1
    FROM sn GROUP BY 1, 2, 3, 4, 5, 6"""


@query("B2_spend_actuals", given("growth_wide", **SPEND) + amounts_sql("actuals", "NonCB", "Opex", False))
def _(t: Tables):
    return rounded(growth.initiative_amounts(spend_wide(t), DETAILS, SPEND_KEYS, "NonCB", "Opex", "Investment", "actuals"), ["actuals"])


@query("B2_spend_forecast", given("growth_wide", **SPEND) + amounts_sql("forecast", "NonCB", "Opex", True))
def _(t: Tables):
    return rounded(growth.initiative_amounts(spend_wide(t), DETAILS, SPEND_KEYS, "NonCB", "Opex", "Investment", "forecast", missing_as_zero=True), ["forecast"])


PAY = {
    "w": f"""SELECT team, growth_initiative, code, substring(growth_initiative, 7, 1) AS country, {sql_choose('code', STATUSES)} AS hiring_status, {', '.join(MONTH_NAMES)} FROM growth_wide""",
    "f": "SELECT * FROM w WHERE hiring_status IS NOT NULL",
    "mm": melt_sql("f", "team, growth_initiative, code, country, hiring_status"),
}


def pay_wide(t: Tables):
    return growth_wide(t).withColumn("country", F.substring("growth_initiative", 7, 1)).withColumn("hiring_status", choose("code", STATUSES))


@query("B3_payroll_actuals", given("growth_wide", **PAY) + f"""
    SELECT growth_initiative, team, country, hiring_status, month, month_num, quarter, {m('CASE WHEN count(value) = count(*) THEN sum(value) END', 'actuals')},
      sum((hiring_status IN ('Started - External', 'Started - Internal', 'Offer Accepted - Internal'))::INT)::BIGINT AS ftes_hired,
      (CASE WHEN count(value) = count(*) THEN sum((value > 0)::INT) END)::BIGINT AS ftes_started, count(*) AS fte_estimated, 'C&B' AS account, 'Opex' AS account_l2, 'Investment' AS account_l1
    FROM mm GROUP BY 1, 2, 3, 4, 5, 6, 7""")
def _(t: Tables):
    return rounded(growth.payroll_actuals(pay_wide(t), ["hiring_status"], HIRED), ["actuals"])


@query("B3_payroll_forecast", given("growth_wide", **PAY, pp="SELECT growth_initiative, team, country, hiring_status, code, month, month_num, quarter, sum(coalesce(value, 0)) AS forecast FROM mm GROUP BY 1, 2, 3, 4, 5, 6, 7, 8") + f"""
    SELECT growth_initiative, team, country, hiring_status, month, month_num, quarter, {m('sum(forecast)', 'forecast')}, sum((forecast > 0)::INT)::BIGINT AS forecasted_ftes, 'C&B' AS account, 'Opex' AS account_l2, 'Investment' AS account_l1
    FROM pp GROUP BY 1, 2, 3, 4, 5, 6, 7""")
def _(t: Tables):
    return rounded(growth.payroll_forecast(pay_wide(t), ["hiring_status"], ["code"]), ["forecast"])


@query("B4_capital_actuals", given("growth_wide", **SPEND) + amounts_sql("actuals", "Capex", "Capex", False))
def _(t: Tables):
    return rounded(growth.initiative_amounts(spend_wide(t), DETAILS, SPEND_KEYS, "Capex", "Capex", "Investment", "actuals"), ["actuals"])


@query("B4_capital_forecast", given("growth_wide", **SPEND) + amounts_sql("forecast", "Capex", "Capex", True))
def _(t: Tables):
    return rounded(growth.initiative_amounts(spend_wide(t), DETAILS, SPEND_KEYS, "Capex", "Capex", "Investment", "forecast", missing_as_zero=True), ["forecast"])


SALES_ACCOUNTS = {"AF": "Sales", "AO": "SGM", "NF": "SGM %", "NO": "Sales", "RF": "SGM", "RO": "Other"}
SALES = {
    "w": f"SELECT CASE WHEN team <> 'SMALL' THEN team END AS region, CASE WHEN growth_initiative = 'Brand#9' THEN 'Initiative' ELSE growth_initiative END AS growth_initiative, code, {sql_choose('code', SALES_ACCOUNTS)} AS account, {', '.join(MONTH_NAMES)} FROM growth_wide",
    "k": """SELECT * FROM w WHERE account IN ('SGM', 'Sales') AND NOT contains(growth_initiative, 'Init') QUALIFY row_number() OVER (PARTITION BY coalesce(region, 'NA'), growth_initiative ORDER BY code) <= 2""",
    "k2": "SELECT * EXCLUDE (region), coalesce(region, 'NA') AS team FROM k",
}


def sales_wide(t: Tables):
    wide = growth_wide(t).withColumn("account", choose("code", SALES_ACCOUNTS))
    return wide.withColumn("region", F.when(F.col("team") != "SMALL", F.col("team"))).withColumn(
        "growth_initiative", F.when(F.col("growth_initiative") == "Brand#9", "Initiative").otherwise(F.col("growth_initiative"))).drop("team")


@query("B5_sales_actuals", given("growth_wide", **SALES, mm=melt_sql("k2", "team, growth_initiative, account")) + f"SELECT team, growth_initiative, account, month, month_num, quarter, {m('value', 'actuals')}, account AS account_l1, account AS account_l2 FROM mm")
def _(t: Tables):
    return rounded(growth.sales_lines(sales_wide(t), ["code"], "actuals"), ["actuals"])


@query("B5_sales_forecast", given("growth_wide", **SALES, mm=melt_sql("k2", "team, growth_initiative, account")) + f"""
    SELECT team, growth_initiative, account, account AS account_l1, account AS account_l2, month, month_num, quarter, {m('CASE WHEN count(value) = count(*) THEN sum(value) END', 'forecast')} FROM mm GROUP BY 1, 2, 3, 6, 7, 8""")
def _(t: Tables):
    return rounded(growth.sales_forecast(growth.sales_lines(sales_wide(t), ["code"], "forecast")), ["forecast"])


THEME = {
    "th": " UNION ALL ".join(
        f"SELECT coalesce(CASE WHEN team <> 'SMALL' THEN team END, 'NA') AS team, growth_initiative, '{a}' AS account, " + ", ".join(f"sum(coalesce({n}, 0)) AS {n}" for n in MONTH_NAMES)
        + f" FROM growth_wide WHERE code LIKE '{f}%' AND contains(growth_initiative, '#1') GROUP BY 1, 2" for a, f in (("NonCB", "A"), ("CB", "N"))),
}


def theme_tables(t: Tables):
    wide = growth_wide(t).withColumn("team", F.when(F.col("team") != "SMALL", F.col("team")))
    return {name: wide.filter(F.col("code").startswith(f)).drop("code") for name, f in (("NonCB", "A"), ("CB", "N"))}


@query("B6_theme_matrix", given("growth_wide", **THEME) + f"SELECT team, growth_initiative, account, {ms(*MONTH_NAMES)} FROM th UNION ALL SELECT 'Total', '-', '-', {', '.join(m(f'sum({n})') for n in MONTH_NAMES)} FROM th")
def _(t: Tables):
    return rounded(growth.theme_report(theme_tables(t), "#1"), MONTH_NAMES)


@query("B6_theme_by_account", given("growth_wide", **THEME) + f"SELECT account, {', '.join(m(f'sum({n})', n) for n in MONTH_NAMES)} FROM th GROUP BY 1")
def _(t: Tables):
    return rounded(growth.account_totals(growth.theme_report(theme_tables(t), "#1")), MONTH_NAMES)
