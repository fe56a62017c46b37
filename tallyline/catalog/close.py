"""Queries for the monthly close."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tallyline.catalog.registry import Tables, m, ms, query, rounded
from tallyline.catalog.views import amortization, facts, given, ledger, planned
from tallyline.functions.periods import MONTH_ABBREVIATIONS
from tallyline.operators.reshape import spread_found, union_all
from tallyline.plans import close

AS_OF = date(1998, 3, 1)
DAY = "DATE '1998-03-01'"
BEFORE = "1998-04-01"  # the first day after the month of AS_OF

CLOSE_RULES = [
    ("ECONOMY", "Supplies"), ("PROMO", "Promotion - Agency"), ("GIZMO", "Tools"), ("ANVIL", "Tools"), ("WIDGET", "Services - Partner"),
    ("HOT", "Energy"), ("COLD", "Energy"), ("RING", "Software"), ("BOLT", "Rent"),
]
CLOSE_CASE = "CASE " + " ".join(f"WHEN contains(cost_element_name, '{k}') THEN '{v}'" for k, v in CLOSE_RULES) + " ELSE 'Others' END"
EXCLUDED = ["13", "17", "101"]
CLEARING = "#0+[0-9]*[37]$"
PROJECT_RULES = [("anvil", "Forge"), ("gizmo", "Lab"), ("ring", "Lab")]
PROJECT_CASE = "CASE " + " ".join(f"WHEN contains(description, '{k}') THEN '{v}'" for k, v in PROJECT_RULES) + " ELSE 'Other projects' END"


def lines_sql(clearing: bool, symmetric: bool) -> dict[str, str]:
    below = "OR (cost_element_name = 'SMALL RED RING' AND value < -50000)" if symmetric else ""
    cleared = f"""SELECT cost_element, cost_element_name, year, period, sum(value) AS c FROM ledger
        WHERE {'TRUE' if clearing else 'FALSE'} AND regexp_matches(offset_account, '{CLEARING}') GROUP BY 1, 2, 3, 4"""
    return {
        "cleared": cleared,
        "posted": f"""SELECT cost_element, CASE WHEN (cost_element_name = 'SMALL RED RING' AND value > 50000) {below} THEN offset_account ELSE cost_element_name END AS cost_element_name,
            year, period, sum(value) AS a FROM ledger WHERE cost_element NOT IN ('13', '17', '101') GROUP BY 1, 2, 3, 4""",
        "lines": f"""SELECT {CLOSE_CASE.replace('cost_element_name', 'p.cost_element_name')} AS category, p.cost_element, p.cost_element_name, make_date(p.year, p.period, 1) AS period, a AS actual, coalesce(c, 0) AS clearing_account, a - coalesce(c, 0) AS gross
            FROM posted p LEFT JOIN cleared c ON p.cost_element = c.cost_element AND p.cost_element_name = c.cost_element_name AND p.year = c.year AND p.period = c.period""",
    }


AMORT_SQL = f"""SELECT 'Soft.Amort/' || {PROJECT_CASE} AS category, date_trunc('month', DATE '1899-12-30' + period::INT)::DATE AS period, sum(abs(value)) AS value
    FROM amortization GROUP BY 1, 2"""


def close_lines(t: Tables, clearing: bool = True, symmetric: bool = False, as_of: date | None = None):
    return close.close_lines(
        ledger(t), CLOSE_RULES, excluded=EXCLUDED, clearing=CLEARING if clearing else None,
        watched="SMALL RED RING", above=50000, below=-50000 if symmetric else None, as_of=as_of,
    )


def close_facts(t: Tables):
    past = t.shipped(None, BEFORE)
    lines = close_lines(past, as_of=AS_OF)
    split = close.amortization_split(amortization(past), PROJECT_RULES, AS_OF, "Soft.Amort")
    return close.ledger_actuals(lines, AS_OF, split, replaced="Softw", capitalized="Capitalized")


CLOSE_SQL = f"""SELECT category, period, 'Q' || quarter(period) AS quarter, 'actuals' AS type, value FROM (
      SELECT category, period, sum(gross) AS value FROM lines WHERE NOT contains(category, 'Softw') GROUP BY 1, 2
      UNION ALL SELECT category, period, value FROM amort UNION ALL SELECT 'Capitalized', period, sum(clearing_account) FROM lines GROUP BY 2) WHERE period <= {DAY}"""


@query("V1_ledger_close_lines", given("ledger", **lines_sql(True, False)) + f"SELECT category, cost_element, cost_element_name, period, {ms('actual', 'clearing_account', 'gross')} FROM lines")
def _(t: Tables):
    return rounded(close_lines(t), ["actual", "clearing_account", "gross"])


@query("V1_ledger_close_actuals", given("ledger", "amortization", **lines_sql(True, False), amort=AMORT_SQL) + f"SELECT category, period, quarter, type, {m('value', 'value')} FROM ({CLOSE_SQL})")
def _(t: Tables):
    return rounded(close_facts(t), ["value"])


@query("V2_symmetric_override_actuals", given("ledger", **lines_sql(False, True)) + f"""
    SELECT category, period, 'Q' || quarter(period) AS quarter, 'actuals' AS type, {m('sum(gross)', 'value')} FROM lines WHERE period <= {DAY} GROUP BY 1, 2""")
def _(t: Tables):
    return rounded(close.ledger_actuals(close_lines(t.shipped(None, BEFORE), clearing=False, symmetric=True, as_of=AS_OF), AS_OF), ["value"])


@query("V3_amortization_split", given("amortization", amort=AMORT_SQL) + f"SELECT category, period, {m('value', 'value')} FROM amort WHERE period <= {DAY}")
def _(t: Tables):
    return rounded(close.amortization_split(amortization(t.shipped(None, BEFORE)), PROJECT_RULES, AS_OF, "Soft.Amort"), ["value"])


def planned_sql(flag: str, kind: str, category: str = "category") -> str:
    return f"""SELECT {category} AS category, date_trunc('month', DATE '1899-12-30' + period::INT)::DATE AS period, 'Q' || quarter(date_trunc('month', DATE '1899-12-30' + period::INT)) AS quarter,
      '{kind}' AS type, sum(value) AS value FROM planned WHERE flag = '{flag}' AND DATE '1899-12-30' + period::INT < DATE '1998-04-01' GROUP BY 1, 2, 3"""


MERGED_CASE = "CASE WHEN contains(category, 'PROMO') THEN 'Service Upgrade' ELSE category END"
PLAN_SQL = planned_sql("N", "op")
FORECAST_SQL = planned_sql("R", "fcast", MERGED_CASE)


@query("V4_plan_facts", given("planned", p=PLAN_SQL) + f"SELECT category, period, quarter, type, {m('value', 'value')} FROM p")
def _(t: Tables):
    return rounded(close.planned_facts(planned(t.shipped(None, BEFORE), "N"), "op", AS_OF), ["value"])


@query("V4_forecast_facts", given("planned", f=FORECAST_SQL) + f"SELECT category, period, quarter, type, {m('value', 'value')} FROM f")
def _(t: Tables):
    return rounded(close.planned_facts(planned(t.shipped(None, BEFORE), "R"), "fcast", AS_OF, merged=("PROMO", "Service Upgrade")), ["value"])


WINDOW_SQL = {
    "MTD": "period = DATE '1998-03-01'",
    "QTD": "period BETWEEN DATE '1998-01-01' AND DATE '1998-03-01'",
    "YTD": "period BETWEEN DATE '1998-01-01' AND DATE '1998-03-01'",
}


def variance_sql(name: str, by: str = "category", source: str = "facts", where: str | None = None, unit: bool = False) -> str:
    def total(kind: str) -> str:
        return f"coalesce(sum(CASE WHEN type = '{kind}' THEN value END), 0)"

    cells = {"actuals": total("actuals"), "forecast": total("fcast"), "VF": f"{total('actuals')} - {total('fcast')}", "OP": total("op"), "VOP": f"{total('actuals')} - {total('op')}"}
    shown = [f"round_even(({v}) / 1000, 0) + 0e0 AS {name}_{k}" if unit else m(v, f"{name}_{k}") for k, v in cells.items()]
    return f"SELECT {by}, {', '.join(shown)} FROM {source} WHERE {where or WINDOW_SQL[name]} GROUP BY {', '.join(str(i + 1) for i in range(len(by.split(','))))}"


@query("V5_month_to_date_variance", given("facts") + variance_sql("MTD"))
def _(t: Tables):
    return rounded(close.statement(facts(t.shipped("1998-03-01", "1998-04-01")), AS_OF, "MTD"), close.window_columns("MTD"))


@query("V5_month_to_date_thousands", given("facts") + variance_sql("MTD", unit=True))
def _(t: Tables):
    return close.in_units(close.statement(facts(t.shipped("1998-03-01", "1998-04-01")), AS_OF, "MTD"), 1000, ["category"])


LATE = date(1999, 11, 1)
LATE_QTD = "period BETWEEN DATE '1999-10-01' AND DATE '1999-11-01'"
LATE_YTD = "period BETWEEN DATE '1999-01-01' AND DATE '1999-11-01'"


@query("V6_quarter_to_date_variance", given("facts") + variance_sql("QTD", where=LATE_QTD))
def _(t: Tables):
    return rounded(close.statement(facts(t.shipped("1999-10-01", "1999-12-01")), LATE, "QTD"), close.window_columns("QTD"))


@query("V7_year_to_date_variance", given("facts") + variance_sql("YTD", where=LATE_YTD))
def _(t: Tables):
    return rounded(close.statement(facts(t.shipped("1999-01-01", "1999-12-01")), LATE, "YTD"), close.window_columns("YTD"))


ALL_WINDOWS = [c for n in ("MTD", "QTD", "YTD") for c in close.window_columns(n)]


def overview_sql(source: str, qtd: str, ytd: str, mtd: str) -> dict[str, str]:
    return {
        "y": variance_sql("YTD", source=source, where=ytd), "q": variance_sql("QTD", source=source, where=qtd), "mo": variance_sql("MTD", source=source, where=mtd),
        "flat": f"""SELECT trim(replace(split_part(y.category, '-', 1), '/', '-')) AS category, CASE WHEN contains(y.category, '-') THEN trim(split_part(y.category, '-', 2)) END AS vendor, {', '.join(ALL_WINDOWS)}
            FROM y LEFT JOIN q ON y.category = q.category LEFT JOIN mo ON y.category = mo.category""",
    }


@query("V8_statement_overview", given("facts", **overview_sql("facts", LATE_QTD, LATE_YTD, "period = DATE '1999-11-01'")) + "SELECT * FROM flat")
def _(t: Tables):
    return rounded(close.statement_overview(facts(t.shipped("1999-01-01", "1999-12-01")), LATE), ALL_WINDOWS)


@query("V8_overview_of_the_close", given("ledger", "amortization", "planned", **lines_sql(True, False), amort=AMORT_SQL,
       allfacts=f"SELECT category, period, type, value FROM ({CLOSE_SQL}) UNION ALL SELECT category, period, type, value FROM ({PLAN_SQL}) UNION ALL SELECT category, period, type, value FROM ({FORECAST_SQL})",
       **overview_sql("allfacts", WINDOW_SQL["QTD"], WINDOW_SQL["YTD"], WINDOW_SQL["MTD"])) + "SELECT * FROM flat")
def _(t: Tables):
    plan = close.planned_facts(planned(t.shipped(None, BEFORE), "N"), "op", AS_OF)
    forecast = close.planned_facts(planned(t.shipped(None, BEFORE), "R"), "fcast", AS_OF, merged=("PROMO", "Service Upgrade"))
    return rounded(close.statement_overview(union_all(close_facts(t), plan, forecast), AS_OF), ALL_WINDOWS)


def unit_sql(unit: str) -> str:
    return f"SELECT * FROM facts WHERE unit = '{unit}'"


def unit_overview(unit: str) -> str:
    steps = overview_sql("u", LATE_QTD, LATE_YTD, "period = DATE '1999-11-01'")
    body = steps.pop("flat")
    inner = ", ".join(f"{k} AS ({v})" for k, v in {"u": unit_sql(unit), **steps}.items())
    return f"SELECT * FROM (WITH {inner} {body})"


@query("V9_consolidation", given("facts", stacked=f"{unit_overview('first')} UNION ALL {unit_overview('second')}") + f"""
    SELECT CASE WHEN contains(category, 'PROMO') THEN 'Service Upgrade' ELSE category END AS category, vendor, {', '.join(m(f'coalesce(sum({c}), 0)', c) for c in ALL_WINDOWS)} FROM stacked GROUP BY 1, 2""")
def _(t: Tables):
    units = close.statement_overview(facts(t.shipped("1999-01-01", "1999-12-01")), LATE, by=("unit", "category")).drop("unit")
    return rounded(close.consolidate([units], merged=("PROMO", "Service Upgrade")), ALL_WINDOWS)


@query("V10_detailed_report", given("ledger", "amortization", **lines_sql(True, False), amort=AMORT_SQL, c=CLOSE_SQL, other=
    f"SELECT category, period, 'Q' || quarter(period) AS quarter, 'actuals' AS type, sum(gross) AS value FROM lines WHERE period <= {DAY} GROUP BY 1, 2",
    stacked="SELECT *, 'first' AS class FROM c UNION ALL SELECT *, 'second' AS class FROM other") + f"""
    SELECT trim(split_part(split_part(category, '/', 1), '-', 1)) AS category, coalesce(CASE WHEN contains(category, '/') THEN trim(split_part(category, '/', 2)) END,
      CASE WHEN contains(split_part(category, '/', 1), '-') THEN trim(split_part(split_part(category, '/', 1), '-', 2)) END, trim(split_part(split_part(category, '/', 1), '-', 1))) AS detail,
      period, quarter, type, {m('value', 'value')}, class FROM stacked""")
def _(t: Tables):
    plain = close.ledger_actuals(close_lines(t.shipped(None, BEFORE), as_of=AS_OF), AS_OF)
    return rounded(close.detailed_report({"first": close_facts(t), "second": plain}), ["value"])


MONTH_CELLS = MONTH_ABBREVIATIONS + ["Q1", "Q2", "Q3", "Q4"]


def overview_cells(condition: str = "TRUE", suffix: str = "") -> str:
    cells = [m(f"coalesce(sum(CASE WHEN {condition} AND month(period) = {i} THEN value END), 0)", n + suffix) for i, n in enumerate(MONTH_ABBREVIATIONS, 1)]
    return ", ".join(cells + [m(f"coalesce(sum(CASE WHEN {condition} AND quarter(period) = {q} THEN value END), 0)", f"Q{q}{suffix}") for q in range(1, 5)])


@query("V11_cross_table", given("facts") + f"""
    SELECT category, year(period)::INT AS year, {', '.join(overview_cells(f"type = '{k}'", f"_{k}") for k in ("actuals", "op", "fcast"))} FROM facts GROUP BY 1, 2 HAVING count(*) FILTER (type = 'actuals') > 0""")
def _(t: Tables):
    wide = close.overview(facts(t), fill=0.0)
    table = close.cross_table(wide)
    cells = [c for c in table.columns if c not in ("category", "year")]
    return rounded(table.fillna(0.0, subset=cells), cells)


@query("V12_wide_report_to_long", given("facts", f="SELECT * FROM facts WHERE type = 'actuals'", w=f"SELECT category, year(period)::INT AS year, {overview_cells()} FROM f GROUP BY 1, 2")
       + " UNION ALL ".join(f"SELECT category, year, '{n}' AS period, {m(n, 'value')} FROM w" for n in MONTH_ABBREVIATIONS))
def _(t: Tables):
    return rounded(close.refeed(close.overview(facts(t), fill=0.0)), ["value"])


@query("V12_serial_columns_to_long", given("facts") + f"""
    SELECT category, p.period, {m('sum(value)', 'value')} FROM (SELECT DISTINCT category FROM facts) c
    CROSS JOIN (SELECT DISTINCT period FROM facts) p LEFT JOIN facts f USING (category, period) GROUP BY 1, 2""")
def _(t: Tables):
    serial = F.date_diff("period", F.lit("1899-12-30").cast("date")).cast("string")
    wide = spread_found(facts(t).withColumn("serial", serial), ["category"], "serial", "value")
    return rounded(close.refeed_serial(wide), ["value"])


@query("V13_consolidated_table", given("facts") + f"SELECT category, type, year(period)::INT AS year, {overview_cells()} FROM facts GROUP BY 1, 2, 3")
def _(t: Tables):
    return rounded(close.consolidated([facts(t)]), MONTH_CELLS)


@query("V13_detailed_table", given("ledger", "amortization", "planned", **lines_sql(True, False), amort=AMORT_SQL) + f"""
    SELECT category, period, quarter, type, {m('coalesce(value, 0)', 'value')} FROM ({CLOSE_SQL} UNION ALL {PLAN_SQL} UNION ALL {FORECAST_SQL})""")
def _(t: Tables):
    plan = close.planned_facts(planned(t.shipped(None, BEFORE), "N"), "op", AS_OF)
    forecast = close.planned_facts(planned(t.shipped(None, BEFORE), "R"), "fcast", AS_OF, merged=("PROMO", "Service Upgrade"))
    return rounded(union_all(close_facts(t), plan, forecast).fillna(0.0, subset=["value"]), ["value"])
