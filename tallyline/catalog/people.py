"""Queries for headcount and pay."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.catalog.registry import Tables, m, query, rounded, s
from tallyline.catalog.views import given, ledger
from tallyline.functions.periods import MONTH_ABBREVIATIONS
from tallyline.plans import people

CENTERS = {"1": "first", "2": "first", "7": "second", "12": "third", "20": "third"}
CENTER_CASE = "CASE cost_center " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in CENTERS.items()) + " END"
ROSTER = """SELECT DISTINCT c_name || ',' || c_mktsegment || ' M' AS name, c_custkey::VARCHAR AS ee_number, c_nationkey::VARCHAR AS cost_center, date_trunc('month', o_orderdate)::DATE AS date
    FROM orders JOIN customer ON o_custkey = c_custkey"""
HEADS = {"ro": ROSTER, "hd": f"SELECT *, {CENTER_CASE} AS unit, 'Q' || quarter(date) AS quarter FROM ro WHERE cost_center IN ('1', '2', '7', '12', '20')"}


def rosters(t: Tables):
    """One roster row per customer and month with an order."""
    rows = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(
        F.concat(F.col("c_name"), F.lit(","), F.col("c_mktsegment"), F.lit(" M")).alias("name"), F.col("c_custkey").cast("string").alias("ee_number"),
        F.col("c_nationkey").cast("string").alias("cost_center"), F.date_format("o_orderdate", "MM-yyyy").alias("period"),
    )
    return rows.distinct()


def heads(t: Tables):
    return people.heads(rosters(t), CENTERS)


@query("E1_heads", given(**HEADS) + "SELECT name, ee_number, cost_center, unit, date, quarter FROM hd")
def _(t: Tables):
    return heads(t)


#: The months the orders can fall in.
MONTHS = [f"{month} {year}" for year in range(1995, 2002) for month in MONTH_ABBREVIATIONS]
MONTH_CELLS = ", ".join(f"""count(*) FILTER (label = '{month}') AS "{month}\"""" for month in MONTHS)


@query("E1_head_matrix", given(**HEADS, p="SELECT unit, strftime(date, '%b %Y') AS label FROM hd") + f"SELECT unit, {MONTH_CELLS}, count(*) AS all_months FROM p GROUP BY unit")
def _(t: Tables):
    return people.head_matrix(heads(t), MONTHS)


@query("E2_new_heads", given(**HEADS) + "SELECT name, ee_number, cost_center, unit, date, quarter FROM hd WHERE date = DATE '2000-08-01' AND name NOT IN (SELECT name FROM hd WHERE date <> DATE '2000-08-01')")
def _(t: Tables):
    return people.new_heads(heads(t), "2000-08-01")


@query("E3_pay_estimate", given(**HEADS, pay="SELECT o_custkey::VARCHAR AS ee_number, o_orderpriority AS earning_code, sum(o_totalprice) AS regular FROM orders WHERE o_orderstatus = 'F' GROUP BY 1, 2") + f"""
    SELECT hd.*, earning_code, {m('regular', 'regular')}, {m('round(regular, 2) * 12', 'year_estimate')} FROM hd LEFT JOIN pay ON pay.ee_number = hd.ee_number WHERE date = DATE '1998-09-01'""")
def _(t: Tables):
    payroll = t.orders.filter(F.col("o_orderstatus") == "F").select(F.col("o_custkey").cast("string").alias("ee_number"), F.col("o_orderpriority").alias("earning_code"), F.col("o_totalprice").alias("earnings"))
    september = heads(t.ordered("1998-09-01", "1998-10-01"))
    estimated = people.pay_estimate(september, payroll)
    return rounded(estimated, ["regular", "year_estimate"])


NAMES = {
    "fc": "SELECT 'Ann ' || s_name || ' X' AS n, s_name AS last FROM supplier",
    "rs": "SELECT DISTINCT replace(c_name, 'Customer', 'Supplier') AS last, c_mktsegment AS first, c_custkey::VARCHAR AS ee_number FROM customer WHERE c_acctbal > 0",
}


def forecast_people(t: Tables):
    return people.split_first_last(t.supplier.select(F.concat(F.lit("Ann "), F.col("s_name"), F.lit(" X")).alias("employee")), "employee")


def roster_people(t: Tables):
    name = F.concat(F.replace(F.col("c_name"), F.lit("Customer"), F.lit("Supplier")), F.lit(","), F.col("c_mktsegment"), F.lit(" Middle"))
    return people.split_last_first(t.customer.filter(F.col("c_acctbal") > 0).select(name.alias("name"), F.col("c_custkey").cast("string").alias("ee_number")), "name")


@query("E4_split_names", given(**NAMES) + "SELECT ee_number, last, first FROM rs")
def _(t: Tables):
    return roster_people(t)


@query("E4_missing_people", given(**NAMES) + "SELECT last, 'forecast' AS found_in FROM fc WHERE last NOT IN (SELECT last FROM rs) UNION ALL SELECT last, 'roster' FROM rs WHERE last NOT IN (SELECT last FROM fc)")
def _(t: Tables):
    return people.missing_people(forecast_people(t), roster_people(t))


@query("E4_payments_of_missing", given(**NAMES, pay="SELECT o_custkey::VARCHAR AS pn, o_totalprice AS earnings FROM orders WHERE o_totalprice > 480000") + """
    SELECT last, first, ee_number, earnings FROM rs LEFT JOIN pay ON pn = ee_number WHERE last NOT IN (SELECT last FROM fc)""")
def _(t: Tables):
    payroll = t.orders.filter(F.col("o_totalprice") > 480000).select(F.col("o_custkey").cast("string").alias("payroll_number"), F.col("o_totalprice").alias("earnings"))
    return people.payments_of_missing(roster_people(t), forecast_people(t), payroll)


@query("E5_growth_hires", """
    SELECT c_custkey AS employee_id, c_name AS employee_name, NULL::VARCHAR AS region_code, 'Tools' AS division, NULL::VARCHAR AS platform FROM customer WHERE c_mktsegment IN ('BUILDING', 'FURNITURE')""")
def _(t: Tables):
    rows = t.customer.select(F.col("c_custkey").alias("employee_id"), F.col("c_name").alias("employee_name"), F.concat(F.lit("  "), F.initcap("c_mktsegment"), F.lit(" ")).alias("hiring_status"))
    return people.growth_hires(rows, ["building", "furniture"], blank=["region_code", "platform"], fixed={"division": "Tools"}, layout=["employee_id", "employee_name", "region_code", "division", "platform"])


COST_RULES = [("ECONOMY", "C&B"), ("GIZMO", "Tools"), ("HOT", "Energy")]
COSTS = {
    "lg": "SELECT * FROM ledger WHERE year = 1998 AND period = 3 AND cost_element NOT IN ('13', '17')",
    "ct": """SELECT CASE WHEN contains(cost_element_name, 'ECONOMY') THEN 'C&B' WHEN contains(cost_element_name, 'GIZMO') THEN 'Tools' WHEN contains(cost_element_name, 'HOT') THEN 'Energy'
        WHEN contains(offset_account, '00007') THEN 'Funded' ELSE cost_element_name END AS category, cost_element_name, value FROM lg""",
    "cg": "SELECT category, cost_element_name, sum(value) AS amount FROM ct GROUP BY 1, 2",
}


def costs(t: Tables):
    month = ledger(t.shipped("1998-03-01", "1998-04-01")).withColumnRenamed("offset_account", "document_header")
    return people.cost_by_category(month, COST_RULES, excluded=["13", "17"], header_rule=("00007", "Funded"))


@query("E6_cost_by_category", given("ledger", **COSTS) + f"SELECT category, cost_element_name, {m('amount', 'amount')} FROM cg UNION ALL SELECT 'Total', '-', {m('sum(amount)')} FROM cg")
def _(t: Tables):
    return rounded(costs(t), ["amount"])


@query("E6_pay_difference", given("ledger", **COSTS, d="""SELECT round(sum(amount), 2) AS actual, (SELECT round(sum(s_acctbal), 2) FROM supplier) AS forecast FROM cg WHERE category = 'C&B'""") + f"""
    SELECT {m('actual', 'actual')}, {m('forecast', 'forecast')}, {m('actual - forecast', 'difference')}, {s('(actual - forecast) / 175000e0', 'share', 6)} FROM d""")
def _(t: Tables):
    gap = people.pay_difference(costs(t), "C&B", t.supplier, "s_acctbal", 175000.0)
    return rounded(gap, ["actual", "forecast", "difference"]).withColumn("share", F.round("share", 6))
