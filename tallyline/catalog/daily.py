"""Queries for daily sales tracking."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tallyline.catalog.registry import Tables, fine, ms, query, rounded, s, ss
from tallyline.catalog.views import buyers, daily, given
from tallyline.functions.periods import calendar
from tallyline.plans import daily as plan

KEYS = ["region", "category", "year", "day_code"]
MEASURES = {"actuals": "FO", "qr": "F", "op": "O", "cp": "P", "lowtarget": "FP", "meantarget": "OP", "hightarget": "FOP"}


def day_measures(t: Tables):
    """Long rows: an order counts for every measure whose statuses include its own."""
    names = F.array_compact(F.array(*[F.when(F.col("o_orderstatus").isin(list(statuses)), F.lit(name)) for name, statuses in MEASURES.items()]))
    return buyers(t).select(
        F.col("r_name").alias("region"), F.col("o_orderpriority").alias("category"), F.year("o_orderdate").alias("year"),
        F.concat(F.lit("d"), F.dayofyear("o_orderdate").cast("string")).alias("day_code"), F.col("o_totalprice").alias("value"), F.explode(names).alias("measure"),
    )


DAY_SUMS = "SELECT r_name AS region, o_orderpriority AS category, year(o_orderdate)::INT AS year, 'd' || dayofyear(o_orderdate) AS day_code, " + ", ".join(
    f"sum(CASE WHEN o_orderstatus IN ({', '.join(repr(x) for x in st)}) THEN o_totalprice END) AS {name}" for name, st in MEASURES.items()) + " FROM buyers GROUP BY 1, 2, 3, 4 HAVING actuals IS NOT NULL"


@query("D1_daily_perspective", given("buyers", g=DAY_SUMS, cal="SELECT d::DATE AS data_date FROM range(DATE '1996-01-01', DATE '1997-01-01', INTERVAL 1 DAY) r(d)") + f"""
    SELECT region, category, g.year, day_code, {ms(*MEASURES)}, data_date, day(data_date)::INT AS day, 'Week ' || ((day(data_date) - 1) // 7 + 1) AS week, strftime(data_date, '%b') AS month, 'Q' || quarter(data_date) AS quarter
    FROM g LEFT JOIN cal ON day_code = 'd' || dayofyear(data_date)""")
def _(t: Tables):
    days = calendar(t.spark, "1996-01-01", "1996-12-31")
    return rounded(plan.daily_perspective(day_measures(t), list(MEASURES), KEYS, days), list(MEASURES))


def month_targets(t: Tables):
    """Monthly forecast, budget and posted amounts, taken from open, partly and finished orders."""
    rows = buyers(t).select(
        F.col("r_name").alias("region"), F.col("o_orderpriority").alias("category"), F.year("o_orderdate").alias("year"),
        F.date_format("o_orderdate", "MMM").alias("period"), "o_orderstatus", "o_totalprice",
    )
    keys = ["region", "category", "year", "period"]
    return {
        name: rows.filter(F.col("o_orderstatus") == status).groupBy(*keys).agg(F.sum("o_totalprice").alias(name))
        for name, status in (("fcast", "F"), ("budget", "O"), ("posted", "P"))
    }


TARGETS = """SELECT r_name AS region, o_orderpriority AS category, year(o_orderdate)::INT AS year, month(o_orderdate)::INT AS month, round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END), 2) AS fcast,
    round(sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END), 2) AS budget, round(sum(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END), 2) AS posted FROM buyers GROUP BY 1, 2, 3, 4 HAVING fcast IS NOT NULL"""


@query("D1_forecast_perspective", given("buyers", g=TARGETS) + f"""
    SELECT region, category, year, strftime(make_date(year, month, 1), '%b') AS period, month AS month_day, make_date(year, month, 1) AS ref_date, 'Q' || quarter(make_date(year, month, 1)) AS quarter, {ms('fcast', 'budget', 'posted')} FROM g""")
def _(t: Tables):
    return rounded(plan.forecast_perspective(month_targets(t), ["region", "category", "year", "period"]), ["fcast", "budget", "posted"])


def sales(t: Tables):
    """Orders of a day with the share of the month expected by then: linear for qr, a little ahead for op."""
    number = F.dayofmonth("day")
    return daily(t).select("region", "category", "day", F.col("value").alias("actuals"), (number / 31).alias("qr"), ((number + 1) / 33).alias("op"))


def targets(t: Tables):
    """The monthly targets of month_targets out of one pass over the orders."""
    kinds = {"fcast": "F", "budget": "O", "posted": "P"}
    sums = [F.round(F.sum(F.when(F.col("o_orderstatus") == status, F.col("o_totalprice"))), 2).alias(name) for name, status in kinds.items()]
    keys = [F.col("r_name").alias("region"), F.col("o_orderpriority").alias("category"), F.year("o_orderdate").alias("year"), F.month("o_orderdate").alias("month")]
    return buyers(t).groupBy(*keys).agg(*sums).filter(F.col("fcast").isNotNull())


TRACK = {
    "d": "SELECT region, category, day, round(sum(value), 2) AS actuals, day(day) / 31 AS qr, (day(day) + 1) / 33 AS op FROM daily GROUP BY 1, 2, 3",
    "t": TARGETS,
    "tracked": """SELECT a.region, a.category, year(a.day)::INT AS year, month(a.day)::INT AS month, day(a.day)::INT AS day_no, a.actuals, a.qr, a.op, p.actuals AS py_actuals,
        round((SELECT sum(x.actuals) FROM d x WHERE x.region = a.region AND x.category = a.category AND date_trunc('month', x.day) = date_trunc('month', a.day) AND x.day <= a.day), 2) AS mtd_actuals,
        round((SELECT sum(x.actuals) FROM d x WHERE x.region = a.region AND x.category = a.category AND year(x.day) = year(a.day) - 1 AND month(x.day) = month(a.day) AND day(x.day) <= day(a.day)), 2) AS py_mtd_actuals,
        f.fcast, f.budget, q.posted AS py_posted
        FROM d a LEFT JOIN d p ON p.region = a.region AND p.category = a.category AND year(p.day) = year(a.day) - 1 AND month(p.day) = month(a.day) AND day(p.day) = day(a.day)
        LEFT JOIN t f ON f.region = a.region AND f.category = a.category AND f.year = year(a.day) AND f.month = month(a.day)
        LEFT JOIN t q ON q.region = a.region AND q.category = a.category AND q.year = year(a.day) - 1 AND q.month = month(a.day)""",
}
TRACK_MONEY = ["actuals", "py_actuals", "mtd_actuals", "py_mtd_actuals", "fcast", "budget", "py_posted"]


@query("D2_single_day_tracking", given("daily", **TRACK) + f"SELECT region, category, year, month, day_no, {ms(*TRACK_MONEY)}, {ss('qr', 'op')} FROM tracked WHERE year = 1998 AND month = 3 AND day_no = 17")
def _(t: Tables):
    return rounded(plan.track_day(sales(t.ordered("1997-03-01", "1998-04-01")), targets(t.ordered("1997-01-01", "1999-01-01")), date(1998, 3, 17)), TRACK_MONEY, ["qr", "op"])


def per(a: str, b: str) -> str:
    return f"({a}) / nullif({b}, 0)"


DERIVED = {
    "actuals": "actuals", "py_actuals": "py_actuals", "d_vpy": per("actuals", "py_actuals") + " - 1", "mtd_actuals": "mtd_actuals",
    "qr": "qr * fcast", "vqr_usd": "mtd_actuals - qr * fcast", "vqr_share": per("mtd_actuals - qr * fcast", "qr * fcast"),
    "op": "op * budget", "vop_usd": "mtd_actuals - op * budget", "vop_share": per("mtd_actuals - op * budget", "op * budget"),
    "py_mtd_actuals": "py_mtd_actuals", "vpy_usd": "mtd_actuals - py_mtd_actuals", "vpy_share": per("mtd_actuals - py_mtd_actuals", "py_mtd_actuals"),
    "fcast": "fcast", "qr_converted": per("mtd_actuals", "fcast"), "qr_gap": "fcast - mtd_actuals",
    "budget": "budget", "op_converted": per("mtd_actuals", "budget"), "op_gap": "budget - mtd_actuals",
    "py_posted": "py_posted", "py_converted": per("mtd_actuals", "py_posted"), "py_gap": "py_posted - mtd_actuals",
}


@query("D3_tracking_of_all_days", given("daily", **TRACK) + "SELECT region, category, year, month, day_no, " + ", ".join(s(f"coalesce({e}, 0)", n, 4) for n, e in DERIVED.items()) + " FROM tracked")
def _(t: Tables):
    table = plan.derive(plan.track(sales(t), targets(t)))
    return table.withColumns({n: fine(F.col(n), digits=4) for n in DERIVED})
