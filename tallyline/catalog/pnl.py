"""Queries for the profit-and-loss statement."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.catalog.registry import Tables, fine, query, rounded, s
from tallyline.catalog.views import ACCOUNTS, given, pl
from tallyline.plans import cube_log, pnl
from tallyline.session import scratch_folder

SC = ["actual", "forecast", "budget", "py", "ppy"]
BASE = {"actual": "py", "forecast": "py", "budget": "py", "py": "ppy", "ppy": "pppy"}

CUBE = """SELECT region, channel, product, account, ref_date, sum(CASE WHEN scenario = 'actual' THEN result END) AS actual,
    sum(CASE WHEN scenario = 'forecast' THEN result END) AS forecast, sum(CASE WHEN scenario = 'budget' THEN result END) AS budget FROM pl GROUP BY 1, 2, 3, 4, 5"""
COMPARED = "SELECT a.*, b.actual AS py, c.actual AS ppy, d.actual AS pppy FROM cube a " + " ".join(
    f"LEFT JOIN cube {x} ON a.region = {x}.region AND a.channel = {x}.channel AND a.product = {x}.product AND a.account = {x}.account AND {x}.ref_date = a.ref_date - INTERVAL {k} YEAR"
    for k, x in enumerate("bcd", 1))
WIDE = "SELECT region, channel, product, ref_date, " + ", ".join(
    f'max(CASE WHEN account = \'{a}\' THEN {s_} END) AS "{a}_{s_}"' for a in ACCOUNTS for s_ in [*SC, "pppy"]) + " FROM compared GROUP BY 1, 2, 3, 4"


def line_sql(title: str, scenario: str) -> str:
    def c(account: str) -> str:
        return f'"{account}_{scenario}"'

    base = f'"Net Sales_{BASE[scenario]}"'
    organic = f"({c('Net Sales')} - {base} - {c('Sales FX')} - {c('Acq Div')})"
    margin = f"({c('SGM')} - {c('SG&A')})"
    if title in ACCOUNTS:
        return c(title)
    formulas = {"PY_sales": base, "Organic_usd": organic, "Organic_perc": f"{organic} / nullif({base}, 0)", "CM": margin, "CM_perc": f"{margin} / nullif({c('Net Sales')}, 0)"}
    return formulas.get(title) or f"{c(title[:-5])} / nullif({c('Net Sales')}, 0)"


LINES = " UNION ALL ".join(
    f"SELECT region, channel, product, ref_date, '{title}' AS account, " + ", ".join(f"{line_sql(title, x)} AS {x}" for x in SC) + " FROM wide" for title in pnl.LINE_ORDER)
STEPS = {"cube": CUBE, "compared": COMPARED, "wide": WIDE, "lines": LINES}


def variance_sql(digits: int = 4) -> str:
    out = [s("coalesce(actual, 0)", "actual", digits)]
    for other, name in pnl.VARIANCES:
        gap = f"(actual - {other})"
        out += [s(f"coalesce({other}, 0)", other, digits), s(f"coalesce({gap}, 0)", f"{name}_usd", digits), s(f"coalesce({gap} / nullif({other}, 0), 0)", f"{name}_perc", digits)]
    return ", ".join(out)


VALUES = ["actual"] + [c for other, name in pnl.VARIANCES for c in (other, f"{name}_usd", f"{name}_perc")]
SHOWN = "CASE account " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in pnl.DISPLAY.items()) + " ELSE account END"
RANK = "CASE account " + " ".join(f"WHEN '{k}' THEN {i}" for i, k in enumerate(pnl.LINE_ORDER, 1)) + " END"
STATEMENT = f"""SELECT year(ref_date)::INT AS observation, strftime(ref_date, '%B') AS period, 'Q' || quarter(ref_date) AS quarter, region, channel, product, ref_date,
    {RANK}::INT AS indicative, {SHOWN} AS account, {variance_sql()} FROM lines"""


def four(df, names):
    return df.withColumns({n: fine(F.col(n), digits=4) for n in names})


@query("L1_scenarios_with_prior_years", given("pl", cube=CUBE, compared=COMPARED) + "SELECT region, channel, product, account, ref_date, "
       + ", ".join(s(x, x, 2) for x in ("actual", "forecast", "budget", "py", "ppy", "pppy")) + " FROM compared")
def _(t: Tables):
    return rounded(pnl.compare_scenarios(pl(t)), ["actual", "forecast", "budget", "py", "ppy", "pppy"])


@query("L2_measures_by_scenario", given("pl", **STEPS) + " UNION ALL ".join(
    f"SELECT region, channel, product, ref_date, account, '{x}' AS scenario, {s(x, 'value', 4)} FROM lines" for x in SC))
def _(t: Tables):
    lines = pnl.report_lines(pnl.post(pl(t)))
    return four(pnl.measures_by_scenario(lines), ["value"])


@query("L3_variances", given("pl", **STEPS) + f"SELECT region, channel, product, ref_date, account, {variance_sql()} FROM lines")
def _(t: Tables):
    return four(pnl.variances(pnl.report_lines(pnl.post(pl(t)))), VALUES)


@query("L4_report_order", given("pl", **STEPS) + f"SELECT DISTINCT {RANK}::INT AS indicative, {SHOWN} AS account, count(*) OVER (PARTITION BY account) AS n FROM lines")
def _(t: Tables):
    shown = pnl.present(pnl.report_lines(pnl.post(pl(t))))
    return shown.groupBy("indicative", "account").agg(F.count(F.lit(1)).alias("n")).orderBy("indicative")


@query("L5_whole_book_statement", given("pl", **STEPS) + STATEMENT)
def _(t: Tables):
    return four(pnl.statement(pl(t), ordered=True), VALUES)


@query("L5_newest_month_statement", given("pl", **STEPS) + STATEMENT + " WHERE ref_date = (SELECT max(ref_date) FROM pl)")
def _(t: Tables):
    newest = pnl.newest_month(t.lineitem, "l_shipdate")
    return four(pnl.newest_statement(pl(t, pnl.months_needed(newest)), newest), VALUES)


def refreshed(t: Tables) -> str:
    """A cube of four refreshes: old months, lines posted late for one of them (wrong at first, then written again), new months."""
    path = scratch_folder(t.spark, "cube")
    lines = pl(t).withColumn("late", (F.col("ref_date") == "1996-05-01") & (F.col("channel") == "BUILDING"))
    old, late = F.col("ref_date") < "1998-01-01", F.col("late")
    cube_log.create(t.spark, path)
    cube_log.append(lines.filter(old & ~late), path, "old months")
    cube_log.append(lines.filter(late).withColumn("result", F.col("result") * 2), path, "late lines")
    cube_log.append(lines.filter(~old), path, "new months")
    cube_log.append(lines.filter(late), path, "late lines")
    return path


@query("L5_statement_by_deltas", given("pl", **STEPS) + STATEMENT)
def _(t: Tables):
    return four(cube_log.statement(t.spark, refreshed(t)), VALUES)


@query("L6_next_month_rows", given("pl") + """
    SELECT region, channel, product, account, scenario, (ref_date + INTERVAL 1 MONTH)::DATE AS ref_date, 'Q' || quarter(ref_date + INTERVAL 1 MONTH) AS quarter, year(ref_date + INTERVAL 1 MONTH)::INT AS observation,
      month(ref_date + INTERVAL 1 MONTH)::INT AS month, strftime(ref_date + INTERVAL 1 MONTH, '%B') AS period, 'FY' || strftime(ref_date + INTERVAL 1 MONTH, '%y') AS years
    FROM pl WHERE ref_date = (SELECT max(ref_date) FROM pl)""")
def _(t: Tables):
    newest = pnl.newest_month(t.lineitem, "l_shipdate")
    return pnl.next_month_rows(pl(t, [newest]), newest)
