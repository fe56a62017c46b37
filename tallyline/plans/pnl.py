"""Profit and loss: scenarios with prior years, measures, variances and report lines."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.nulls import ratio_or_null, zero
from tallyline.functions.periods import fiscal_label, month_name, quarter_label
from tallyline.operators.reshape import gather, shift_years, spread, stack_cells
from tallyline.operators.rules import rank_of, relabel

SCENARIOS = ("actual", "forecast", "budget")
PRIOR = ("py", "ppy", "pppy")
COMPARED = (*SCENARIOS, "py", "ppy")
DIMS = ("region", "channel", "product")


@dataclass(frozen=True)
class Accounts:
    """Names of the posted accounts the measures are built from (fixed values of the report)."""

    net_sales: str = "Net Sales"
    sales_fx: str = "Sales FX"
    acq_div: str = "Acq Div"
    sgm: str = "SGM"
    ocos: str = "OCOS"
    agm: str = "AGM"
    sga: str = "SG&A"
    om: str = "OM"

    def listed(self) -> list[str]:
        return [self.net_sales, self.sales_fx, self.acq_div, self.sgm, self.ocos, self.agm, self.sga, self.om]


# Report order and display names of the lines.
LINE_ORDER = [
    "Net Sales", "Sales FX", "Acq Div", "Organic_usd", "PY_sales", "Organic_perc", "SGM", "SGM_perc", "OCOS",
    "AGM", "AGM_perc", "SG&A", "SG&A_perc", "OM", "OM_perc", "CM", "CM_perc",
]
DISPLAY = {
    "Organic_usd": "Organic $", "PY_sales": "PY Sales", "Organic_perc": "Organic %", "SGM_perc": "SGM %",
    "SG&A_perc": "SG&A %", "AGM_perc": "AGM %", "OM_perc": "OM %", "CM_perc": "CM %",
}


def compare_scenarios(pl: DataFrame, dims: Sequence[str] = DIMS, scenarios: Sequence[str] = SCENARIOS) -> DataFrame:
    """Scenarios as columns per (dims, account, month), with the actuals of three prior years.

    The posted lines are summed to the cube first; the prior years are attached to the cube.
    """
    cube = post(pl, dims, scenarios)
    return shift_years(cube, "ref_date", [*dims, "account"], "actual", PRIOR, carried=[s for s in scenarios if s != "actual"])


def post(pl: DataFrame, dims: Sequence[str] = DIMS, scenarios: Sequence[str] = SCENARIOS) -> DataFrame:
    """The posted lines summed to one row per (dims, account, month), scenarios as columns."""
    return spread(pl, [*dims, "account", "ref_date"], "scenario", list(scenarios), "result")


def report_lines(cube: DataFrame, dims: Sequence[str] = DIMS, accounts: Accounts = Accounts()) -> DataFrame:
    """Posted accounts and derived measures as lines, one column per scenario.

    The organic base of a scenario is the net sales one year before it: py for the current-year
    scenarios, ppy for py and pppy for ppy. The cube rows are re-dated to the years in which they
    serve as prior years, and one aggregation brings all accounts, scenarios and years together; the
    measures are row-wise arithmetic on it. A prior year counts only where the account is posted in
    the month itself.
    """
    def cell(account: str, scenario: str) -> str:
        return f"{accounts.listed().index(account)}__{scenario}"

    back = F.col("__back")
    years = F.array(*[F.lit(k) for k in range(len(PRIOR) + 1)])
    copies = cube.withColumn("__back", F.explode(years)).withColumn("ref_date", F.add_months(F.col("ref_date"), back * 12))
    sums = []
    for account in accounts.listed():
        here = F.col("account") == account
        sums += [F.sum(F.when(here & (back == 0), F.col(s))).alias(cell(account, s)) for s in SCENARIOS]
        sums += [
            F.when(F.max(here & (back == 0)), F.sum(F.when(here & (back == k), F.col("actual")))).alias(cell(account, name))
            for k, name in enumerate(PRIOR, 1) if name != "pppy" or account == accounts.net_sales
        ]
    wide = copies.groupBy(*dims, "ref_date").agg(*sums, F.max(back == 0).alias("__own")).filter("__own")

    def lines(scenario: str) -> dict[str, Column]:
        def posted(account: str) -> Column:
            return F.col(cell(account, scenario))

        base = F.col(cell(accounts.net_sales, {"py": "ppy", "ppy": "pppy"}.get(scenario, "py")))
        sales = posted(accounts.net_sales)
        organic = sales - base - posted(accounts.sales_fx) - posted(accounts.acq_div)
        contribution = posted(accounts.sgm) - posted(accounts.sga)
        out = {a: posted(a) for a in accounts.listed()}
        out |= {"PY_sales": base, "Organic_usd": organic, "Organic_perc": ratio_or_null(organic, base)}
        for account in (accounts.sgm, accounts.agm, accounts.sga, accounts.om):
            out[f"{account}_perc"] = ratio_or_null(posted(account), sales)
        out |= {"CM": contribution, "CM_perc": ratio_or_null(contribution, sales)}
        return out

    per_scenario = [lines(s) for s in COMPARED]
    rows = [(title, [p[title] for p in per_scenario]) for title in per_scenario[0]]
    stacked = wide.select(*dims, "ref_date", stack_cells(rows, "account", COMPARED).alias("line"))
    return stacked.select(*dims, "ref_date", "line.*")


def measures_by_scenario(lines: DataFrame, dims: Sequence[str] = DIMS) -> DataFrame:
    """The lines in long form: one row per line and scenario."""
    return gather(lines, [*dims, "ref_date", "account"], "scenario", "value", COMPARED)


VARIANCES = (("forecast", "vfcast"), ("budget", "vop"), ("py", "vpy"), ("ppy", "vppy"))


def variances(lines: DataFrame, dims: Sequence[str] = DIMS) -> DataFrame:
    """Actuals against forecast, budget and two prior years, in amount and share.

    An undefined ratio stays missing through the formulas and becomes 0 at the end.
    """
    out = [F.col(c) for c in (*dims, "ref_date", "account")] + [zero("actual").alias("actual")]
    for other, name in VARIANCES:
        gap = F.col("actual") - F.col(other)
        out += [zero(other).alias(other), zero(gap).alias(f"{name}_usd"), zero(ratio_or_null(gap, other)).alias(f"{name}_perc")]
    return lines.select(*out)


def present(report: DataFrame) -> DataFrame:
    """Report order and display names."""
    return report.withColumn("indicative", rank_of("account", LINE_ORDER)).withColumn("account", relabel("account", DISPLAY))


def labelled(variance_lines: DataFrame) -> DataFrame:
    """Variances in their report names, with rank and the labels of their period."""
    report = present(variance_lines)
    labels = [F.year("ref_date").alias("observation"), month_name(F.month("ref_date")).alias("period"), quarter_label("ref_date").alias("quarter")]
    return report.select(*labels, *report.columns)


def statement(pl: DataFrame, dims: Sequence[str] = DIMS, accounts: Accounts = Accounts(), ordered: bool = False) -> DataFrame:
    """The whole book: every date and combination of dimensions in one job; report order on request."""
    report = labelled(variances(report_lines(post(pl, dims), dims, accounts), dims))
    return report.orderBy("ref_date", "indicative", *dims) if ordered else report


def months_needed(newest: date) -> list[date]:
    """A month and the same month of the prior years a statement looks back to."""
    return [date(newest.year - k, newest.month, 1) for k in range(len(PRIOR) + 1)]


def newest_statement(pl: DataFrame, newest: date, dims: Sequence[str] = DIMS, accounts: Accounts = Accounts()) -> DataFrame:
    """The statement of one month; just that month and its prior years are read.

    The months are literals, so a table partitioned by ref_date is pruned when the plan is made.
    """
    needed = pl.filter(F.col("ref_date").isin(months_needed(newest)))
    return statement(needed, dims, accounts).filter(F.col("ref_date") == F.lit(newest))


def next_month_rows(pl: DataFrame, newest: date) -> DataFrame:
    """Rows of the newest month moved on by one month, with all period labels rebuilt and no result."""
    moved = pl.filter(F.col("ref_date") == F.lit(newest)).drop("result").withColumn("ref_date", F.add_months("ref_date", 1))
    return moved.withColumns({
        "quarter": quarter_label("ref_date"),
        "observation": F.year("ref_date"),
        "month": F.month("ref_date"),
        "period": month_name(F.month("ref_date")),
        "years": fiscal_label(F.year("ref_date")),
    })


def newest_month(dates: DataFrame, column: str) -> date:
    """First day of the newest month of a date column: one aggregate, one value to the driver."""
    return dates.agg(F.trunc(F.max(column).cast("date"), "MM").alias("m")).first()["m"]
