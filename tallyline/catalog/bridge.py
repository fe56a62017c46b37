"""Queries for the net-sales bridge and organic growth."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tallyline.catalog.registry import Tables, m, ms, query, rounded, s
from tallyline.catalog.views import given, net_sales, organics
from tallyline.operators.rules import rank_of
from tallyline.operators.totals import residual_line
from tallyline.plans import bridge

BY_PRODUCT = [("Outdoor", "ASIA", "Outdoor ASIA"), ("Tools", "EUROPE", "Tools EUROPE")]
REGIONS = {"Tools EUROPE": "HQ", "AFRICA": "HQ Hedge"}
RELABELLED = """SELECT CASE WHEN channel = 'Tools EUROPE' THEN 'HQ' WHEN channel = 'AFRICA' THEN 'HQ Hedge' ELSE region END AS region, channel AS region_channel, product, type, ref_date, result
    FROM (SELECT *, CASE WHEN product = 'Outdoor' AND region_channel = 'ASIA' THEN 'Outdoor ASIA' WHEN product = 'Tools' AND region_channel = 'EUROPE' THEN 'Tools EUROPE' ELSE region_channel END AS channel FROM net_sales)"""
PIVOT = "SELECT ref_date, product, region, region_channel, " + ", ".join(f"round(sum(CASE WHEN type = '{x}' THEN result END), 2) AS {x}" for x in bridge.TYPES) + " FROM relabelled GROUP BY 1, 2, 3, 4"
STEP1 = """SELECT *, actual_sales - actual_sales_py AS sales_vpy, actual_fx AS fx_vpy, actual_acqdiv AS acqdiv_vpy, actual_sales - actual_sales_py - actual_fx - actual_acqdiv AS org_vpy, actual_volume AS vol_vpy, actual_price AS price_vpy,
    actual_sales - fcst_sales AS sales_vfcst, actual_fx_vs_fcst AS fx_vfcst, actual_acqdiv - fcst_acqdiv AS acqdiv_vfcst, actual_price - fcst_price AS price_vfcst,
    actual_sales - op_sales AS sales_vop, actual_fx_vs_op AS fx_vop, actual_acqdiv - op_acqdiv AS acqdiv_vop, actual_price - op_price AS price_vop FROM wide"""
STEP2 = """SELECT *, vol_vfcst + price_vfcst AS org_vfcst, vol_vop + price_vop AS org_vop FROM
    (SELECT *, sales_vfcst - fx_vfcst - price_vfcst - acqdiv_vfcst AS vol_vfcst, sales_vop - fx_vop - price_vop - acqdiv_vop AS vol_vop FROM step1)"""
STEPS = {"relabelled": RELABELLED, "wide": PIVOT, "step1": STEP1, "bridged": STEP2}
AMOUNTS = ["actual_sales", "fcst_sales", "op_sales", "actual_sales_py", "actual_sales_2py", "fcst_price", "op_price", "fcst_volume", "op_volume"] + [
    f"{p}_{o}" for o in ("vpy", "vfcst", "vop") for p in bridge.PARTS]


def relabelled(t: Tables):
    return bridge.relabel_lines(net_sales(t), BY_PRODUCT, REGIONS)


def bridged(t: Tables):
    return rounded(bridge.bridge(relabelled(t)), AMOUNTS)


@query("R1_net_sales_bridge", given("net_sales", **STEPS) + f"SELECT ref_date, product, region, region_channel, {ms(*AMOUNTS)} FROM bridged")
def _(t: Tables):
    return bridged(t)


@query("R2_relabelled_lines", given("net_sales", relabelled=RELABELLED) + f"SELECT region, region_channel, product, count(*) AS n, {m('sum(result)', 'result')} FROM relabelled GROUP BY 1, 2, 3")
def _(t: Tables):
    return relabelled(t).groupBy("region", "region_channel", "product").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("result"), 2).alias("result"))


def points(expr: str) -> str:
    return f"round_even({expr} * 10000, -1)"


def ratio_sql() -> str:
    share = {p: f"({p}_vpy / nullif(actual_sales_py, 0))" for p in bridge.PARTS}
    out = [s(f"coalesce({share[p]}, 0)", f"{p}_vpy_ratio") for p in bridge.PARTS]
    for o in ("vfcst", "vop"):
        for p in bridge.PARTS:
            before = "fcst_price" if (o, p) == ("vfcst", "price") else f"({p}_vpy - {p}_{o})"
            divisor = "fcst_sales" if (o, p) == ("vfcst", "acqdiv") else "actual_sales_py"
            out.append(s(f"coalesce({points(share[p])} - {points(f'({before} / nullif({divisor}, 0))')}, 0)", f"{p}_{o}_ratio"))
    return ", ".join(out)


# The bridge amounts enter the ratios rounded to cents, in both engines.
ROUNDED = "SELECT ref_date, product, region, region_channel, " + ms(*AMOUNTS) + " FROM bridged"


@query("R3_ratio_table", given("net_sales", **STEPS, b=ROUNDED) + f"SELECT ref_date, product, region, region_channel, strftime(ref_date, '%B') AS period, 'Q' || quarter(ref_date) AS quarter, {ratio_sql()} FROM b")
def _(t: Tables):
    table = bridge.ratio_table(bridged(t))
    return rounded(table, shares=[c for c in table.columns if c.endswith("_ratio")])


@query("R4_year_to_date_kpis", given("net_sales", **STEPS, b=ROUNDED, k="""SELECT region_channel, round(sum(sales_vpy), 2) AS sales_vpy, round(sum(sales_vfcst), 2) AS sales_vfcst, round(sum(actual_sales_py), 2) AS actual_sales_py
    FROM b WHERE product = 'Tools' AND ref_date BETWEEN DATE '1999-01-01' AND DATE '1999-07-01' GROUP BY 1""") + f"""
    SELECT region_channel, {ms('sales_vpy', 'sales_vfcst', 'actual_sales_py')}, {s('coalesce(sales_vpy / nullif(actual_sales_py, 0), 0)', 'sales_vpy_ratio')},
      {s(f"coalesce({points('(sales_vpy / nullif(actual_sales_py, 0))')} - {points('((sales_vpy - sales_vfcst) / nullif(actual_sales_py, 0))')}, 0)", 'sales_vfcst_ratio')} FROM k""")
def _(t: Tables):
    kpis = bridge.year_to_date_kpis(bridged(t.shipped("1999-01-01", "1999-08-01")), date(1999, 7, 1), "Tools")
    return rounded(kpis, ["sales_vpy", "sales_vfcst", "actual_sales_py"], ["sales_vpy_ratio", "sales_vfcst_ratio"])


@query("R5_residual_line", given("net_sales", g="SELECT ref_date, region, type, sum(result) AS result FROM net_sales WHERE type IS NOT NULL GROUP BY 1, 2, 3") + f"""
    SELECT ref_date, region, type, {m('result', 'result')} FROM g UNION ALL
    SELECT ref_date, region, 'Other', {m("sum(CASE WHEN type = 'actual_sales' THEN result END) - coalesce(sum(CASE WHEN type IN ('actual_price', 'actual_volume', 'actual_fx') THEN result END), 0)")}
    FROM g GROUP BY 1, 2 HAVING sum(CASE WHEN type = 'actual_sales' THEN result END) IS NOT NULL""")
def _(t: Tables):
    summed = net_sales(t).groupBy("ref_date", "region", "type").agg(F.sum("result").alias("result"))
    return rounded(residual_line(summed, ["ref_date", "region"], "type", "actual_sales", ["actual_price", "actual_volume", "actual_fx"], "result", "Other"), ["result"])


ORGANIC_CELLS = [*bridge.ORGANIC, "mtd_sales_vfcast", "mtd_sales_vop", "mtd_sales_vpy"]
ORGANIC_SQL = "SELECT ref_date, geo, region || ' / ' || channel AS region_channel, " + ", ".join(f"round(sum(CASE WHEN type = '{x}' THEN result END), 2) AS {x}" for x in bridge.ORGANIC) + """
    FROM organics WHERE ref_date <= DATE '1998-02-01' GROUP BY 1, 2, 3"""
ORGANIC_LINES = ["NATION_3 / BUILDING", "NATION_1 / MACHINERY", "NATION_99 / BUILDING", "NATION_7 / FURNITURE"]
ORGANIC_SELECT = f"""ref_date, year(ref_date)::INT AS observation, month(ref_date)::INT AS month, strftime(ref_date, '%B') AS period, 'Q' || quarter(ref_date) AS quarter, geo, {ms(*bridge.ORGANIC)},
    {m('sales_actual_mtd - forecast_mtd', 'mtd_sales_vfcast')}, {m('sales_actual_mtd - op_mtd', 'mtd_sales_vop')}, {m('sales_actual_mtd - sales_py_mtd', 'mtd_sales_vpy')}"""


@query("R6_organics_summary", given("organics", o=ORGANIC_SQL) + f"SELECT region_channel, {ORGANIC_SELECT} FROM o")
def _(t: Tables):
    return rounded(bridge.organics_summary(organics(t.shipped(None, "1998-03-01")), date(1998, 3, 15)), ORGANIC_CELLS)


@query("R6_organics_report_layout", given("organics", o=ORGANIC_SQL, lay=f"SELECT unnest({ORGANIC_LINES!r}) AS region_channel, unnest(range(1, 5))::INT AS ord") + f"""
    SELECT lay.region_channel, ord, {ORGANIC_SELECT} FROM lay LEFT JOIN o ON lay.region_channel = o.region_channel""")
def _(t: Tables):
    lines = t.spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in ORGANIC_LINES])).alias("region_channel"))
    lines = lines.withColumn("ord", rank_of("region_channel", ORGANIC_LINES))
    return rounded(bridge.organics_summary(organics(t.shipped(None, "1998-03-01")), date(1998, 3, 15), lines), ORGANIC_CELLS).orderBy("ord", "ref_date")
