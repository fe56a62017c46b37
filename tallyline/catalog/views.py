"""Views that give the test tables the shapes the financial plans expect.

Every view is a lazy plan over whole tables with a twin in SQL (`CTE`). Filters on dates are
written on the raw date column so that they reach the parquet scan.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.catalog.registry import Tables
from tallyline.functions.periods import MONTH_NAMES, SPREADSHEET_ORIGIN, month_start
from tallyline.operators.reshape import spread

# The statement date used by the registered queries.
AS_OF = "1998-03-01"

ACCOUNTS = ["Net Sales", "Sales FX", "Acq Div", "SGM", "OCOS", "AGM", "SG&A", "OM"]
SCENARIOS = {"A": "actual", "R": "forecast", "N": "budget"}
FACT_TYPES = {"A": "actuals", "N": "op", "R": "fcast"}


def choose(column: str, mapping: dict) -> Column:
    chain = None
    for old, new in mapping.items():
        chain = F.when(F.col(column) == old, F.lit(new)) if chain is None else chain.when(F.col(column) == old, F.lit(new))
    return chain


def sql_choose(column: str, mapping: dict) -> str:
    arms = " ".join(f"WHEN {old!r} THEN {new!r}" for old, new in mapping.items())
    return f"CASE {column} {arms} END"


def product_cents(a: str, b: str) -> Column:
    """Product of two columns in whole cents, by the same arithmetic in every engine."""
    return F.floor(F.col(a) * F.col(b) * 100 + 0.5) / 100


def four_places(value: Column) -> Column:
    """Four decimals by the same arithmetic in every engine."""
    return F.floor(value * 10000 + 0.5) / 10000


def sql_cents(a: str, b: str) -> str:
    return f"(floor({a} * {b} * 100e0 + 0.5e0) / 100e0)"


def facts(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_partkey", "l_returnflag", "l_linestatus", "l_shipdate", "l_extendedprice")
    parts = t.part.select("p_partkey", "p_type", "p_brand")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat_ws(" - ", "p_type", "p_brand").alias("category"),
        F.when(F.col("l_linestatus") == "F", "first").otherwise("second").alias("unit"),
        month_start("l_shipdate").alias("period"),
        choose("l_returnflag", FACT_TYPES).alias("type"),
        F.col("l_extendedprice").alias("value"),
    )


def ledger(t: Tables) -> DataFrame:
    lines = t.lineitem.select("l_partkey", "l_suppkey", "l_linestatus", "l_shipdate", "l_extendedprice")
    parts = t.part.select("p_partkey", "p_type", "p_name")
    suppliers = t.supplier.select("s_suppkey", "s_name")
    return (
        lines.join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .join(suppliers, F.col("l_suppkey") == F.col("s_suppkey"), "left")
        .select(
            F.col("p_partkey").cast("string").alias("cost_element"),
            F.upper(F.concat_ws(" ", "p_type", "p_name")).alias("cost_element_name"),
            F.col("s_name").alias("offset_account"),
            F.year("l_shipdate").alias("year"),
            F.month("l_shipdate").alias("period"),
            F.when(F.col("l_linestatus") == "F", F.col("l_extendedprice")).otherwise(-F.col("l_extendedprice")).alias("value"),
        )
    )


def serial_day(column: str) -> Column:
    return F.date_diff(F.col(column).cast("date"), F.lit(SPREADSHEET_ORIGIN).cast("date"))


def amortization(t: Tables) -> DataFrame:
    parts = t.part.select("p_partkey", "p_name")
    lines = t.lineitem.select("l_partkey", "l_shipdate", "l_extendedprice", "l_tax")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_name").alias("description"),
        serial_day("l_shipdate").alias("period"),
        (-product_cents("l_extendedprice", "l_tax")).alias("value"),
    )


def planned(t: Tables, flag: str) -> DataFrame:
    """Plan or forecast lines with a serial date, one kind per return flag."""
    parts = t.part.select("p_partkey", "p_type", "p_brand")
    lines = t.lineitem.filter(F.col("l_returnflag") == flag).select("l_partkey", "l_shipdate", "l_extendedprice")
    return lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.concat_ws(" - ", "p_type", "p_brand").alias("category"),
        serial_day("l_shipdate").alias("period"),
        F.col("l_extendedprice").alias("value"),
    )


def buyers(t: Tables) -> DataFrame:
    """Orders with segment, nation and region of the buyer."""
    nations = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    regions = t.region.select("r_regionkey", "r_name")
    customers = t.customer.select("c_custkey", "c_nationkey", "c_mktsegment")
    places = nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    return (
        t.orders.join(customers, F.col("o_custkey") == F.col("c_custkey"))
        .join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    )


def product_group() -> Column:
    return F.when(F.col("p_type").isin("ECONOMY", "PROMO", "SMALL"), "Outdoor").otherwise("Tools")


def account_of_size() -> Column:
    slot = F.floor((F.col("p_size") - 1) * 8 / 50).cast("int") + 1
    return F.element_at(F.array(*[F.lit(a) for a in ACCOUNTS]), slot)


def within_months(column: str, months) -> Column:
    """Ranges on the raw column, so that the scan skips row groups of other months."""
    hit = F.lit(False)
    for first in months:
        after = first.replace(year=first.year + first.month // 12, month=first.month % 12 + 1)
        hit = hit | ((F.col(column) >= F.lit(str(first)).cast("timestamp_ntz")) & (F.col(column) < F.lit(str(after)).cast("timestamp_ntz")))
    return hit


def pl(t: Tables, months=None) -> DataFrame:
    """Posted P&L lines by region, channel, product, account, scenario and month."""
    heads = buyers(t).select("o_orderkey", "r_name", "c_mktsegment")
    posted = t.lineitem if months is None else t.lineitem.filter(within_months("l_shipdate", months))
    lines = posted.select("l_orderkey", "l_partkey", "l_returnflag", "l_shipdate", "l_extendedprice")
    parts = t.part.select("p_partkey", "p_type", "p_size")
    return (
        lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.col("r_name").alias("region"),
            F.col("c_mktsegment").alias("channel"),
            product_group().alias("product"),
            account_of_size().alias("account"),
            choose("l_returnflag", SCENARIOS).alias("scenario"),
            month_start("l_shipdate").alias("ref_date"),
            F.col("l_extendedprice").alias("result"),
        )
    )


# Net-sales measure of a line, by return flag and line number.
NET_SALES_TYPES = {
    "A1": "actual_sales", "A2": "actual_sales_py", "A3": "actual_sales_2py", "A4": "actual_fx",
    "A5": "actual_acqdiv", "A6": "actual_price", "A7": "actual_volume",
    "R1": "fcst_sales", "R2": "fcst_price", "R3": "fcst_volume", "R4": "fcst_acqdiv",
    "R5": "actual_fx_vs_fcst", "R6": "actual_fx_vs_op", "R7": "actual_sales",
    "N1": "op_sales", "N2": "op_price", "N3": "op_volume", "N4": "op_acqdiv",
    "N5": "fcst_sales", "N6": "op_sales", "N7": "actual_sales_py",
}


def net_sales(t: Tables) -> DataFrame:
    heads = buyers(t).select("o_orderkey", "r_name")
    lines = t.lineitem.select("l_orderkey", "l_partkey", "l_returnflag", "l_linenumber", "l_shipdate", "l_extendedprice")
    parts = t.part.select("p_partkey", "p_type")
    return (
        lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .withColumn("code", F.concat(F.col("l_returnflag"), F.col("l_linenumber").cast("string")))
        .select(
            F.col("r_name").alias("region"),
            F.col("r_name").alias("region_channel"),
            product_group().alias("product"),
            choose("code", NET_SALES_TYPES).alias("type"),
            month_start("l_shipdate").alias("ref_date"),
            F.col("l_extendedprice").alias("result"),
        )
    )


ORGANIC_TYPES = {
    "1": "sales_actual_mtd", "2": "forecast_mtd", "3": "op_mtd", "4": "sales_py_mtd",
    "5": "sales_fx_mtd", "6": "sales_acqdiv_mtd", "7": "sales_actual_mtd",
}


def organics(t: Tables) -> DataFrame:
    heads = buyers(t).select("o_orderkey", "r_name", "n_name", "c_mktsegment")
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice")
    return (
        lines.join(heads, F.col("l_orderkey") == F.col("o_orderkey"))
        .withColumn("code", F.col("l_linenumber").cast("string"))
        .select(
            F.col("r_name").alias("geo"),
            F.col("n_name").alias("region"),
            F.col("c_mktsegment").alias("channel"),
            choose("code", ORGANIC_TYPES).alias("type"),
            month_start("l_shipdate").alias("ref_date"),
            F.col("l_extendedprice").alias("result"),
        )
    )


def daily(t: Tables) -> DataFrame:
    """Orders of a day by region and priority, with the nation as entity."""
    return buyers(t).select(
        F.col("r_name").alias("region"),
        F.col("o_orderpriority").alias("category"),
        F.col("n_name").alias("entity"),
        F.col("o_orderdate").cast("date").alias("day"),
        F.col("o_totalprice").alias("value"),
    )


def rates(t: Tables) -> DataFrame:
    """Daily rate per currency: mean order value of the nation, in hundred thousands."""
    return (
        buyers(t)
        .groupBy(F.col("n_name").alias("from_ccy"), F.col("o_orderdate").cast("date").alias("date"))
        .agg(four_places(F.round(F.sum("o_totalprice"), 2) / F.count(F.lit(1)) / 100000).alias("inverse_spot_rate"))
    )


def transactional(t: Tables) -> DataFrame:
    """Transactional currency amounts per month and supplying entity."""
    nations = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    regions = t.region.select("r_regionkey", "r_name")
    entities = (
        t.supplier.select("s_suppkey", "s_name", "s_nationkey")
        .join(nations, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(regions, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    lines = t.lineitem.select("l_suppkey", "l_partkey", "l_returnflag", "l_shipdate", "l_extendedprice", "l_tax")
    parts = t.part.select("p_partkey", "p_type")
    return (
        lines.join(entities, F.col("l_suppkey") == F.col("s_suppkey"))
        .join(parts, F.col("l_partkey") == F.col("p_partkey"))
        .select(
            F.date_format("l_shipdate", "MMM").alias("month"),
            choose("l_returnflag", {"A": "ACTUAL", "R": "FCS", "N": "PLAN"}).alias("scenario"),
            F.col("s_name").alias("entity"),
            F.col("p_type").alias("business"),
            F.col("r_name").alias("region"),
            F.col("n_name").alias("market"),
            F.concat(F.lit("C"), F.substring("n_name", 8, 2)).alias("lc"),
            product_cents("l_extendedprice", "l_tax").alias("transactional_fx"),
        )
    )


def pnl_rates(t: Tables) -> DataFrame:
    """Profit-and-loss rate per month and currency."""
    return (
        buyers(t)
        .groupBy(
            F.date_format("o_orderdate", "MMM").alias("month"),
            F.concat(F.lit("C"), F.substring("n_name", 8, 2)).alias("lc"),
        )
        .agg(four_places(F.round(F.sum("o_totalprice"), 2) / F.count(F.lit(1)) / 100000).alias("pnl_rate"))
    )


def fx_factors(t: Tables) -> DataFrame:
    """Distribution factor per month, keyed by business (some part types) or by market (nations)."""
    mean = F.round(F.sum("l_discount"), 2) / F.count(F.lit(1))
    shares = four_places(mean).alias("factor")
    month = F.date_format("l_shipdate", "MMM").alias("month")
    lines = t.lineitem.select("l_suppkey", "l_partkey", "l_shipdate", "l_discount")
    by_business = (
        lines.join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
        .filter(F.col("p_type").isin("PROMO", "SMALL"))
        .groupBy(F.col("p_type").alias("region_market"), month).agg(shares)
    )
    by_market = (
        lines.join(t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
        .join(t.nation.select("n_nationkey", "n_name"), F.col("s_nationkey") == F.col("n_nationkey"))
        .groupBy(F.col("n_name").alias("region_market"), month).agg(shares)
    )
    return by_business.unionByName(by_market)


def hierarchy(t: Tables) -> DataFrame:
    """Three-level entity hierarchy: region, nation, supplier; upper members are parents."""
    nations = t.nation.select("n_nationkey", "n_name", "n_regionkey")
    regions = t.region.select("r_regionkey", "r_name")
    suppliers = t.supplier.select("s_name", "s_nationkey")
    tree = regions.join(nations, F.col("r_regionkey") == F.col("n_regionkey"))
    base = tree.join(suppliers, F.col("n_nationkey") == F.col("s_nationkey"))
    none = F.lit(None).cast("string")

    def level(df: DataFrame, x2: Column, x3: Column, name: Column, kind: str) -> DataFrame:
        return df.select(
            F.lit("Entity").alias("dimension"), F.lit(kind).alias("member_type"), name.alias("name"),
            F.col("r_name").alias("x1"), x2.alias("x2"), x3.alias("x3"),
        )

    return (
        level(regions, none, none, F.col("r_name"), "Parent")
        .unionByName(level(tree, F.col("n_name"), none, F.col("n_name"), "Parent"))
        .unionByName(level(base, F.col("n_name"), F.col("s_name"), F.col("s_name"), "Base"))
    )


def growth_wide(t: Tables) -> DataFrame:
    """Initiative lines with one column per month; a month without lines stays missing."""
    parts = t.part.select("p_partkey", "p_type", "p_brand")
    lines = t.lineitem.select("l_partkey", "l_returnflag", "l_linestatus", "l_shipdate", "l_extendedprice")
    long = lines.join(parts, F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_type").alias("team"),
        F.col("p_brand").alias("growth_initiative"),
        F.concat("l_returnflag", "l_linestatus").alias("code"),
        F.date_format("l_shipdate", "MMMM").alias("month"),
        F.col("l_extendedprice").alias("value"),
    )
    return spread(long, ["team", "growth_initiative", "code"], "month", MONTH_NAMES, "value")


def trades(t: Tables) -> DataFrame:
    return t.events.select(
        F.col("event_type").alias("symbol"),
        F.when(F.hour("ts") < 12, "Buy").otherwise("Sell").alias("opening_direction"),
        F.date_diff(F.col("ts").cast("date"), F.lit("1899-12-31").cast("date")).alias("closing_serial"),
        F.col("value").cast("string").alias("net_usd"),
    )


_BUYERS = """buyers AS (
  SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, c_mktsegment, n_name, r_name
  FROM orders JOIN customer ON o_custkey = c_custkey
  JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

_MONTH_COLUMNS = ", ".join(
    f"sum(CASE WHEN month(l_shipdate) = {i} THEN l_extendedprice END) AS {name}"
    for i, name in enumerate(
        ["January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December"], 1
    )
)

_ACCOUNT = "CASE floor((p_size - 1) * 8 / 50)::INT " + " ".join(f"WHEN {i} THEN '{a}'" for i, a in enumerate(ACCOUNTS)) + " END"

_PRODUCT = "CASE WHEN p_type IN ('ECONOMY', 'PROMO', 'SMALL') THEN 'Outdoor' ELSE 'Tools' END"

CTE: dict[str, tuple[tuple[str, ...], str]] = {
    "buyers": ((), _BUYERS),
    "facts": ((), f"""facts AS (
  SELECT p_type || ' - ' || p_brand AS category, CASE WHEN l_linestatus = 'F' THEN 'first' ELSE 'second' END AS unit,
    date_trunc('month', l_shipdate)::DATE AS period, {sql_choose('l_returnflag', FACT_TYPES)} AS type, l_extendedprice AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""),
    "ledger": ((), """ledger AS (
  SELECT p_partkey::VARCHAR AS cost_element, upper(p_type || ' ' || p_name) AS cost_element_name, s_name AS offset_account,
    year(l_shipdate)::INT AS year, month(l_shipdate)::INT AS period,
    CASE WHEN l_linestatus = 'F' THEN l_extendedprice ELSE -l_extendedprice END AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey LEFT JOIN supplier ON l_suppkey = s_suppkey)"""),
    "amortization": ((), f"""amortization AS (
  SELECT p_name AS description, date_diff('day', DATE '1899-12-30', l_shipdate::DATE) AS period,
    -{sql_cents('l_extendedprice', 'l_tax')} AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""),
    "planned": ((), """planned AS (
  SELECT l_returnflag AS flag, p_type || ' - ' || p_brand AS category,
    date_diff('day', DATE '1899-12-30', l_shipdate::DATE) AS period, l_extendedprice AS value
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""),
    "pl": (("buyers",), f"""pl AS (
  SELECT r_name AS region, c_mktsegment AS channel, {_PRODUCT} AS product, {_ACCOUNT} AS account,
    {sql_choose('l_returnflag', SCENARIOS)} AS scenario, date_trunc('month', l_shipdate)::DATE AS ref_date, l_extendedprice AS result
  FROM lineitem JOIN buyers ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""),
    "net_sales": (("buyers",), f"""net_sales AS (
  SELECT r_name AS region, r_name AS region_channel, {_PRODUCT} AS product,
    {sql_choose("l_returnflag || l_linenumber::VARCHAR", NET_SALES_TYPES)} AS type,
    date_trunc('month', l_shipdate)::DATE AS ref_date, l_extendedprice AS result
  FROM lineitem JOIN buyers ON l_orderkey = o_orderkey JOIN part ON l_partkey = p_partkey)"""),
    "organics": (("buyers",), f"""organics AS (
  SELECT r_name AS geo, n_name AS region, c_mktsegment AS channel, {sql_choose("l_linenumber::VARCHAR", ORGANIC_TYPES)} AS type,
    date_trunc('month', l_shipdate)::DATE AS ref_date, l_extendedprice AS result
  FROM lineitem JOIN buyers ON l_orderkey = o_orderkey)"""),
    "daily": (("buyers",), """daily AS (
  SELECT r_name AS region, o_orderpriority AS category, n_name AS entity, o_orderdate::DATE AS day, o_totalprice AS value FROM buyers)"""),
    "rates": (("buyers",), """rates AS (
  SELECT n_name AS from_ccy, o_orderdate::DATE AS date, floor(round(sum(o_totalprice), 2) / count(*) / 100000 * 10000e0 + 0.5e0) / 10000e0 AS inverse_spot_rate
  FROM buyers GROUP BY 1, 2)"""),
    "transactional": ((), f"""transactional AS (
  SELECT strftime(l_shipdate, '%b') AS month, {sql_choose('l_returnflag', {'A': 'ACTUAL', 'R': 'FCS', 'N': 'PLAN'})} AS scenario,
    s_name AS entity, p_type AS business, r_name AS region, n_name AS market, 'C' || substring(n_name, 8, 2) AS lc,
    {sql_cents('l_extendedprice', 'l_tax')} AS transactional_fx
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey JOIN part ON l_partkey = p_partkey)"""),
    "pnl_rates": (("buyers",), """pnl_rates AS (
  SELECT strftime(o_orderdate, '%b') AS month, 'C' || substring(n_name, 8, 2) AS lc,
    floor(round(sum(o_totalprice), 2) / count(*) / 100000 * 10000e0 + 0.5e0) / 10000e0 AS pnl_rate FROM buyers GROUP BY 1, 2)"""),
    "fx_factors": ((), """fx_factors AS (
  SELECT p_type AS region_market, strftime(l_shipdate, '%b') AS month, floor(round(sum(l_discount), 2) / count(*) * 10000e0 + 0.5e0) / 10000e0 AS factor
  FROM lineitem JOIN part ON l_partkey = p_partkey WHERE p_type IN ('PROMO', 'SMALL') GROUP BY 1, 2
  UNION ALL
  SELECT n_name, strftime(l_shipdate, '%b'), floor(round(sum(l_discount), 2) / count(*) * 10000e0 + 0.5e0) / 10000e0
  FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey GROUP BY 1, 2)"""),
    "hierarchy": ((), """hierarchy AS (
  SELECT 'Entity' AS dimension, 'Parent' AS member_type, r_name AS name, r_name AS x1, NULL::VARCHAR AS x2, NULL::VARCHAR AS x3 FROM region
  UNION ALL SELECT 'Entity', 'Parent', n_name, r_name, n_name, NULL FROM region JOIN nation ON r_regionkey = n_regionkey
  UNION ALL SELECT 'Entity', 'Base', s_name, r_name, n_name, s_name
  FROM region JOIN nation ON r_regionkey = n_regionkey JOIN supplier ON n_nationkey = s_nationkey)"""),
    "growth_wide": ((), f"""growth_wide AS (
  SELECT p_type AS team, p_brand AS growth_initiative, l_returnflag || l_linestatus AS code, {_MONTH_COLUMNS}
  FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3)"""),
    "trades": ((), """trades AS (
  SELECT event_type AS symbol, CASE WHEN hour(ts) < 12 THEN 'Buy' ELSE 'Sell' END AS opening_direction,
    date_diff('day', DATE '1899-12-31', ts::DATE) AS closing_serial, value::VARCHAR AS net_usd FROM events)"""),
}


def given(*names: str, **more: str) -> str:
    """WITH clause for the named views (and what they need), plus further steps in order."""
    wanted: list[str] = []

    def need(name: str) -> None:
        for other in CTE[name][0]:
            need(other)
        if name not in wanted:
            wanted.append(name)

    for name in names:
        need(name)
    steps = [CTE[n][1] for n in wanted] + [f"{n} AS ({body})" for n, body in more.items()]
    return "WITH " + ",\n".join(steps) + "\n"
