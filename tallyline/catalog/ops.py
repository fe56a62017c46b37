"""Queries for the order meter, trading, cash, control documents and calendars."""

from __future__ import annotations

from datetime import date

from pyspark.sql import functions as F

from tallyline.catalog.registry import Tables, m, ms, query, rounded
from tallyline.catalog.views import buyers, given, trades
from tallyline.functions.periods import close_ranges, close_window
from tallyline.plans import ops

FEED = """SELECT n_name AS nation, r_name AS region, c_mktsegment AS group_name, o_orderpriority AS sbu, round(sum(o_totalprice), 2) AS total, round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END), 2) AS shipped,
    round(sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END), 2) AS confirmed, round(sum(CASE WHEN o_orderstatus = 'P' THEN o_totalprice ELSE 0 END), 2) AS partly FROM buyers GROUP BY 1, 2, 3, 4"""
METER = {
    "feed": FEED,
    "home": """SELECT CASE nation WHEN 'NATION_1' THEN 'US' WHEN 'NATION_6' THEN 'CAN' ELSE 'LATAM' END AS country, sbu AS super_sbu, sbu AS gpp_sbu, group_name AS super_demand_group, shipped AS shipments, partly AS shipments_py,
        shipped AS pd_shipments, total AS target, total AS total_projection, partly AS new_business, partly AS open_orders, CASE WHEN nation IN ('NATION_1', 'NATION_6') THEN 'NA' ELSE 'LAG' END AS region,
        CASE WHEN nation IN ('NATION_1', 'NATION_6') THEN 'North America' ELSE 'Rest Of The World' END AS super_region FROM feed WHERE region = 'AMERICA'""",
    "away": """SELECT nation AS country, sbu AS super_sbu, sbu AS gpp_sbu, group_name AS super_demand_group, shipped AS shipments, shipped * 0.7e0 AS shipments_py, shipped - shipped * 0.03e0 AS pd_shipments, total AS target,
        shipped + coalesce(confirmed, 0) AS total_projection, partly AS new_business, partly AS open_orders, CASE WHEN region = 'ASIA' THEN 'ANZ' ELSE 'EMEA' END AS region, 'Europe and Pacific' AS super_region FROM feed WHERE region <> 'AMERICA'""",
}
AMOUNTS = ["shipments", "target", "total_projection", "new_business", "open_orders"]


@query("T1_order_meter", given("buyers", **METER) + f"""
    SELECT DISTINCT country, super_sbu, gpp_sbu, super_demand_group, {ms(*AMOUNTS)}, (round(shipments_py, 4) + 0e0) AS shipments_py, (round(pd_shipments, 4) + 0e0) AS pd_shipments, region, super_region, DATE '2023-03-10' AS run_date
    FROM (SELECT * FROM home UNION ALL SELECT * FROM away)""")
def _(t: Tables):
    def total(condition=None):
        return F.round(F.sum("o_totalprice" if condition is None else F.when(F.col("o_orderstatus") == condition, F.col("o_totalprice"))), 2)

    feed = buyers(t).groupBy(F.col("n_name").alias("nation"), F.col("r_name").alias("region"), F.col("c_mktsegment").alias("super_demand_group"), F.col("o_orderpriority").alias("super_sbu")).agg(
        total().alias("target"), total("F").alias("shipments"), total("O").alias("confirmed_today"), total("P").alias("unconfirmed_today")
    ).withColumn("gpp_sbu", F.col("super_sbu"))
    filled = feed.fillna(0.0, subset=["shipments", "unconfirmed_today"])
    country = F.when(F.col("nation") == "NATION_1", "US").when(F.col("nation") == "NATION_6", "CAN").otherwise("LATAM")
    home = filled.filter(F.col("region") == "AMERICA").select(
        country.alias("country"), "super_sbu", "gpp_sbu", "super_demand_group", "shipments", F.col("unconfirmed_today").alias("shipments_py"), F.col("shipments").alias("pd_shipments"), "target",
        F.col("target").alias("total_projection"), F.col("unconfirmed_today").alias("new_business"), F.col("unconfirmed_today").alias("unconfirmed"),
    )
    away = filled.filter(F.col("region") != "AMERICA").withColumnRenamed("nation", "country").withColumn("region", F.when(F.col("region") == "ASIA", "AMZ").otherwise(F.col("region")))
    text = away.withColumns({c: F.col(c).cast("string") for c in ("shipments", "target", "confirmed_today")}).withColumn("new_business", F.col("unconfirmed_today")).withColumn("unconfirmed_today", F.col("unconfirmed_today").cast("string"))
    meter = ops.order_meter(ops.home_orders(home), ops.away_orders(text, "Europe and Pacific"), date(2023, 3, 10))
    return rounded(meter, AMOUNTS).withColumns({c: F.round(c, 4) for c in ("shipments_py", "pd_shipments")})


TRADES = {"td": "SELECT symbol, opening_direction, TRY_CAST(net_usd AS DOUBLE) AS net_usd, DATE '1899-12-31' + closing_serial::INT AS date_close FROM trades"}


@query("T2_trading_by_day", given("trades", **TRADES) + f"SELECT symbol, year(date_close)::INT AS year, month(date_close)::INT AS period, day(date_close)::INT AS day, {m('sum(net_usd)', 'net_usd')} FROM td GROUP BY 1, 2, 3, 4")
def _(t: Tables):
    return rounded(ops.trade_results(ops.trade_days(trades(t)), ["symbol", "year", "period", "day"]), ["net_usd"])


@query("T2_symbol_ranking", given("trades", **TRADES) + f"SELECT symbol, {m('sum(net_usd)', 'net_usd')} FROM td GROUP BY 1 ORDER BY 2")
def _(t: Tables):
    return rounded(ops.trade_results(ops.trade_days(trades(t)), ["symbol"]), ["net_usd"]).orderBy("net_usd")


@query("T3_symbol_by_direction", given("trades", **TRADES) + f"""SELECT opening_direction, {m("sum(CASE WHEN year(date_close) = 2023 THEN net_usd END)", '"2023"')}, {m("sum(CASE WHEN year(date_close) = 2024 THEN net_usd END)", '"2024"')} FROM td WHERE symbol = 'purchase' GROUP BY 1""")
def _(t: Tables):
    wide = ops.results_by_direction(ops.trade_days(trades(t)), "purchase", [2023, 2024])
    return wide.withColumns({y: F.round(F.col(f"`{y}`"), 2) for y in ("2023", "2024")})


@query("T3_symbols_by_year", given("trades", **TRADES) + f"""SELECT symbol, 0e0 AS "2023", {m("sum(net_usd)", '"2024"')}, {m('sum(net_usd)', 'overview')} FROM td GROUP BY 1""")
def _(t: Tables):
    wide = ops.results_by_symbol(ops.trade_days(trades(t)), [2023, 2024])
    return wide.withColumns({y: F.round(F.col(f"`{y}`"), 2) for y in ("2023", "2024", "overview")})


CASH = {"mv": """SELECT CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 'Deposit' ELSE 'Withdrawal' END AS kind, c_mktsegment AS account, CASE o_orderstatus WHEN 'F' THEN 'Completed' WHEN 'O' THEN 'Approved' ELSE 'Canceled' END AS status,
    o_totalprice AS amount FROM buyers"""}


def moves(t: Tables):
    return buyers(t).select(
        F.when(F.col("o_orderpriority").isin("1-URGENT", "2-HIGH"), "Deposit").otherwise("Withdrawal").alias("transaction_type"), F.col("c_mktsegment").alias("trading_account"),
        F.when(F.col("o_orderstatus") == "F", "Completed").when(F.col("o_orderstatus") == "O", "Approved").otherwise("Canceled").alias("status"), F.col("o_totalprice").alias("amount"),
    )


@query("T4_cash_movements", given("buyers", **CASH, g="SELECT kind, account, sum(CASE WHEN kind = 'Deposit' THEN -amount ELSE amount END) AS amount, count(*) AS n FROM mv WHERE status IN ('Completed', 'Approved') GROUP BY 1, 2") + f"""
    SELECT kind AS transaction_type, account AS trading_account, {m('amount', 'amount')}, n FROM g UNION ALL SELECT 'Total', '-', {m('sum(amount)')}, sum(n)::BIGINT FROM g""")
def _(t: Tables):
    return rounded(ops.cash_movements(moves(t)), ["amount"])


@query("T4_cash_columns", given("buyers", **CASH, g="SELECT account, sum(CASE WHEN kind = 'Withdrawal' THEN amount ELSE 0 END) AS w, sum(CASE WHEN kind = 'Deposit' THEN amount ELSE 0 END) AS d FROM mv WHERE status <> 'Canceled' GROUP BY 1") + f"""
    SELECT account AS trading_account, {m('w', '"Withdrawal"')}, {m('d', '"Deposit"')} FROM g UNION ALL SELECT 'Total', {m('sum(w)')}, {m('sum(d)')} FROM g""")
def _(t: Tables):
    return rounded(ops.cash_columns(moves(t), ["Withdrawal", "Deposit"], ["trading_account"]), ["Withdrawal", "Deposit"])


@query("T4_cash_balance", given("buyers", **CASH, g="SELECT kind, sum(amount) AS amount FROM mv WHERE status <> 'Canceled' GROUP BY 1") + f"SELECT kind AS transaction_type, {m('amount', 'amount')} FROM g UNION ALL SELECT 'Total', {m('sum(amount)')} FROM g")
def _(t: Tables):
    return rounded(ops.cash_balance(moves(t).withColumn("amount", F.col("amount").cast("string"))), ["amount"])


CONTROLS = {
    "doc": """SELECT conv_id AS doc, turn AS position, ' Related to CC' || turn::VARCHAR AS criteria, CASE WHEN role = 'user' THEN 'CT' || lpad(turn::VARCHAR, 6, '0') || ': ' || text WHEN role = 'assistant' THEN text END AS control,
        CASE WHEN role = 'assistant' THEN ' ' || text END AS test, CASE WHEN role = 'assistant' AND length(text) > 300 THEN 'Deviation ' END AS result FROM conversations""",
    "kd": "SELECT *, CASE WHEN regexp_matches(substring(control, 1, 9), 'CT') THEN trim(replace(substring(control, 1, 9), ':', '')) END AS k FROM doc",
    "fd": "SELECT *, last_value(k IGNORE NULLS) OVER (PARTITION BY doc ORDER BY position ROWS UNBOUNDED PRECEDING) AS policy FROM kd",
    "pr": "SELECT DISTINCT doc, trim(replace(trim(criteria), 'Related to', '')) AS criteria, k AS policy FROM kd WHERE k IS NOT NULL",
    "tx": "SELECT doc, policy, trim(control, ' ') AS body, min(position) AS position FROM fd WHERE policy IS NOT NULL AND trim(control, ' ') <> '' GROUP BY 1, 2, 3",
    "cn": "SELECT doc, policy, string_agg(body, ' ' ORDER BY position, body) AS controls, count(*) AS n_controls FROM tx GROUP BY 1, 2",
    "ts": "SELECT DISTINCT doc, policy, trim(test, ' ') AS test, trim(coalesce(result, 'No deviations noted.'), ' ') AS result FROM fd WHERE policy IS NOT NULL AND test IS NOT NULL",
}


def documents(t: Tables):
    """Conversations as control documents: a user turn is a heading, the answer a control text and a test."""
    turn, role, text = F.col("turn"), F.col("role"), F.col("text")
    heading = F.concat(F.lit("CT"), F.lpad(turn.cast("string"), 6, "0"), F.lit(": "), text)
    return t.conversations.select(
        F.col("conv_id").alias("doc"), turn.alias("position"), F.concat(F.lit(" Related to CC"), turn.cast("string")).alias("criteria"),
        F.when(role == "user", heading).when(role == "assistant", text).alias("control"), F.when(role == "assistant", F.concat(F.lit(" "), text)).alias("test"),
        F.when((role == "assistant") & (F.length(text) > 300), "Deviation ").alias("result"),
    )


@query("T5_policy_table", given(**CONTROLS) + """
    SELECT pr.doc, pr.criteria, pr.policy, n_controls, test, result FROM pr JOIN cn ON pr.doc = cn.doc AND pr.policy = cn.policy LEFT JOIN ts ON pr.doc = ts.doc AND pr.policy = ts.policy""")
def _(t: Tables):
    return ops.policy_table(documents(t))


@query("T5_control_texts", given(**CONTROLS) + "SELECT doc, policy, 0::BIGINT AS part, controls, n_controls AS n_items FROM cn")
def _(t: Tables):
    return ops.control_texts(documents(t))


@query("T5_criteria_descriptions", given(**CONTROLS) + """
    SELECT doc, trim(replace(criteria, 'Related to', '')) AS criteria, 0::BIGINT AS part, string_agg(test, '' ORDER BY position) AS criteria_description, count(*) AS n_items FROM doc WHERE test IS NOT NULL GROUP BY doc, criteria""")
def _(t: Tables):
    return ops.criteria_descriptions(documents(t).withColumnRenamed("test", "description"), keys=("doc", "criteria"))


@query("T6_close_calendar", """
    SELECT year(o_orderdate)::INT AS year, strftime(o_orderdate, '%b') AS month, min(o_orderdate)::DATE AS period_start, max(o_orderdate)::DATE AS period_end, max(o_orderdate)::DATE + 3 AS booking_end FROM orders GROUP BY 1, 2""")
def _(t: Tables):
    days = t.orders.select(F.col("o_orderdate").cast("date").alias("data_date"), F.date_format("o_orderdate", "MMM").alias("month"))
    return close_window(close_ranges(days), "first_day", "last_day")


@query("T7_event_calendar", """
    SELECT event_id, CASE WHEN day(ts) < 15 THEN 'Week Of ' ELSE '' END || strftime(ts, '%B') || ' ' || day(ts) || 'th' AS original, strftime(ts, '%b') AS period, day(ts)::INT AS day FROM events WHERE event_type <> 'error'""")
def _(t: Tables):
    n = F.dayofmonth("ts")
    written = F.concat(F.when(n < 15, "Week Of ").otherwise(""), F.date_format("ts", "MMMM"), F.lit(" "), n.cast("string"), F.lit("th"))
    rows = t.events.select("event_id", F.when(F.col("event_type") == "error", "to be announced").otherwise(written).alias("original"))
    return ops.event_calendar(rows, "original")
