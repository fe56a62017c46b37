"""Queries for aggregations, reshaping and windows."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.catalog.registry import Tables, cents, fine, m, query, rounded, s
from tallyline.catalog.views import daily, facts, given, growth_wide
from tallyline.functions import nulls
from tallyline.functions.periods import MONTH_ABBREVIATIONS, MONTH_NAMES
from tallyline.operators import reshape, totals, windows
from tallyline.plans.close import overview


@query("A1_group_sum", given(v="SELECT l_returnflag AS flag, l_linenumber AS line, CASE WHEN l_linenumber < 7 OR l_quantity <> 50 THEN l_extendedprice END AS v FROM lineitem") + f"""
    SELECT flag, line, {m('CASE WHEN count(v) = count(*) THEN sum(v) END', 'strict')}, {m('coalesce(sum(v), 0)', 'loose')} FROM v GROUP BY 1, 2""")
def _(t: Tables):
    v = F.when((F.col("l_linenumber") < 7) | (F.col("l_quantity") != 50), F.col("l_extendedprice")).alias("v")
    lines = t.lineitem.select(F.col("l_returnflag").alias("flag"), F.col("l_linenumber").alias("line"), v)
    return lines.groupBy("flag", "line").agg(cents(nulls.strict_sum("v"), "strict"), cents(nulls.loose_sum("v"), "loose"))


@query("A2_group_count", f"SELECT event_type, user_id, count(*) AS n, {m('sum(value)', 'amount')} FROM events GROUP BY 1, 2")
def _(t: Tables):
    return t.events.groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("n"), cents(F.sum("value"), "amount"))


@query("A3_mean_over_rows", f"""
    SELECT o_orderpriority, {s("round(sum(CASE WHEN o_orderstatus <> 'P' THEN o_totalprice END), 2) / count(*)", 'average', 6)} FROM orders GROUP BY 1""")
def _(t: Tables):
    known = t.orders.select("o_orderpriority", F.when(F.col("o_orderstatus") != "P", F.col("o_totalprice")).alias("v"))
    return known.groupBy("o_orderpriority").agg(fine(F.round(F.sum("v"), 2) / F.count(F.lit(1)), "average", 6))


@query("A4_range_label", """
    SELECT o_custkey, min(o_orderdate)::DATE AS first_day, max(o_orderdate)::DATE AS last_day, min(o_orderdate)::DATE::VARCHAR || ' : ' || max(o_orderdate)::DATE::VARCHAR AS date_range
    FROM orders GROUP BY 1""")
def _(t: Tables):
    day = F.col("o_orderdate").cast("date")
    spans = t.orders.groupBy("o_custkey").agg(F.min(day).alias("first_day"), F.max(day).alias("last_day"))
    return spans.withColumn("date_range", F.concat_ws(" : ", F.col("first_day").cast("string"), F.col("last_day").cast("string")))


@query("A5_first_and_last", """
    SELECT user_id, arg_min(event_type, ts) AS first_type, arg_max(event_type, ts) AS last_type FROM events GROUP BY 1""")
def _(t: Tables):
    return t.events.groupBy("user_id").agg(F.min_by("event_type", "ts").alias("first_type"), F.max_by("event_type", "ts").alias("last_type"))


@query("A6_sum_all_numerics", f"""
    SELECT l_returnflag, l_linestatus, sum(l_orderkey)::BIGINT AS l_orderkey, sum(l_linenumber)::BIGINT AS l_linenumber, {m('sum(l_quantity)', 'l_quantity')},
      {m('sum(l_extendedprice)', 'l_extendedprice')}, {m('sum(l_discount)', 'l_discount')}, {m("coalesce(sum(CASE WHEN l_returnflag <> 'N' THEN l_tax END), 0)", 'l_tax')}
    FROM lineitem GROUP BY 1, 2""")
def _(t: Tables):
    lines = t.lineitem.drop("l_partkey", "l_suppkey").withColumn("l_tax", F.when(F.col("l_returnflag") != "N", F.col("l_tax")))
    sums = totals.sum_numeric(lines, ["l_returnflag", "l_linestatus"])
    return rounded(sums, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])


@query("A7_flatten_text", """
    WITH pairs AS (SELECT DISTINCT p_brand, p_name FROM part)
    SELECT p_brand AS brand, 0::BIGINT AS part, string_agg(p_name, ',' ORDER BY p_name) AS names, count(*) AS n_items FROM pairs GROUP BY 1""")
def _(t: Tables):
    pairs = t.part.select(F.col("p_brand").alias("brand"), F.col("p_name").alias("item")).distinct()
    return windows.flatten_text(pairs, ["brand"], "item", "names")


@query("A7_flatten_large_groups", """
    WITH pairs AS (SELECT DISTINCT p_type AS kind, p_name AS item FROM part),
    numbered AS (SELECT *, row_number() OVER (PARTITION BY kind ORDER BY item) - 1 AS spot FROM pairs)
    SELECT kind, floor(spot / 20)::BIGINT AS part, string_agg(item, ',' ORDER BY item) AS names, count(*) AS n_items FROM numbered GROUP BY 1, 2""")
def _(t: Tables):
    pairs = t.part.select(F.col("p_type").alias("kind"), F.col("p_name").alias("item")).distinct()
    return windows.flatten_text(pairs, ["kind"], "item", "names", part_items=20)


@query("A8_distinct_keys", "SELECT DISTINCT l_suppkey, l_returnflag, l_linestatus FROM lineitem")
def _(t: Tables):
    return t.lineitem.select("l_suppkey", "l_returnflag", "l_linestatus").distinct()


@query("A9_totals_row", f"""
    WITH g AS (SELECT c_mktsegment AS segment, n_name AS nation, sum(c_acctbal) AS balance, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1, 2)
    SELECT segment, nation, {m('balance', 'balance')}, n FROM g UNION ALL SELECT 'Total', '-', {m('sum(balance)')}, sum(n)::BIGINT FROM g""")
def _(t: Tables):
    sums = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("c_mktsegment").alias("segment"), F.col("n_name").alias("nation")).agg(F.sum("c_acctbal").alias("balance"), F.count(F.lit(1)).alias("n"))
    return rounded(totals.add_totals(sums, "segment"), ["balance"])


@query("A10_subtotals", f"""
    SELECT CASE WHEN grouping(o_orderpriority) = 1 THEN 'GRAND TOTAL' ELSE o_orderpriority END AS o_orderpriority,
      CASE WHEN grouping(o_orderpriority) = 1 THEN 'GRAND TOTAL' WHEN grouping(o_orderstatus) = 1 THEN 'TOTAL' ELSE o_orderstatus END AS o_orderstatus,
      count(*) AS sold, {m('sum(o_totalprice)', 'income')} FROM orders GROUP BY ROLLUP (o_orderpriority, o_orderstatus)""")
def _(t: Tables):
    return totals.subtotals(t.orders, "o_orderpriority", "o_orderstatus", {"sold": F.count(F.lit(1)), "income": F.round(F.sum("o_totalprice"), 2)})


@query("A11_scalar_in_arithmetic", f"""
    SELECT o_orderpriority, {s('round(sum(o_totalprice), 2) / (SELECT round(sum(o_totalprice), 2) FROM orders)', 'share')},
      (SELECT count(*) FROM orders) - (SELECT count(DISTINCT l_orderkey) FROM lineitem) AS without_lines FROM orders GROUP BY 1""")
def _(t: Tables):
    whole = t.orders.agg(F.round(F.sum("o_totalprice"), 2)).scalar()
    open_orders = t.orders.agg(F.count(F.lit(1))).scalar() - t.lineitem.select("l_orderkey").distinct().agg(F.count(F.lit(1))).scalar()
    return t.orders.groupBy("o_orderpriority").agg(F.round(F.sum("o_totalprice"), 2).alias("v")).select("o_orderpriority", fine(F.col("v") / whole, "share"), open_orders.alias("without_lines"))


@query("A12_long_to_wide", f"""
    SELECT o_custkey, {m("sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice END)", 'F')}, {m("sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice END)", 'O')},
      {m("sum(CASE WHEN o_orderstatus = 'P' THEN o_totalprice END)", 'P')} FROM orders GROUP BY 1""")
def _(t: Tables):
    return rounded(reshape.spread(t.orders, ["o_custkey"], "o_orderstatus", ["F", "O", "P"], "o_totalprice"), ["F", "O", "P"])


# As many columns as there are orders.
@query("A12_column_blocks", f"""
    WITH c AS (SELECT o_orderpriority, 'order ' || lpad(o_orderkey::VARCHAR, 12, '0') AS name, sum(o_totalprice) AS value FROM orders GROUP BY 1, 2),
    n AS (SELECT name, row_number() OVER (ORDER BY name) - 1 AS i FROM (SELECT DISTINCT name FROM c))
    SELECT o_orderpriority, i // {reshape.BLOCK_NAMES} AS block, (i % {reshape.BLOCK_NAMES})::INT AS position, name, {m('value', 'value')} FROM c JOIN n USING (name)""")
def _(t: Tables):
    long = t.orders.select("o_orderpriority", F.concat(F.lit("order "), F.lpad(F.col("o_orderkey").cast("string"), 12, "0")).alias("label"), "o_totalprice")
    blocks = reshape.spread_blocks(long, ["o_orderpriority"], "label", "o_totalprice")
    return rounded(reshape.block_cells(blocks, ["o_orderpriority"], "value"), ["value"])


@query("A13_several_measures_wide", "SELECT l_linenumber, " + ", ".join(
    f"""(round(sum(CASE WHEN l_returnflag = '{f}' THEN {c} END), 2) + 0e0) AS "{c}_{f}" """ for f in "ANR" for c in ("l_quantity", "l_extendedprice", "l_tax")) + " FROM lineitem GROUP BY 1")
def _(t: Tables):
    wide = reshape.spread(t.lineitem, ["l_linenumber"], "l_returnflag", ["A", "N", "R"], ["l_quantity", "l_extendedprice", "l_tax"])
    return rounded(wide, [c for c in wide.columns if c != "l_linenumber"])


@query("A14_wide_to_long", given("growth_wide") + " UNION ALL ".join(f"SELECT team, growth_initiative, code, '{n}' AS month, {m(n, 'value')} FROM growth_wide" for n in MONTH_NAMES))
def _(t: Tables):
    long = reshape.gather(growth_wide(t), ["team", "growth_initiative", "code"], "month", "value", MONTH_NAMES)
    return rounded(long, ["value"])


@query("A15_month_and_quarter_overview", given("facts") + "SELECT category, type, " + ", ".join(
    [f"""{m(f"coalesce(sum(CASE WHEN month(period) = {i} THEN value END), 0)", n)}""" for i, n in enumerate(MONTH_ABBREVIATIONS, 1)]
    + [f"""{m(f"coalesce(sum(CASE WHEN quarter(period) = {q} THEN value END), 0)", f'Q{q}')}""" for q in range(1, 5)]) + ", year(period)::INT AS year FROM facts GROUP BY category, type, year(period)")
def _(t: Tables):
    cells = MONTH_ABBREVIATIONS + ["Q1", "Q2", "Q3", "Q4"]
    return rounded(overview(facts(t), ["category", "type"], fill=0.0), cells)


@query("W1_row_index", """
    SELECT o_orderkey, o_orderdate::DATE AS day, row_number() OVER (ORDER BY o_orderdate, o_orderkey) + 1 AS index FROM orders""")
def _(t: Tables):
    rows = t.orders.select("o_orderkey", F.col("o_orderdate").cast("date").alias("day"))
    return windows.row_index(rows, ["day", "o_orderkey"], "index", start=2)


@query("W2_first_rows", """
    SELECT o_custkey, o_orderkey FROM orders QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) <= 2""")
def _(t: Tables):
    rows = t.orders.select("o_custkey", "o_orderkey", "o_orderdate")
    return windows.first_rows(rows, ["o_custkey"], ["o_orderdate", "o_orderkey"], 2).drop("o_orderdate")


@query("W3_latest_per_group", """
    SELECT l_suppkey, l_returnflag, l_shipdate::DATE AS day, l_orderkey, l_linenumber, l_partkey FROM lineitem
    QUALIFY l_shipdate = max(l_shipdate) OVER (PARTITION BY l_suppkey, l_returnflag)""")
def _(t: Tables):
    rows = t.lineitem.select("l_suppkey", "l_returnflag", F.col("l_shipdate").cast("date").alias("day"), "l_orderkey", "l_linenumber", "l_partkey")
    return windows.latest_per_group(rows, ["l_suppkey", "l_returnflag"], "day")


@query("W4_latest_rows", "SELECT * EXCLUDE (l_shipdate), l_shipdate::DATE AS l_shipdate FROM lineitem WHERE l_shipdate = (SELECT max(l_shipdate) FROM lineitem)")
def _(t: Tables):
    return windows.latest_rows(t.lineitem, "l_shipdate").withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


@query("W5_fill_down", """
    SELECT conv_id, turn, last_value(CASE WHEN role = 'user' THEN text END IGNORE NULLS) OVER (PARTITION BY conv_id ORDER BY turn ROWS UNBOUNDED PRECEDING) AS section FROM conversations""")
def _(t: Tables):
    heads = t.conversations.select("conv_id", "turn", F.when(F.col("role") == "user", F.col("text")).alias("head"))
    return windows.fill_down(heads, ["conv_id"], "turn", "head", "section", chunk=3).drop("head")


@query("W6_running_month_to_date", given("daily", days="SELECT region, year(day) AS y, month(day) AS mo, day(day) AS d, sum(value) AS v FROM daily GROUP BY 1, 2, 3, 4") + f"""
    SELECT region, y::INT AS year, mo::INT AS month, d::INT AS day, {m('v', 'value')}, {m('sum(v) OVER (PARTITION BY region, y, mo ORDER BY d)', 'mtd')} FROM days""")
def _(t: Tables):
    days = daily(t).select("region", F.year("day").alias("year"), F.month("day").alias("month"), F.dayofmonth("day").alias("day"), "value")
    return rounded(windows.running_sum(days, ["region", "year", "month"], "day", "value", "mtd"), ["value", "mtd"])
