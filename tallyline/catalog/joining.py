"""Queries for joins and set operations."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.catalog.registry import Tables, cents, m, query, rounded, s
from tallyline.catalog.views import daily, fx_factors, given, transactional
from tallyline.functions.periods import MONTH_NAMES, calendar_of, fiscal_label, month_number, month_of
from tallyline.operators import joins
from tallyline.operators.reshape import shift_years, union_all
from tallyline.operators.rules import rank_of
from tallyline.operators.totals import overlap_counts


@query("J1_left_join_many_keys", given(
    a="SELECT l_returnflag AS flag, l_linestatus AS status, l_linenumber AS line, sum(l_extendedprice) AS first FROM lineitem WHERE l_shipdate < DATE '1998-01-01' AND l_linenumber < 6 GROUP BY 1, 2, 3",
    b="SELECT l_returnflag AS flag, l_linestatus AS status, l_linenumber AS line, sum(l_extendedprice) AS second FROM lineitem WHERE l_shipdate >= DATE '1998-01-01' AND l_linenumber > 2 GROUP BY 1, 2, 3") + f"""
    SELECT a.flag, a.status, a.line, {m('first', 'first')}, {m('second', 'second')} FROM a LEFT JOIN b ON a.flag = b.flag AND a.status = b.status AND a.line = b.line""")
def _(t: Tables):
    keys = [F.col("l_returnflag").alias("flag"), F.col("l_linestatus").alias("status"), F.col("l_linenumber").alias("line")]
    cut = F.lit("1998-01-01").cast("timestamp_ntz")
    a = t.lineitem.filter((F.col("l_shipdate") < cut) & (F.col("l_linenumber") < 6)).groupBy(*keys).agg(cents(F.sum("l_extendedprice"), "first"))
    b = t.lineitem.filter((F.col("l_shipdate") >= cut) & (F.col("l_linenumber") > 2)).groupBy(*keys).agg(cents(F.sum("l_extendedprice"), "second"))
    return a.join(b, ["flag", "status", "line"], "left")


@query("J2_left_join_named_keys", """
    SELECT o_orderkey, o_custkey, c_name, c_mktsegment FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal > 0) ON o_custkey = c_custkey""")
def _(t: Tables):
    accounts = t.customer.filter(F.col("c_acctbal") > 0).select("c_custkey", "c_name", "c_mktsegment")
    return joins.join_named(t.orders.select("o_orderkey", "o_custkey"), accounts, {"o_custkey": "c_custkey"})


@query("J3_common_codes", "SELECT DISTINCT o_orderkey AS code FROM orders WHERE o_orderkey IN (SELECT l_orderkey FROM lineitem)")
def _(t: Tables):
    return joins.common_keys(t.orders, "o_orderkey", t.lineitem, "l_orderkey", "code")


@query("J4_missing_both_ways", """
    WITH a AS (SELECT DISTINCT o_orderkey AS code, o_orderstatus AS status FROM orders),
    b AS (SELECT DISTINCT l_orderkey AS code, l_linestatus AS status FROM lineitem)
    SELECT code, status, 'orders' AS found_in FROM (SELECT * FROM a EXCEPT SELECT * FROM b)
    UNION ALL SELECT code, status, 'lines' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def _(t: Tables):
    a = t.orders.select(F.col("o_orderkey").alias("code"), F.col("o_orderstatus").alias("status"))
    b = t.lineitem.select(F.col("l_orderkey").alias("code"), F.col("l_linestatus").alias("status"))
    return joins.missing_both_ways(a, b, ["code", "status"], names=("orders", "lines"))


@query("J4_anti_join_null_keys", """
    WITH a AS (SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS status FROM orders),
    b AS (SELECT DISTINCT CASE WHEN l_linestatus <> 'O' THEN l_linestatus END AS status FROM lineitem)
    SELECT o_orderkey, status FROM a WHERE NOT EXISTS (SELECT 1 FROM b WHERE a.status IS NOT DISTINCT FROM b.status)""")
def _(t: Tables):
    a = t.orders.select("o_orderkey", F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")).alias("status"))
    b = t.lineitem.select(F.when(F.col("l_linestatus") != "O", F.col("l_linestatus")).alias("status")).distinct()
    return joins.without(a, b, ["status"])


@query("J5_semi_join", "SELECT c_custkey, c_name FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)")
def _(t: Tables):
    big = t.orders.filter(F.col("o_totalprice") > 450000).select(F.col("o_custkey").alias("c_custkey"))
    return t.customer.select("c_custkey", "c_name").join(big, "c_custkey", "left_semi")


@query("J6_membership", """
    SELECT p_partkey, (EXISTS (SELECT 1 FROM lineitem WHERE l_partkey = p_partkey AND l_quantity > 49))::INT AS is_big FROM part
    WHERE p_brand NOT IN (SELECT p_brand FROM part WHERE p_retailprice > 1900)""")
def _(t: Tables):
    kept = joins.keep_members(t.part.select("p_partkey", "p_brand"), "p_brand", t.part.filter(F.col("p_retailprice") > 1900), "p_brand", negate=True)
    return joins.membership(kept, "p_partkey", t.lineitem.filter(F.col("l_quantity") > 49), "l_partkey", "is_big").drop("p_brand")


@query("J7_natural_join", f"""
    WITH a AS (SELECT n_nationkey AS nation, count(*) AS buyers FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
    b AS (SELECT s_nationkey AS nation, count(*) AS suppliers FROM supplier GROUP BY 1),
    c AS (SELECT c_nationkey AS nation, sum(o_totalprice) AS orders FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1)
    SELECT nation, buyers, suppliers, {m('orders', 'orders')} FROM a LEFT JOIN b USING (nation) LEFT JOIN c USING (nation)""")
def _(t: Tables):
    a = t.customer.groupBy(F.col("c_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("buyers"))
    b = t.supplier.groupBy(F.col("s_nationkey").alias("nation")).agg(F.count(F.lit(1)).alias("suppliers"))
    c = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy(F.col("c_nationkey").alias("nation")).agg(cents(F.sum("o_totalprice"), "orders"))
    return joins.natural_join([a, b, c])


@query("J8_prior_years", given("daily", months="SELECT region, date_trunc('month', day)::DATE AS ref_date, sum(value) AS v FROM daily GROUP BY 1, 2") + f"""
    SELECT a.region, a.ref_date, {m('a.v', 'value')}, {m('b.v', 'py')}, {m('c.v', 'ppy')}, {m('d.v', 'pppy')} FROM months a
    LEFT JOIN months b ON a.region = b.region AND b.ref_date = a.ref_date - INTERVAL 1 YEAR
    LEFT JOIN months c ON a.region = c.region AND c.ref_date = a.ref_date - INTERVAL 2 YEAR
    LEFT JOIN months d ON a.region = d.region AND d.ref_date = a.ref_date - INTERVAL 3 YEAR""")
def _(t: Tables):
    months = daily(t).groupBy("region", F.trunc("day", "MM").alias("ref_date")).agg(F.sum("value").alias("value"))
    return rounded(shift_years(months, "ref_date", ["region"], "value", ["py", "ppy", "pppy"]), ["value", "py", "ppy", "pppy"])


@query("J9_lookup_with_fallback", given("transactional", "fx_factors", amounts="SELECT month, business, market, sum(transactional_fx) AS amount FROM transactional GROUP BY 1, 2, 3") + f"""
    SELECT a.month, business, market, {m('amount', 'amount')}, {s('coalesce(x.factor, y.factor)', 'factor')} FROM amounts a
    LEFT JOIN fx_factors x ON x.region_market = business AND x.month = a.month LEFT JOIN fx_factors y ON y.region_market = market AND y.month = a.month""")
def _(t: Tables):
    amounts = transactional(t).groupBy("month", "business", "market").agg(cents(F.sum("transactional_fx"), "amount"))
    found = joins.lookup_with_fallback(amounts, fx_factors(t), "region_market", "factor", "business", "market", on=["month"])
    return rounded(found, shares=["factor"])


@query("J10_contains_any_code", """
    SELECT page_id, url FROM pages WHERE EXISTS (SELECT 1 FROM (SELECT DISTINCT lower(word) AS code FROM (SELECT unnest(string_split_regex(text, '[^A-Za-z]+')) AS word FROM benchmark) WHERE length(word) >= 5)
      WHERE contains(url, code))""")
def _(t: Tables):
    words = t.benchmark.select(F.explode(F.split("text", "[^A-Za-z]+")).alias("code"))
    codes = words.filter(F.length("code") >= 5).select(F.lower("code").alias("code"))
    return joins.containing_any(t.pages.select("page_id", "url"), "url", codes, "code")


# Codes that all begin alike: English pages numbered like customers.
@query("J10_codes_that_begin_alike", """
    SELECT page_id, url FROM pages p WHERE EXISTS (SELECT 1 FROM (SELECT DISTINCT '/en/' || (c_custkey * 3) AS code FROM customer) c WHERE contains(p.url, c.code))""")
def _(t: Tables):
    codes = t.customer.select(F.concat(F.lit("/en/"), (F.col("c_custkey") * 3).cast("string")).alias("code"))
    return joins.containing_any_indexed(t.pages.select("page_id", "url"), "url", codes, "code")


@query("J11_business_days_only", given("daily") + f"""
    SELECT day, 'd' || dayofyear(day) AS day_code, strftime(day, '%b') AS month, 'Q' || quarter(day) AS quarter, {m('sum(value)', 'value')}
    FROM daily WHERE isodow(day) <= 5 GROUP BY 1""")
def _(t: Tables):
    days = calendar_of(daily(t), "day", business_days_only=True).withColumnRenamed("data_date", "day_date").drop("day", "week")
    sums = daily(t).groupBy("day").agg(cents(F.sum("value"), "value"))
    return joins.join_named(sums, days, {"day": "day_date"}, "inner")


@query("J12_report_scaffold", """
    SELECT s_name AS line, y::INT AS observation, 'FY' || substring(y::VARCHAR, 3, 2) AS years, mo AS period, p AS product, make_date(y, i, 1) AS ref_date
    FROM supplier, range(1995, 2002) ys(y), (SELECT unnest(['""" + "', '".join(MONTH_NAMES) + """']) AS mo, unnest(range(1, 13)) AS i), (SELECT unnest(['Total', 'Tools', 'Outdoor']) AS p)""")
def _(t: Tables):
    template = t.supplier.select(F.col("s_name").alias("line"))
    grid = joins.expand_grid(template, observation=range(1995, 2002), period=MONTH_NAMES, product=["Total", "Tools", "Outdoor"])
    return grid.select("line", "observation", fiscal_label("observation").alias("years"), "period", "product", month_of("observation", month_number("period")).alias("ref_date"))


REPORT_LINES = ["NATION_3", "NATION_1", "Hedge", "NATION_24", "NATION_0"]


@query("J13_layout_join", f"""
    WITH sums AS (SELECT n_name AS line, {m('sum(c_acctbal)', 'value')} FROM customer JOIN nation ON c_nationkey = n_nationkey GROUP BY 1),
    lay AS (SELECT unnest({REPORT_LINES!r}) AS line, unnest(range(1, 6))::INT AS ord)
    SELECT lay.line, ord, value FROM lay LEFT JOIN sums ON lay.line = sums.line ORDER BY ord""")
def _(t: Tables):
    lay = t.spark.range(1).select(F.explode(F.array(*[F.lit(x) for x in REPORT_LINES])).alias("line")).withColumn("ord", rank_of("line", REPORT_LINES))
    sums = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).groupBy(F.col("n_name").alias("line")).agg(cents(F.sum("c_acctbal"), "value"))
    return joins.layout(lay, sums, ["line"]).orderBy("ord")


@query("J14_mapping_chain", """
    SELECT DISTINCT s_name AS entity, n_name AS market, r_name AS region, p_brand AS brand FROM lineitem
    JOIN supplier ON l_suppkey = s_suppkey LEFT JOIN nation ON s_nationkey = n_nationkey LEFT JOIN (SELECT * FROM region WHERE r_name <> 'ASIA') ON n_regionkey = r_regionkey
    JOIN part ON l_partkey = p_partkey WHERE l_quantity > 45""")
def _(t: Tables):
    # Duplicate pairs are dropped before the mapping joins, so they see one row per (supplier, part).
    pairs = t.lineitem.filter(F.col("l_quantity") > 45).select("l_suppkey", "l_partkey").distinct()
    step = pairs.join(t.supplier.select("s_suppkey", "s_name", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    step = joins.join_named(step, t.nation.select("n_nationkey", "n_name", "n_regionkey"), {"s_nationkey": "n_nationkey"})
    step = joins.join_named(step, t.region.filter(F.col("r_name") != "ASIA"), {"n_regionkey": "r_regionkey"})
    step = step.join(t.part.select("p_partkey", "p_brand"), F.col("l_partkey") == F.col("p_partkey"))
    return step.select(F.col("s_name").alias("entity"), F.col("n_name").alias("market"), F.col("r_name").alias("region"), F.col("p_brand").alias("brand")).distinct()


@query("U1_union_missing_columns", """
    SELECT c_nationkey AS nation, c_acctbal AS balance, c_mktsegment AS segment FROM customer UNION ALL SELECT s_nationkey, s_acctbal, NULL FROM supplier""")
def _(t: Tables):
    a = t.customer.select(F.col("c_nationkey").alias("nation"), F.col("c_acctbal").alias("balance"), F.col("c_mktsegment").alias("segment"))
    b = t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_nationkey").alias("nation"))
    return union_all(a, b)


@query("U2_strict_union", "SELECT c_name AS name, c_acctbal AS balance FROM customer UNION ALL SELECT s_name, s_acctbal FROM supplier")
def _(t: Tables):
    return t.customer.select(F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")).unionByName(t.supplier.select(F.col("s_acctbal").alias("balance"), F.col("s_name").alias("name")))


@query("U3_union_distinct", "SELECT o_orderdate::DATE AS day, o_custkey AS party FROM orders UNION SELECT l_shipdate::DATE, l_suppkey FROM lineitem")
def _(t: Tables):
    a = t.orders.select(F.col("o_orderdate").cast("date").alias("day"), F.col("o_custkey").alias("party"))
    return a.unionByName(t.lineitem.select(F.col("l_shipdate").cast("date").alias("day"), F.col("l_suppkey").alias("party"))).distinct()


@query("U4_key_overlap", """
    WITH a AS (SELECT DISTINCT o_orderkey AS k FROM orders), b AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_quantity > 20),
    f AS (SELECT 'orders' AS side, (k IN (SELECT k FROM b))::VARCHAR AS found FROM a UNION ALL SELECT 'lines', (k IN (SELECT k FROM a))::VARCHAR FROM b),
    g AS (SELECT s.side, v.found, (SELECT count(*) FROM f WHERE f.side = s.side AND f.found = v.found) AS n FROM (VALUES ('orders'), ('lines')) s(side), (VALUES ('true'), ('false')) v(found))
    SELECT * FROM g UNION ALL SELECT side, 'Total', sum(n)::BIGINT FROM g GROUP BY side""")
def _(t: Tables):
    a = t.orders.select(F.col("o_orderkey").alias("k"))
    b = t.lineitem.filter(F.col("l_quantity") > 20).select(F.col("l_orderkey").alias("k"))
    return overlap_counts(a, b, "k", names=("orders", "lines"))
