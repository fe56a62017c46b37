"""Queries for reconciliations, rejected postings and requisitions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.catalog.registry import Tables, m, query, rounded
from tallyline.catalog.views import given
from tallyline.operators import digests
from tallyline.operators.totals import add_totals
from tallyline.plans import reconcile
from tallyline.session import scratch_folder

PLAN = "SELECT p_type AS team, p_brand AS initiative, strftime(l_shipdate, '%B') AS month, CASE WHEN l_quantity > 1 THEN l_extendedprice ELSE 0 END AS value FROM lineitem JOIN part ON l_partkey = p_partkey"
SIDES = {
    "st": f"SELECT team, initiative, month, sum(value) AS ruled FROM ({PLAN} WHERE l_returnflag = 'N' AND p_brand <> 'Brand#7') WHERE value <> 0 GROUP BY 1, 2, 3",
    "sc": f"SELECT team, initiative, month, sum(value) AS cloud FROM ({PLAN} WHERE l_returnflag = 'A' AND p_brand <> 'Brand#3') WHERE value <> 0 GROUP BY 1, 2, 3",
    "j": "SELECT st.*, cloud, cloud - ruled AS divergence FROM st LEFT JOIN sc USING (team, initiative, month)",
}
PLAN_KEYS = ["team", "initiative", "month"]


def diagnosed(t: Tables):
    lines = t.lineitem.join(t.part.select("p_partkey", "p_type", "p_brand"), F.col("l_partkey") == F.col("p_partkey")).select(
        F.col("p_type").alias("team"), F.col("p_brand").alias("initiative"), F.date_format("l_shipdate", "MMMM").alias("month"), "l_returnflag",
        F.when(F.col("l_quantity") > 1, F.col("l_extendedprice")).otherwise(0.0).alias("value"),
    )
    plan = lines.filter((F.col("l_returnflag") == "N") & (F.col("initiative") != "Brand#7"))
    collected = lines.filter((F.col("l_returnflag") == "A") & (F.col("initiative") != "Brand#3"))
    return reconcile.plan_vs_collected(plan, collected, PLAN_KEYS)


@query("K1_plan_vs_collected", given(**SIDES) + f"SELECT team, initiative, month, {m('ruled', 'ruled_value')}, {m('cloud', 'cloud_value')}, {m('divergence', 'divergence')} FROM j")
def _(t: Tables):
    return rounded(diagnosed(t), ["ruled_value", "cloud_value", "divergence"])


@query("K1_divergences", given(**SIDES) + f"SELECT team, initiative, month, {m('ruled', 'ruled_value')}, {m('cloud', 'cloud_value')}, round_even(round(divergence, 2), 0) + 0e0 AS divergence FROM j WHERE divergence <> 0")
def _(t: Tables):
    exact = rounded(diagnosed(t), ["ruled_value", "cloud_value", "divergence"])
    return reconcile.divergences(exact, PLAN_KEYS)


TRADE = {
    "bills": "SELECT o_custkey::VARCHAR AS code, o_orderpriority AS brand, sum(o_totalprice) AS shipped, sum(o_totalprice * 2) AS cost FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1, 2",
    "sold": "SELECT o_custkey::VARCHAR AS code, o_orderpriority AS brand, sum(o_totalprice) AS shipped, sum(o_totalprice * 3) AS cost FROM orders WHERE o_totalprice > 200000 GROUP BY 1, 2",
    "cm": "SELECT code FROM bills INTERSECT SELECT code FROM sold",
    "r": """SELECT code, brand, b.shipped AS shipped_bills, s.shipped AS shipped_sales, b.cost AS cost_bills, s.cost AS cost_sales, b.shipped - s.shipped AS delta_shipped, b.cost - s.cost AS delta_cost
        FROM bills b FULL JOIN sold s USING (code, brand) WHERE code IN (SELECT code FROM cm) AND NOT contains(code, '99')""",
}
TRADE_CELLS = ["shipped_bills", "shipped_sales", "cost_bills", "cost_sales", "delta_shipped", "delta_cost"]


@query("K2_sales_vs_billing", given(**TRADE) + f"""
    SELECT code, brand, {', '.join(m(f'coalesce({c}, 0)', c) for c in TRADE_CELLS)}, {m('coalesce(delta_cost, 0) + coalesce(delta_shipped, 0)', 'delta_total')},
      (round(coalesce(delta_cost, 0) + coalesce(delta_shipped, 0), 2) = 0)::INT AS matched FROM r""")
def _(t: Tables):
    rows = t.orders.select(F.col("o_custkey").cast("string").alias("code"), F.col("o_orderpriority").alias("brand"), F.col("o_totalprice").alias("shipped"), "o_orderstatus")
    billing = rows.filter(F.col("o_orderstatus") != "P").withColumn("cost", F.col("shipped") * 2)
    sales = rows.filter(F.col("shipped") > 200000).withColumn("cost", F.col("shipped") * 3)
    return rounded(reconcile.sales_vs_billing(billing, sales, excluded="99"), [*TRADE_CELLS, "delta_total"])


@query("K2_unmatched_by_digest", given(**TRADE) + f"""
    SELECT code, brand, {', '.join(m(f'coalesce({c}, 0)', c) for c in TRADE_CELLS)}, {m('coalesce(delta_cost, 0) + coalesce(delta_shipped, 0)', 'delta_total')}
    FROM r WHERE round(coalesce(delta_cost, 0) + coalesce(delta_shipped, 0), 2) <> 0""")
def _(t: Tables):
    rows = t.orders.select(F.col("o_custkey").cast("string").alias("code"), F.col("o_orderpriority").alias("brand"), F.col("o_totalprice").alias("shipped"), "o_orderstatus")
    billing = rows.filter(F.col("o_orderstatus") != "P").withColumn("cost", F.col("shipped") * 2)
    sales = rows.filter(F.col("shipped") > 200000).withColumn("cost", F.col("shipped") * 3)
    return rounded(reconcile.unmatched(billing, sales, excluded="99"), [*TRADE_CELLS, "delta_total"])


# A copy of the ledger in which some lines were changed, some lost and some split in two.
COPY = {
    "a": "SELECT l_orderkey AS entry, l_suppkey AS entity, l_linenumber AS line, l_extendedprice AS amount, l_quantity AS units FROM lineitem",
    "b": """SELECT entry, entity, line, CASE WHEN entry % 997 = 3 THEN amount + 0.01 ELSE amount END AS amount, CASE WHEN entry % 1499 = 8 THEN units - 1 ELSE units END AS units
        FROM a WHERE NOT (entry % 1201 = 5 AND line = 1)""",
    "sa": "SELECT entry, entity, round(sum(amount), 2) AS amount, sum(units) AS units FROM a GROUP BY 1, 2",
    "sb": "SELECT entry, entity, round(sum(amount), 2) AS amount, sum(units) AS units FROM b GROUP BY 1, 2",
    "d": "SELECT entry, entity, sa.amount AS amount_ledger, sb.amount AS amount_copy, sa.units AS units_ledger, sb.units AS units_copy, sa.entry IS NOT NULL AS in_ledger, sb.entry IS NOT NULL AS in_copy FROM sa FULL JOIN sb USING (entry, entity)",
}
COPY_SQL = "SELECT * FROM d WHERE amount_ledger IS DISTINCT FROM amount_copy OR units_ledger IS DISTINCT FROM units_copy OR in_ledger <> in_copy"


def ledger_and_copy(t: Tables):
    ledger = t.lineitem.select(F.col("l_orderkey").alias("entry"), F.col("l_suppkey").alias("entity"), F.col("l_linenumber").alias("line"), F.col("l_extendedprice").alias("amount"), F.col("l_quantity").alias("units"))
    entry = F.col("entry")
    copy = ledger.filter(~((entry % 1201 == 5) & (F.col("line") == 1))).withColumns({
        "amount": F.when(entry % 997 == 3, F.col("amount") + 0.01).otherwise(F.col("amount")), "units": F.when(entry % 1499 == 8, F.col("units") - 1).otherwise(F.col("units"))})
    # One line in seven is booked in two halves: equal sums of unequal rows.
    halves = copy.withColumn("share", F.explode(F.when(F.col("line") == 7, F.array(F.lit(1.0), F.lit(0.0))).otherwise(F.array(F.lit(1.0)))))
    return ledger, halves.withColumns({"amount": F.col("amount") * F.col("share"), "units": F.col("units") * F.col("share")})


@query("J4_tie_out_by_digest", given(**COPY) + COPY_SQL)
def _(t: Tables):
    return rounded(digests.tie_out(*ledger_and_copy(t), ["entry", "entity"], ["amount", "units"], ("ledger", "copy")), ["amount_ledger", "amount_copy"])


@query("J4_tie_out_of_written", given(**COPY) + COPY_SQL)
def _(t: Tables):
    paths = [scratch_folder(t.spark, name) for name in ("ledger", "copy")]
    for side, path in zip(ledger_and_copy(t), paths, strict=True):
        digests.write_keyed(side, path, ["entry", "entity"], ["amount", "units"])
    return rounded(digests.tie_out_written(t.spark, *paths, ["entry", "entity"], ["amount", "units"], ("ledger", "copy")), ["amount_ledger", "amount_copy"])


@query("K3_wide_compress", f"""
    SELECT l_returnflag, l_linestatus, p_type, p_brand, {m('sum(l_quantity)', 'l_quantity')}, {m('sum(l_extendedprice)', 'l_extendedprice')}, {m('sum(l_discount)', 'l_discount')}, {m('sum(l_tax)', 'l_tax')},
      {m('sum(p_retailprice)', 'p_retailprice')}, sum(p_size)::BIGINT AS p_size FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY 1, 2, 3, 4""")
def _(t: Tables):
    rows = t.lineitem.drop("l_shipdate").join(t.part.drop("p_name"), F.col("l_partkey") == F.col("p_partkey"))
    codes = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "p_partkey"]
    out = reconcile.compress(rows, ["l_returnflag", "l_linestatus", "p_type", "p_brand"], identifiers=codes)
    return rounded(out, ["l_quantity", "l_extendedprice", "l_discount", "l_tax", "p_retailprice"])


# Rejected postings: orders stand in for postings, customers for the account map.
POSTINGS = """SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'ACCT;ENTITY' WHEN o_orderstatus = 'O' THEN 'ENTITY' END AS error_columns, o_custkey::VARCHAR AS account,
    'E' || o_custkey::VARCHAR AS report_entity, 'A' || (o_custkey * 3)::VARCHAR AS report_account, CASE WHEN o_orderpriority <> '5-LOW' THEN o_totalprice::VARCHAR ELSE 'open' END AS amount,
    substring(o_orderpriority, 3, 3) AS business_area, o_orderstatus AS currency, 'F' || o_orderstatus AS report_function, o_orderpriority AS center FROM orders"""
ACCOUNT_MAP = """SELECT c_custkey::VARCHAR AS entity, (c_custkey * 3)::VARCHAR AS account, c_custkey::VARCHAR AS source_account, c_mktsegment AS custom, c_name || ' ' || CASE WHEN c_nationkey < 12 THEN 'URGENT' ELSE 'none' END AS partner
    FROM customer WHERE c_acctbal > 0"""
ACCOUNTS = "SELECT (c_custkey * 3)::VARCHAR AS target_account, 'R' || c_nationkey::VARCHAR AS report_account FROM customer WHERE c_nationkey <> 5"
FUNCTIONS = "SELECT DISTINCT c_mktsegment AS function_code, lower(c_mktsegment) AS report_function FROM customer WHERE c_mktsegment <> 'BUILDING'"


def postings(t: Tables):
    key = F.col("o_custkey")
    return t.orders.select(
        "o_orderkey", F.when(F.col("o_orderstatus") == "P", "ACCT;ENTITY").when(F.col("o_orderstatus") == "O", "ENTITY").alias("error_columns"),
        key.cast("string").alias("account"), F.concat(F.lit("E"), key.cast("string")).alias("report_entity"), F.concat(F.lit("A"), (key * 3).cast("string")).alias("report_account"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_totalprice").cast("string")).otherwise("open").alias("amount"),
        F.substring("o_orderpriority", 3, 3).alias("business_area"), F.col("o_orderstatus").alias("currency"), F.concat(F.lit("F"), F.col("o_orderstatus")).alias("report_function"),
        F.col("o_orderpriority").alias("center"),
    )


def account_map(t: Tables):
    key = F.col("c_custkey")
    return t.customer.filter(F.col("c_acctbal") > 0).select(
        key.cast("string").alias("entity"), (key * 3).cast("string").alias("account"), key.cast("string").alias("source_account"), F.col("c_mktsegment").alias("custom"),
        F.concat_ws(" ", "c_name", F.when(F.col("c_nationkey") < 12, "URGENT").otherwise("none")).alias("partner"),
    )


def targets(t: Tables):
    accounts = t.customer.filter(F.col("c_nationkey") != 5).select((F.col("c_custkey") * 3).cast("string").alias("target_account"), F.concat(F.lit("R"), F.col("c_nationkey").cast("string")).alias("report_account"))
    functions = t.customer.filter(F.col("c_mktsegment") != "BUILDING").select(F.col("c_mktsegment").alias("function_code"), F.lower("c_mktsegment").alias("report_function")).distinct()
    return accounts, functions


@query("K4_rejects_by_account", given(p=POSTINGS, a=ACCOUNT_MAP, ac=ACCOUNTS, fn=FUNCTIONS, rj="SELECT * FROM p WHERE contains(error_columns, 'ACCT')") + """
    SELECT DISTINCT '000' || a.source_account AS account, a.entity, 'E' || a.entity AS report_entity, a.account AS target_account, ac.report_account, a.custom AS function_code, fn.report_function
    FROM a JOIN ac ON ac.target_account = a.account LEFT JOIN fn ON fn.function_code = a.custom WHERE a.entity IN (SELECT account FROM rj) AND a.source_account IN (SELECT account FROM rj)""")
def _(t: Tables):
    return reconcile.account_upload(reconcile.rejected(postings(t), "ACCT"), account_map(t), *targets(t))


@query("K4_reject_total", given(p=POSTINGS) + f"SELECT {m('coalesce(sum(TRY_CAST(amount AS DOUBLE)), 0)', 'total')}, count(*) AS n FROM p WHERE contains(error_columns, 'ACCT')")
def _(t: Tables):
    return rounded(reconcile.reject_total(reconcile.rejected(postings(t), "ACCT")), ["total"])


ENTITY = {
    "p": POSTINGS, "a": ACCOUNT_MAP,
    "rj": "SELECT o_orderkey, '000' || account AS account, report_account, replace(report_account, 'A', '') AS plain_account, TRY_CAST(amount AS DOUBLE) AS amount, business_area, currency, center FROM p WHERE contains(error_columns, 'ENTITY')",
    "fo": """SELECT DISTINCT '000' || source_account AS source_account, entity FROM a WHERE '000' || source_account IN (SELECT account FROM rj) AND account IN (SELECT plain_account FROM rj)
        AND EXISTS (SELECT 1 FROM (SELECT DISTINCT business_area FROM rj) x WHERE contains(a.partner, x.business_area))""",
    "em": """SELECT DISTINCT o_orderkey, rj.account, report_account, plain_account, amount, business_area, currency, center,
        CASE WHEN length(entity) = 4 THEN 'E' || entity WHEN length(entity) <> 4 THEN 'E0' || entity END AS report_entity FROM rj LEFT JOIN fo ON fo.source_account = rj.account""",
}


def mapped_entities(t: Tables):
    return reconcile.entity_map(reconcile.rejected(postings(t), "ENTITY"), account_map(t))


@query("K5_entity_map", given(**ENTITY) + "SELECT o_orderkey, account, report_account, plain_account, amount, business_area, currency, center, report_entity FROM em")
def _(t: Tables):
    return mapped_entities(t)


@query("K5_entity_upload", given(**ENTITY) + "SELECT DISTINCT business_area, center, currency, report_entity, report_account FROM em WHERE report_entity IS NOT NULL")
def _(t: Tables):
    return reconcile.entity_upload(mapped_entities(t), ["business_area", "center", "currency", "report_entity", "report_account"])


@query("K5_basic_entity_upload", given(**ENTITY) + "SELECT DISTINCT business_area, currency, report_entity FROM em WHERE report_entity IS NOT NULL")
def _(t: Tables):
    return reconcile.entity_upload(mapped_entities(t), ["business_area", "currency", "report_entity"])


CENTERS = "SELECT DISTINCT l_suppkey::VARCHAR AS center, p_type AS fn FROM lineitem JOIN part ON l_partkey = p_partkey WHERE l_quantity > 48"


def center_pairs(t: Tables):
    pairs = t.lineitem.filter(F.col("l_quantity") > 48).join(t.part.select("p_partkey", "p_type"), F.col("l_partkey") == F.col("p_partkey"))
    return pairs.select(F.col("l_suppkey").cast("string").alias("center"), F.col("p_type").alias("fn"))


@query("K6_functions_per_center", given(c=CENTERS) + "SELECT center, 0::BIGINT AS part, string_agg(fn, ',' ORDER BY fn) AS functions, count(*) AS n_items FROM c GROUP BY 1")
def _(t: Tables):
    return reconcile.functions_per_center(center_pairs(t), "center", "fn")


@query("K6_centers_not_mapped", given(c=CENTERS, g="SELECT center, 0::BIGINT AS part, string_agg(fn, ',' ORDER BY fn) AS functions, count(*) AS n_items FROM c GROUP BY 1") + """
    SELECT * FROM g WHERE center NOT IN (SELECT s_suppkey::VARCHAR FROM supplier WHERE s_acctbal > 2000)""")
def _(t: Tables):
    current = t.supplier.filter(F.col("s_acctbal") > 2000).select(F.col("s_suppkey").cast("string").alias("current_center"))
    return reconcile.functions_per_center(reconcile.unmapped_centers(center_pairs(t), "center", current, "current_center"), "center", "fn")


REQUESTS = {
    "a": "SELECT CASE WHEN c_nationkey > 3 THEN c_custkey::VARCHAR END AS number, 'C' || c_custkey::VARCHAR AS number_2, 'Growth: ' || c_mktsegment || ' . extra' AS justification, 'NA - ' || c_mktsegment || ' - tools' AS business FROM customer WHERE c_acctbal > 0",
    "b": "SELECT s_suppkey::VARCHAR AS number, NULL::VARCHAR AS number_2, 'Backfill' AS justification, 'EMEA - plant' AS business FROM supplier",
    "r": """SELECT coalesce(trim(number), trim(number_2)) AS number, trim(string_split_regex(justification, '[.?:]')[2]) AS justification, trim(string_split(business, '-')[1]) AS region, trim(string_split(business, '-')[2]) AS segment,
        coalesce(trim(string_split(business, '-')[3]), 'unknown') AS unit FROM (SELECT * FROM a UNION ALL SELECT * FROM b)""",
    "c": """SELECT *, (number IN (SELECT o_custkey::VARCHAR FROM orders WHERE o_totalprice > 400000))::INT AS in_long, (number IN (SELECT o_custkey::VARCHAR FROM orders WHERE o_orderpriority = '1-URGENT'))::INT AS in_short FROM r""",
}


def requisitions(t: Tables):
    a = t.customer.filter(F.col("c_acctbal") > 0).select(
        F.when(F.col("c_nationkey") > 3, F.col("c_custkey").cast("string")).alias("number"), F.concat(F.lit("C"), F.col("c_custkey").cast("string")).alias("number_2"),
        F.concat(F.lit("Growth: "), F.col("c_mktsegment"), F.lit(" . extra")).alias("justification"), F.concat(F.lit("NA - "), F.col("c_mktsegment"), F.lit(" - tools")).alias("business"),
    )
    b = t.supplier.select(F.col("s_suppkey").cast("string").alias("number"), F.lit("Backfill").alias("justification"), F.lit("EMEA - plant").alias("business"))
    return reconcile.parse_requisitions(a, b)


def stores(t: Tables):
    rows = t.orders.select(F.col("o_custkey").cast("string").alias("req"), "o_totalprice", "o_orderpriority")
    return {"long": (rows.filter(F.col("o_totalprice") > 400000), "req"), "short": (rows.filter(F.col("o_orderpriority") == "1-URGENT"), "req")}


@query("K7_requisition_cross_check", given(**REQUESTS) + "SELECT *, in_long + in_short AS found FROM c")
def _(t: Tables):
    return reconcile.cross_check(requisitions(t), stores(t))


@query("K7_pending_requisitions", given(**REQUESTS) + "SELECT number, justification, region, segment, unit FROM c WHERE in_long + in_short = 0")
def _(t: Tables):
    requests = requisitions(t)
    return reconcile.pending(requests, reconcile.cross_check(requests, stores(t)))


@query("K7_requisition_summary", given(**REQUESTS, g="SELECT region, segment, unit, justification, count(*) AS n FROM r GROUP BY 1, 2, 3, 4") + """
    SELECT * FROM g UNION ALL SELECT 'Total', '-', '-', '-', sum(n)::BIGINT FROM g""")
def _(t: Tables):
    return add_totals(requisitions(t).groupBy("region", "segment", "unit", "justification").agg(F.count(F.lit(1)).alias("n")), "region")
