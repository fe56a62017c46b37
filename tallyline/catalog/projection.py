"""Queries for projections, filters, predicates and sorts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.catalog.registry import Tables, cents, fine, m, query, rounded, s
from tallyline.catalog.views import given, growth_wide, ledger
from tallyline.functions import nulls
from tallyline.functions.periods import MONTH_NAMES
from tallyline.operators import columns, rules
from tallyline.operators.joins import first_match
from tallyline.plans.growth import LEVEL_1, LEVEL_2


@query("P1_clean_headers", """
    SELECT c_custkey AS customer_key, c_name AS full_name, c_nationkey AS nation_number_key, c_acctbal AS acct_bal_percent,
           c_mktsegment AS x2_segment, c_name AS full_name_2 FROM customer""")
def _(t: Tables):
    messy = t.customer.select(
        F.col("c_custkey").alias("Customer Key"), F.col("c_name").alias("Full.Name"), F.col("c_nationkey").alias("nation #Key"),
        F.col("c_acctbal").alias("AcctBal %"), F.col("c_mktsegment").alias("2-Segment"), F.col("c_name").alias("full name"),
    )
    return columns.clean_names(messy)


@query("P2_pick_columns", "SELECT p_partkey, p_brand, p_retailprice FROM part")
def _(t: Tables):
    kept = columns.keep_matching(t.part, contains=["KEY", "price"], starts_with=["P_b", "p_t"])
    return columns.drop_matching(kept, ends_with=["TYPE"])


@query("P3_rename_by_suffix", "SELECT s_suppkey, s_name AS s_name_dist, s_nationkey AS s_nationkey_dist, s_acctbal AS s_acctbal_dist FROM supplier")
def _(t: Tables):
    return columns.rename_all(t.supplier, lambda name: f"{name}_dist", besides=["s_suppkey"])


@query("P4_project_and_relocate", "SELECT o_orderdate::DATE AS order_day, o_orderpriority AS priority, o_orderkey, o_totalprice AS amount FROM orders")
def _(t: Tables):
    picked = t.orders.select("o_orderkey", F.col("o_totalprice").alias("amount"), F.col("o_orderpriority").alias("priority"), F.col("o_orderdate").cast("date").alias("order_day"))
    moved = columns.relocate(picked, ["order_day"])
    return columns.relocate(moved, ["priority"], after="order_day")


@query("P5_drop_empty_columns", "SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN o_totalprice END AS partly FROM orders")
def _(t: Tables):
    wide = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "P", F.col("o_totalprice")).alias("partly"),
        F.when(F.col("o_orderstatus") == "never", F.col("o_totalprice")).alias("nothing"),
        F.lit(None).cast("string").alias("blank"),
    )
    return columns.drop_empty_columns(wide)


@query("P6_fill_missing", given(sums="SELECT l_orderkey, sum(l_extendedprice) AS amount, max(l_returnflag) AS flag FROM lineitem GROUP BY 1") + f"""
    SELECT o_orderkey, {m("coalesce(amount, 0)", "amount")}, coalesce(flag, 'unknown') AS flag FROM orders LEFT JOIN sums ON o_orderkey = l_orderkey""")
def _(t: Tables):
    sums = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.sum("l_extendedprice").alias("amount"), F.max("l_returnflag").alias("flag"))
    joined = t.orders.select("o_orderkey").join(sums, "o_orderkey", "left")
    return rounded(columns.fill_missing(joined, {"flag": "unknown"}, numbers=0.0), ["amount"])


@query("P7_restore_label", """
    SELECT c_custkey, coalesce(CASE WHEN r_name <> 'AMERICA' THEN r_name END, 'NA') AS region
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""")
def _(t: Tables):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select("n_nationkey", F.when(F.col("r_name") != "AMERICA", F.col("r_name")).alias("region"))
    regions = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "region")
    return columns.restore_label(regions, "region", "NA")


@query("P8_tolerant_numbers", """
    SELECT e.event_id, TRY_CAST(CASE WHEN event_type = 'error' THEN props ELSE value::VARCHAR END AS DOUBLE) AS amount, event_id::VARCHAR AS code FROM events e""")
def _(t: Tables):
    texts = t.events.select("event_id", F.when(F.col("event_type") == "error", F.col("props")).otherwise(F.col("value").cast("string")).alias("amount"), F.col("event_id").cast("string").alias("code"))
    return columns.coerce_numbers(texts, ["amount"])


@query("P9_pattern_filter", """
    SELECT doc_id, url FROM (SELECT page_id AS doc_id, nullif(regexp_extract(url, 'https.*'), '') AS url FROM pages)
    WHERE NOT coalesce(regexp_matches(url, '\\.net|/fr/'), FALSE)""")
def _(t: Tables):
    secure = F.when(F.col("url").rlike("https"), F.regexp_extract("url", "https.*", 0))
    found = t.pages.select(F.col("page_id").alias("doc_id"), secure.alias("url"))
    return found.filter(nulls.lacks("url", r"\.net|/fr/"))


@query("P10_any_present", given(sides="""
    SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_totalprice END AS filled, CASE WHEN o_orderpriority = '1-URGENT' THEN o_orderpriority END AS urgent,
      CASE WHEN o_totalprice > 400000 THEN o_custkey END AS big FROM orders""") + """
    SELECT *, (filled IS NOT NULL AND urgent IS NOT NULL AND big IS NOT NULL) AS complete FROM sides WHERE filled IS NOT NULL OR urgent IS NOT NULL OR big IS NOT NULL""")
def _(t: Tables):
    sides = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("filled"),
        F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_orderpriority")).alias("urgent"),
        F.when(F.col("o_totalprice") > 400000, F.col("o_custkey")).alias("big"),
    )
    cells = ["filled", "urgent", "big"]
    all_there = F.lit(True)
    for name in cells:
        all_there = all_there & F.col(name).isNotNull()
    return columns.keep_any_present(sides, cells).withColumn("complete", all_there)


@query("P10_complete_cases", """
    SELECT o_orderkey, o_totalprice AS filled, o_custkey AS big FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 400000""")
def _(t: Tables):
    sides = t.orders.select(
        "o_orderkey",
        F.when(F.col("o_orderstatus") == "F", F.col("o_totalprice")).alias("filled"),
        F.when(F.col("o_totalprice") > 400000, F.col("o_custkey")).alias("big"),
    )
    return columns.keep_complete(sides)


@query("P11_membership_filter", """
    SELECT segment, count(*) AS n FROM (SELECT CASE WHEN c_acctbal >= 0 THEN c_mktsegment END AS segment FROM customer)
    WHERE NOT coalesce(segment IN ('BUILDING', 'FURNITURE'), FALSE) GROUP BY 1""")
def _(t: Tables):
    segments = t.customer.select(F.when(F.col("c_acctbal") >= 0, F.col("c_mktsegment")).alias("segment"))
    return segments.filter(nulls.none_of("segment", ["BUILDING", "FURNITURE"])).groupBy("segment").agg(F.count(F.lit(1)).alias("n"))


@query("P12_due_tomorrow", """
    SELECT o_orderkey, o_orderstatus AS status, o_orderpriority AS owner, o_orderdate::DATE AS close_day FROM orders
    WHERE o_orderdate = DATE '1998-03-02' AND o_orderstatus <> 'F'""")
def _(t: Tables):
    # The raw column is compared with a literal so that the parquet scan skips other days.
    due = (F.col("o_orderdate") == F.date_add(F.lit("1998-03-01").cast("date"), 1).cast("timestamp_ntz")) & (F.col("o_orderstatus") != "F")
    return t.orders.filter(due).select("o_orderkey", F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("owner"), F.col("o_orderdate").cast("date").alias("close_day"))


NAME_RULES = [("ECONOMY", "Consumables"), ("ANVIL", "Heavy"), ("GIZMO", "Gadgets"), ("RED", "Colour"), ("BLUE", "Colour"), ("HOT", "Thermal"), ("COLD", "Thermal"), ("PROMO", "Promotion")]
NAME_CASE = "CASE " + " ".join(f"WHEN contains(cost_element_name, '{k}') THEN '{v}'" for k, v in NAME_RULES) + " ELSE 'Others' END"


@query("P13_keyword_category", given("ledger") + f"SELECT {NAME_CASE} AS category, count(*) AS n, {m('sum(value)', 'value')} FROM ledger GROUP BY 1")
def _(t: Tables):
    labelled = ledger(t).withColumn("category", rules.categorise("cost_element_name", NAME_RULES, "Others"))
    return labelled.groupBy("category").agg(F.count(F.lit(1)).alias("n"), cents(F.sum("value"), "value"))


# As many rules as there are customers, the later ones first; most beginnings are shared.
@query("P13_rules_of_a_table", """
    WITH r AS (SELECT -c_custkey AS rank, '/' || lower(substr(c_mktsegment, 1, 1)) || CASE WHEN c_nationkey > 12 THEN 'n/' ELSE 'r/' END || c_custkey AS keyword, c_mktsegment || ' ' || c_custkey AS label FROM customer
      UNION ALL SELECT -c_custkey, CASE WHEN c_nationkey % 2 = 0 THEN '/en/' ELSE '/fr/' END || c_custkey, c_mktsegment || ' ' || c_custkey FROM customer)
    SELECT page_id, coalesce((SELECT arg_min(label, (rank, keyword)) FROM r WHERE contains(url, keyword)), 'other') AS category FROM pages""")
def _(t: Tables):
    key = F.col("c_custkey").cast("string")
    rules = [
        t.customer.select((-F.col("c_custkey")).alias("rank"), F.concat(start, key).alias("keyword"), F.concat_ws(" ", "c_mktsegment", key).alias("label"))
        for start in (F.concat(F.lit("/"), F.lower(F.substring("c_mktsegment", 1, 1)), F.when(F.col("c_nationkey") > 12, "n/").otherwise("r/")), F.when(F.col("c_nationkey") % 2 == 0, "/en/").otherwise("/fr/"))
    ]
    return first_match(t.pages.select("page_id", "url"), "url", rules[0].unionByName(rules[1]), "category", "other").select("page_id", "category")


@query("P14_attribute_override", given("ledger", named="""
    SELECT *, CASE WHEN cost_element_name = 'SMALL RED RING' AND value > 50000 THEN offset_account
                   WHEN cost_element_name = 'SMALL RED RING' AND value < -50000 THEN offset_account ELSE cost_element_name END AS name FROM ledger""") + f"""
    SELECT name, count(*) AS n, {m('sum(value)', 'value')} FROM named GROUP BY 1""")
def _(t: Tables):
    name = rules.override_name("cost_element_name", "value", "offset_account", "SMALL RED RING", above=50000, below=-50000)
    return ledger(t).select(name.alias("name"), "value").groupBy("name").agg(F.count(F.lit(1)).alias("n"), cents(F.sum("value"), "value"))


FLAG_ACCOUNTS = {"A": "C&B", "N": "HC", "R": "Capex"}


@query("P15_split_measure", f"""
    SELECT CASE WHEN account = 'HC' THEN 'C&B' ELSE account END AS account, {m("sum(CASE WHEN account = 'HC' THEN v ELSE 0 END)", "ftes")},
           {m("sum(CASE WHEN account = 'HC' THEN 0 ELSE v END)", "value")}
    FROM (SELECT CASE l_returnflag WHEN 'A' THEN 'C&B' WHEN 'N' THEN 'HC' ELSE 'Capex' END AS account, l_extendedprice AS v FROM lineitem) GROUP BY 1""")
def _(t: Tables):
    lines = t.lineitem.select(rules.relabel("l_returnflag", FLAG_ACCOUNTS).alias("account"), F.col("l_extendedprice").alias("v"))
    account, count, amount = rules.split_measure("account", "v", "HC", "C&B")
    split = lines.select(account.alias("account"), count.alias("ftes"), amount.alias("value"))
    return split.groupBy("account").agg(cents(F.sum("ftes"), "ftes"), cents(F.sum("value"), "value"))


@query("P16_account_levels", f"""
    WITH a AS (SELECT CASE l_linenumber WHEN 1 THEN 'Non-C&B' WHEN 2 THEN 'C&B' WHEN 3 THEN 'Net Sales' WHEN 4 THEN 'SGM' WHEN 5 THEN 'Capex' ELSE 'Other' END AS account, l_extendedprice AS v FROM lineitem),
    b AS (SELECT *, CASE WHEN contains(account, 'C&B') THEN 'Opex' WHEN contains(account, 'Sales') THEN 'Sales' ELSE account END AS account_l2 FROM a)
    SELECT account, account_l2, CASE WHEN account_l2 IN ('Opex', 'Capex') THEN 'Investment' ELSE account_l2 END AS account_l1, {m('sum(v)', 'value')} FROM b GROUP BY 1, 2, 3""")
def _(t: Tables):
    names = {1: "Non-C&B", 2: "C&B", 3: "Net Sales", 4: "SGM", 5: "Capex"}
    lines = t.lineitem.select(rules.relabel("l_linenumber", names, default="Other").alias("account"), F.col("l_extendedprice").alias("v"))
    leveled = lines.withColumn("account_l2", rules.categorise("account", LEVEL_2)).withColumn("account_l1", rules.categorise("account_l2", LEVEL_1))
    return leveled.groupBy("account", "account_l2", "account_l1").agg(cents(F.sum("v"), "value"))


@query("P17_indicator_flags", """
    SELECT o_orderpriority AS priority, sum(CASE WHEN o_orderstatus IN ('F', 'P') THEN 1 ELSE 0 END)::BIGINT AS hired,
           sum(CASE WHEN o_totalprice > 250000 THEN 1 ELSE 0 END)::BIGINT AS started FROM orders GROUP BY 1""")
def _(t: Tables):
    flagged = t.orders.select(F.col("o_orderpriority").alias("priority"), rules.flag_in("o_orderstatus", ["F", "P"]).alias("hired"), rules.flag(F.col("o_totalprice") > 250000).alias("started"))
    return flagged.groupBy("priority").agg(F.sum("hired").alias("hired"), F.sum("started").alias("started"))


@query("P18_row_total", given("growth_wide", filled="SELECT team, growth_initiative, code, " + ", ".join(f"coalesce({n}, 0) AS {n}" for n in MONTH_NAMES) + " FROM growth_wide") + f"""
    SELECT team, growth_initiative, code, {m(' + '.join(MONTH_NAMES), 'total')} FROM filled WHERE ({' + '.join(MONTH_NAMES)}) <> 0""")
def _(t: Tables):
    filled = columns.fill_missing(growth_wide(t), numbers=0.0)
    kept = columns.drop_zero_rows(filled, MONTH_NAMES)
    return kept.select("team", "growth_initiative", "code", cents(columns.row_total(MONTH_NAMES), "total"))


@query("P19_safe_ratio", given(sums="""
    SELECT o_custkey, round(sum(CASE WHEN o_orderstatus = 'F' THEN o_totalprice ELSE 0 END), 2) AS actual,
      round(sum(CASE WHEN o_orderstatus = 'O' THEN o_totalprice ELSE 0 END), 2) AS plan FROM orders GROUP BY 1""") + f"""
    SELECT o_custkey, {m('actual - plan', 'variance')}, {s('coalesce((actual - plan) / nullif(plan, 0), 0)', 'variance_share')},
      {s('coalesce(actual / nullif(plan, 0) - 1, 0)', 'growth')} FROM sums""")
def _(t: Tables):
    def part(status: str):
        return F.round(F.sum(F.when(F.col("o_orderstatus") == status, F.col("o_totalprice")).otherwise(0.0)), 2)

    sums = t.orders.groupBy("o_custkey").agg(part("F").alias("actual"), part("O").alias("plan"))
    gap = F.col("actual") - F.col("plan")
    return sums.select("o_custkey", cents(gap, "variance"), fine(nulls.ratio(gap, "plan"), "variance_share"), fine(nulls.zero(nulls.ratio_or_null("actual", "plan") - 1), "growth"))


@query("P20_scale_and_round", given(sums="SELECT l_returnflag, l_linenumber, round(sum(l_extendedprice), 2) AS v, round(sum(l_quantity), 2) AS q FROM lineitem GROUP BY 1, 2") + """
    SELECT l_returnflag, l_linenumber, round_even(v / 1000, 0) + 0e0 AS v, round_even(q / 1000, 0) + 0e0 AS q, round_even(q / v * 10000, -1) + 0e0 AS points FROM sums""")
def _(t: Tables):
    sums = t.lineitem.groupBy("l_returnflag", "l_linenumber").agg(F.round(F.sum("l_extendedprice"), 2).alias("v"), F.round(F.sum("l_quantity"), 2).alias("q"))
    pointed = sums.withColumn("points", nulls.basis_points(nulls.ratio("q", "v")))
    return columns.scale(pointed, ["v", "q"], 1000, digits=0)


@query("P21_constant_rate", f"""
    SELECT c_custkey, {m('c_acctbal * 4120e0', 'local')}, {m('4120e0 * c_acctbal - (9000000e0 - 6400500e0)', 'open_part')} FROM customer""")
def _(t: Tables):
    return t.customer.select("c_custkey", cents(rules.convert("c_acctbal", 4120), "local"), cents(rules.remainder_to_target(F.lit(4120.0), "c_acctbal", 9000000, 6400500), "open_part"))


@query("P22_sign_normalisation", f"""
    SELECT c_mktsegment AS kind, {m("sum(CASE WHEN c_mktsegment = 'BUILDING' THEN -c_acctbal ELSE c_acctbal END)", 'amount')}, {m('sum(abs(c_acctbal))', 'volume')} FROM customer GROUP BY 1""")
def _(t: Tables):
    moved = t.customer.select(F.col("c_mktsegment").alias("kind"), rules.signed("c_acctbal", "c_mktsegment", "BUILDING").alias("amount"), F.abs("c_acctbal").alias("volume"))
    return moved.groupBy("kind").agg(cents(F.sum("amount"), "amount"), cents(F.sum("volume"), "volume"))


@query("O1_sorted_summary", f"SELECT o_orderpriority, o_orderstatus, count(*) AS n, {m('sum(o_totalprice)', 'value')} FROM orders GROUP BY 1, 2 ORDER BY value DESC, o_orderpriority")
def _(t: Tables):
    sums = t.orders.groupBy("o_orderpriority", "o_orderstatus").agg(F.count(F.lit(1)).alias("n"), cents(F.sum("o_totalprice"), "value"))
    return sums.orderBy(F.desc("value"), "o_orderpriority")


@query("O2_top_one", f"""
    SELECT o_custkey, {m('sum(o_totalprice)', 'value')} FROM orders GROUP BY 1 ORDER BY value DESC, o_custkey LIMIT 1""")
def _(t: Tables):
    sums = t.orders.groupBy("o_custkey").agg(cents(F.sum("o_totalprice"), "value"))
    return sums.orderBy(F.desc("value"), "o_custkey").limit(1)


LINE_ORDER = ["STANDARD", "SMALL", "PROMO", "ECONOMY"]


@query("O3_presentation_order", f"""
    SELECT CASE p_type WHEN 'STANDARD' THEN 1 WHEN 'SMALL' THEN 2 WHEN 'PROMO' THEN 3 WHEN 'ECONOMY' THEN 4 END AS indicative, p_type AS line,
      {m('sum(p_retailprice)', 'value')} FROM part GROUP BY 1, 2""")
def _(t: Tables):
    sums = t.part.groupBy(F.col("p_type").alias("line")).agg(cents(F.sum("p_retailprice"), "value"))
    return sums.withColumn("indicative", rules.rank_of("line", LINE_ORDER)).orderBy(F.asc_nulls_last("indicative"), "line")
