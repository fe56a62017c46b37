"""Queries for hierarchies and entity classification."""

from __future__ import annotations

from pyspark.sql import functions as F

from tallyline.catalog.registry import Tables, cents, m, query, rounded
from tallyline.catalog.views import given, hierarchy, transactional
from tallyline.operators.ancestry import ancestry, residuals, roll_up
from tallyline.plans import hierarchy as plan

LEVELS = ["x1", "x2", "x3"]


@query("H1_path_search", given("hierarchy", p="SELECT *, concat_ws('-', x1, x2, x3, member_type, name) AS structure FROM hierarchy") + """
    SELECT dimension, member_type, name, structure FROM p WHERE dimension = 'Entity' AND regexp_matches(structure, 'AMERICA|ASIA') AND regexp_matches(structure, 'NATION_[0-9]-')""")
def _(t: Tables):
    tables = plan.with_path(hierarchy(t), LEVELS, ["member_type", "name"])
    return plan.search(tables, "Entity", "AMERICA|ASIA", "NATION_[0-9]-").select("dimension", "member_type", "name", "structure")


RULES = [
    ("x1", "AMERICA", "North America", "x2"), ("x1", "EUROPE|MIDDLE", "EMEA", "x2"), ("x1", "^AFRICA$", "EMEA", "x2"), ("x1", "ASIA", "Asia", "x2"),
    ("x2", "NATION_1[0-9]", "Manufacturing", "x3"), ("x2", "NATION_2$", "HQ", "x1"), ("x3", "00[0-9]7$", "Hedge", "x1"),
]


def described(t: Tables):
    """Base members with a description out of the supplier's balance and name."""
    suppliers = t.supplier.select(F.col("s_name").alias("supplier"), F.when(F.col("s_acctbal") < 0, "DO NOT USE").when(F.col("s_acctbal") > 8000, "Plant Outdoor").when(F.col("s_acctbal") > 500, "Plant").alias("description"))
    return plan.base_members(hierarchy(t), "Entity", "x3", "Supplier").join(suppliers, F.col("name") == F.col("supplier")).drop("supplier")


BASE = "SELECT h.*, CASE WHEN s_acctbal < 0 THEN 'DO NOT USE' WHEN s_acctbal > 8000 THEN 'Plant Outdoor' WHEN s_acctbal > 500 THEN 'Plant' END AS description FROM hierarchy h JOIN supplier ON name = s_name WHERE member_type = 'Base'"
CLASSIFIED = " UNION ALL ".join(
    f"SELECT CASE WHEN contains(description, 'Outdoor') THEN 'Outdoor' ELSE 'Tools' END AS segment, '{region}' AS region, {sub} AS sub_region, name FROM b WHERE coalesce(description, '') <> 'DO NOT USE' AND regexp_matches({level}, '{pattern}')"
    for level, pattern, region, sub in RULES)


@query("H2_region_classification", given("hierarchy", b=BASE) + CLASSIFIED)
def _(t: Tables):
    return plan.classify(described(t), RULES, "Outdoor", "Tools", unused="DO NOT USE")


@query("H3_segment_complement", given("hierarchy", b=BASE, c=CLASSIFIED) + "SELECT DISTINCT segment, region, sub_region, name FROM c WHERE name NOT IN (SELECT name FROM c WHERE segment = 'Tools')")
def _(t: Tables):
    members = plan.classify(described(t), RULES, "Outdoor", "Tools", unused="DO NOT USE").distinct()
    return plan.complement(members, members.filter(F.col("segment") == "Tools"), "name")


@query("H4_base_members", given("hierarchy") + "SELECT name, x1, x2 FROM hierarchy WHERE member_type = 'Base' AND regexp_matches(x2, 'NATION_(3|7|12)$')")
def _(t: Tables):
    return plan.base_members(hierarchy(t), "Entity", "x2", "NATION_(3|7|12)$").select("name", "x1", "x2")


SALES = "SELECT business AS segment, lc, entity, month, sum(transactional_fx) AS value FROM transactional GROUP BY 1, 2, 3, 4"
GAPS = {
    "sl": SALES,
    "mi": "SELECT * FROM sl WHERE entity NOT IN (SELECT s_name FROM supplier WHERE s_acctbal > 3000) AND value <> 0 AND lc <> 'C1'",
    "g": "SELECT segment, lc, month, sum(value) AS v, string_agg(DISTINCT entity, ',' ORDER BY entity) AS entities, count(DISTINCT entity) AS n_entities FROM mi GROUP BY 1, 2, 3",
}


def gap_sources(t: Tables):
    sales = transactional(t).groupBy(F.col("business").alias("segment"), "lc", "entity", "month").agg(cents(F.sum("transactional_fx"), "value"))
    return sales, t.supplier.filter(F.col("s_acctbal") > 3000).select(F.col("s_name").alias("entity"))


@query("H5_gap_report", given("transactional", **GAPS) + f"""
    SELECT segment, lc, month, {m('v', 'v')}, {m('v * 1000', 'f')}, n_entities FROM g WHERE v <> 0
    UNION ALL SELECT 'Total', '-', '-', {m('sum(v)')}, {m('sum(v) * 1000')}, sum(n_entities)::BIGINT FROM g""")
def _(t: Tables):
    return rounded(plan.gap_report(*gap_sources(t), home_currency="C1", unit=1000.0), ["v", "f"])


@query("H5_gap_names", given("transactional", **GAPS) + "SELECT segment, lc, month, 0::BIGINT AS part, entities, n_entities AS n_items FROM g")
def _(t: Tables):
    return plan.gap_names(*gap_sources(t), home_currency="C1")


@query("H6_region_tie_out", given("transactional", g="SELECT region, sum(transactional_fx) AS v FROM transactional WHERE region NOT LIKE '%MIDDLE%' GROUP BY 1") + f"""
    SELECT region, {m('v', 'transactional_fx')}, NULL::DOUBLE AS difference FROM g UNION ALL SELECT 'Total', {m('sum(v)')}, {m('50000e0 - sum(v)')} FROM g""")
def _(t: Tables):
    return rounded(plan.region_tie_out(transactional(t), "transactional_fx", "MIDDLE", 50000.0), ["transactional_fx", "difference"])


# A ragged hierarchy: chains of twelve customers below their nations, of those in debt below the region at once, and parts
# below the part of half their number.
EDGES = """SELECT 'R ' || r_name AS child, 'World' AS parent FROM region
    UNION ALL SELECT 'N ' || n_name, 'R ' || r_name FROM nation JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT 'C ' || c_custkey, CASE WHEN c_custkey % 12 <> 0 THEN 'C ' || (c_custkey - 1) WHEN c_acctbal >= 0 THEN 'N ' || n_name ELSE 'R ' || r_name END
    FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT 'P ' || p_partkey, CASE WHEN p_partkey > 1 THEN 'P ' || (p_partkey // 2) ELSE 'World' END FROM part WHERE p_partkey > 0"""
CLOSURE = "SELECT child AS member, child AS ancestor, 0 AS distance FROM e UNION ALL SELECT 'World', 'World', 0 UNION ALL SELECT c.member, e.parent, c.distance + 1 FROM c JOIN e ON c.ancestor = e.child"
BOOKED = "SELECT 'C ' || o_custkey AS member, o_totalprice AS amount FROM orders UNION ALL SELECT 'P ' || p_partkey, p_retailprice FROM part WHERE p_partkey > 0"


def recursive(**steps: str) -> str:
    return given(**steps).replace("WITH", "WITH RECURSIVE", 1)


def edges(t: Tables):
    regions = t.region.select(F.concat(F.lit("R "), "r_name").alias("child"), F.lit("World").alias("parent"))
    nations = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    named = nations.select(F.concat(F.lit("N "), "n_name").alias("child"), F.concat(F.lit("R "), "r_name").alias("parent"))
    key = F.col("c_custkey")
    above = F.when(key % 12 != 0, F.concat(F.lit("C "), (key - 1).cast("string"))).when(F.col("c_acctbal") >= 0, F.concat(F.lit("N "), "n_name")).otherwise(F.concat(F.lit("R "), "r_name"))
    customers = t.customer.join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select(F.concat(F.lit("C "), key.cast("string")).alias("child"), above.alias("parent"))
    part = F.col("p_partkey")
    half = F.when(part > 1, F.concat(F.lit("P "), F.floor(part / 2).cast("string"))).otherwise("World")
    parts = t.part.filter(part > 0).select(F.concat(F.lit("P "), part.cast("string")).alias("child"), half.alias("parent"))
    return regions.unionByName(named).unionByName(customers).unionByName(parts)


def booked(t: Tables):
    orders = t.orders.select(F.concat(F.lit("C "), F.col("o_custkey").cast("string")).alias("member"), F.col("o_totalprice").alias("amount"))
    return orders.unionByName(t.part.filter("p_partkey > 0").select(F.concat(F.lit("P "), F.col("p_partkey").cast("string")).alias("member"), F.col("p_retailprice").alias("amount")))


@query("H1_ancestors", recursive(e=EDGES, c=CLOSURE) + "SELECT member, ancestor, distance FROM c")
def _(t: Tables):
    return ancestry(edges(t)).pairs


@query("H6_ragged_roll_up", recursive(e=EDGES, c=CLOSURE, b=f"SELECT member, sum(amount) AS amount FROM ({BOOKED}) GROUP BY 1") + f"""
    SELECT ancestor AS member, {m('coalesce(sum(amount) FILTER (distance = 0), 0)', 'own_amount')}, {m('coalesce(sum(amount), 0)', 'total_amount')}, count(*) FILTER (distance > 0) AS n_below
    FROM c LEFT JOIN b USING (member) GROUP BY 1""")
def _(t: Tables):
    return rounded(roll_up(booked(t), ancestry(edges(t)), "member", ["amount"]), ["own_amount", "total_amount"])


# What was reported: the whole amount below each member, but of every seventh customer nothing.
UNREPORTED = "^C [0-9]*[07]$"


@query("R5_residuals_of_every_level", recursive(
    e=EDGES, c=CLOSURE, b=f"SELECT member, sum(amount) AS amount FROM ({BOOKED}) GROUP BY 1",
    r=f"SELECT ancestor AS member, round(coalesce(sum(amount), 0), 2) AS value FROM c LEFT JOIN b USING (member) WHERE NOT regexp_matches(ancestor, '{UNREPORTED}') GROUP BY 1") + f"""
    SELECT r.member, {m('r.value', 'value')}, {m('coalesce(sum(k.value), 0)', 'children')}, {m('r.value - coalesce(sum(k.value), 0)', 'residual')}, count(*) AS n_children
    FROM r JOIN e ON e.parent = r.member LEFT JOIN r k ON k.member = e.child GROUP BY r.member, r.value""")
def _(t: Tables):
    links = edges(t)
    totals = roll_up(booked(t), ancestry(links), "member", ["amount"]).filter(~F.col("member").rlike(UNREPORTED))
    left = residuals(totals.select("member", cents(F.col("total_amount"), "value")), links, "member", "value")
    return rounded(left, ["value", "children", "residual"])


# Links that run in circles: each part to the remainder of its number's square.
CIRCLES = "SELECT DISTINCT (p_partkey * p_partkey + 1) % 9973 AS child, (((p_partkey * p_partkey + 1) % 9973) * ((p_partkey * p_partkey + 1) % 9973) + 1) % 9973 AS parent FROM part"


@query("H1_cycles", recursive(
    e=CIRCLES, w="SELECT child AS member, parent AS ancestor FROM e UNION SELECT w.member, e.parent FROM w JOIN e ON w.ancestor = e.child",
    y="SELECT member FROM w WHERE member = ancestor", o="SELECT * FROM e WHERE child NOT IN (SELECT member FROM y)",
    c="SELECT child AS member, parent AS ancestor, 1 AS distance FROM o UNION ALL SELECT c.member, o.parent, c.distance + 1 FROM c JOIN o ON c.ancestor = o.child",
    n="SELECT child AS member FROM e UNION SELECT parent FROM e") + """
    SELECT n.member, n.member IN (SELECT member FROM y) AS on_cycle, count(c.ancestor) AS n_above, coalesce(max(distance), 0) AS height FROM n LEFT JOIN c USING (member) GROUP BY 1, 2""")
def _(t: Tables):
    square = (F.col("p_partkey") * F.col("p_partkey") + 1) % 9973
    found = ancestry(t.part.select(square.alias("child"), ((square * square + 1) % 9973).alias("parent")))
    cycle = found.on_cycle.withColumnRenamed("member", "__on").withColumn("__yes", F.lit(True))
    heights = found.pairs.groupBy("member").agg(F.count_if(F.col("distance") > 0).alias("n_above"), F.max("distance").alias("height"))
    return heights.join(cycle, F.col("member") == F.col("__on"), "left").select("member", F.coalesce("__yes", F.lit(False)).alias("on_cycle"), "n_above", "height")
