"""Queries for sources and sinks. Each writes the given tables to a fresh folder and reads them back."""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import functions as F

from tallyline.catalog.registry import Tables, m, query, rounded
from tallyline.catalog.views import given, organics
from tallyline.operators.reshape import union_all
from tallyline.operators.rules import categorise
from tallyline.session import scratch_folder
from tallyline.sources import readers, writers


def people(t: Tables):
    return t.customer.select("c_custkey", "c_name", F.when(F.col("c_nationkey") > 2, F.col("c_mktsegment")).otherwise("NA").alias("segment"), F.when(F.col("c_acctbal") > 0, F.col("c_acctbal")).alias("balance"))


PEOPLE = "SELECT c_custkey, c_name, CASE WHEN c_nationkey > 2 THEN c_mktsegment ELSE 'NA' END AS segment, CASE WHEN c_acctbal > 0 THEN c_acctbal END AS balance FROM customer"
PEOPLE_SCHEMA = "c_custkey bigint, c_name string, segment string, balance double"


@query("S1_delimited_scan", f"SELECT * FROM ({PEOPLE}) UNION ALL SELECT * FROM ({PEOPLE})")
def _(t: Tables):
    root = scratch_folder(t.spark, "delimited")
    frames = []
    for name, sep in (("comma", ","), ("pipe", "|")):
        writers.write_delimited(people(t), f"{root}/{name}", sep)
        frames.append(readers.read_delimited(t.spark, f"{root}/{name}", PEOPLE_SCHEMA, sep))
    return union_all(*frames)


@query("S2_named_table", "SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def _(t: Tables):
    return readers.read_table(t.spark, t.folder, "supplier.parquet").select("s_suppkey", "s_name", "s_acctbal")


@query("S3_snapshot", PEOPLE)
def _(t: Tables):
    path = f"{scratch_folder(t.spark, 'snapshot')}/people"
    writers.save_snapshot(people(t), path)
    return t.spark.read.parquet(path)


@query("S4_file_inventory", """
    SELECT c_mktsegment AS team, c_nationkey AS nation, CASE WHEN c_mktsegment LIKE '%A%' THEN 'with A' ELSE c_mktsegment END AS kind, count(*) AS n_rows, TRUE AS has_bytes FROM customer GROUP BY 1, 2""")
def _(t: Tables):
    """A folder per segment and nation as the tables have them; every file is listed and its rows are counted."""
    root = f"{scratch_folder(t.spark, 'tree')}/people"
    rows = t.customer.select(F.concat_ws("|", F.col("c_custkey").cast("string"), "c_name").alias("value"), "c_mktsegment", "c_nationkey")
    rows.repartition("c_mktsegment", "c_nationkey").write.partitionBy("c_mktsegment", "c_nationkey").text(root)
    files = readers.file_inventory(t.spark, root, ["team", "nation"], glob="*.txt")
    held = t.spark.read.option("recursiveFileLookup", "true").text(root).groupBy(F.col("_metadata.file_path").alias("held")).agg(F.count(F.lit(1)).alias("rows"))
    plain = F.regexp_extract("path", "[^/]+/[^/]+/[^/]+$", 0)
    found = files.withColumn("place", plain).join(held.select(F.regexp_extract("held", "[^/]+/[^/]+/[^/]+$", 0).alias("at"), "rows"), F.col("place") == F.col("at"))
    after = lambda c: F.regexp_extract(c, "=(.*)$", 1)
    team = F.replace(after("team"), F.lit("%20"), F.lit(" "))
    by = found.groupBy(team.alias("team"), after("nation").cast("int").alias("nation")).agg(F.sum("rows").alias("n_rows"), F.min(F.col("length") > 0).alias("has_bytes"))
    return by.withColumn("kind", categorise("team", [("A", "with A")]))


@query("S5_many_file_union", """
    SELECT 'customer' AS source, c_custkey::VARCHAR AS key, c_name AS name, c_mktsegment AS segment, NULL AS balance FROM customer
    UNION ALL SELECT 'supplier', s_suppkey::VARCHAR, s_name, NULL, s_acctbal::DECIMAL(12, 2)::VARCHAR FROM supplier""")
def _(t: Tables):
    root = scratch_folder(t.spark, "union")
    customers = t.customer.select(F.col("c_custkey").alias("Key"), F.col("c_name").alias("Name"), F.col("c_mktsegment").alias("Segment"))
    suppliers = t.supplier.select(F.col("s_suppkey").alias("Key"), F.col("s_acctbal").cast("decimal(12,2)").alias("Balance"), F.col("s_name").alias("Name"))
    writers.write_delimited(customers, f"{root}/customer")
    writers.write_delimited(suppliers, f"{root}/supplier")
    rows = readers.read_many(t.spark, root)
    source = F.when(F.col("segment").isNotNull(), "customer").otherwise("supplier")
    return rows.select(source.alias("source"), "key", "name", "segment", "balance")


def landed(t: Tables) -> str:
    """Order files of three layouts, one for each status, that agree on some columns' types and not on others'."""
    root = scratch_folder(t.spark, "layouts")
    parts = {
        "F": {"Order": F.col("o_orderkey"), "Day": F.col("o_orderdate").cast("date"), "Amount": F.col("o_totalprice").cast("decimal(14,2)"), "Note": F.col("o_custkey")},
        "O": {"Day": F.col("o_orderdate").cast("date"), "Order": F.col("o_orderkey"), "Amount": F.floor("o_totalprice"), "Code": F.lpad(F.col("o_custkey").cast("string"), 9, "0")},
        "P": {"Order": F.col("o_orderkey"), "Day": F.date_format("o_orderdate", "MMM d"), "Note": F.col("o_orderpriority"), "Amount": F.lit(None).cast("string")},
    }
    for status, columns in parts.items():
        writers.write_delimited(t.orders.filter(F.col("o_orderstatus") == status).select(*[c.alias(n) for n, c in columns.items()]), f"{root}/{status}")
    return root


LANDED = """landed AS (
    SELECT 'F' AS status, o_orderkey::VARCHAR AS "order", o_orderdate::DATE::VARCHAR AS day, o_totalprice::DECIMAL(14, 2)::VARCHAR AS amount, o_custkey::VARCHAR AS note, NULL::VARCHAR AS code FROM orders WHERE o_orderstatus = 'F'
    UNION ALL SELECT 'O', o_orderkey::VARCHAR, o_orderdate::DATE::VARCHAR, floor(o_totalprice)::BIGINT::VARCHAR, NULL, lpad(o_custkey::VARCHAR, 9, '0') FROM orders WHERE o_orderstatus = 'O'
    UNION ALL SELECT 'P', o_orderkey::VARCHAR, strftime(o_orderdate, '%b %-d'), NULL, o_orderpriority, NULL FROM orders WHERE o_orderstatus = 'P')"""
LANDED_COLUMNS = ["order", "day", "amount", "note", "code"]


def kind_sql(column: str) -> str:
    c = f'"{column}"'
    return f"""CASE WHEN {c} IS NULL THEN 0 WHEN regexp_full_match({c}, '[+-]?(0|[1-9][0-9]*)') THEN 1 WHEN regexp_full_match({c}, '[+-]?(0|[1-9][0-9]*)(\\.[0-9]+)?') THEN 2
        WHEN regexp_full_match({c}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}') AND try_cast({c} AS DATE) IS NOT NULL THEN 4 ELSE 8 END"""


TYPE_SQL = "CASE WHEN kinds = 0 THEN 'void' WHEN kinds = 1 THEN 'bigint' WHEN kinds & 12 = 0 THEN 'decimal' WHEN kinds = 4 THEN 'date' ELSE 'string' END AS type"


@query("S10_column_types", f"WITH {LANDED}, k AS (" + " UNION ALL ".join(
    f"SELECT status, '{c}' AS \"column\", bit_or({kind_sql(c)}) AS kinds FROM landed GROUP BY ROLLUP (status)" for c in LANDED_COLUMNS) + f') SELECT coalesce(status, \'all\') AS status, "column", {TYPE_SQL} FROM k')
def _(t: Tables):
    """Types of the columns of every layout, and of all of them together, from one pass over the files."""
    rows = readers.read_many(t.spark, landed(t))
    status = F.when(F.col("code").isNotNull(), "O").when(F.col("amount").isNotNull(), "F").otherwise("P").alias("status")
    kinds = readers.column_kinds(rows.select(status, *LANDED_COLUMNS), LANDED_COLUMNS, ["status"])
    whole = readers.column_types(kinds, LANDED_COLUMNS).select(F.lit("all").alias("status"), "column", "type")
    return readers.column_types(kinds, LANDED_COLUMNS, ["status"]).unionByName(whole)


@query("S5_typed_union", f"""WITH {LANDED} SELECT "order"::BIGINT AS "order", day, amount::DOUBLE AS amount, note, code FROM landed""")
def _(t: Tables):
    rows = readers.typed(readers.read_many(t.spark, landed(t)).drop("file_name"))
    return rows.select("order", "day", F.col("amount").cast("double").alias("amount"), "note", "code")


@query("S6_newest_source", """
    SELECT printf('POST_NA_C11_%s_%06d.csv', strftime(o_orderdate, '%Y%m%d'), o_orderkey) AS file, strftime(o_orderdate, '%Y%m%d')::INT AS stamp, o_orderkey AS code FROM orders ORDER BY o_orderdate DESC, o_orderkey DESC LIMIT 1""")
def _(t: Tables):
    name = F.concat(F.lit("POST_NA_C11_"), F.date_format("o_orderdate", "yyyyMMdd"), F.lit("_"), F.format_string("%06d", "o_orderkey"), F.lit(".csv"))
    files = t.orders.select(name.alias("file")).withColumn("path", F.concat(F.lit("feed/"), F.col("file")))
    return readers.newest_source(files, r"_(\d{8})_", r"_(\d+)\.").drop("path").withColumn("code", F.col("code").cast("bigint"))


@query("S7_header_promotion", "SELECT s_suppkey::VARCHAR AS supplier_key, s_name AS supplier_name, s_nationkey::VARCHAR AS nation FROM supplier")
def _(t: Tables):
    root = scratch_folder(t.spark, "header")
    top = t.spark.range(1).select(F.explode(F.array(F.lit("Report,,"), F.lit("Supplier Key,Supplier.Name,Nation"))).alias("value"))
    top.write.text(f"{root}/top")
    t.supplier.select(F.concat_ws(",", F.col("s_suppkey").cast("string"), "s_name", F.col("s_nationkey").cast("string")).alias("value")).write.text(f"{root}/body")
    return readers.promote_header(t.spark, f"{root}/body", row=2, header_path=f"{root}/top")


@query("S8_report_sink", f"SELECT 'segments' AS table_name, c_mktsegment AS line, {m('sum(c_acctbal)', 'value')} FROM customer GROUP BY 2 UNION ALL SELECT 'brands', p_brand, {m('sum(p_retailprice)')} FROM part GROUP BY 2")
def _(t: Tables):
    tables = {
        "segments": t.customer.groupBy(F.col("c_mktsegment").alias("line")).agg(F.sum("c_acctbal").alias("value")),
        "brands": t.part.groupBy(F.col("p_brand").alias("line")).agg(F.sum("p_retailprice").alias("value")),
    }
    root = scratch_folder(t.spark, "report")
    writers.write_report(tables, root)
    back = [readers.read_table(t.spark, root, n).withColumn("table_name", F.lit(n)) for n in tables]
    return rounded(union_all(*back), ["value"])


HISTORY = f"""SELECT region, ref_date, run, {m('sum(result)', 'result')} FROM (
    SELECT region, ref_date, 'r1' AS run, result FROM organics WHERE ref_date < DATE '1998-06-01'
    UNION ALL SELECT region, ref_date, 'r2', result * 2 FROM organics WHERE ref_date >= DATE '1998-06-01' AND ref_date < DATE '1999-02-01'
    UNION ALL SELECT region, ref_date, 'r3', result * 3 FROM organics WHERE ref_date >= DATE '1999-02-01') GROUP BY 1, 2, 3"""


def history(t: Tables, after: dict | None = None) -> str:
    """Three refreshes of the whole table: the first up to 1998, the others from a moment on with new amounts. after: what to do with the log after a run."""
    path = f"{scratch_folder(t.spark, 'history')}/organics"
    rows = organics(t).groupBy("geo", "region", "channel", "type", "ref_date").agg(F.sum("result").alias("result"))
    day = F.col("ref_date")

    def refresh(condition, times: int, run: str, moment: date) -> None:
        writers.append_run(rows.filter(condition).withColumn("result", F.col("result") * times), path, run, moment, "ref_date")
        if run in (after or {}):
            after[run](path)

    refresh(day < F.lit("1999-01-01").cast("date"), 1, "r1", date(1900, 1, 1))
    refresh(day >= F.lit("1998-06-01").cast("date"), 2, "r2", date(1998, 6, 1))
    refresh(day >= F.lit("1999-02-01").cast("date"), 3, "r3", date(1999, 2, 1))
    return path


@query("S9_history_append", given("organics") + HISTORY)
def _(t: Tables):
    visible = readers.read_history(t.spark, history(t), "ref_date")
    return rounded(visible.groupBy("region", "ref_date", "run").agg(F.sum("result").alias("result")), ["result"])


@query("S9_folded_history", given("organics") + HISTORY)
def _(t: Tables):
    """The same history after two refreshes were folded into a base and the third came after it."""
    path = history(t, after={"r2": lambda path: writers.fold_runs(t.spark, path, "ref_date")})
    visible = readers.read_history(t.spark, path, "ref_date")
    return rounded(visible.groupBy("region", "ref_date", "run").agg(F.sum("result").alias("result")), ["result"])


@query("S10_schema_audit", """
    SELECT 'key,name,team' AS columns, 3 AS n_columns, FALSE AS lacks_required, count(*) AS n_rows FROM customer
    UNION ALL SELECT 'key,balance', 2, TRUE, count(*) FROM supplier""")
def _(t: Tables):
    root = scratch_folder(t.spark, "audit")
    writers.write_delimited(t.customer.select(F.col("c_custkey").alias("Key"), F.col("c_name").alias("Name"), F.col("c_mktsegment").alias("Team")), f"{root}/customer")
    writers.write_delimited(t.supplier.select(F.col("s_suppkey").alias("Key"), F.col("s_acctbal").alias("Balance")), f"{root}/supplier")
    audited = readers.schema_audit(t.spark, root, "team")
    return audited.groupBy("columns", "n_columns", "lacks_required").agg(F.sum("n_lines").alias("n_rows"))


REFRESHED = """SELECT geo, region, channel, type, ref_date, sum(result) AS result FROM organics WHERE ref_date < DATE '1998-06-01' GROUP BY 1, 2, 3, 4, 5
    UNION ALL SELECT geo, region, channel, type, ref_date, sum(result) * 2 FROM organics WHERE ref_date >= DATE '1998-06-01' AND ref_date < DATE '1999-02-01' GROUP BY 1, 2, 3, 4, 5
    UNION ALL SELECT geo, region, channel, type, ref_date, sum(result) * 3 FROM organics WHERE ref_date >= DATE '1999-02-01' GROUP BY 1, 2, 3, 4, 5"""


@query("R7_snapshot_refresh", given("organics", h=REFRESHED) + f"""
    SELECT geo, region, channel, type, ref_date, {m('result', 'result')}, DATE '1999-06-02' AS exec_day, '1999-06-02 08:30:00' AS timestamp FROM h""")
def _(t: Tables):
    visible = readers.read_history(t.spark, history(t), "ref_date").drop("run")
    return rounded(writers.stamp_run(visible, date(1999, 6, 2), datetime(1999, 6, 2, 8, 30)), ["result"])
