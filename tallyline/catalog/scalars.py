"""Queries for scalar functions and for functions mapped over parameter tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.catalog.registry import Tables, cents, m, query
from tallyline.catalog.views import daily, given
from tallyline.functions import nulls, periods, text
from tallyline.operators.reshape import union_all


@query("F1_text_tests", r"""
    SELECT doc_id, regexp_matches(text, '(?i)license|copyright') AS is_legal, contains(text, '@') AS has_at, (length(text) - length(replace(text, ',', '')))::INT AS commas, length(text)::INT AS n_chars FROM documents""")
def _(t: Tables):
    body = F.col("text")
    return t.documents.select(
        "doc_id", nulls.matches(body, "(?i)license|copyright").alias("is_legal"), nulls.holds(body, "@").alias("has_at"),
        F.regexp_count(body, F.lit(",")).alias("commas"), F.length(body).alias("n_chars"),
    )


@query("F2_text_edits", r"""
    SELECT page_id, regexp_replace(url, '^https?://', '') AS bare, replace(url, '/en/', '/EN/') AS upper_lang, regexp_replace(url, '\D', '', 'g') AS digits, trim(replace(url, '/', ' ')) AS words FROM pages""")
def _(t: Tables):
    url = F.col("url")
    return t.pages.select(
        "page_id", F.regexp_replace(url, "^https?://", "").alias("bare"), F.replace(url, F.lit("/en/"), F.lit("/EN/")).alias("upper_lang"),
        text.digits_only(url).alias("digits"), F.trim(F.replace(url, F.lit("/"), F.lit(" "))).alias("words"),
    )


@query("F3_text_case", """
    SELECT p_partkey, upper(p_name) AS loud, lower(p_type) AS quiet,
      upper(substring(split_part(p_name, ' ', 1), 1, 1)) || substring(split_part(p_name, ' ', 1), 2) || ' ' || upper(substring(split_part(p_name, ' ', 2), 1, 1)) || substring(split_part(p_name, ' ', 2), 2) AS title FROM part""")
def _(t: Tables):
    return t.part.select("p_partkey", F.upper("p_name").alias("loud"), F.lower("p_type").alias("quiet"), F.initcap("p_name").alias("title"))


@query("F4_substring_extract", r"""
    SELECT s_suppkey, substring(s_name, 1, 4) AS head, substring(s_name, 10, 9) AS code, regexp_extract(s_name, '[^#]+') AS kind, nullif(regexp_extract(s_name, '[7-9]{2}'), '') AS high FROM supplier""")
def _(t: Tables):
    return t.supplier.select(
        "s_suppkey", text.slice_text("s_name", 0, 4).alias("head"), text.slice_text("s_name", 10, 18).alias("code"),
        text.extract_or_null("s_name", "[^#]+").alias("kind"), text.extract_or_null("s_name", "[7-9]{2}").alias("high"),
    )


@query("F5_split_and_concat", r"""
    SELECT page_id, parts[1] AS scheme, parts[2] AS host, parts[3] AS lang, parts[9] AS beyond, concat_ws('|', parts[2], parts[9], parts[3]) AS joined
    FROM (SELECT page_id, string_split_regex(regexp_replace(url, '://', '/'), '[/?#]') AS parts FROM pages)""")
def _(t: Tables):
    flat = F.regexp_replace("url", "://", "/")
    pieces = [text.piece(flat, "[/?#]", i) for i in (0, 1, 2, 8)]
    scheme, host, lang, beyond = pieces
    return t.pages.select("page_id", scheme.alias("scheme"), host.alias("host"), lang.alias("lang"), beyond.alias("beyond"), F.concat_ws("|", host, beyond, lang).alias("joined"))


@query("F6_key_padding", """
    SELECT o_orderkey, '000' || o_orderkey::VARCHAR AS account, CASE WHEN length(o_custkey::VARCHAR) = 4 THEN 'E' ELSE 'E0' END || o_custkey::VARCHAR AS entity,
      replace(replace('A' || o_custkey::VARCHAR, 'A', ''), 'E', '') AS stripped FROM orders""")
def _(t: Tables):
    customer = F.col("o_custkey").cast("string")
    return t.orders.select(
        "o_orderkey", F.concat(F.lit("000"), F.col("o_orderkey").cast("string")).alias("account"), text.pad_code(customer, 4, "E", "E0").alias("entity"),
        F.regexp_replace(F.concat(F.lit("A"), customer), "A|E", "").alias("stripped"),
    )


@query("F7_date_parts", """
    SELECT o_orderkey, make_date(year(o_orderdate), month(o_orderdate), 1) AS month_start, year(o_orderdate)::INT AS y, month(o_orderdate)::INT AS mo, day(o_orderdate)::INT AS d, quarter(o_orderdate)::INT AS q,
      DATE '1899-12-30' + o_custkey::INT AS from_serial, DATE '1899-12-31' + o_custkey::INT AS from_late_serial FROM orders""")
def _(t: Tables):
    day = F.col("o_orderdate")
    return t.orders.select(
        "o_orderkey", periods.month_of(F.year(day), F.month(day)).alias("month_start"), F.year(day).alias("y"), F.month(day).alias("mo"), F.dayofmonth(day).alias("d"),
        F.quarter(day).alias("q"), periods.from_serial("o_custkey").alias("from_serial"), periods.from_serial("o_custkey", periods.LATE_ORIGIN).alias("from_late_serial"),
    )


@query("F8_date_arithmetic", """
    SELECT o_orderkey, (o_orderdate - INTERVAL 12 MONTH)::DATE AS year_before, (o_orderdate + INTERVAL 1 MONTH)::DATE AS month_after,
      date_trunc('month', o_orderdate)::DATE AS month_first, o_orderdate::DATE + 3 AS plus_three FROM orders""")
def _(t: Tables):
    day = F.col("o_orderdate").cast("date")
    return t.orders.select("o_orderkey", F.add_months(day, -12).alias("year_before"), F.add_months(day, 1).alias("month_after"), periods.month_start(day).alias("month_first"), F.date_add(day, 3).alias("plus_three"))


@query("F9_period_labels", """
    SELECT DISTINCT date_trunc('month', o_orderdate)::DATE AS period, strftime(o_orderdate, '%b %Y') AS label, strftime(o_orderdate, '%m-%Y') AS numeric_label,
      strftime(o_orderdate, '%B') AS name, month(o_orderdate)::INT AS number, CASE WHEN month(o_orderdate) <> 5 THEN month(o_orderdate) END::INT AS from_long_abbreviation, strftime(o_orderdate, '%b') AS abbreviation FROM orders""")
def _(t: Tables):
    months = t.orders.select(periods.month_start("o_orderdate").alias("period")).distinct()
    name = periods.month_name(F.month("period"))
    odd = F.when(F.month("period") == 5, "Mai").otherwise(periods.month_name(F.month("period"), periods.MONTH_ABBREVIATIONS))
    return months.select(
        "period", periods.month_label("period").alias("label"), F.date_format("period", "MM-yyyy").alias("numeric_label"), name.alias("name"), periods.month_number(name).alias("number"),
        periods.month_number(odd, periods.MONTH_ABBREVIATIONS).alias("from_long_abbreviation"), periods.month_name(F.month("period"), periods.MONTH_ABBREVIATIONS).alias("abbreviation"),
    )


@query("F10_fiscal_label", """
    SELECT DISTINCT year(l_shipdate)::INT AS y, l_returnflag AS flag, 'FY' || substring((year(l_shipdate) - CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 2 END)::VARCHAR, 3, 2) AS label FROM lineitem""")
def _(t: Tables):
    back = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(2)
    pairs = t.lineitem.select(F.year("l_shipdate").alias("y"), F.col("l_returnflag").alias("flag"), "l_returnflag").select("y", "flag", periods.fiscal_label("y", back).alias("label"))
    return pairs.distinct()


@query("F11_free_text_date", """
    SELECT DISTINCT CASE WHEN day(o_orderdate) < 15 THEN 'Week Of ' ELSE '' END || strftime(o_orderdate, '%B') || ' ' || day(o_orderdate) ||
      CASE WHEN day(o_orderdate) IN (1, 21, 31) THEN 'st' ELSE 'th' END AS original, strftime(o_orderdate, '%b') AS period, day(o_orderdate)::INT AS day FROM orders""")
def _(t: Tables):
    n = F.dayofmonth("o_orderdate")
    written = F.concat(
        F.when(n < 15, "Week Of ").otherwise(""), F.date_format("o_orderdate", "MMMM"), F.lit(" "), n.cast("string"), F.when(n.isin(1, 21, 31), "st").otherwise("th")
    )
    month, day = periods.free_text_day("original")
    return t.orders.select(written.alias("original")).distinct().select("original", month.alias("period"), day.alias("day"))


@query("F12_math", """
    SELECT c_custkey, abs(c_acctbal) AS size, round_even(c_acctbal, -1) + 0e0 AS tens, round_even(c_acctbal, 0) + 0e0 AS whole,
      round_even(c_nationkey / 2e0, 0) + 0e0 AS half_even, coalesce(c_acctbal / nullif(c_nationkey, 0), 0) AS per_nation FROM customer""")
def _(t: Tables):
    return t.customer.select(
        "c_custkey", F.abs("c_acctbal").alias("size"), nulls.half_even("c_acctbal", -1).alias("tens"), nulls.half_even("c_acctbal").alias("whole"),
        nulls.half_even(F.col("c_nationkey") / 2).alias("half_even"), nulls.ratio("c_acctbal", F.col("c_nationkey").cast("double")).alias("per_nation"),
    )


@query("F13_conditional_and_null", """
    WITH v AS (SELECT p_partkey, CASE WHEN p_size > 10 THEN p_size END AS size, p_name, p_brand FROM part)
    SELECT p_partkey, CASE WHEN size > 25 THEN 'large' WHEN size <= 25 THEN 'medium' END AS if_else, CASE WHEN size > 25 THEN 'large' ELSE 'other' END AS case_when,
      size IS NULL AS is_missing, coalesce(size, p_partkey) AS fallback FROM v""")
def _(t: Tables):
    v = t.part.select("p_partkey", F.when(F.col("p_size") > 10, F.col("p_size")).alias("size"))
    large = F.col("size") > 25
    return v.select(
        "p_partkey", nulls.if_else(large, F.lit("large"), F.lit("medium")).alias("if_else"), F.when(large, "large").otherwise("other").alias("case_when"),
        F.col("size").isNull().alias("is_missing"), F.coalesce("size", "p_partkey").alias("fallback"),
    )


@query("F14_unnest", """
    SELECT word, count(*) AS n, count(DISTINCT doc_id) AS docs FROM (SELECT doc_id, unnest(string_split(text, ' ')) AS word FROM documents) WHERE word <> '' GROUP BY 1""")
def _(t: Tables):
    # Every word once for its count and, if it is new in its row and the row has an id, once for its document: one shuffle on the word.
    words = F.split("text", " ")
    new = F.when(F.col("doc_id").isNotNull(), F.array_distinct(words))
    both = t.documents.select(F.explode(F.array(F.struct(words.alias("w"), F.lit(0).alias("d")), F.struct(new.alias("w"), F.lit(1).alias("d")))).alias("e"))
    each = both.select(F.explode("e.w").alias("word"), F.col("e.d").alias("d")).filter(F.col("word") != "")
    repeated = t.documents.filter("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("again")).count().filter("count > 1")
    if not repeated.isEmpty():
        # Rows that repeat an id are one document: what they count too much is taken off.
        rows = t.documents.join(repeated, F.col("doc_id") == F.col("again"), "left_semi").select("doc_id", F.explode(F.array_distinct(words)).alias("word"))
        more = rows.filter(F.col("word") != "").groupBy("word", "doc_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
        each = each.unionByName(more.select("word", (1 - F.col("n")).alias("d")))
    return each.groupBy("word").agg(F.count_if(F.col("d") == 0).alias("n"), F.sum("d").alias("docs"))


@query("G1_mapped_over_parameters", given("daily") + f"""
    SELECT region, category, year(day)::INT AS year, {m('sum(value)', 'value')}, count(*) AS n FROM daily GROUP BY 1, 2, 3""")
def _(t: Tables):
    # One call per (region, category, year) in a loop becomes one grouping over the same keys.
    return daily(t).groupBy("region", "category", F.year("day").alias("year")).agg(cents(F.sum("value"), "value"), F.count(F.lit(1)).alias("n"))


def trimmed(df: DataFrame) -> DataFrame:
    return df.withColumn("name", F.trim("name"))


def above(df: DataFrame, least: float) -> DataFrame:
    return df.filter(F.col("balance") > least)


@query("G2_table_functions", f"""
    SELECT kind, count(*) AS n, {m('sum(balance)', 'balance')} FROM (SELECT 'customer' AS kind, c_name AS name, c_acctbal AS balance FROM customer UNION ALL SELECT 'supplier', s_name, s_acctbal FROM supplier)
    WHERE balance > 1000 GROUP BY 1""")
def _(t: Tables):
    a = t.customer.select(F.lit("customer").alias("kind"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance"))
    b = t.supplier.select(F.lit("supplier").alias("kind"), F.col("s_name").alias("name"), F.col("s_acctbal").alias("balance"))
    kept = union_all(a, b).transform(trimmed).transform(above, 1000)
    return kept.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), cents(F.sum("balance"), "balance"))
