"""Two-sided reconciliations, rejected postings and requisition checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.nulls import half_even, lacks, matches, to_number
from tallyline.functions.text import pad_code, piece
from tallyline.operators.digests import tie_out
from tallyline.operators.joins import containing_any, join_named, join_null_safe, keep_members, membership
from tallyline.operators.reshape import union_all
from tallyline.operators.totals import sum_numeric
from tallyline.operators.windows import flatten_text


def plan_vs_collected(plan: DataFrame, collected: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Planned and collected sums per key, for the keys of the plan, with the divergence.

    Zero lines are dropped on both sides. Both sides are stacked and summed in one aggregation.
    """
    sides = plan.filter(F.col("value") != 0).select(*keys, F.col("value").alias("ruled"), F.lit(None).cast("double").alias("cloud"))
    sides = sides.unionByName(
        collected.filter(F.col("value") != 0).select(*keys, F.lit(None).cast("double").alias("ruled"), F.col("value").alias("cloud"))
    )
    summed = sides.groupBy(*keys).agg(F.sum("ruled").alias("ruled_value"), F.sum("cloud").alias("cloud_value"))
    return summed.filter(F.col("ruled_value").isNotNull()).withColumn("divergence", F.col("cloud_value") - F.col("ruled_value"))


def divergences(diagnosed: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Non-zero divergences in whole units, largest first; the keys break ties."""
    found = diagnosed.filter(F.col("divergence") != 0)
    return found.withColumn("divergence", half_even("divergence")).orderBy(F.desc("divergence"), *keys)


def compress(df: DataFrame, keys: Sequence[str], identifiers: Sequence[str] = ()) -> DataFrame:
    """All numeric columns summed per key; identifier columns become text first and drop out."""
    texts = df.withColumns({c: F.col(c).cast("string") for c in identifiers}) if identifiers else df
    return sum_numeric(texts, keys)


def sales_vs_billing(billing: DataFrame, sales: DataFrame, excluded: str | None = None) -> DataFrame:
    """Shipment and cost per code and brand from both sources, with deltas and a match flag.

    Both tables have code, brand, shipped, cost; only codes found in both are compared, and a code missing in both
    is one of them. Both sources are stacked and summed in one aggregation, from which the common codes are taken too.
    """
    def side(df: DataFrame, name: str) -> DataFrame:
        return df.select("code", "brand", "shipped", "cost", F.lit(name).alias("source"))

    both = side(billing, "bills").unionByName(side(sales, "sales"))
    if excluded:
        both = both.filter(lacks("code", excluded))
    found = F.col("source") == "bills"
    cells = [F.sum(F.when(F.col("source") == s, F.col(c))).alias(f"{c}_{s}") for c in ("shipped", "cost") for s in ("bills", "sales")]
    summed = both.groupBy("code", "brand").agg(*cells, F.max(found).alias("__billed"), F.max(~found).alias("__sold"))
    common = summed.groupBy("code").agg(F.max("__billed").alias("billed"), F.max("__sold").alias("sold")).filter("billed AND sold").select("code")
    wide = join_null_safe(summed.drop("__billed", "__sold"), common, ["code"], "left_semi")
    deltas = wide.withColumn("delta_shipped", F.col("shipped_bills") - F.col("shipped_sales")).withColumn("delta_cost", F.col("cost_bills") - F.col("cost_sales"))
    filled = deltas.fillna(0.0)
    total = F.col("delta_cost") + F.col("delta_shipped")
    return filled.withColumn("delta_total", total).withColumn("matched", (total == 0).cast("int"))


def unmatched(billing: DataFrame, sales: DataFrame, excluded: str | None = None) -> DataFrame:
    """The codes and brands of sales_vs_billing that don't match, with their deltas.

    Codes are bucketed, and only buckets whose digests differ are shuffled and compared: where most codes agree, most
    rows stay where they are.
    """
    kept = [df.filter(lacks("code", excluded)) if excluded else df for df in (billing, sales)]
    sums = tie_out(*kept, ["code", "brand"], ["shipped", "cost"], ("bills", "sales"), by=["code"], all_of_bucket=True)
    common = sums.groupBy("code").agg(F.max("in_bills").alias("billed"), F.max("in_sales").alias("sold")).filter("billed AND sold").select("code")
    wide = join_null_safe(sums.drop("in_bills", "in_sales"), common, ["code"], "left_semi")
    deltas = wide.withColumn("delta_shipped", F.col("shipped_bills") - F.col("shipped_sales")).withColumn("delta_cost", F.col("cost_bills") - F.col("cost_sales"))
    total = deltas.fillna(0.0).withColumn("delta_total", F.round(F.col("delta_cost") + F.col("delta_shipped"), 2))
    return total.filter(F.col("delta_total") != 0)


def rejected(postings: DataFrame, column: str, amounts: str = "amount") -> DataFrame:
    """Postings rejected because of one column, with account as text and amount as number."""
    typed = postings.withColumn("account", F.col("account").cast("string")).withColumn(amounts, to_number(F.col(amounts).cast("string")))
    return typed.filter(matches("error_columns", column))


def account_upload(
    rejects: DataFrame, account_map: DataFrame, target_accounts: DataFrame, target_functions: DataFrame, entity_prefix: str = "E", pad: str = "000"
) -> DataFrame:
    """Upload rows for postings rejected by account.

    account_map: entity, account, source_account, custom. target_accounts: target_account, report_account.
    target_functions: function_code, report_function. The map is restricted to rejected entities and
    source accounts by semi-joins, then both target tables are looked up.
    """
    wanted = rejects.select(F.replace(F.col("report_entity"), F.lit(entity_prefix), F.lit("")).alias("entity_key"), F.col("account").alias("reject_account"), "report_entity").distinct()
    focus = keep_members(account_map, "entity", wanted, "entity_key")
    focus = keep_members(focus, "source_account", wanted, "reject_account")
    mapped = focus.select("entity", "account", "source_account", "custom").distinct()
    functions = join_named(mapped, target_functions.select("function_code", "report_function"), {"custom": "function_code"})
    padded = functions.withColumn("source_account", F.concat(F.lit(pad), F.col("source_account")))
    detailed = padded.join(target_accounts.withColumnRenamed("target_account", "account"), "account", "inner")
    entities = wanted.select("entity_key", "report_entity").distinct()
    upload = join_named(detailed, entities, {"entity": "entity_key"})
    return upload.select(
        F.col("source_account").alias("account"), "entity", "report_entity", F.col("account").alias("target_account"), "report_account",
        F.col("custom").alias("function_code"), "report_function",
    ).distinct()


def entity_map(rejects: DataFrame, account_map: DataFrame, account_prefix: str = "A", pad: str = "000") -> DataFrame:
    """Rejected postings with the entity found through their account.

    The map row must belong to a rejected source account and report account, and its partner text
    must contain one of the rejected business areas.
    """
    padded = rejects.withColumn("account", F.concat(F.lit(pad), F.col("account")))
    padded = padded.withColumn("plain_account", F.replace(F.col("report_account"), F.lit(account_prefix), F.lit("")))
    # One distinct table serves all three tests, so its shuffle is shared.
    wanted = padded.select("account", "plain_account", "business_area").distinct()
    source = account_map.withColumn("source_account", F.concat(F.lit(pad), F.col("source_account")))
    focus = keep_members(source, "source_account", wanted, "account")
    focus = keep_members(focus, "account", wanted, "plain_account")
    focus = containing_any(focus, "partner", wanted, "business_area")
    entities = focus.select("source_account", "entity").distinct()
    found = join_named(padded, entities, {"account": "source_account"}).distinct()
    return found.withColumn("report_entity", pad_code("entity", 4, "E", "E0")).drop("entity", "report_function", "error_columns")


def entity_upload(mapped: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct upload rows for the chosen columns; rows without an entity are left out."""
    return mapped.filter(F.col("report_entity").isNotNull()).select(*columns).distinct()


def reject_total(rejects: DataFrame, amounts: str = "amount") -> DataFrame:
    return rejects.agg(F.coalesce(F.sum(amounts), F.lit(0.0)).alias("total"), F.count(F.lit(1)).alias("n"))


def functions_per_center(pairs: DataFrame, center: str, function: str, part_items: int = 10000) -> DataFrame:
    """Distinct functions of a cost centre joined into texts of at most `part_items` of them."""
    known = pairs.filter(F.col(function).isNotNull()).select(center, function).distinct()
    return flatten_text(known, [center], function, "functions", part_items=part_items)


def unmapped_centers(reported: DataFrame, center: str, current: DataFrame, current_center: str) -> DataFrame:
    return keep_members(reported, center, current, current_center, negate=True)


def parse_requisitions(*lists: DataFrame) -> DataFrame:
    """Requisition lists stacked and parsed.

    Of the justification the text behind the first of . ? : is kept; the business text splits into
    region, segment and unit; a missing number falls back to the second one.
    """
    stacked = union_all(*lists)
    parts = [F.trim(piece("business", "-", i)) for i in range(3)]
    return stacked.select(
        F.coalesce(F.trim("number"), F.trim("number_2")).alias("number"),
        F.trim(piece("justification", "[.?:]", 1)).alias("justification"),
        parts[0].alias("region"), parts[1].alias("segment"), F.coalesce(parts[2], F.lit("unknown")).alias("unit"),
    )


def cross_check(requisitions: DataFrame, stores: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Presence flag per store and their sum; 0 marks a requisition found nowhere."""
    out = requisitions
    for name, (store, column) in stores.items():
        out = membership(out, "number", store, column, f"in_{name}")
    total: Column = sum((F.col(f"in_{name}") for name in stores), F.lit(0))
    return out.withColumn("found", total)


def pending(requisitions: DataFrame, checked: DataFrame) -> DataFrame:
    """Requisitions whose number was found nowhere; that holds for those without number too, if they were checked."""
    absent = checked.filter(F.col("found") == 0).select("number").distinct()
    return join_null_safe(requisitions, absent, ["number"], "left_semi")
