"""Member hierarchies: paths, classification by rules, gap reports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions.nulls import holds, lacks, matches
from tallyline.operators.joins import without
from tallyline.operators.totals import add_totals
from tallyline.operators.windows import flatten_text


def with_path(members: DataFrame, levels: Sequence[str], others: Sequence[str] = (), separator: str = "-") -> DataFrame:
    """Concatenated path of the filled level (and further) columns."""
    return members.withColumn("structure", F.concat_ws(separator, *levels, *others))


def search(tables: DataFrame, dimension: str, *patterns: str) -> DataFrame:
    """Members of a dimension whose path matches all patterns."""
    hits = reduce(lambda a, b: a & b, [matches("structure", p) for p in patterns])
    return tables.filter((F.col("dimension") == dimension) & hits)


def base_members(tables: DataFrame, dimension: str, level: str, pattern: str, member_type: str = "Base") -> DataFrame:
    """Leaf members below a node, named by a pattern on one level column."""
    return tables.filter((F.col("dimension") == dimension) & (F.col("member_type") == member_type) & matches(level, pattern))


def classify(
    members: DataFrame,
    rules: Sequence[tuple[str, str, str, str]],
    segment_word: str,
    other_segment: str,
    unused: str | None = None,
    keep: Sequence[str] = ("name",),
) -> DataFrame:
    """Region, sub-region and segment of base members.

    A rule is (level column, pattern, region, sub-region column). A member matching several rules
    appears once per rule: the matches are collected in one array per row and exploded, so the
    member table is read once for all rules.
    """
    described = members if unused is None else members.filter(lacks("description", unused))
    hits = F.array(*[
        F.when(matches(level, pattern), F.struct(F.lit(region).alias("region"), F.col(sub).alias("sub_region")))
        for level, pattern, region, sub in rules
    ])
    segment = F.when(holds("description", segment_word), F.lit(segment_word)).otherwise(F.lit(other_segment))
    matched = described.withColumn("segment", segment).withColumn("hit", F.explode(F.array_compact(hits)))
    return matched.select("segment", "hit.region", "hit.sub_region", *keep)


def complement(all_members: DataFrame, part: DataFrame, key: str) -> DataFrame:
    """Members that are not in a part; part and complement together make up the whole."""
    return without(all_members, part, [key])


GAP_KEYS = ["segment", "lc", "month"]


def gap_report(
    sales: DataFrame, listed: DataFrame, home_currency: str = "USD", unit: float = 1_000_000.0
) -> DataFrame:
    """Amounts of entities absent from a list, by segment, currency and month, with totals.

    `sales` has segment, lc, entity, month, value. `n_entities` counts the entities of a group; `gap_names` has
    their names.
    """
    per_entity = _gaps(sales, listed, home_currency).groupBy(*GAP_KEYS, "entity").agg(F.sum("value").alias("v"))
    summed = per_entity.groupBy(*GAP_KEYS).agg(F.sum("v").alias("v"), F.count("entity").alias("n_entities")).withColumn("f", F.col("v") * unit)
    return add_totals(summed, "segment").filter(F.col("f") != 0).select(*GAP_KEYS, "v", "f", "n_entities")


def gap_names(sales: DataFrame, listed: DataFrame, home_currency: str = "USD", part_items: int = 10000) -> DataFrame:
    """Names of the entities absent from a list, joined per segment, currency and month into texts of at most `part_items`."""
    missing = _gaps(sales, listed, home_currency).select(*GAP_KEYS, "entity").distinct()
    return flatten_text(missing, GAP_KEYS, "entity", "entities", part_items=part_items)


def _gaps(sales: DataFrame, listed: DataFrame, home_currency: str) -> DataFrame:
    return without(sales, listed, ["entity"]).filter((F.col("value") != 0) & (F.col("lc") != home_currency))


def region_tie_out(tracked: DataFrame, value: str, excluded: str, reported: float) -> DataFrame:
    """Totals per region outside a pattern, and what the reported total exceeds them by."""
    summed = tracked.filter(lacks("region", excluded)).groupBy("region").agg(F.sum(value).alias(value))
    return add_totals(summed, "region").withColumn(
        "difference", F.when(F.col("region") == "Total", F.lit(float(reported)) - F.col(value))
    )
