"""Hierarchies given as child-parent links of unknown depth: ancestors, roll-ups and residuals of every level.

Ancestors are found by doubling: from all pairs up to a distance and all links of exactly that distance follow all pairs
up to twice the distance, so a chain of depth d takes about log2(d) rounds of two joins, not d. Each round is written
once. Branches may have any depth, and a member may have several parents; pairs are kept once, with the least distance.

A cycle is met as a member that is its own ancestor. Members on cycles are reported and lose the links to their parents,
so everything below a cycle still rolls up into the members on it, and nothing is looped over.

Links without child or parent, and repeated ones, count for nothing.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.session import written


class Ancestry(NamedTuple):
    """pairs: member, ancestor, distance, each member with itself at distance 0. on_cycle: the members on cycles."""

    pairs: DataFrame
    on_cycle: DataFrame


def _steps(near: DataFrame, far: DataFrame, reach: int) -> DataFrame:
    """Pairs of near followed by links of far, which lead `reach` up."""
    links = far.select(F.col("member").alias("__from"), F.col("ancestor").alias("__to"))
    return near.join(links, F.col("ancestor") == F.col("__from")).select("member", F.col("__to").alias("ancestor"), (F.col("distance") + reach).alias("distance"))


def _least(pairs: DataFrame) -> DataFrame:
    return pairs.groupBy("member", "ancestor").agg(F.min("distance").alias("distance"))


def _closed(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All pairs of links (member, ancestor) at distance 1 or more, as far as no cycle was met, and the members on cycles."""
    pairs, jumps, reach = links.limit(0), links, 1
    while True:
        # pairs: distances below reach. jumps: distance reach.
        pairs, beyond = written(_least(pairs.unionByName(jumps).unionByName(_steps(pairs, jumps, reach))), "pairs"), jumps
        on_cycle = pairs.filter(F.col("member") == F.col("ancestor")).select("member")
        if on_cycle.limit(1).count():
            return pairs, on_cycle
        jumps = written(_least(_steps(beyond, beyond, reach)), "jumps")
        reach *= 2
        if not jumps.limit(1).count():
            return pairs, on_cycle


def ancestry(edges: DataFrame, child: str = "child", parent: str = "parent") -> Ancestry:
    """All ancestors of all members of the links, and the members on cycles."""
    known = edges.select(F.col(child).alias("member"), F.col(parent).alias("ancestor")).filter("member IS NOT NULL AND ancestor IS NOT NULL").distinct()
    whole = written(known.withColumn("distance", F.lit(1)), "links")
    links, cut = whole, whole.select("member").limit(0)
    while True:
        pairs, on_cycle = _closed(links)
        if not on_cycle.limit(1).count():
            break
        # Longer cycles may be left: they are met in a later round, with those found opened.
        links = written(links.join(on_cycle, "member", "left_anti"), "links")
        cut = cut.unionByName(on_cycle)
    names = whole.select("member").union(whole.select("ancestor")).distinct()
    itself = names.select("member", F.col("member").alias("ancestor"), F.lit(0).alias("distance"))
    return Ancestry(pairs.unionByName(itself), cut)


def roll_up(amounts: DataFrame, found: Ancestry, member: str, measures: Sequence[str]) -> DataFrame:
    """Per member of the hierarchy: own and total amounts of itself and all below it, and the number of members below.

    Amounts are summed per member before they meet the pairs, and per ancestor in each task before the shuffle.
    """
    summed = amounts.groupBy(F.col(member).alias("__of")).agg(*[F.sum(m).alias(m) for m in measures])
    spread = found.pairs.join(summed, F.col("member") == F.col("__of"), "left")
    own = F.col("distance") == 0
    cells = [c for m in measures for c in (F.coalesce(F.sum(F.when(own, F.col(m))), F.lit(0)).alias(f"own_{m}"), F.coalesce(F.sum(m), F.lit(0)).alias(f"total_{m}"))]
    return spread.groupBy(F.col("ancestor").alias(member)).agg(*cells, F.count_if(~own).alias("n_below"))


def residuals(reported: DataFrame, edges: DataFrame, member: str, value: str, child: str = "child", parent: str = "parent") -> DataFrame:
    """Of every reported parent what its children leave over: member, value, children (their sum), residual, n_children.

    A child without a report counts as 0. Works on one level's links at a time, so on all levels at once: one join and one
    aggregation, whatever the depth.
    """
    links = edges.select(F.col(child).alias("__child"), F.col(parent).alias("__parent")).filter("__child IS NOT NULL AND __parent IS NOT NULL").distinct()
    per_member = reported.groupBy(member).agg(F.sum(value).alias(value))
    below = links.join(per_member, F.col("__child") == F.col(member), "left").select(F.col("__parent").alias(member), F.lit(None).cast("double").alias(value), F.coalesce(value, F.lit(0)).cast("double").alias("children"), F.lit(1).alias("n"))
    own = per_member.select(member, F.col(value).cast("double").alias(value), F.lit(None).cast("double").alias("children"), F.lit(0).alias("n"))
    folded = own.unionByName(below).groupBy(member).agg(F.sum(value).alias(value), F.sum("children").alias("children"), F.sum("n").alias("n_children"))
    return folded.filter((F.col("n_children") > 0) & F.col(value).isNotNull()).withColumn("residual", F.col(value) - F.col("children"))
