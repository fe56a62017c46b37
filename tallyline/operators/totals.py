"""Totals, subtotals and residual lines."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.operators.columns import numeric_columns


def sum_numeric(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sum of every numeric column per key, NULLs skipped."""
    cells = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in numeric_columns(df, besides=keys)]
    return df.groupBy(*keys).agg(*cells)


def add_totals(df: DataFrame, label: str, title: str = "Total", filler: str = "-") -> DataFrame:
    """Append a totals row: the title in the label column, sums below numbers, a filler elsewhere.

    The detail is normally an aggregate; its shuffle is reused for the total, so the source is
    scanned once. Summed columns take the type of their sum, which is wide enough for the total.
    """
    sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in numeric_columns(df, besides=[label])]
    summed = {c for c in numeric_columns(df, besides=[label])}
    total = df.agg(*sums) if sums else df.agg(F.count(F.lit(1)).alias("__n"))
    cells: list[Column] = []
    for name, kind in df.dtypes:
        if name == label:
            cells.append(F.lit(title).alias(name))
        elif name in summed:
            cells.append(F.col(name))
        else:
            cells.append((F.lit(filler) if kind == "string" else F.lit(None).cast(kind)).alias(name))
    wide = {name: F.col(name).cast(kind) for name, kind in total.dtypes if name in summed}
    return df.withColumns({**wide, label: F.col(label).cast("string")}).unionByName(total.select(*cells))


def subtotals(df: DataFrame, group: str, detail: str, measures: dict[str, Column], sub="TOTAL", grand="GRAND TOTAL") -> DataFrame:
    """Detail rows, a subtotal per group and a grand total out of one rollup."""
    level = F.grouping_id()
    rolled = df.rollup(group, detail).agg(*[m.alias(n) for n, m in measures.items()], level.alias("__level"))
    return rolled.select(
        F.when(F.col("__level") == 3, F.lit(grand)).otherwise(F.col(group)).alias(group),
        F.when(F.col("__level") == 0, F.col(detail)).when(F.col("__level") == 1, F.lit(sub)).otherwise(F.lit(grand)).alias(detail),
        *measures,
    )


def residual_line(df: DataFrame, keys: Sequence[str], member: str, parent: str, children: Sequence[str], value: str, title: str) -> DataFrame:
    """Append 'parent minus named children' as one more member per key.

    A missing child counts as 0; without a parent row there is no residual.
    """
    is_parent = F.col(member) == parent
    total = F.sum(F.when(is_parent, F.col(value)))
    named = F.coalesce(F.sum(F.when(F.col(member).isin(list(children)), F.col(value))), F.lit(0.0))
    rest = df.groupBy(*keys).agg((total - named).alias(value)).filter(F.col(value).isNotNull())
    kept = df.select(*keys, member, value)
    return kept.unionByName(rest.withColumn(member, F.lit(title)))


def overlap_counts(left: DataFrame, right: DataFrame, key: str, names=("left", "right")) -> DataFrame:
    """How many keys of either side are found on the other, with a total per side.

    Both key sets meet in one aggregation and the flags are counted from it.
    """
    both = (
        left.select(F.col(key), F.lit(0).alias("side"))
        .unionByName(right.select(F.col(key), F.lit(1).alias("side")))
        .groupBy(key)
        .agg(F.min("side").alias("lo"), F.max("side").alias("hi"))
    )
    counted = both.agg(
        F.count_if(F.col("lo") != F.col("hi")).alias("shared"),
        F.count_if(F.col("hi") == 0).alias("left_only"),
        F.count_if(F.col("lo") == 1).alias("right_only"),
    )
    entries = []
    for name, own in ((names[0], "left_only"), (names[1], "right_only")):
        entries += [
            F.struct(F.lit(name).alias("side"), F.lit("true").alias("found"), F.col("shared").alias("n")),
            F.struct(F.lit(name).alias("side"), F.lit("false").alias("found"), F.col(own).alias("n")),
            F.struct(F.lit(name).alias("side"), F.lit("Total").alias("found"), (F.col("shared") + F.col(own)).alias("n")),
        ]
    return counted.select(F.inline(F.array(*entries)))
