"""Order-dependent operators that stay parallel.

Each of them names its order column and keeps the rows of one window bounded, so a key that
holds a large share of the table does not end up in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.session import written

_POSITION_BITS = 33  # monotonically_increasing_id keeps the partition above these bits


def row_index(df: DataFrame, order: Sequence[Column | str], name: str = "index", start: int = 1) -> DataFrame:
    """Running number over the whole table in a given order, computed in parallel.

    The table is range-partitioned and sorted, then written once to the shared folder so that
    partition number and position cannot change between the two uses. The start of each partition
    is a prefix sum over one count per partition. The order must be unique.
    """
    placed = written(df.orderBy(*order).withColumn("__id", F.monotonically_increasing_id()), "index")
    part = F.shiftright(F.col("__id"), _POSITION_BITS)
    position = F.col("__id").bitwiseAND(F.lit((1 << _POSITION_BITS) - 1))
    # One row per partition of the sorted table: its size is the partition count, not the data.
    sizes = placed.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__rows"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("__part", F.coalesce(F.sum("__rows").over(before), F.lit(0)).alias("__start"))
    return (
        placed.withColumn("__part", part)
        .join(F.broadcast(starts), "__part")
        .withColumn(name, F.col("__start") + position + F.lit(start))
        .drop("__part", "__start", "__id")
    )


def first_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], n: int) -> DataFrame:
    """First n rows per key. Spark keeps only n rows per key in every task before the shuffle.

    It does so up to spark.sql.optimizer.windowGroupLimitThreshold rows (1000); raise that setting for a larger n.
    """
    window = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__rank", F.row_number().over(window)).filter(F.col("__rank") <= n).drop("__rank")


def latest_per_group(df: DataFrame, keys: Sequence[str], date: str) -> DataFrame:
    """All rows of the newest date per key, ties included; rows without date never.

    Two phases and no sort: the newest date of each key, a maximum in every task before the shuffle, then the rows equal
    to it. Where the newest dates are too many to be sent to all tasks, rows are dealt by key and date, so a hot key is
    spread over its dates. Missing keys are keys like any other.
    """
    newest = df.groupBy(*[F.col(k).alias(f"__{k}") for k in keys]).agg(F.max(date).alias("__newest")).filter(F.col("__newest").isNotNull())
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return df.join(newest, [*same, F.col(date) == F.col("__newest")], "left_semi")


def latest_rows(df: DataFrame, date: str) -> DataFrame:
    """All rows of the newest date of the table; the date is a scalar subquery pushed to the scan."""
    return df.filter(F.col(date) == df.agg(F.max(date)).scalar())


def fill_down(df: DataFrame, keys: Sequence[str], position: str, value: str, name: str, chunk: int = 1 << 20) -> DataFrame:
    """Carry the last filled value forward in position order.

    Rows are cut into chunks of the integer position. The last value of each chunk is carried over
    the chunks first, then forward inside each chunk, so no window is longer than a chunk or than
    the number of chunks.
    """
    cut = df.withColumn("__chunk", F.floor(F.col(position) / chunk))
    filled = F.col(value).isNotNull()
    ends = cut.groupBy(*keys, "__chunk").agg(F.max_by(F.col(value), F.when(filled, F.col(position))).alias("__end"))
    over_chunks = Window.partitionBy(*keys).orderBy("__chunk").rowsBetween(Window.unboundedPreceding, -1)
    carried = ends.select(*keys, "__chunk", F.last("__end", ignorenulls=True).over(over_chunks).alias("__carried"))
    inside = Window.partitionBy(*keys, "__chunk").orderBy(position).rowsBetween(Window.unboundedPreceding, 0)
    return (
        cut.withColumn("__inside", F.last(value, ignorenulls=True).over(inside))
        .join(carried, [*keys, "__chunk"], "left")
        .withColumn(name, F.coalesce(F.col("__inside"), F.col("__carried")))
        .drop("__chunk", "__inside", "__carried")
    )


def running_sum(df: DataFrame, keys: Sequence[str], order: str, value: str, name: str) -> DataFrame:
    """Running sum per key in the order column; rows of the same order value share one sum.

    Sums per (keys, order) are formed before the window, which is therefore no longer than the
    number of distinct order values (days of a month).
    """
    daily = df.groupBy(*keys, order).agg(F.sum(value).alias(value))
    window = Window.partitionBy(*keys).orderBy(order).rangeBetween(Window.unboundedPreceding, 0)
    return daily.withColumn(name, F.sum(value).over(window))


def flatten_text(
    df: DataFrame, keys: Sequence[str], item: str, name: str, separator: str = ",", part_items: int = 10000, order: str | None = None
) -> DataFrame:
    """Join the items of each group into texts of `part_items` items, in item order (or that of a position column).

    Columns: the keys, `part` (from 0), the text, `n_items` of the part; the texts of a group, in the order of
    `part`, make up the whole text. One path for every size: equal items are counted first, the others are dealt by
    ranges of (keys, order), so a hot group lies in many ranges; the place of an item follows from one count per
    group and range, and no task holds more of a group than a range or a part. To put a fact beside other columns
    join `group_sizes`, which has one row per group, not the parts.
    """
    sort_key = order or item
    rows = df.filter(F.col(item).isNotNull()).select(*keys, F.col(sort_key).alias("__s"), F.col(item).alias("__v"))
    counted = rows.groupBy(*keys, "__s", "__v").agg(F.count(F.lit(1)).alias("__c"))
    ranged = counted.repartitionByRange(*keys, "__s", "__v").withColumn("__range", F.spark_partition_id())
    runs = ranged.groupBy(*keys, "__range").agg(F.array_sort(F.collect_list(F.struct("__s", "__v", "__c"))).alias("__items"), F.sum("__c").alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)
    placed = runs.withColumn("__before", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    each = placed.select(*keys, "__range", "__before", F.posexplode("__items").alias("__at", "__item"))
    inside = Window.partitionBy(*keys, "__range").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("__before") + F.coalesce(F.sum("__item.__c").over(inside), F.lit(0))
    spans = each.select(*keys, "__item.__v", "__item.__c", start.alias("__first"))
    single = spans.select(*keys, "__v", F.explode(F.sequence(F.col("__first"), F.col("__first") + F.col("__c") - 1)).alias("__at"))
    return (
        single.select(*keys, F.floor(F.col("__at") / part_items).alias("part"), F.struct(F.col("__at").alias("at"), F.col("__v").alias("v")).alias("e"))
        .groupBy(*keys, "part")
        .agg(F.array_join(F.transform(F.array_sort(F.collect_list("e")), lambda e: e["v"]), separator).alias(name), F.count(F.lit(1)).alias("n_items"))
    )


def group_sizes(df: DataFrame, keys: Sequence[str], item: str, name: str = "n_items") -> DataFrame:
    """How many items each group has: the one-row-per-group companion of flatten_text."""
    return df.filter(F.col(item).isNotNull()).groupBy(*keys).agg(F.count(F.lit(1)).alias(name))
