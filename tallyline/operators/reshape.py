"""Long to wide and back, and alignment of several measure tables on one key."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions.nulls import as_col, strict_sum_where
from tallyline.operators.windows import row_index
from tallyline.session import written

# Up to this many output cells a spread runs as conditional sums straight on the rows: one shuffle.
# Beyond it the rows are summed per (ids, name) first, since every row would otherwise visit every cell.
DIRECT_CELLS = 24
# Beyond this many cells the conditional form generates too much code and Spark's pivot is used.
CONDITIONAL_CELLS = 120
# Columns of a block where there are too many names for one wide table.
BLOCK_NAMES = 256


def label_for(value) -> str:
    return str(value)


def spread(
    df: DataFrame,
    ids: Sequence[str],
    names_from: str,
    values: Sequence,
    measures: str | Sequence[str],
    fill: float | None = None,
    prefix: str = "",
    strict: bool = False,
    total: str | None = None,
) -> DataFrame:
    """Long to wide with sums. The values are given, so the schema is fixed and no job runs to find it.

    With one measure the columns are named after the values, with several `{measure}_{value}`. Rows of other values
    keep their ids in the result; `total` names a column with the sum of one measure over all rows, listed or not,
    which tells what the listed columns leave out. Cells have the type of the measure's sum, filled or not.
    """
    many = not isinstance(measures, str)
    listed = list(measures) if many else [measures]
    if total and (many or strict):
        raise ValueError("a total needs one measure that skips missing values")

    def title(measure: str, value) -> str:
        return f"{prefix}{measure}_{label_for(value)}" if many else f"{prefix}{label_for(value)}"

    n_cells = len(values) * len(listed)
    if n_cells > DIRECT_CELLS and not strict:
        df = df.groupBy(*ids, names_from).agg(*[F.sum(m).alias(m) for m in listed])
    titles = [title(measure, value) for measure in listed for value in values]
    if n_cells <= CONDITIONAL_CELLS or strict or total:
        cells = []
        for measure in listed:
            for value in values:
                hit = F.col(names_from) == F.lit(value)
                cell = strict_sum_where(measure, hit) if strict else F.sum(F.when(hit, F.col(measure)))
                cells.append(cell.alias(title(measure, value)))
        wide = df.groupBy(*ids).agg(*cells, *([F.sum(listed[0]).alias(total)] if total else []))
    else:
        wide = df.groupBy(*ids).pivot(names_from, list(values)).agg(*[F.sum(m).alias(m) for m in listed])
        # Spark names the cells '{value}' for one measure and '{value}_{measure}' for several.
        wide = wide.withColumnsRenamed({
            f"{label_for(value)}_{measure}" if len(listed) > 1 else label_for(value): title(measure, value) for value in values for measure in listed})
    return wide if fill is None else wide.fillna(fill, subset=[*titles, *([total] if total else [])])


def spread_found(
    df: DataFrame, ids: Sequence[str], names_from: str, measures: str | Sequence[str], most: int = 1000, **options
) -> DataFrame:
    """Long to wide with a column for every name that occurs, in order.

    The names are found first (one small job); more than `most` of them are an error, since they become columns.
    """
    found = [r[0] for r in df.select(names_from).filter(F.col(names_from).isNotNull()).distinct().limit(most + 1).collect()]
    if len(found) > most:
        raise ValueError(f"{names_from} has more than {most} values")
    return spread(df, ids, names_from, sorted(found), measures, **options)


class Blocks(NamedTuple):
    """A matrix of any width. cells: ids, block, values (one place for each name of the block). manifest: block, position, name."""

    cells: DataFrame
    manifest: DataFrame


def spread_blocks(df: DataFrame, ids: Sequence[str], names_from: str, measure: str, size: int = BLOCK_NAMES) -> Blocks:
    """Long to wide with sums for as many names as the data hold: blocks of `size` columns instead of one table of all.

    Names are numbered in their order by a parallel sort, and no name or number of names passes the driver. A row of the
    result is as wide as a block whatever the table; a block in which an id has no cell has no row. Rows without a name
    have no column and are left out.
    """
    label = F.col(names_from).alias("__label")
    summed = written(df.filter(F.col(names_from).isNotNull()).groupBy(*ids, label).agg(F.sum(measure).alias(measure)), "cells")
    numbered = row_index(summed.select(F.col("__label").alias("name")).distinct(), ["name"], "__index", start=0)
    index = F.col("__index")
    manifest = written(numbered.select(F.floor(index / size).alias("block"), (index % size).cast("int").alias("position"), "name"), "manifest")
    placed = summed.join(manifest, F.col("__label") == F.col("name")).select(*ids, "block", "position", measure)
    wide = spread(placed, [*ids, "block"], "position", list(range(size)), measure)
    return Blocks(wide.select(*ids, "block", F.array(*[F.col(str(k)) for k in range(size)]).alias("values")), manifest)


def block_columns(blocks: Blocks, ids: Sequence[str], names: Sequence) -> DataFrame:
    """Some named columns of a matrix as a wide table; only their blocks are looked at. An id without any of them has no row."""
    found = {r["name"]: (r["block"], r["position"]) for r in blocks.manifest.filter(F.col("name").isin(list(names))).collect()}
    kept = blocks.cells.filter(F.col("block").isin(sorted({b for b, _ in found.values()})))
    kind = blocks.cells.schema["values"].dataType.elementType

    def cell(name) -> Column:
        block, position = found.get(name, (-1, 0))
        return F.max(F.when(F.col("block") == block, F.get("values", F.lit(position)))).cast(kind).alias(label_for(name))

    cells = [cell(n) for n in names]
    held = F.coalesce(*[F.col(f"`{label_for(n)}`").cast("string") for n in names]).isNotNull()
    return kept.groupBy(*ids).agg(*cells).filter(held)


def block_cells(blocks: Blocks, ids: Sequence[str], value: str) -> DataFrame:
    """Blocks back to long: ids, block, position, name and value of every cell that isn't missing."""
    long = blocks.cells.select(*ids, "block", F.posexplode("values").alias("position", value)).filter(F.col(value).isNotNull())
    return long.join(blocks.manifest, ["block", "position"])


def gather(df: DataFrame, ids: Sequence[str], names_to: str, values_to: str, columns: Iterable[str] | None = None) -> DataFrame:
    """Wide to long; NULL cells are kept."""
    cells = list(columns) if columns is not None else [c for c in df.columns if c not in set(ids)]
    return df.unpivot(list(ids), cells, names_to, values_to)


def stack_measures(tables: dict[str, DataFrame], keys: Sequence[str]) -> DataFrame:
    """Several one-measure tables as long rows: keys, measure, value."""
    parts = [table.select(*keys, F.lit(name).alias("measure"), F.col(name).cast("double").alias("value")) for name, table in tables.items()]
    return reduce(lambda a, b: a.unionByName(b), parts)


def fold_measures(long: DataFrame, keys: Sequence[str], measures: Sequence[str], all_keys: bool = False) -> DataFrame:
    """Long measures side by side, one row per key.

    Left-join semantics: the keys of the first measure decide the rows, unless all_keys is set.
    """
    def of(name: str) -> Column:
        return F.col("measure") == name

    cells = [F.sum(F.when(of(name), F.col("value"))).alias(name) for name in measures]
    folded = long.groupBy(*keys).agg(*cells, F.max(of(measures[0])).alias("__first"))
    if not all_keys:
        folded = folded.filter("__first")
    return folded.drop("__first")


def align_measures(tables: dict[str, DataFrame], keys: Sequence[str], all_keys: bool = False) -> DataFrame:
    """Put the measures of several tables side by side, one row per key of the first table.

    Instead of one join per table the tables are stacked and folded in a single aggregation,
    so the data is shuffled once no matter how many tables there are.
    """
    return fold_measures(stack_measures(tables, keys), keys, list(tables), all_keys)


def shift_years(
    df: DataFrame, date: str, keys: Sequence[str], value: str, names: Sequence[str], carried: Sequence[str] = ()
) -> DataFrame:
    """Attach the value of 1, 2, ... years before to every (keys, date) row, named in that order.

    Each row is re-dated to the years in which it serves as a prior year and all copies meet in one
    aggregation, which replaces one self-join per year. The input holds one row per (keys, date);
    `carried` lists further numeric columns of the row itself to keep.
    """
    years = F.array(*[F.lit(k) for k in range(len(names) + 1)])
    moved = F.add_months(F.col(date), F.col("__back") * 12)
    # Going back a year from 29 February leads to 28 February: the 28th serves both days, the 29th only another 29th.
    serves = F.when(F.dayofmonth(moved) == F.dayofmonth(date), moved)
    leap_day = F.when((F.month(date) == 2) & (F.dayofmonth(F.last_day(date)) == 28) & (F.dayofmonth(date) == 28) & (F.dayofmonth(F.last_day(moved)) == 29), F.last_day(moved))
    copies = df.withColumn("__back", F.explode(years)).filter(F.col(date).isNotNull() | (F.col("__back") == 0)).withColumn(
        date, F.explode(F.when(F.col(date).isNull(), F.array(date)).otherwise(F.array_compact(F.array(serves, leap_day)))))
    own = F.col("__back") == 0
    cells = [F.sum(F.when(own, F.col(c))).alias(c) for c in (value, *carried)]
    cells += [F.sum(F.when(F.col("__back") == k, F.col(value))).alias(n) for k, n in enumerate(names, 1)]
    folded = copies.groupBy(*keys, date).agg(*cells, F.max(own).alias("__own"))
    return folded.filter("__own").drop("__own")


def stack_cells(rows: Sequence[tuple[str, Sequence[Column]]], label: str, names: Sequence[str]) -> Column:
    """Explode a list of (label, cells) into rows with a label column and named cells."""
    entries = [
        F.struct(F.lit(title).alias(label), *[as_col(c).alias(n) for c, n in zip(cells, names, strict=True)])
        for title, cells in rows
    ]
    return F.explode(F.array(*entries))


def union_all(*frames: DataFrame) -> DataFrame:
    """Union by name; a column a table lacks becomes NULL."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
