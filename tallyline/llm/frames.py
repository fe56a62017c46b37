"""Helpers shared by the operators of this subpackage: table access, cut lineage, bounded broadcasts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.session import written

# What a model or an index may weigh before it is sent to every executor.
BROADCAST_BYTES = 32 << 20


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables, read by Spark from wherever the folder lies."""
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def columns_of(df: DataFrame, **wanted: str) -> DataFrame:
    """The named columns under the given types, whatever else the table holds; a missing one is all null."""
    have = set(df.columns)
    return df.select(*[(F.col(f"`{c}`") if c in have else F.lit(None)).cast(t).alias(c) for c, t in wanted.items()])


def fresh(df: DataFrame, *stems: str) -> list[str]:
    """Column names that occur nowhere in the table, whatever the case of its letters."""
    taken = {c.lower() for c in df.columns}
    out = []
    for stem in stems:
        name = f"__{stem}"
        while name in taken:
            name += "_"
        taken.add(name)
        out.append(name)
    return out


def settled(df: DataFrame, label: str = "step") -> DataFrame:
    """Written once as Parquet in the shared folder and read back: a lost executor repeats nothing before it."""
    return written(df, label)


def small(df: DataFrame, most_rows: int = 100_000) -> DataFrame:
    """A written table of narrow rows, marked for broadcast if it has no more than `most_rows` rows."""
    return F.broadcast(df) if df.count() <= most_rows else df


def fold(key: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo the number of folds; a missing id is in fold 0."""
    return F.coalesce(F.crc32(key.cast("string").cast("binary")) % parts, F.lit(0))


def class_sizes(df: DataFrame, column: str, most: int) -> dict:
    """How many rows each class has; more than `most` classes are an error."""
    found = df.groupBy(column).agg(F.count("*").alias("n")).limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"{column} has more than {most} values")
    return {r[0]: r[1] for r in found}


def bounded_sample(df: DataFrame, column: str, sizes: dict, key: Column, most: int) -> DataFrame:
    """About `most` rows of each class, the same ones at every run: those whose key's hash is below most / size.

    A class of at most `most` rows stays whole. It is a filter: nothing is shuffled, sorted or gathered.
    """
    if not sizes:
        return df.filter(F.lit(False))
    large = [F.lit(x) for value, n in sizes.items() if n > most for x in (value, most / n)]
    if not large:
        return df
    share = F.coalesce(F.try_element_at(F.create_map(*large), F.col(column)), F.lit(1.0))
    spot = F.xxhash64(key.cast("string"), F.lit("sample")) / F.lit(2.0**64) + F.lit(0.5)
    return df.filter((spot < share) | (share >= 1.0))


def total(df: DataFrame, *sums: Column) -> tuple:
    """One row of aggregates, as plain numbers; an empty table gives zeros."""
    return tuple(x or 0 for x in df.agg(*sums).first())
