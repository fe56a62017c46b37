"""Sharding by rendezvous hashing over weighted shards. Column algebra only.

Every shard draws a number for a record's key, -ln(u) / weight with u from md5(key:shard), and the shard with the least
number takes the record. A shard's part of the keys is its part of the weights. A shard's number depends on nothing but
the key and that shard, so a further shard takes records only into itself, a shard that goes leaves the others' records
where they are, and a changed weight moves records only to or from the shard it belongs to.

A place inside a shard (slot) comes from one sort of narrow rows by (shard, key, ...), which Spark does by ranges: a row's
slot is its place in the whole order less the place of its shard's first row. The row number of the scan is the last
sort key, so a shard, and an id that holds a third of all rows, is cut into as many ranges as it needs.

Defined results: a missing key is the empty text, a key like any other. Rows that repeat a key share a shard and get
slots of their own; rows alike in every column may swap theirs. A weight of 0 takes nothing. An empty table gives an
empty one. Equal texts are no groups here: only the key and the shards decide.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.frames import columns_of, fresh, settled
from tallyline.operators.windows import row_index

LAW = "key"
#: The shards of the registered query, and their weights.
SHARDS = 8
#: Hexadecimal digits of the digest that make up u: 52 bits, which a double holds exactly.
DIGITS = 13


def draw(key: Column, shard: Column, weight: Column) -> Column:
    """The number a shard draws for a key; the least one wins."""
    digest = F.md5(F.concat(key, F.lit(":"), shard.cast("string")).cast("binary"))
    spot = F.conv(F.substring(digest, 1, DIGITS), 16, 10).cast("bigint").cast("double")
    return -F.log((spot + F.lit(0.5)) / F.lit(16.0**DIGITS)) / weight


def shard_of(key: Column, weights: Sequence[float]) -> Column:
    """The shard, from 0, that takes a key. weights: one for each shard, 0 or more, at least one of them more."""
    if min(weights, default=0) < 0 or not any(weights):
        raise ValueError("weights must not be negative, and one of them must be more than 0")
    text = F.coalesce(key.cast("string"), F.lit(""))
    shards = F.array(*[F.struct(F.lit(k).alias("shard"), F.lit(float(w)).alias("weight")) for k, w in enumerate(weights) if w])
    return F.array_min(F.transform(shards, lambda s: F.struct(draw(text, s["shard"], s["weight"]).alias("draw"), s["shard"].alias("shard"))))["shard"]


def assign(docs: DataFrame, weights: Sequence[float], key: str = "doc_id", name: str = "shard") -> DataFrame:
    """The rows with the shard that takes them; nothing is shuffled."""
    return docs.withColumn(name, shard_of(F.col(f"`{key}`"), weights))


def slots(rows: DataFrame, shard: str, order: Sequence[str], name: str = "slot") -> DataFrame:
    """Rows with their place in their shard, from 0 without gaps, in the given order. One row per shard is broadcast."""
    turn, place, first, own = fresh(rows, "turn", "place", "first", "own")
    numbered = settled(rows.withColumn(turn, F.monotonically_increasing_id()), "sharded")
    before = Window.orderBy(own).rowsBetween(Window.unboundedPreceding, -1)
    starts = numbered.groupBy(F.col(shard).alias(own)).agg(F.count(F.lit(1)).alias(place)).select(own, F.coalesce(F.sum(place).over(before), F.lit(0)).alias(first))
    placed = row_index(numbered, [shard, *order, turn], place, start=0).join(F.broadcast(starts), F.col(shard) == F.col(own))
    return placed.withColumn(name, F.col(place) - F.col(first)).drop(turn, place, first, own)


def plan(docs: DataFrame, weights: Sequence[float]) -> DataFrame:
    """One row for each document: its size and checksum, its shard and slot, and its shard if one more of weight 1 joined."""
    rows = columns_of(docs, doc_id="bigint", text="string")
    content = F.coalesce("text", F.lit(""))
    sharded = rows.select(
        "doc_id", (F.octet_length(content).cast("bigint") + 1).alias("size"), F.crc32(content.cast("binary")).alias("text_crc32"), F.lit(LAW).alias("law"),
        shard_of(F.col("doc_id"), weights).alias("shard"), shard_of(F.col("doc_id"), [*weights, 1.0]).alias("grown_shard"))
    return slots(sharded, "shard", ["doc_id", "text_crc32", "size"]).select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def write(docs: DataFrame, path: str, weights: Sequence[float], key: str = "doc_id", name: str = "shard") -> None:
    """The documents as Parquet, one folder for each shard, a shard in as many files as it has ranges of the order written."""
    turn, = fresh(docs, "turn")
    placed = assign(docs, weights, key, name).withColumn(turn, F.monotonically_increasing_id())
    placed.repartitionByRange(F.col(name), F.col(turn)).drop(turn).write.partitionBy(name).parquet(path)
