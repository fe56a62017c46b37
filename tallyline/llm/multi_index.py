"""Near-duplicate vectors by an inverted multi-index.

Unit vectors are cut in two halves, and each half has a codebook of its own; the pair of nearest centroids is the
cell of a vector, so k centroids a half make a grid of k * k cells. A vector visits cells in ascending order of the
sum of its two squared centroid distances (the multi-sequence order), its own first, until that sum exceeds the least
one by a slack. The slack is calibrated on the sample: partners at exactly the threshold are drawn for sampled
vectors, and the slack is the one with which the target part of them would be visited from either side. What is
visited is verified by cosine in double precision, so every link is right.

The codebooks are fitted on about SAMPLE vectors; every vector is indexed. Equal vectors are one until the end. A full
cell is dealt into blocks by hash, and every pair of blocks is a task; a task returns, for each vector, how many it
links to and the smallest of its cluster, and a pair that two tasks see counts in one of them only.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing; a shorter
vector counts as if zeros followed. Rows without id get a row without links; rows that
repeat an id are vectors of their own, and equal ones link with each other.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.components import components
from tallyline.llm.frames import columns_of, settled, small, total
from tallyline.llm.ngram_join import cluster_roots

THRESHOLD, RECALL = 0.95, 0.99
SAMPLE, CELL, MOST_CENTROIDS, ROUNDS = 10_000, 200, 256, 12
BLOCK = 128
CODED_SQL = "vec_id bigint, key binary, vec binary"
PLACED_SQL = "rep bigint, members bigint, vec binary, home int, visits array<int>"
TASK_SQL = "cell int, kind int, i int, j int, side int, rep bigint, members bigint, vec binary, home int, visits array<int>"
LINKED_SQL = "rep bigint, links bigint, root bigint"


def coded(batches, width: int):
    """Vectors as bytes of doubles, scaled so that the largest component is 1; key is empty where nothing can link."""
    for batch in batches:
        column = batch.column("embedding")
        keys, vectors = [], []
        for row in column:
            values = np.array([np.nan if x is None else x for x in row.as_py()] if row.is_valid else [], np.float64)
            top = np.abs(values).max(initial=0)
            if len(values) and np.isfinite(values).all() and top > 0:
                vectors.append(np.pad(values / top, (0, width - len(values))).tobytes())
                keys.append(xxhash.xxh3_128_digest(np.pad(values, (0, width - len(values))).tobytes()))
            else:
                vectors.append(b"")
                keys.append(b"")
        yield pa.RecordBatch.from_arrays([batch.column("vec_id"), pa.array(keys, pa.binary()), pa.array(vectors, pa.binary())], names=["vec_id", "key", "vec"])


def unit(blobs) -> np.ndarray:
    rows = np.stack([np.frombuffer(b, np.float64) for b in blobs])
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def halves(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    middle = vectors.shape[1] // 2
    return vectors[:, :middle], vectors[:, middle:]


def far(points: np.ndarray, centers: np.ndarray) -> np.ndarray:
    """Squared distances."""
    return np.maximum((points**2).sum(axis=1)[:, None] - 2 * points @ centers.T + (centers**2).sum(axis=1)[None, :], 0)


def codebook(points: np.ndarray, count: int, draw) -> np.ndarray:
    """Lloyd's algorithm from random points."""
    centers = points[draw.choice(len(points), min(count, len(points)), replace=False)]
    for _ in range(ROUNDS):
        near = far(points, centers).argmin(axis=1)
        sums = np.zeros_like(centers)
        np.add.at(sums, near, points)
        size = np.bincount(near, minlength=len(centers))
        centers = np.where(size[:, None] > 0, sums / np.maximum(size, 1)[:, None], centers)
    return centers


def fit(vectors: np.ndarray, count: int, threshold: float, recall: float) -> dict:
    """Codebooks of `count` centroids and the slack for the target recall."""
    draw = np.random.default_rng(11)
    books = [codebook(part, count, draw) for part in halves(vectors)]
    other = draw.normal(size=vectors.shape)
    other -= (other * vectors).sum(axis=1, keepdims=True) * vectors
    other /= np.maximum(np.linalg.norm(other, axis=1, keepdims=True), 1e-300)
    partners = threshold * vectors + np.sqrt(1 - threshold**2) * other
    costs = [[far(p, b) for p, b in zip(halves(v), books, strict=True)] for v in (vectors, partners)]
    homes = [[c.argmin(axis=1) for c in pair] for pair in costs]
    rows = np.arange(len(vectors))
    excess = [
        sum(c[rows, h] - c.min(axis=1) for c, h in zip(costs[a], homes[1 - a], strict=True)) for a in (0, 1)]
    return {"books": books, "slack": float(np.quantile(np.minimum(*excess), recall)) + 1e-12}


def visited(vectors: np.ndarray, model: dict) -> tuple[np.ndarray, list[list[int]]]:
    """The own cell and all cells within the slack, nearest first, of every vector."""
    order, over = [], []
    for part, book in zip(halves(vectors), model["books"], strict=True):
        cost = far(part, book)
        rank = np.argsort(cost, axis=1, kind="stable")
        order.append(rank)
        over.append(np.take_along_axis(cost, rank, axis=1) - cost.min(axis=1, keepdims=True))
    width = len(model["books"][1])
    reach = [int((o <= model["slack"]).sum(axis=1).max(initial=1)) for o in over]
    who, cell, cost = [], [], []
    for a in range(reach[0]):
        for b in range(reach[1]):
            total_cost = over[0][:, a] + over[1][:, b]
            near = np.flatnonzero((total_cost <= model["slack"]) | (a + b == 0))
            who.append(near)
            cell.append(order[0][near, a] * width + order[1][near, b])
            cost.append(total_cost[near])
    who, cell, cost = np.concatenate(who), np.concatenate(cell), np.concatenate(cost)
    at = np.lexsort((cost, who))
    edges = np.searchsorted(who[at], np.arange(len(vectors) + 1))
    cells = cell[at]
    return order[0][:, 0] * width + order[1][:, 0], [cells[a:z].tolist() for a, z in zip(edges[:-1], edges[1:], strict=True)]


def placed(batches, sent):
    for batch in batches:
        if batch.num_rows:
            home, visits = visited(unit(batch.column("vec").to_pylist()), sent.value)
            yield pa.RecordBatch.from_arrays(
                [batch.column("rep"), batch.column("members"), batch.column("vec"), pa.array(home.astype(np.int32)), pa.array(visits, pa.list_(pa.int32()))],
                names=["rep", "members", "vec", "home", "visits"])


def linked(group: pa.Table, threshold: float) -> pa.Table:
    """The links of one pair of blocks. Kind 0: both hold vectors at home in the cell; 1: those of side 1 only visit."""
    group = group.combine_chunks().sort_by("rep")
    cell, kind, i, j = (group.column(c)[0].as_py() for c in ("cell", "kind", "i", "j"))
    vectors = unit(group.column("vec").to_pylist())
    near = vectors @ vectors.T >= threshold
    np.fill_diagonal(near, False)
    side = np.asarray(group.column("side"))
    if kind or i != j:
        near &= side[:, None] != side[None, :]
    counted = near
    if kind:
        # A visitor's own cell sees the pair as well if the vector at home here visits it: the lower cell counts.
        home = np.asarray(group.column("home"))
        sets = [set(v) for v in group.column("visits").to_pylist()]
        lower = [h for h in set(home[side == 1].tolist()) if h < cell]
        there = np.array([[h in s for h in lower] for s in sets], bool).reshape(len(sets), len(lower))
        own = np.array([[h == x for h in lower] for x in home.tolist()], bool).reshape(there.shape)
        twice = (own.astype(np.float32) @ there.T.astype(np.float32)) > 0  # [visitor, resident]
        twice &= (side[:, None] == 1) & (side[None, :] == 0)
        counted = near & ~(twice | twice.T)
    members, reps = np.asarray(group.column("members")), np.asarray(group.column("rep"))
    roots = reps[cluster_roots(near)]
    full = np.flatnonzero(near.any(axis=1))
    return pa.table({"rep": pa.array(reps[full]), "links": pa.array((counted.astype(np.int64) @ members)[full]), "root": pa.array(roots[full])})


def join(table: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL, sample: int = SAMPLE) -> DataFrame:
    """One row for each row of the table: vec_id, n_links, component_id, kept.

    Equal vectors form a class with a number of its own, so rows that repeat a vec_id are compared with their own vectors.
    """
    rows = columns_of(table, vec_id="bigint", embedding="array<double>")
    named = rows.filter("vec_id IS NOT NULL")
    width = max(2, total(named, F.max(F.size("embedding")))[0])
    one = settled(named.mapInArrow(lambda batches: coded(batches, width), CODED_SQL), "vectors")
    same = one.filter("length(key) > 0").groupBy("key").agg(F.min("vec_id").alias("least"), F.count("*").alias("members"), F.min("vec").alias("vec"))
    classes = settled(same.withColumn("rep", F.monotonically_increasing_id()), "classes")
    count = classes.count()
    out = one.select("vec_id", "key")
    if count > 1:
        spot = F.xxhash64("key", F.lit("sample")) / F.lit(2.0**64) + F.lit(0.5)
        drawn = classes.filter(spot < sample / count).select("key", "vec").orderBy("key").toArrow()  # about `sample` vectors
        if drawn.num_rows < 2:
            drawn = classes.select("key", "vec").orderBy("key").limit(2).toArrow()
        centroids = int(np.clip(round((count / CELL) ** 0.5), 2, MOST_CENTROIDS))
        sent = table.sparkSession.sparkContext.broadcast(fit(unit(drawn.column("vec").to_pylist()), centroids, threshold, recall))
        index = settled(classes.select("rep", "members", "vec").mapInArrow(lambda batches: placed(batches, sent), PLACED_SQL), "index")
        each = index.select("*", F.explode("visits").alias("cell"))
        sizes = small(settled(each.groupBy(F.col("cell").alias("c")).agg(
            F.ceil(F.sum((F.col("home") == F.col("cell")).cast("int")) / BLOCK).cast("int").alias("at_home"),
            F.ceil(F.sum((F.col("home") != F.col("cell")).cast("int")) / BLOCK).cast("int").alias("guests")).filter("at_home > 0"), "cells"))
        spread = each.join(sizes, F.col("cell") == F.col("c"))
        mine = F.pmod(F.xxhash64("rep", "cell"), F.when(F.col("home") == F.col("cell"), F.col("at_home")).otherwise(F.col("guests"))).cast("int")
        spread = spread.withColumn("mine", mine)
        # A vector at home meets every block at home (the lower block is side 0) and every block of guests; a guest every block at home.
        residents = F.transform(F.sequence(F.lit(0), F.col("at_home") - 1), lambda b: F.struct(
            F.lit(0).alias("kind"), F.least(b, F.col("mine")).alias("i"), F.greatest(b, F.col("mine")).alias("j"), (F.col("mine") > b).cast("int").alias("side")))
        hosts = F.when(F.col("guests") > 0, F.transform(F.sequence(F.lit(0), F.greatest(F.col("guests") - 1, F.lit(0))), lambda b: F.struct(
            F.lit(1).alias("kind"), F.col("mine").alias("i"), b.alias("j"), F.lit(0).alias("side")))).otherwise(F.filter(residents, lambda x: F.lit(False)))
        guests = F.transform(F.sequence(F.lit(0), F.col("at_home") - 1), lambda b: F.struct(F.lit(1).alias("kind"), b.alias("i"), F.col("mine").alias("j"), F.lit(1).alias("side")))
        tasks = spread.select("cell", F.explode(F.when(F.col("home") == F.col("cell"), F.concat(residents, hosts)).otherwise(guests)).alias("task"), "rep", "members", "vec", "home", "visits")
        tasks = tasks.select("cell", "task.*", "rep", "members", "vec", "home", "visits")
        found = settled(tasks.groupBy("cell", "kind", "i", "j").applyInArrow(lambda group: linked(group, threshold), LINKED_SQL), "links")
        roots = components(found.select(F.col("rep").alias("u"), F.col("root").alias("v"))).withColumnRenamed("node", "linked_rep")
        links = found.groupBy(F.col("rep").alias("counted_rep")).agg(F.sum("links").alias("links"))
        of_class = classes.select(F.col("key").alias("k"), "rep", "least", "members").join(links, F.col("rep") == F.col("counted_rep"), "left").join(
            roots, F.col("rep") == F.col("linked_rep"), "left")
    else:
        of_class = classes.select(F.col("key").alias("k"), "rep", "least", "members", F.lit(0).alias("links"), F.col("rep").alias("root"))
    of_class = settled(of_class.select("k", "least", (F.col("members") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", "rep").alias("root")), "linked")
    smallest = of_class.groupBy(F.col("root").alias("component")).agg(F.min("least").alias("component_id"))
    of_class = of_class.join(smallest, F.col("root") == F.col("component"))
    out = out.join(of_class, F.col("key") == F.col("k"), "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    out = out.unionByName(rows.filter("vec_id IS NULL").select("vec_id", F.lit(0).cast("bigint").alias("n_links"), F.col("vec_id").alias("component_id")))
    return out.withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
