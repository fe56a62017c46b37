"""The prefix trie of conversations: double arrays by prefix shard, upper nodes merged over all shards.

A turn is known by a 128-bit digest of role and text, a conversation's path is its turns' digests in a row. Equal paths
are counted first. The distinct paths are sorted by ranges and cut into shards of about SHARD_TURNS turns, so each shard
is a run of neighbouring prefixes whatever their shares; it numbers its turns densely and packs them into a double array
(double_array), written as one row. Traversing the arrays level by level gives the nodes and their sums.

Only what two neighbouring shards have in common, the beginning of the last path of one and the first of the next, lies
in several shards. These nodes' parts are added up over all shards. Such a node's subtree holds the shared nodes below
it in the shard it starts in and all that start in shards before the last one it reaches, so what they add to it follows
from running sums over the shards. No task needs more than a shard, a node's parts, or one row for each shard.

A path is one row of 24 bytes for each turn. The ids of the conversations that end in a node are hashed in their order,
joined beforehand to texts of CHUNK ids by ranges.

Defined results: rows without conv_id belong to no conversation. A missing turn comes first; equal turns of a
conversation go by role, then by the digest; repeated rows are turns of their own. Missing role or text are empty. An
empty table has no node.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.llm.double_array import DoubleArray, nodes_of
from tallyline.llm.frames import columns_of, settled, small
from tallyline.operators.windows import row_index
from tallyline.session import scratch_folder

#: Conversations of one group of GROUP ids may begin with up to MOST - 1 turns of the group's first.
GROUP, MOST = 100, 6
#: Turns of a shard, ids of a text that is hashed, bytes of a turn's digest.
SHARD_TURNS, CHUNK, WIDTH = 1 << 18, 8_192, 16
EMPTY = hashlib.sha256(b"").hexdigest()

SHARD = """shard bigint, first binary, last binary, turns binary, chars binary, base binary, `check` binary,
    ends binary, n_ends binary, conv_ends binary, hashes array<string>"""
NODE = """shared boolean, shard bigint, node binary, above binary, conv_id bigint, depth bigint, parent_conv_id bigint, n_convs bigint,
    n_children bigint, n_leaves bigint, saved_tokens bigint, chars bigint, ends_sha256 string"""
RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def turns_of(conversations: DataFrame) -> DataFrame:
    """conv_id, i (place in the conversation, from 0), key (digest in hexadecimal) and chars of every turn.

    Places come from one sort of narrow rows by ranges, so a conversation of any length is spread over tasks.
    """
    rows = columns_of(conversations, conv_id="bigint", turn="bigint", role="string", text="string").filter("conv_id IS NOT NULL").na.fill("", ["role", "text"])
    content = F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text"))
    narrow = rows.select("conv_id", "turn", "role", F.substring(F.sha2(content.cast("binary"), 256), 1, 2 * WIDTH).alias("key"), F.char_length("text").cast("bigint").alias("chars"))
    numbered = settled(narrow.withColumn("at", F.monotonically_increasing_id()), "turns")
    placed = row_index(numbered, ["conv_id", "turn", "role", "key", "at"], "place", start=0)
    first = placed.groupBy(F.col("conv_id").alias("of")).agg(F.min("place").alias("first"))
    return placed.join(first, F.col("conv_id") == F.col("of")).select("conv_id", (F.col("place") - F.col("first")).alias("i"), "key", "chars")


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, path, chars of every conversation, its first turns replaced by those of its group's first conversation.

    turns: as turns_of gives them. A conversation c takes crc32(c) % MOST turns from conversation c - c % GROUP.
    """
    ids = turns.filter("i = 0").select("conv_id", (F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST).alias("taken"), (F.col("conv_id") - F.col("conv_id") % GROUP).alias("base"))
    own = turns.withColumn("taken", F.crc32(F.col("conv_id").cast("string").cast("binary")) % MOST).filter("i >= taken")
    # Bounded: at most MOST - 1 turns of each first conversation.
    heads = turns.filter((F.col("i") < MOST - 1) & (F.col("conv_id") % GROUP == 0)).groupBy(F.col("conv_id").alias("head")).agg(F.collect_list(F.struct("i", "key", "chars")).alias("turns"))
    given = ids.join(heads, F.col("base") == F.col("head")).select("conv_id", "taken", F.explode("turns").alias("t")).filter("t.i < taken").select("conv_id", "t")
    # Own turns come after the ones taken over, whose places are below MOST.
    rest = own.select("conv_id", F.struct((F.col("i") + MOST).alias("i"), "key", "chars").alias("t"))
    none = ids.select("conv_id", F.lit(None).cast(rest.schema["t"].dataType).alias("t"))
    in_order = given.unionByName(rest).unionByName(none).groupBy("conv_id").agg(F.array_sort(F.collect_list("t")).alias("t"))
    return in_order.select("conv_id", F.unhex(F.array_join(F.transform("t", lambda t: t["key"]), "")).alias("path"), F.transform("t", lambda t: t["chars"]).alias("chars"))


def joined_ids(batches) -> Iterator[pa.RecordBatch]:
    """Of rows (node, conv_id) in order: for each run of up to CHUNK rows of a node its first conv_id, their number and the ids joined."""
    node, ids = None, []

    def row():
        return pa.RecordBatch.from_arrays([pa.array([node]), pa.array([ids[0]], pa.int64()), pa.array([len(ids)], pa.int64()), pa.array([",".join(map(str, ids))])], ["node", "conv_id", "n", "ids"])

    for batch in batches:
        for n, c in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if ids and (n != node or len(ids) == CHUNK):
                yield row()
                ids = []
            node = n
            ids.append(c)
    if ids:
        yield row()


def hashed_ids(batches) -> Iterator[pa.RecordBatch]:
    """Of rows of joined_ids in order: one row for each node, with the hash of all its ids. The texts pass by one at a time."""
    node = state = first = None
    n = 0

    def row():
        return pa.RecordBatch.from_arrays([pa.array([first], pa.int64()), pa.array([n], pa.int64()), pa.array([state.hexdigest()])], ["first", "n", "hash"])

    for batch in batches:
        for key, conv_id, count, ids in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if state is not None and key == node:
                state.update(b",")
            else:
                if state is not None:
                    yield row()
                node, state, first, n = key, hashlib.sha256(), conv_id, 0
            state.update(ids.encode())
            n += count
    if state is not None:
        yield row()


def distinct_paths(convs: DataFrame) -> DataFrame:
    """path, chars, n, conv_id (the smallest) and hash (of all conv_ids) of every distinct path."""
    ends = convs.select(F.sha2("path", 256).alias("node"), "conv_id").repartitionByRange("node", "conv_id").sortWithinPartitions("node", "conv_id")
    chunks = ends.mapInArrow(joined_ids, "node string, conv_id bigint, n bigint, ids string")
    found = chunks.repartition("node").sortWithinPartitions("node", "conv_id").mapInArrow(hashed_ids, "first bigint, n bigint, hash string")
    return convs.join(found, F.col("conv_id") == F.col("first")).select("path", "chars", "n", "conv_id", "hash")


def packed(rows: list[dict], shard: int) -> pa.RecordBatch:
    """One shard's row: its turns, the double array of its paths (which are sorted), and what ends in which slot."""
    sizes = np.fromiter((len(r["path"]) // WIDTH for r in rows), np.int64, len(rows))
    starts = np.concatenate([[0], np.cumsum(sizes)])
    blob = b"".join(r["path"] for r in rows)
    coded = pa.FixedSizeBinaryArray.from_buffers(pa.binary(WIDTH), len(blob) // WIDTH, [None, pa.py_buffer(blob)]).dictionary_encode()
    ids = np.asarray(coded.indices, np.int64)
    chars = np.zeros(len(coded.dictionary), np.int64)
    chars[ids] = np.fromiter((x for r in rows for x in r["chars"]), np.int64, len(ids))
    parents, labels, ends = nodes_of(ids, starts)
    trie, slot = DoubleArray.packed(parents, labels)
    plain = [rows[0]["path"], rows[-1]["path"], b"".join(coded.dictionary.to_pylist())]
    arrays = [chars, trie.base, trie.check, slot[ends], np.array([r["n"] for r in rows]), np.array([r["conv_id"] for r in rows])]
    columns = [pa.array([x], pa.binary()) for x in [*plain, *(np.asarray(a, np.int64).tobytes() for a in arrays)]]
    names = ["first", "last", "turns", "chars", "base", "check", "ends", "n_ends", "conv_ends"]
    return pa.RecordBatch.from_arrays([pa.array([shard], pa.int64()), *columns, pa.array([[r["hash"] for r in rows]])], ["shard", *names, "hashes"])


def shards(most: int):
    """Of sorted paths with the number of their partition: one row for each run of about `most` turns."""

    def plan(batches):
        rows, turns, shard = [], 0, None
        for batch in batches:
            # A few rows at a time: a row may hold a very long path.
            for piece in (batch.slice(k, 256) for k in range(0, batch.num_rows, 256)):
                for r in piece.to_pylist():
                    shard = r["part"] << 32 if shard is None else shard
                    rows.append(r)
                    turns += len(r["path"]) // WIDTH + 1
                    if turns >= most:
                        yield packed(rows, shard)
                        rows, turns, shard = [], 0, shard + 1
        if rows:
            yield packed(rows, shard)

    return plan


def write(conversations: DataFrame, path: str, shard_turns: int | None = None) -> None:
    """The packed trie of the rebuilt conversations as Parquet, one row for each shard, in the order of their prefixes."""
    convs = settled(rebuilt(settled(turns_of(conversations), "places")), "paths")
    ranged = distinct_paths(convs).repartitionByRange("path").sortWithinPartitions("path").withColumn("part", F.spark_partition_id().cast("bigint"))
    ranged.mapInArrow(shards(shard_turns or SHARD_TURNS), SHARD).write.parquet(path)


def common(batches) -> Iterator[pa.RecordBatch]:
    """Of rows (shard, a, b): how many turns the paths a and b have in common at their beginning."""
    for batch in batches:
        counts = []
        for a, b in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist(), strict=True):
            size = min(len(a or b""), len(b or b""))
            same = np.frombuffer(a or b"", np.uint8)[:size] == np.frombuffer(b or b"", np.uint8)[:size]
            counts.append((size if same.all() else int(np.argmin(same))) // WIDTH)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(counts, pa.int64())], ["shard", "n"])


def neighbours(trie: DataFrame) -> DataFrame:
    """shard, before, after: turns that a shard's first and last path share with the neighbouring shards'."""
    in_order = Window.orderBy("shard")
    pairs = trie.select("shard", F.col("last").alias("a"), F.lead("first").over(in_order).alias("b"))
    after = settled(pairs.mapInArrow(common, "shard bigint, n bigint"), "neighbours")
    return after.select(F.col("shard").alias("at"), F.coalesce(F.lag("n").over(in_order), F.lit(0)).alias("before"), F.col("n").alias("after"))


def traversed(row: dict) -> pa.RecordBatch:
    """The nodes of one shard. Of a node that other shards hold as well, only what this shard adds to it."""
    read = {k: np.frombuffer(row[k], np.int64) for k in ("chars", "base", "check", "ends", "n_ends", "conv_ends")}
    trie = DoubleArray(read["base"], read["check"])
    size = len(trie.check)
    turns = pa.FixedSizeBinaryArray.from_buffers(pa.binary(WIDTH), len(row["turns"]) // WIDTH, [None, pa.py_buffer(row["turns"])])
    digest = np.full(size, None, object)
    for path, most in ((row["first"], row["before"]), (row["last"], row["after"])):
        keys = pa.FixedSizeBinaryArray.from_buffers(pa.binary(WIDTH), most, [None, pa.py_buffer(path[: most * WIDTH])])
        state = hashlib.sha256()
        for depth, s in enumerate(trie.walk(np.asarray(pc.fill_null(pc.index_in(keys, turns), -1), np.int64))):
            state.update(path[(depth - 1) * WIDTH : depth * WIDTH] if depth else b"")
            digest[s] = state.digest()[:WIDTH]
    shared = digest != None  # noqa: E711
    n, conv, hashes = np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max), np.full(size, EMPTY, object)
    n[read["ends"]], conv[read["ends"]], hashes[read["ends"]] = read["n_ends"], read["conv_ends"], row["hashes"]
    levels = trie.levels()
    depths, chars = np.zeros(size, np.int64), np.zeros(size, np.int64)
    for depth, slots in enumerate(levels[1:], 1):
        depths[slots], chars[slots] = depth, read["chars"][trie.labels(slots)]
    children = np.bincount(trie.check[trie.check >= 0], minlength=size)
    leaves, saved = ((children == 0) & ~shared).astype(np.int64), np.zeros(size, np.int64)
    for slots in reversed(levels):
        saved[slots] += np.where(shared[slots], 0, (n[slots] - 1) * chars[slots])
        up = trie.check[slots]
        if up[0] >= 0:
            np.add.at(n, up, n[slots])
            np.minimum.at(conv, up, conv[slots])
            np.add.at(leaves, up, leaves[slots])
            np.add.at(saved, up, saved[slots])
    slots = np.concatenate(levels)
    up = np.maximum(trie.check[slots], 0)
    known = (slots > 0) & ~shared[up]
    columns = {
        "shared": shared[slots], "shard": np.full(len(slots), row["shard"]), "node": pa.array(digest[slots], pa.binary()),
        "above": pa.array(np.where(slots > 0, digest[up], None), pa.binary()), "conv_id": conv[slots], "depth": depths[slots],
        "parent_conv_id": pa.array(conv[up], pa.int64(), mask=~known), "n_convs": n[slots], "n_children": children[slots], "n_leaves": leaves[slots],
        "saved_tokens": saved[slots], "chars": chars[slots], "ends_sha256": pa.array(hashes[slots], pa.string())}
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], list(columns))


def traversal(batches) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            yield traversed(batch.slice(k, 1).to_pylist()[0])


def merged(parts: DataFrame, edges: DataFrame) -> DataFrame:
    """The shared nodes, their parts added up over all shards. edges: one row (at) for each shard."""
    once = parts.groupBy("node").agg(
        F.min("conv_id").alias("conv_id"), F.max("depth").alias("depth"), F.max("above").alias("above"), F.sum("n_convs").alias("n_convs"), F.sum("n_children").alias("families"),
        F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"), F.max("chars").alias("chars"), F.max(F.when(F.col("ends_sha256") != EMPTY, F.col("ends_sha256"))).alias("hash"),
        F.min("shard").alias("from"), F.max("shard").alias("to"), (F.count(F.lit(1)) - 1).alias("again"))
    once = settled(once, "shared")
    # A child that several shards hold was counted in each of them.
    again = once.filter("above IS NOT NULL").groupBy(F.col("above").alias("of")).agg(F.sum("again").alias("repeats"))
    counted = once.join(again, F.col("node") == F.col("of"), "left").withColumn("n_children", F.col("families") - F.coalesce("repeats", F.lit(0)))
    own = counted.withColumns({"leaf": (F.col("n_children") == 0).cast("bigint"), "own": (F.col("n_convs") - 1) * F.col("chars")})
    # Shared nodes that start in one shard lie on one path: its last.
    below = Window.partitionBy("from").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    chained = settled(own.withColumns({"leaf_below": F.sum("leaf").over(below), "own_below": F.sum("own").over(below)}), "chained")
    by_shard = chained.groupBy(F.col("from").alias("start")).agg(F.sum("leaf").alias("leaf"), F.sum("own").alias("own"))
    so_far = Window.orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    sums = settled(edges.select("at").join(by_shard, F.col("at") == F.col("start"), "left").select(
        "at", *[F.coalesce(F.sum(c).over(so_far), F.lit(0)).alias(f"{c}_to") for c in ("leaf", "own")],
        F.coalesce("leaf", F.lit(0)).alias("leaf_here"), F.coalesce("own", F.lit(0)).alias("own_here")), "sums")
    ends = sums.select(F.col("at").alias("last"), *[(F.col(f"{c}_to") - F.col(f"{c}_here")).alias(f"{c}_before") for c in ("leaf", "own")])
    placed = chained.join(sums, F.col("from") == F.col("at")).join(ends, F.col("to") == F.col("last"))
    several = F.col("to") > F.col("from")
    return settled(placed.select(
        "node", "above", "conv_id", "depth", "n_convs", "n_children",
        (F.col("leaves") + F.col("leaf_below") + F.when(several, F.col("leaf_before") - F.col("leaf_to")).otherwise(0)).alias("n_leaves"),
        (F.col("saved") + F.col("own_below") + F.when(several, F.col("own_before") - F.col("own_to")).otherwise(0)).alias("saved_tokens"),
        F.coalesce("hash", F.lit(EMPTY)).alias("ends_sha256")), "merged")


def read(spark: SparkSession, path: str) -> DataFrame:
    """All nodes of a written trie, one row each."""
    trie = spark.read.parquet(path)
    edges = settled(neighbours(trie), "edges")
    found = settled(trie.join(small(edges), F.col("shard") == F.col("at")).drop("at").mapInArrow(traversal, NODE), "nodes")
    top = merged(found.filter("shared"), edges)
    parents = top.select(F.col("node").alias("over"), F.col("conv_id").alias("over_id"))
    whole = found.filter("NOT shared AND above IS NULL").select(*RESULT)
    hanging = found.filter("NOT shared AND above IS NOT NULL").drop("parent_conv_id").join(parents, F.col("above") == F.col("over"), "left").withColumnRenamed("over_id", "parent_conv_id")
    upper = top.join(parents, F.col("above") == F.col("over"), "left").withColumnRenamed("over_id", "parent_conv_id")
    return whole.unionByName(hanging.select(*RESULT)).unionByName(upper.select(*RESULT))


def nodes(conversations: DataFrame, shard_turns: int | None = None) -> DataFrame:
    """One row for each node of the trie of the rebuilt conversations."""
    path = scratch_folder(conversations.sparkSession, "trie")
    write(conversations, path, shard_turns)
    return read(conversations.sparkSession, path)
